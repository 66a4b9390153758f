"""Column expressions: text, dates, vectors, rules."""
