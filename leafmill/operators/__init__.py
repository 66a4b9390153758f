"""Relational, near-duplicate and graph operators."""
