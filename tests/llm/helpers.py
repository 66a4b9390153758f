"""Small corpora with the awkward cases, and plain-Python versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string"


def corpus(n: int = 60, seed: int = 0) -> list[tuple]:
    """Rows with nulls in any column, empty and blank texts, copies, near copies, shared passages, a long text, repeated rows."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéñß") for _ in range(r.randint(2, 7))) for _ in range(400)]
    prose = lambda k: " ".join(r.choice(vocab) + r.choice(["", "", ",", ".\n"]) for _ in range(k))
    shared = [prose(30) for _ in range(3)]
    texts: list[str | None] = [None, "", " \n\t", "one", "two words", "!!!", prose(3000)]
    while len(texts) < n:
        k = r.random()
        if k < 0.2:
            texts.append(r.choice(texts))
        elif k < 0.45:
            w = (r.choice([t for t in texts if t and len(t) > 300] or [prose(80)])).split(" ")
            for _ in range(r.randint(1, 4)):
                w[r.randrange(len(w))] = r.choice(vocab)
            texts.append(" ".join(w))
        elif k < 0.7:
            texts.append(prose(r.randint(5, 60)) + " " + r.choice(shared) + " " + prose(r.randint(5, 60)))
        else:
            texts.append(prose(r.randint(20, 150)))
    rows = [(i * 3 % 101, t, r.choice(["xx", "yy", None]), r.choice(["s", None]), None if t is None else len(t), 0.5, "x") for i, t in enumerate(texts)]
    rows.append(rows[10])  # a row repeated
    rows.append((None, texts[12], None, None, None, None, None))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def shingle_set(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
