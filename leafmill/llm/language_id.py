"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram's vector binds its letters' vectors, each permuted by its
place (v = rot2(a) * rot1(b) * c), and a text's vector bundles (adds) those of all its trigrams. A language's
prototype is the bundle of all training texts of the language; a text takes the language of the nearest prototype
by cosine. Letters are lower-cased; all else is one gap, which counts as a letter between words.

Cases: a null text or one without a letter is "und" with score 0; equal cosines go to the first language in
alphabetical order; with no training rows all is "und"; repeated rows train as often as they stand and are each
answered; very long texts are read whole, in slices; null ids and null languages never train; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafmill.llm.arrow import grouped, id_texts, mapped
from leafmill.llm.common import fold

DIMENSIONS, SEED = 1024, 20
SLICE = 1 << 20
MASK = (1 << 21) - 1


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, 0 for anything but letters."""
    out = np.zeros(0x110000, np.int64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low[0])
    return out


@lru_cache(4096)
def _vector(letter: int, d: int) -> np.ndarray:
    return (np.random.default_rng([SEED, letter]).integers(0, 2, d, dtype=np.int8) * 2 - 1).astype(np.int8)


def _gather(letters: np.ndarray, d: int, turn: int) -> np.ndarray:
    """Rotated vectors of the letters, one row each."""
    own, inverse = np.unique(letters, return_inverse=True)
    return np.stack([np.roll(_vector(int(x), d), turn) for x in own])[inverse]


def trigram_vectors(codes: np.ndarray, d: int = DIMENSIONS) -> np.ndarray:
    return _gather(codes >> 42, d, 2) * _gather((codes >> 21) & MASK, d, 1) * _gather(codes & MASK, d, 0)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a text as 63-bit codes, and how often each stands. None if there is no letter."""
    table, seen, counts = _letters(), [], []
    text = text or ""
    carry = np.zeros(1, np.int64)
    for at in range(0, len(text), SLICE):
        x = table[np.frombuffer(text[at : at + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)]
        x = np.concatenate([carry, x, np.zeros(int(at + SLICE >= len(text)), np.int64)])
        x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]
        if len(x) > 2:
            u, n = np.unique((x[:-2] << 42) | (x[1:-1] << 21) | x[2:], return_counts=True)
            seen.append(u)
            counts.append(n)
        carry = x[-2:]
    if not seen:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, inverse = np.unique(np.concatenate(seen), return_inverse=True)
    return u, np.bincount(inverse, np.concatenate(counts)).astype(np.int64)


def bundles(texts: list[str | None], d: int = DIMENSIONS) -> np.ndarray:
    """One hypervector per text; zero for a text without a letter."""
    found = [trigrams(t) for t in texts]
    own, inverse = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
    out, done = np.zeros((len(texts), d), np.float32), 0
    if not len(own):
        return out
    counts = np.zeros((len(texts), len(own)), np.float32)
    for i, (c, n) in enumerate(found):
        counts[i, inverse[done : done + len(c)]] = n
        done += len(c)
    for at in range(0, len(own), 4096):
        out += counts[:, at : at + 4096] @ trigram_vectors(own[at : at + 4096], d).astype(np.float32)
    return out


def train(documents: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototypes, scaled to length 1. documents: text, lang. Reads all rows."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for langs, texts in id_texts(batches):
            found = [trigrams(t) for t in texts]
            for lang in set(langs):
                codes = [f for f, l in zip(found, langs, strict=True) if l == lang]
                own, inverse = np.unique(np.concatenate([c for c, _ in codes]), return_inverse=True)
                if len(own):
                    n = np.bincount(inverse, np.concatenate([n for _, n in codes])).astype(np.float32)
                    for at in range(0, len(own), 4096):
                        total[lang] = total.get(lang, 0) + (n[at : at + 4096] @ trigram_vectors(own[at : at + 4096], dimensions).astype(np.float32)).astype(np.float64)
        if total:
            yield pa.RecordBatch.from_pydict({"lang": list(total), "v": [v.tolist() for v in total.values()]}, pa.schema([("lang", pa.string()), ("v", pa.list_(pa.float64()))]))

    rows = mapped(documents.where(F.col("lang").isNotNull()).select("lang", "text"), sums, "lang string, v array<double>")
    # one row per language and dimension, whatever the size of the corpus
    summed = rows.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()
    langs = sorted({r["lang"] for r in summed})
    out, at = np.zeros((len(langs), dimensions)), {l: k for k, l in enumerate(langs)}
    for r in summed:
        out[at[r["lang"]], r["i"]] = r["x"]
    return langs, out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def annotate(documents: DataFrame, langs: list[str], prototypes: np.ndarray) -> DataFrame:
    """documents with lang_pred, score (cosine, 0 to 1) and margin (to the next language); rows don't move."""
    model = documents.sparkSession.sparkContext.broadcast((langs, prototypes.astype(np.float32)))  # languages x dimensions
    fresh = ["lang_pred", "score", "margin"]
    documents = documents.drop(*fresh)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, p = model.value
        for b in batches:
            pred, score, margin, done = [], [], [], 0
            texts = b.column(at).to_pylist()
            for part in grouped(texts, lambda t: len(t or "") + 64, 1 << 20):
                h = bundles(part, p.shape[1] if names else DIMENSIONS)
                size = np.linalg.norm(h, axis=1)
                cos = (h @ p.T) / np.maximum(size, 1e-9)[:, None] if names else np.zeros((len(part), 1))
                best, order = cos.argmax(1), np.sort(cos, axis=1)
                lone = (size == 0) | (not names)
                pred += ["und" if z else names[k] for k, z in zip(best, lone, strict=True)]
                score += np.where(lone, 0.0, np.clip(order[:, -1], 0, 1)).tolist()
                margin += np.where(lone, 0.0, order[:, -1] - (order[:, -2] if cos.shape[1] > 1 else 0)).tolist()
                done += len(part)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())], names=[*b.schema.names, *fresh])

    return mapped(documents, run, StructType([*documents.schema.fields, *StructType.fromDDL("lang_pred string, score double, margin double").fields]))


def predict(documents: DataFrame, langs: list[str], prototypes: np.ndarray) -> DataFrame:
    """doc_id, lang_pred, score, margin."""
    return annotate(documents.select("doc_id", "text"), langs, prototypes).drop("text")


def batch_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def identify(documents: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Train on the rows whose fold isn't held out, then answer for all: doc_id, held_out, lang_pred, score, margin."""
    langs, prototypes = train(documents.where(fold("doc_id", folds) != held))
    out = predict(documents, langs, prototypes)
    return out.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "lang_pred", "score", "margin")
