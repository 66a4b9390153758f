"""Quality scores from document statistics: random Fourier features, ridge, isotonic calibration.

Statistics of each text are standardised and mapped to random Fourier features, whose inner products approximate a
Gaussian kernel. Ridge scores solve the normal equations, which each task sums over its rows; only the sums move.
Isotonic regression over a histogram of the scores of labelled rows kept from the ridge turns them into rates of label 1.

Cases: null and empty texts have all-zero statistics and a score like any other; null labels don't train; with no
labelled row every score is 0.5; of differing labels for one id the larger holds; repeated rows are each scored;
texts are read whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.arrow import id_texts
from leafmill.llm.common import fold
from leafmill.llm.language_id import batch_type
from leafmill.sources.staging import staged

FEATURES, WIDTH, RIDGE, SEED, BINS = 256, 4.0, 1e-3, 6, 1000
#: One labelled row in so many is kept for the calibration.
CALIBRATES = 4
NAMES = ["log_words", "word_len", "word_len_sd", "upper", "digit", "symbol", "mark", "space", "other", "distinct_words", "top_word", "adjacent", "lines", "dup_lines", "long_word", "ended_lines", "packed", "caps_words"]
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _classes() -> np.ndarray:
    """Byte -> class: 0 lower letter or part of one beyond ASCII, 1 upper, 2 digit, 3 symbol, 4 mark, 5 space, 6 other."""
    out = np.zeros(256, np.int64)
    for i in range(128):
        c = chr(i)
        out[i] = 1 if c.isupper() else 0 if c.islower() else 2 if c.isdigit() else 3 if c in "#*$%&|<>" else 5 if c in " \t\n\v\f\r" else 4 if c.isprintable() else 6
    return out


CLASSES = _classes()


def statistics(text: str | None) -> np.ndarray:
    out = np.zeros(len(NAMES))
    text = text or ""
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    n = np.bincount(CLASSES[np.frombuffer(raw, np.uint8)], minlength=7)
    words = _WORD.findall(text)
    lens = np.fromiter(map(len, words), np.float64, len(words))
    w = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    ends = max(1, len(lines))
    out[:] = [
        np.log1p(len(words)), lens.mean() if len(words) else 0, lens.std() if len(words) else 0,
        *(n[k] / len(raw) for k in (1, 2, 3, 4, 5, 6)),
        len(counts) / w, max(counts.values(), default=0) / w, sum(map(str.__eq__, words, words[1:])) / w,
        np.log1p(len(lines)), 1 - len(set(lines)) / ends, np.log1p(lens.max() if len(words) else 0),
        sum(x.rstrip()[-1] in ".!?\"'" for x in lines) / ends, len(zlib.compress(raw, 1)) / len(raw), sum(map(str.isupper, words)) / w,
    ]
    return out


def _basis(n: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.normal(size=(len(NAMES), n)) / WIDTH, rng.uniform(0, 2 * np.pi, n)


def fourier(x: np.ndarray, n: int = FEATURES) -> np.ndarray:
    """Features whose inner products are near exp(-|a-b|^2 / (2 WIDTH^2)), and a constant."""
    w, b = _basis(n)
    return np.hstack([np.sqrt(2 / n) * np.cos(x @ w + b), np.ones((len(x), 1))])


def isotonic(score: np.ndarray, ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over bins in order of score; bins without rows take their left neighbour's value."""
    blocks: list[list[float]] = []
    for k in range(len(score)):
        if total[k] <= 0:
            continue
        blocks.append([ones[k], total[k], k])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            o, t, _ = blocks.pop()
            blocks[-1][0] += o
            blocks[-1][1] += t
    out = np.full(len(score), np.nan)
    for o, t, k in blocks:
        out[int(k)] = (o + 0.5 * 1e-3) / (t + 1e-3)
    known = np.flatnonzero(~np.isnan(out))
    if not len(known):
        return np.full(len(score), 0.5)
    return np.interp(np.arange(len(score)), known, out[known])


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of every whole text. One pass; texts never move."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in id_texts(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "x": [statistics(t).tolist() for t in texts]}, pa.schema([("doc_id", batch_type(kind)), ("x", pa.list_(pa.float64()))]))

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>")


def _rows(b: pa.RecordBatch, column: str = "x") -> np.ndarray:
    x = b.column(b.schema.get_field_index(column))
    return np.asarray(x.flatten()).reshape(-1, len(NAMES))


def train(known: DataFrame) -> tuple | None:
    """known: x, y (0 or 1), calibrates. Returns mean, deviation, coefficients, isotonic values; None without rows.

    Rows that calibrate are kept from the ridge, so isotonic values are rates on rows it hasn't seen; where either part is
    empty all rows serve for it.
    """
    n, d = FEATURES + 1, len(NAMES)
    everything, known, kept = known, known.where("not calibrates"), known.where("calibrates")
    if known.isEmpty():
        known = everything
    if kept.isEmpty():
        kept = everything

    def moments(batches):
        total = np.zeros((2, d))
        count = 0
        for b in batches:
            if b.num_rows:
                x = _rows(b)
                total += [x.sum(0), (x * x).sum(0)]
                count += len(x)
        if count:
            yield pa.RecordBatch.from_pydict({"n": [count], "s": [total.ravel().tolist()]}, pa.schema([("n", pa.int64()), ("s", pa.list_(pa.float64()))]))

    first = known.select("x").mapInArrow(moments, "n long, s array<double>")
    sums = first.select("n", F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    if not sums:
        return None
    count = sums[0]["n"]
    s = np.zeros(2 * d)
    for r in sums:
        s[r["i"]] = r["v"]
    mean = s[:d] / count
    dev = np.sqrt(np.maximum(s[d:] / count - mean**2, 0))
    dev[dev < 1e-6] = 1

    def normal(batches):
        a, b_ = np.zeros((n, n)), np.zeros(n)
        for b in batches:
            if b.num_rows:
                z = fourier(np.clip((_rows(b) - mean) / dev, -6, 6))
                a += z.T @ z
                b_ += z.T @ np.asarray(b.column(b.schema.get_field_index("y")).to_numpy(zero_copy_only=False), float)
        yield pa.RecordBatch.from_pydict({"i": list(range(n)), "v": np.hstack([a, b_[:, None]]).tolist()}, pa.schema([("i", pa.int32()), ("v", pa.list_(pa.float64()))]))

    def added(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), np.asarray(b.column(1).flatten()).reshape(-1, n + 1), strict=True):
                total[i] = total.get(i, 0) + v
        yield pa.RecordBatch.from_pydict({"i": list(total), "v": [v.tolist() for v in total.values()]}, pa.schema([("i", pa.int32()), ("v", pa.list_(pa.float64()))]))

    # each task gives the rows of its matrix, and those of one place are added up as they come
    parts = known.select("x", "y").mapInArrow(normal, "i int, v array<double>").repartition("i").mapInArrow(added, "i int, v array<double>").collect()
    m = np.zeros((n, n + 1))
    for r in parts:
        m[r["i"]] = r["v"]
    coef = np.linalg.solve(m[:, :n] + RIDGE * count / FEATURES * np.eye(n), m[:, n])

    def histogram(batches):
        ones, total = np.zeros(BINS), np.zeros(BINS)
        for b in batches:
            if b.num_rows:
                k = binned(raw_score(_rows(b), mean, dev, coef))
                y = np.asarray(b.column(b.schema.get_field_index("y")).to_numpy(zero_copy_only=False), float)
                ones += np.bincount(k, y, BINS)
                total += np.bincount(k, minlength=BINS)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"k": k.tolist(), "o": ones[k].tolist(), "t": total[k].tolist()}, pa.schema([("k", pa.int32()), ("o", pa.float64()), ("t", pa.float64())]))

    bins = kept.select("x", "y").mapInArrow(histogram, "k int, o double, t double").groupBy("k").agg(F.sum("o").alias("o"), F.sum("t").alias("t")).collect()
    ones, total = np.zeros(BINS), np.zeros(BINS)
    for r in bins:
        ones[r["k"]], total[r["k"]] = r["o"], r["t"]
    return mean, dev, coef, isotonic(np.arange(BINS), ones, total)


def raw_score(x: np.ndarray, mean: np.ndarray, dev: np.ndarray, coef: np.ndarray) -> np.ndarray:
    return fourier(np.clip((x - mean) / dev, -6, 6)) @ coef


def binned(score: np.ndarray) -> np.ndarray:
    """Bins over -0.5 to 1.5, which holds all but stray ridge scores."""
    return np.clip(((score + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)


def classify(documents: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    facts = staged(measured(documents), "statistics")
    y = labels.groupBy("doc_id").agg(F.max("quality").alias("y")).where(F.col("y").isNotNull() & (fold("doc_id", folds) != held))
    part = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / folds) % CALIBRATES
    known = staged(facts.join(y, "doc_id").select("x", "y", (part == 0).alias("calibrates")), "labelled")
    model = train(known)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if model is None:
                s = np.full(b.num_rows, 0.5)
            else:
                mean, dev, coef, iso = model
                r = raw_score(_rows(b), mean, dev, coef)
                # within a bin the ridge score still orders, by less than isotonic steps
                s = np.clip(iso[binned(r)] * (1 - 1e-6) + 1e-6 / (1 + np.exp(-4 * (r - 0.5))), 0, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    out = facts.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
