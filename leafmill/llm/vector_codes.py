"""Vector code compression: product codes whose nearest entries are found by annular norm pruning.

Vectors are scaled to integers and cut into equal parts; each part has a codebook. An entry can be nearest only if its
norm differs from the part's by at most the distance to the best entry known, so entries are sorted by norm, the interval
is found by binary search, and only that annulus is measured, in whole numbers. A codebook is a bounded model; each round
sums parts by entry inside every task, and what meets afterwards are those sums.

Defined results: rows without vector, or with a null, NaN or infinite component are dropped. Scaled components stop at
+-2^27. The dimension is that of the least id; kept rows of another dimension come back without code and error. Of
repeated ids the least vector seeds the codebook, and every row is coded; rows without id are coded and seed nothing. No
row, no result. A dimension that the number of parts doesn't divide is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.sources.staging import staged

PARTS, ENTRIES, ROUNDS, SCALE, TOP = 8, 16, 6, 4096, 1 << 27


def scaled(v: Column, scale: int = SCALE) -> Column:
    top = F.lit(float(TOP))
    return F.transform(v, lambda x: F.greatest(-top, F.least(top, F.floor(x.cast("double") * scale).cast("double"))).cast("int"))


def usable(v: Column) -> Column:
    """Not null, and of finite components only."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast("double"))
    return v.isNotNull() & F.forall(v, lambda x: F.coalesce(finite(x.cast("double")), F.lit(False)))


class Annulus:
    """The entries of one codebook, sorted by norm."""

    def __init__(self, entries: np.ndarray):
        norm = np.sqrt((entries.astype(np.float64) ** 2).sum(1))
        self.order = np.argsort(norm, kind="stable")
        self.norm, self.entries = norm[self.order], entries[self.order]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row, ties to the lower one, and the squared distance."""
        if not len(x):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        at = np.searchsorted(self.norm, norm).clip(1, max(1, len(self.norm) - 1))
        at -= (len(self.norm) < 2) | (np.abs(norm - self.norm[at - 1]) <= np.abs(norm - self.norm[np.minimum(at, len(self.norm) - 1)]))
        best = ((x - self.entries[at]) ** 2).sum(1)
        reach = np.sqrt(best.astype(np.float64)) * (1 + 1e-9) + 1e-3  # rounding only widens the annulus
        low, high = np.searchsorted(self.norm, norm - reach, "left"), np.searchsorted(self.norm, norm + reach, "right")
        n = high - low
        first = np.cumsum(n) - n
        row = np.repeat(np.arange(len(x)), n)
        entry = np.arange(n.sum()) - np.repeat(first - low, n)
        d = ((x[row] - self.entries[entry]) ** 2).sum(1)
        least = np.minimum.reduceat(d, first)
        index = np.where(d == np.repeat(least, n), self.order[entry], len(self.order))
        return np.minimum.reduceat(index, first), least


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dimension)


def _sums(books: list[np.ndarray], dimension: int):
    width = dimension // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Annulus(b) for b in books]
        total, n = np.zeros((len(books), len(books[0]), width), np.int64), np.zeros((len(books), len(books[0])), np.int64)
        for b in batches:
            x = _matrix(b.column(0), dimension)
            for p, a in enumerate(found):
                part = x[:, p * width : (p + 1) * width]
                near, _ = a.nearest(part)
                np.add.at(total[p], near, part)
                np.add.at(n[p], near, 1)
        p, e = np.nonzero(n)
        columns = [p.astype(np.int32), e.astype(np.int32), n[p, e], *total[p, e].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "n", *[f"s{i}" for i in range(width)]])

    return run, "part int, entry int, n long, " + ", ".join(f"s{i} long" for i in range(width))


def _codes(books: list[np.ndarray], dimension: int):
    width = dimension // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Annulus(b) for b in books]
        for b in batches:
            x = _matrix(b.column(0), dimension)
            near, d = zip(*[a.nearest(x[:, p * width : (p + 1) * width]) for p, a in enumerate(found)], strict=True)
            codes = ["".join(f"{i:02x}" for i in row) for row in np.stack(near, 1).tolist()]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(codes, pa.string()), pa.array(np.sum(d, 0))], names=["vec_id", "label", "code", "error"])

    return run


def train(vectors: DataFrame, dimension: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """A codebook (entries x width) of each part. vectors: vec_id, x (scaled, of one dimension)."""
    if dimension % parts:
        raise ValueError(f"{parts} parts don't divide {dimension} dimensions")
    width = dimension // parts
    ids = [r[0] for r in vectors.select("vec_id").where("vec_id is not null").distinct().orderBy("vec_id").limit(entries).collect()]
    seeds = vectors.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("x").alias("x")).orderBy("vec_id").collect()
    books = [np.array([r.x[p * width : (p + 1) * width] for r in seeds], np.int64).reshape(len(seeds), width) for p in range(parts)]
    for _ in range(rounds if seeds else 0):
        run, schema = _sums(books, dimension)
        wide = [F.sum(F.col(f"s{i}").cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
        for r in vectors.select("x").mapInArrow(run, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide).collect():
            books[r.part][r.entry] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return books


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code (two hex digits a part), error (squared distance to the entries taken); and the codebooks."""
    rows = staged(embeddings.where(usable(F.col("embedding"))).select("vec_id", "label", scaled(F.col("embedding")).alias("x")), "vectors")
    least = rows.where("vec_id is not null").agg(F.min(F.struct("vec_id", F.size("x").alias("n"))).alias("r")).first().r
    if least is None or least.n == 0:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), []
    fit = rows.where(F.size("x") == least.n)
    books = train(fit, least.n, parts, entries, rounds)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    coded = fit.select("x", "vec_id", "label").mapInArrow(_codes(books, least.n), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    odd = rows.where(F.size("x") != least.n).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return coded.unionByName(odd), books


def by_label(coded: DataFrame) -> DataFrame:
    """coded with label_error, the sum of errors over its label; null is a label. Sums are few, and joined to the rows."""
    rows = staged(coded, "codes")
    sums = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def written(books: list[np.ndarray]) -> str:
    """All components of the codebooks, by part, entry and place."""
    return ",".join(str(int(x)) for b in books for x in b.ravel())
