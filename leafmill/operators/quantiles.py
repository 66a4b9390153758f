"""Exact order statistics of large columns, without the values of a column meeting in one task.

The ranks asked for are narrowed down by histograms: first by sign and power of two, then by equal parts of the range that
a rank is in. Each round is one map-side combined count of at most 4,096 buckets a rank, so what is collected is a table of
bounded size. A bucket of one value, or of few different ones, ends the search.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, FEW = 4096, 4096
#: Exponents of doubles lie within this.
_MOST = 1200


@dataclass
class Search:
    """One rank of one column, within the values from lo to hi, before of which are smaller."""

    column: int
    rank: int
    before: int = 0
    lo: float = -math.inf
    hi: float = math.inf
    rows: int | None = None
    value: float | None = None


def _magnitude(x: Column) -> Column:
    """Grows with x: sign and power of two."""
    power = F.greatest(F.lit(-_MOST), F.least(F.lit(_MOST), F.floor(F.log2(F.abs(x))))).cast("long")
    at = power + _MOST + 1
    return F.when(F.isnan(x), F.lit(2 * _MOST + 9)).when(x == 0, F.lit(0)).when(x > 0, at).otherwise(-at).cast("long")


def _counts(xs: DataFrame, searches: list[Search], last: bool) -> dict[int, list]:
    """For each search its buckets in order: (lo, hi, rows)."""
    spots = []
    for n, s in enumerate(searches):
        x = F.col(f"x{s.column}")
        inside = x.isNotNull() if s.rows is None else (x >= F.lit(s.lo)) & (x <= F.lit(s.hi))
        if s.rows is None:
            bucket = _magnitude(x)
        elif math.isinf(s.lo) or math.isinf(s.hi) or math.isinf(s.hi - s.lo):
            # a range beyond doubles is halved in two by each side of it
            bucket = F.floor(x / 2**1000).cast("long") if not (math.isinf(s.lo) or math.isinf(s.hi)) else F.when(x == F.lit(s.lo), F.lit(-1)).when(x == F.lit(s.hi), F.lit(1)).otherwise(F.lit(0)).cast("long")
        else:
            bucket = F.least(F.lit(BUCKETS - 1), F.floor((x - s.lo) / (s.hi - s.lo) * BUCKETS)).cast("long")
        spots.append(F.when(inside, F.struct(F.lit(n).alias("n"), (F.lit(0).cast("long") if last else bucket).alias("b"), x.alias("x"))))
    rows = xs.select(F.inline(F.filter(F.array(*spots), lambda s: s.isNotNull())))
    by = ["n", "x"] if last else ["n", "b"]
    told = rows.groupBy(*by).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("rows"))
    out: dict[int, list] = {}
    for r in sorted(told.collect(), key=lambda r: (r.n, math.isnan(r.lo), r.lo)):
        out.setdefault(r.n, []).append((r.lo, r.hi, r.rows))
    return out


def order_statistics(df: DataFrame, asked: list[tuple[Column, int]]) -> list[float | None]:
    """The value of each rank (from 0) of each column; NaN is the greatest, nulls don't count; null beyond the last."""
    columns = list({str(c): c for c, _ in asked}.values())
    place = {str(c): i for i, c in enumerate(columns)}
    xs = df.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    searches = [Search(place[str(c)], rank) for c, rank in asked]
    open_ = [s for s in searches if s.rank >= 0]
    while open_:
        last = all(s.rows is not None and s.rows <= FEW for s in open_)
        found = _counts(xs, open_, last)
        for n, s in enumerate(open_):
            seen = s.before
            for lo, hi, rows in found.get(n, []):
                if s.rank < seen + rows:
                    s.before, s.lo, s.hi, s.rows = seen, lo, hi, rows
                    if lo == hi or math.isnan(lo):
                        s.value = lo
                    break
                seen += rows
            else:
                s.rank = -1
        open_ = [s for s in open_ if s.value is None and s.rank >= 0]
    return [s.value for s in searches]


def quantiles(df: DataFrame, asked: dict[str, tuple[Column, float]]) -> dict[str, float | None]:
    """Name -> quantile of a column, linear between the two nearest ranks; null without values."""
    if not asked:
        return {}
    counts = df.agg(*[F.count(c).alias(name) for name, (c, _) in asked.items()]).first()
    ranks, wanted = {}, []
    for name, (c, q) in asked.items():
        at = q * (counts[name] - 1)
        ranks[name] = (len(wanted), at - math.floor(at)) if counts[name] else None
        if counts[name]:
            wanted += [(c, math.floor(at)), (c, math.ceil(at))]
    values = order_statistics(df, wanted)
    out: dict[str, float | None] = {}
    for name, spot in ranks.items():
        if spot is None:
            out[name] = None
        else:
            low, high = values[spot[0]], values[spot[0] + 1]
            out[name] = low if low == high else low * (1 - spot[1]) + high * spot[1]
    return out
