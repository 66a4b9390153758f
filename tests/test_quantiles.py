"""Order statistics against sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from leafmill.operators import quantiles as q
from leafmill.operators import statistics


def values(kind):
    r = random.Random(kind)
    return {
        "even": [r.random() for _ in range(3000)], "skewed": [r.choice([-1, 1]) * math.exp(r.gauss(0, 60)) for _ in range(3000)], "few": [float(r.randrange(3)) for _ in range(3000)],
        "one": [7.25], "two": [1.0, 2.0], "none": [], "close": [1 + i * 2.0**-50 for i in range(3000)], "edges": [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, math.inf, -math.inf, math.nan, 1.0] * 3,
    }[kind]


@pytest.mark.parametrize("kind", ["even", "skewed", "few", "one", "two", "none", "close", "edges"])
def test_every_rank_is_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(q, "FEW", 50)
    xs = values(kind)
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double").repartition(3)
    want = sorted(xs, key=lambda x: (math.isnan(x), x))
    ranks = sorted({0, len(xs) // 4, len(xs) // 2, max(0, len(xs) - 1), len(xs)})
    got = q.order_statistics(df, [(F.col("x"), k) for k in ranks])
    for k, x in zip(ranks, got, strict=True):
        w = want[k] if k < len(xs) else None
        assert x == w or (w is not None and math.isnan(w) and math.isnan(x))


def test_quantiles_as_the_engine_has_them(spark):
    df = spark.createDataFrame([(random.Random(i).gauss(0, 1), i % 7) for i in range(999)], "x double, k int")
    got = q.quantiles(df, {"a": (F.col("x"), 0.5), "b": (F.col("x"), 0.37), "c": (F.col("k"), 0.9), "d": (F.lit(None).cast("double"), 0.5)})
    want = df.select(F.percentile("x", F.lit(0.5)), F.percentile("x", F.lit(0.37)), F.percentile("k", F.lit(0.9))).first()
    assert [got["a"], got["b"], got["c"]] == pytest.approx(list(want), abs=1e-15) and got["d"] is None


def test_summaries_gather_no_values(spark):
    df = spark.range(5000).select((F.col("id") * 0.5).alias("x"))
    row = statistics.confidence(df, "x")
    plan = row._jdf.queryExecution().toString()
    assert row.first()["median"] == 1249.75 and "percentile" not in plan and "median(" not in plan


def test_running_sums(spark, monkeypatch):
    monkeypatch.setattr(statistics, "SPAN", 3)
    r = random.Random(1)
    ks = [r.randrange(40) for _ in range(300)]
    got = statistics.cumulative(spark.createDataFrame([(k,) for k in ks], "k long"), "k").collect()
    assert {x.k: x.running for x in got} == {k: sum(1 for y in ks if y <= k) for k in set(ks)}
