"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.sources.staging import release, staged


def _stars(edges: DataFrame) -> DataFrame:
    """u, m: each node and the least of itself and its neighbours. Pre-aggregated, then staged so that the join can split a hot node."""
    return staged(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _stars(both)
    out = staged(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
    release(low, edges)
    return out


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _stars(down)
    hung = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = staged(hung.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small")
    release(low, edges)
    return out


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """node, component (the least node reachable), for every node of an edge. Ids must be of one ordered type.

    Each round halves the depth of what hangs below a least node, so long chains need logarithmically many. Rounds are
    written to the shared folder, so a lost executor never replays an earlier one, and go when the next is there. Nulls and loops: a loop makes its
    node a component of its own, edges with a null end are dropped.
    """
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    nodes = edges.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        now = _small(_large(now))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = stars.union(roots)
    return found.union(nodes.join(found.select("node"), "node", "left_anti").distinct())
