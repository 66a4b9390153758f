"""Frequent closed itemsets of baskets: level-wise minimal generators, then each one's closure.

An itemset is a minimal generator if every proper subset stands in more baskets. Level k+1 joins generators of level k
that a basket holds and that agree but for the last item; a candidate whose support equals that of a subset, or of which a
subset is no generator, is pruned. The closure of a generator is the intersection of the baskets that hold it: an item is
in it if it stands with the generator as often as the generator stands. Every closed itemset is the closure of one.

Baskets with more frequent items than a bound are few by the choice of that bound: fewer than the least support. They
give no candidates of their own; what the others leave possible is counted in them by joins, so they are never gathered
and no pairs of theirs are written out, and results are exact. Tables meet by sort-merge joins only: nothing that grows
with the input is broadcast, collected or dealt to one task.

Defined results: rows without basket or item are left out, repeated rows count once, an empty table gives no itemset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.sources.staging import release, staged

LEAST, SHARE, CONFIDENCE = 12, 10_000, 30

#: Baskets of up to so many frequent items are worked on as one row; the bound doubles until those beyond are few.
BASKET = 64


def _merge(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    return left.join(right.hint("merge"), on, how)


def _candidates(gens: Column, k: int) -> Column:
    """Sets of k + 1 from a sorted array of sets of k, by agreement in all but the last item."""
    from_here = lambda g, i: F.filter(F.slice(gens, i + 2, F.size(gens)), lambda h: F.slice(h, 1, k - 1) == F.slice(g, 1, k - 1))
    return F.flatten(F.transform(gens, lambda g, i: F.transform(from_here(g, i), lambda h: F.concat(g, F.array(F.element_at(h, -1))))))


def _pairs(items: Column) -> Column:
    return F.flatten(F.transform(items, lambda x, i: F.transform(F.slice(items, i + 2, F.size(items)), lambda y: F.array(x, y))))


class Baskets:
    """Distinct (basket, item) rows of frequent items, by kind of basket, and the supports of items."""

    def __init__(self, rows: DataFrame, least: int, share: int):
        once = staged(rows.where("basket is not null and item is not null").select("basket", "item").distinct(), "baskets")
        self.total = once.groupBy("basket").agg(F.lit(1)).count()
        self.least = max(least, -(-self.total // share))
        self.supports = staged(once.groupBy("item").agg(F.count("*").alias("support")).where(F.col("support") >= self.least), "supports")
        # items of all baskets are in every closure, and no more of them than the least basket has
        self.everywhere = [r.item for r in self.supports.where(F.col("support") == self.total).sort("item").collect()]
        items = self.supports.where(F.col("support") < self.total)
        frequent = staged(_merge(once, items.select("item"), "item"), "frequent")
        release(once)
        sizes = staged(frequent.groupBy("basket").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        over = sizes.agg(*[F.count_if(F.col("n") > (BASKET << j)).alias(f"o{j}") for j in range(40)]).first()
        j = next(j for j in range(40) if over[j] < self.least)
        self.large, bound = over[j], BASKET << j
        self.giants = staged(_merge(frequent, sizes.where(F.col("n") > bound).select("basket"), "basket"), "giants") if self.large else None
        kept = staged(_merge(frequent, sizes.where(F.col("n") <= bound).select("basket"), "basket"), "kept")
        self.rows = staged(kept.groupBy("basket").agg(F.sort_array(F.collect_list("item")).alias("items")), "rows")
        release(kept, frequent, sizes)
        one = items.select(F.array("item").alias("g"), "support")
        self.singles = staged(self.with_giants(one.withColumnRenamed("g", "c")).select(F.col("c").alias("g"), "support", (F.col("support") - F.col("m")).alias("n")), "singles")

    def with_giants(self, sets: DataFrame) -> DataFrame:
        """sets (c, ...) with m, the number of giant baskets that hold all of c."""
        if self.giants is None:
            return sets.withColumn("m", F.lit(0).cast("long"))
        one = sets.select("c", F.size("c").alias("size"), F.explode("c").alias("item"))
        held = _merge(one, self.giants, "item").groupBy("c", "basket", "size").agg(F.count("*").alias("k")).where("k = size")
        found = held.groupBy("c").agg(F.count("*").alias("m"))
        return _merge(sets, found, "c", "left").withColumn("m", F.coalesce("m", F.lit(0).cast("long")))

    def counted(self, emitted: DataFrame) -> DataFrame:
        """c, n: candidates by the baskets that emit them, as far as they can still be frequent."""
        return staged(emitted.groupBy("c").agg(F.count("*").alias("n")).where(F.col("n") >= max(1, self.least - self.large)), "counts")

    def generators(self, counts: DataFrame, before: DataFrame, k: int) -> DataFrame:
        """g, support, n of the candidates (k items each) that are minimal generators; before: the level's below."""
        told = self.with_giants(counts).select("c", "n", (F.col("n") + F.col("m")).alias("support")).where(F.col("support") >= self.least)
        without = F.explode(F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.concat(F.slice("c", 1, i - 1), F.slice("c", i + 1, k))))
        subsets = _merge(told.withColumn("g", without), before.select("g", F.col("support").alias("s")), "g")
        good = subsets.groupBy("c", "n", "support").agg(F.count("*").alias("k"), F.min("s").alias("s")).where(f"k = {k} and s > support")
        return staged(good.select(F.col("c").alias("g"), "support", "n"), "generators")

    def extensions(self, met: DataFrame, gens: DataFrame) -> DataFrame:
        """g, item: items that stand in all baskets of g. met: g, item, e (baskets of ordinary size with both)."""
        sure = _merge(met, gens, "g").where("e = n").select("g", "item", (F.col("support") - F.col("n")).alias("due"))
        if self.giants is None:
            return sure.select("g", "item")
        sets = sure.withColumn("c", F.array_sort(F.concat("g", F.array("item"))))
        full = self.with_giants(sets.select("c").distinct())
        return _merge(sets, full, "c").where("m = due").select("g", "item")


def closed_itemsets(rows: DataFrame, least: int = LEAST, share: int = SHARE) -> tuple[DataFrame, DataFrame, int]:
    """items (sorted array), support of every closed itemset with support >= least and support * share >= baskets; item,
    support of frequent items; the number of baskets. rows: basket, item.
    """
    b = Baskets(rows, least, share)
    gens, exts, k = b.singles, [], 1
    levels = [gens]
    held = None
    while True:
        if k == 1:
            emitted = b.rows.select("basket", F.explode(_pairs(F.col("items"))).alias("c"))
        else:
            emitted = held.select("basket", F.explode(_candidates(F.col("gens"), k)).alias("c"))
        counts = b.counted(emitted)
        if k == 1:  # the count of a pair is what the intersection of its items' baskets says of each
            both = counts.select(F.inline(F.array(*[F.struct(F.array(F.get("c", F.lit(i))).alias("g"), F.get("c", F.lit(1 - i)).alias("item"), F.col("n").alias("e")) for i in (0, 1)])))
            exts.append(staged(b.extensions(both, gens), "extensions"))
        up = b.generators(counts, gens, k + 1)
        release(counts)
        if up.isEmpty():
            break
        k += 1
        found = _merge(emitted, up.select(F.col("g").alias("c")), "c").groupBy("basket").agg(F.sort_array(F.collect_list("c")).alias("gens"))
        now = staged(_merge(found, b.rows, "basket"), "held")
        release(held)
        held, gens = now, up
        levels.append(gens)
        met = held.select("items", F.explode("gens").alias("g")).select("g", F.explode(F.array_except("items", "g")).alias("item")).groupBy("g", "item").agg(F.count("*").alias("e"))
        exts.append(staged(b.extensions(met, gens), "extensions"))
    release(held)
    found = None
    everywhere = F.array(*[F.lit(x) for x in b.everywhere]).cast("array<long>")
    for g, e in zip(levels, exts, strict=True):
        more = e.groupBy("g").agg(F.collect_list("item").alias("more"))
        whole = F.array_sort(F.concat("g", F.coalesce("more", F.array().cast("array<long>")), everywhere))
        closed = _merge(g, more, "g", "left").select(whole.alias("items"), "support")
        found = closed if found is None else found.unionByName(closed)
    if b.everywhere:
        found = found.unionByName(rows.sparkSession.createDataFrame([(b.everywhere, b.total)], "items array<long>, support long"))
    return staged(found.distinct(), "closed"), b.supports, b.total


def rules(closed: DataFrame, supports: DataFrame, baskets: int, confidence: int = CONFIDENCE) -> DataFrame:
    """items, support, n_rules, best_item, rules: taking c from a set is a rule if support is confidence % of the rest's and
    more than chance has. rules is an array of c, a (support of the rest), s (support of c), by c.

    The rest of a closed set is closed itself or has the set as its closure, so one join finds its support.
    """
    each = closed.where(F.size("items") > 1).select("items", "support", F.explode("items").alias("c"))
    each = each.withColumn("rest", F.array_remove("items", F.col("c")))
    each = _merge(each, closed.select(F.col("items").alias("rest"), F.col("support").alias("a")), "rest", "left").withColumn("a", F.coalesce("a", "support"))
    each = _merge(each, supports.select(F.col("item").alias("c"), F.col("support").alias("s")), "c")
    good = each.where((100 * F.col("support") >= confidence * F.col("a")) & (F.col("support") * baskets > F.col("a") * F.col("s")))
    told = good.groupBy("items").agg(F.count("*").alias("n_rules"), F.min(F.struct("a", "c")).alias("best"), F.sort_array(F.collect_list(F.struct("c", "a", "s"))).alias("rules"))
    out = _merge(closed, told, "items", "left")
    return out.select("items", "support", F.coalesce("n_rules", F.lit(0).cast("long")).alias("n_rules"), F.col("best.c").alias("best_item"), F.coalesce("rules", F.array().cast("array<struct<c:bigint,a:bigint,s:bigint>>")).alias("rules"))


def digest(told: DataFrame) -> DataFrame:
    """items as text, n_items, support, n_rules, best_item, rules_sha256."""
    said = F.array_join(F.transform("rules", lambda r: F.concat_ws(":", r["c"].cast("string"), r["a"].cast("string"), r["s"].cast("string"))), ";")
    return told.select(F.array_join(F.col("items").cast("array<string>"), ",").alias("items"), F.size("items").cast("long").alias("n_items"), "support", "n_rules", "best_item", F.sha2(said, 256).alias("rules_sha256"))
