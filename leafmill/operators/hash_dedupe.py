"""Near-duplicates by perceptual hash: bands, buckets, Hamming distance, components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions import vectors
from leafmill.operators.components import connected_components
from leafmill.sources.staging import staged

DIGITS, BAND_DIGITS, THRESHOLD = 36, 6, 16
#: Ids of equal hashes that are paired with others at once.
PART = 512


def valid(hashes: DataFrame, digits: int = DIGITS, invalid: str = "exclude") -> DataFrame:
    """id, h. invalid: "exclude" leaves malformed hashes out (they stay singletons), "zero" takes them as 0."""
    good = vectors.valid_hex(F.col("h"), digits)
    rows = hashes.select("id", F.coalesce("h", F.lit("")).alias("h"))
    return rows.withColumn("h", F.when(good, F.col("h")).otherwise("0" * digits)) if invalid == "zero" else rows.where(good)


def banded(hashes: DataFrame, digits: int = DIGITS, band_digits: int = BAND_DIGITS, invalid: str = "exclude") -> DataFrame:
    """id, h, band, value of valid hashes."""
    return valid(hashes, digits, invalid).select("id", "h", F.inline(vectors.bands(F.col("h"), digits, band_digits)))


def bucketed(bands: DataFrame, max_bucket: int | None = None) -> DataFrame:
    """Rows of buckets of two members or more, with up to max_bucket different hashes. A bucket with more gives no pairs
    of its own; None takes all.

    Sizes are aggregated and joined, never windowed, so no bucket is gathered in one task.
    """
    keep = bands.groupBy("band", "value", "h").agg(F.count("*").alias("n")).groupBy("band", "value").agg(F.sum("n").alias("n"), F.count("*").alias("hashes")).where("n >= 2")
    keep = keep if max_bucket is None else keep.where(F.col("hashes") <= max_bucket)
    return bands.join(keep.select("band", "value"), ["band", "value"], "left_semi")


def _near(least: DataFrame, by: str, threshold: int, digits: int, band_digits: int, max_bucket: int | None) -> DataFrame:
    """x and y, in order of by: different hashes that share a band and differ in at most threshold bits, once a band. least: h, least."""
    one = staged(bucketed(banded(least.select(F.col("least").alias("id"), "h"), digits, band_digits), max_bucket), "buckets")
    x, y = one.alias("x"), one.alias("y")
    met = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.value") == F.col("y.value")) & (F.col(f"x.{by}") < F.col(f"y.{by}")))
    return met.where(vectors.hamming(F.col("x.h"), F.col("y.h"), digits) <= threshold)


def linked(hashes: DataFrame, threshold: int = THRESHOLD, digits: int = DIGITS, band_digits: int = BAND_DIGITS, max_bucket: int | None = None, invalid: str = "exclude") -> DataFrame:
    """a, b (a < b), kind. hashes: id, h.

    Equal hashes are linked first and compared once: a hash's least id stands for it, and its other ids hang on that
    one as "copy" rows, however many they are. "near" rows are those least ids that share a band and differ in at most
    threshold bits, once each. max_bucket leaves out buckets of more different hashes; none is by default.
    """
    rows = staged(valid(hashes, digits, invalid), "hashes")
    least = staged(rows.groupBy("h").agg(F.min("id").alias("least")), "least")
    copies = rows.join(least, "h").where("id > least").select(F.col("least").alias("a"), F.col("id").alias("b"), F.lit("copy").alias("kind")).distinct()
    near = _near(least, "id", threshold, digits, band_digits, max_bucket).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    return near.withColumn("kind", F.lit("near")).unionByName(copies)


def duplicate_pairs(hashes: DataFrame, **kw) -> DataFrame:
    """a, b of linked(): enough to group all ids."""
    return linked(hashes, **kw).select("a", "b")


def all_pairs(hashes: DataFrame, threshold: int = THRESHOLD, digits: int = DIGITS, band_digits: int = BAND_DIGITS, max_bucket: int | None = None, invalid: str = "exclude") -> DataFrame:
    """a, b (a < b): every two ids whose hashes share a band and differ in at most threshold bits, once each.

    Different hashes are compared once, as in linked(); then the ids of the two are paired, and those of one hash with
    each other. Rows grow with the square of a group, so its ids are held in parts of about PART, and each two parts are
    rows of their own that any task can write out.
    """
    rows = staged(valid(hashes, digits, invalid).distinct(), "hashes")
    held = staged(rows.groupBy("h").agg(F.min("id").alias("least"), F.count("*").alias("n")), "least")
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / PART)).alias("part")
    ids = staged(rows.join(held, "h").select("h", part, "id").groupBy("h", "part").agg(F.collect_list("id").alias("ids")), "parts")
    near = _near(held, "h", threshold, digits, band_digits, max_bucket).select(F.col("x.h").alias("h"), F.col("y.h").alias("g")).distinct()
    two = near.unionByName(held.where("n > 1").select("h", F.col("h").alias("g")))
    others = ids.select(F.col("h").alias("g"), F.col("part").alias("to"), F.col("ids").alias("others"))
    met = two.join(ids, "h").join(others, "g").where("h < g or part <= to").repartition("h", "part", "g", "to")
    each = met.select((F.expr("h = g and part = to")).alias("same"), F.explode("ids").alias("x"), "others").select("same", "x", F.explode("others").alias("y"))
    pairs = each.where("x < y or (x > y and not same)").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    # an id of several hashes may meet another one more than once
    return pairs if rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty() else pairs.distinct()


def assign(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """id, group_id for every id: the least id of its component, its own if it has no duplicate."""
    comp = connected_components(pairs).withColumnRenamed("node", "id")
    return ids.select("id").distinct().join(comp, "id", "left").select("id", F.coalesce("component", "id").alias("group_id"))


def of_run(rows: DataFrame, batches: DataFrame | None, items: DataFrame | None, run: int | None) -> DataFrame:
    """Rows of the items of one run; all rows if none is named."""
    if run is None:
        return rows
    own = items.join(batches.where(F.col("id_pipeline_run") == run), "id_pipeline_batch", "left_semi").select("id_pipeline_batch_item").distinct()
    return rows.join(own, "id_pipeline_batch_item", "left_semi")


def dedupe_by_hash(image_hash: DataFrame, batches: DataFrame | None = None, items: DataFrame | None = None, run: int | None = None, **kw) -> DataFrame:
    """deduped_hash rows: hash_id, group_id, id_pipeline_batch_item, id_detection, image_hash; of one run if one is named."""
    rows = of_run(image_hash, batches, items, run)
    groups = assign(rows.select(F.col("id_imagehash").alias("id")), duplicate_pairs(rows.select(F.col("id_imagehash").alias("id"), F.col("image_hash").alias("h")), **kw))
    return rows.join(groups, rows["id_imagehash"] == groups["id"]).select(F.col("id").alias("hash_id"), "group_id", "id_pipeline_batch_item", "id_detection", "image_hash")
