"""Runs and batches: preparing, leasing, listing, choosing work."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import rules
from leafmill.sources.staging import staged


def index_volumes(known: DataFrame, fresh: DataFrame) -> DataFrame:
    """Upsert by barcode: new metadata and date win, the key never changes, the rest stays."""
    k, f = known.alias("k"), fresh.dropDuplicates(["barcode"]).alias("f")
    both = k.join(f, F.col("k.barcode") == F.col("f.barcode"), "full_outer")
    pick = lambda c: F.when(F.col("f.barcode").isNotNull(), F.col(f"f.{c}")).otherwise(F.col(f"k.{c}")).alias(c)
    return both.select(F.coalesce("f.barcode", "k.barcode").alias("barcode"), *[pick(c) for c in known.columns if c != "barcode"])


def numbered(df: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """Rows with their place from 0 in a total order, without one task sorting all: ranges are sorted apart and offset by their sizes."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # the range a row is in must not change when read again
    ranged = staged(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("low"))
    before = sizes.select("_part", (F.sum("n").over(Window.orderBy("low")) - F.col("n")).alias("_before"))
    own = Window.partitionBy("_part").orderBy(*order)
    return ranged.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.row_number().over(own) - 1).drop("_part", "_before")


def prepare_run(volumes: DataFrame, run_id: int, items_per_batch: int = 1000, offset: int = 0, limit: int | None = None, append_to: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """batches (id_pipeline_batch, id_pipeline_run, items) and items (id_pipeline_batch_item, id_pipeline_batch, barcode), in order of barcode.

    Offset and limit apply first. append_to (pipeline_batch_item rows) leaves out volumes of earlier runs; totals are
    those of what is left, so no batch is empty.
    """
    if not 10 <= items_per_batch <= 1000:
        raise ValueError("items_per_batch must be from 10 to 1000")
    rows = numbered(volumes.select("barcode").distinct(), ["barcode"])
    rows = rows.where(F.col("ordinal") >= offset) if limit is None else rows.where((F.col("ordinal") >= offset) & (F.col("ordinal") < offset + limit))
    if append_to is not None:
        rows = rows.join(append_to.select("barcode").distinct(), "barcode", "left_anti")
    if offset or limit is not None or append_to is not None:
        rows = numbered(rows.select("barcode"), ["barcode"])
    items = rows.select((F.col("ordinal") + 1).alias("id_pipeline_batch_item"), (F.floor(F.col("ordinal") / items_per_batch) + 1).alias("id_pipeline_batch"), "barcode")
    batches = items.groupBy("id_pipeline_batch").agg(F.count("*").alias("items")).withColumn("id_pipeline_run", F.lit(run_id).cast("long"))
    return batches, items


def chunk(items: DataFrame, index: int, total: int, order: str = "id") -> DataFrame:
    """The index-th (from 0) of total contiguous parts in order."""
    n = items.count()
    size = max(1, -(-n // total))
    return numbered(items, [order]).where(F.floor(F.col("ordinal") / size) == index).drop("ordinal")


def status(batch: DataFrame) -> DataFrame:
    return batch.select("id_pipeline_batch", "id_pipeline_run", rules.batch_status(F.col("started_date"), F.col("ended_date"), F.col("has_crashed")).alias("status"))


def available(batch: DataFrame, now, timeout_seconds: int, ignore_locks: bool = False) -> DataFrame:
    free = rules.batch_available(F.col("started_date"), F.col("ended_date"), F.col("has_crashed"), now, timeout_seconds, ignore_locks)
    return batch.where(free)


def leased(batch: DataFrame, ids: DataFrame, node: str, now) -> DataFrame:
    """batch with the rows of ids taken by node: started now, not ended, not crashed."""
    mark = ids.select("id_pipeline_batch").distinct().withColumn("_take", F.lit(True))
    take = F.coalesce(F.col("_take"), F.lit(False))
    out = batch.join(mark, "id_pipeline_batch", "left").withColumns({
        "node_name": F.when(take, F.lit(node)).otherwise(F.col("node_name")), "started_date": F.when(take, now).otherwise(F.col("started_date")),
        "ended_date": F.when(~take, F.col("ended_date")), "has_crashed": F.when(take, F.lit(False)).otherwise(F.col("has_crashed"))})
    return out.select(*batch.columns)


def released(batch: DataFrame, ids: DataFrame, now, crashed: bool = False) -> DataFrame:
    mark = ids.select("id_pipeline_batch").distinct().withColumn("_done", F.lit(True))
    done = F.coalesce(F.col("_done"), F.lit(False))
    out = batch.join(mark, "id_pipeline_batch", "left").withColumns({"ended_date": F.when(done, now).otherwise(F.col("ended_date")), "has_crashed": F.when(done, F.lit(crashed)).otherwise(F.col("has_crashed"))})
    return out.select(*batch.columns)


def items_with_detections(items: DataFrame, detection: DataFrame) -> DataFrame:
    return items.join(detection, "id_pipeline_batch_item", "left_semi")


def captionable(detection: DataFrame, classification: DataFrame) -> DataFrame:
    """Elements of a class that is captioned; an unknown class is not."""
    kept = classification.where(~F.col("pred_class").isin(*rules.UNCAPTIONED_CLASSES)).select("id_detection", "pred_class")
    return detection.select("id_detection", "id_pipeline_batch_item", "scan_filename").join(kept, "id_detection").distinct()


def items_with_captionable(items: DataFrame, detection: DataFrame, classification: DataFrame) -> DataFrame:
    return items.join(captionable(detection, classification), "id_pipeline_batch_item", "left_semi")


def unseen_volumes(volume: DataFrame, items: DataFrame) -> DataFrame:
    return volume.join(items, "barcode", "left_anti")


def allowed_items(allow: DataFrame, detection: DataFrame) -> DataFrame:
    return allow.join(detection, allow["detection_id"] == detection["id_detection"]).select("id_pipeline_batch_item").distinct()


def pending_orientation(view: DataFrame, force: bool = False) -> DataFrame:
    two = view.where(F.col("pred_class").isin("Image or Illustration", "Chart or Graph"))
    return two if force else two.where(F.col("orientation_correction_gen").isNull())


def pending_backfill(caption: DataFrame, force: bool = False) -> DataFrame:
    return caption if force else caption.where(F.col("lang_detected").isNull())


def latest_item(items: DataFrame) -> DataFrame:
    return items.groupBy("barcode").agg(F.max("id_pipeline_batch_item").alias("id_pipeline_batch_item"))
