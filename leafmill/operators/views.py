"""The filtered, deduplicated dataset: one best element per pair of duplicate groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.functions.rules import DETECTION_THRESHOLD


def representatives(deduped_hash: DataFrame, deduped_embedding: DataFrame, detection: DataFrame) -> DataFrame:
    """id_detection of the first of each (hash group, embedding group): unknown confidence first, then the highest, then the least id.

    row_number() = 1 is planned with a group limit on both sides of the shuffle, so a large group leaves its tasks as one row each.
    """
    both = deduped_hash.select("id_detection", F.col("group_id").alias("hg")).join(deduped_embedding.select("id_detection", F.col("group_id").alias("eg")), "id_detection")
    ranked = both.join(detection.select("id_detection", "bbox_conf"), "id_detection")
    best = Window.partitionBy("hg", "eg").orderBy(F.desc_nulls_first("bbox_conf"), F.asc("id_detection"))
    return ranked.withColumn("rn", F.row_number().over(best)).where("rn = 1").select("id_detection")


def filtered_dataset(tables: dict[str, DataFrame], threshold: float = DETECTION_THRESHOLD, run_items: DataFrame | None = None) -> DataFrame:
    """20 columns. tables: by relation name. run_items (id_pipeline_batch_item) limits it to one run; by default it spans all.

    Rows of optional tables that share a detection multiply, as in the relational definition.
    """
    t = tables
    d = t["detection"].where(F.col("bbox_conf") >= threshold)
    if run_items is not None:
        d = d.join(run_items.select("id_pipeline_batch_item").distinct(), "id_pipeline_batch_item", "left_semi")
    for c in ("orientation_correction_gen", "orientation_correction_confidence_gen", "orientation_correction_probs_gen"):
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast("double" if "confidence" in c else "string"))
    items = t["pipeline_batch_item"].select("id_pipeline_batch_item", "barcode").join(t["volume"].select("barcode"), "barcode")
    rows = (
        d.join(representatives(t["deduped_hash"], t["deduped_embedding"], t["detection"]), "id_detection")
        .join(items, "id_pipeline_batch_item")
        .join(t["classification"].select("id_detection", "pred_class", F.col("pred_conf").alias("classification_conf"), F.col("probs").alias("classification_probs")), "id_detection")
        .join(t["caption"].select("id_detection", F.col("text").alias("caption_text"), F.col("lang").alias("caption_lang"), F.col("lang_detected").alias("caption_lang_detected"), F.col("linear_prob").alias("caption_linear_prob"), F.col("thesaurus_matches").alias("caption_thesaurus_matches")), "id_detection", "left")
        .join(t["image_hash"].select("id_detection", "image_hash"), "id_detection", "left")
        .join(t["image_embedding"].select("id_detection", "embedding"), "id_detection", "left")
    )
    return rows.select(
        "id_detection", F.col("id_pipeline_batch_item").alias("pipeline_batch_item_id"), "barcode", "scan_filename", "bbox_xyxy", "bbox_xywh", "bbox_conf",
        "orientation_correction_gen", "orientation_correction_confidence_gen", "orientation_correction_probs_gen", "pred_class", "classification_conf",
        "classification_probs", "caption_text", "caption_lang", "caption_lang_detected", "caption_linear_prob", "caption_thesaurus_matches", "image_hash", "embedding")


def create_view(spark: SparkSession, tables: dict[str, DataFrame], name: str = "filtered_dataset", drop_existing: bool = False, **kw) -> DataFrame:
    if drop_existing:
        spark.catalog.dropTempView(name)
    df = filtered_dataset(tables, **kw)
    df.createOrReplaceTempView(name)
    return df
