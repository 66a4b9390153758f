"""Near-duplicates by embedding: nearest neighbours over a cosine threshold, components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators.embedding_index import BLOCK_ROWS, best, block_products, neighbours_indexed
from leafmill.operators.hash_dedupe import assign, of_run

DISTANCE, NEIGHBOURS = 0.14, 30


def neighbours_exact(vectors: DataFrame, least: float = 1 - DISTANCE, k: int | None = NEIGHBOURS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """i, j, sim: of each i its k most similar (itself counted, ties by id) with similarity of at least least, i < j.

    Exact and quadratic in its products, one of each two blocks of vectors; vectors are dealt once, and without k pairs
    leave their task as they are. For large tables use neighbours_indexed.
    """
    near = block_products(vectors.select("id", F.col("v").cast("array<float>").alias("v"), F.lit(float(least)).alias("least")), k, block_rows)
    return near if k is None else best(near, k)


def dedupe_by_embedding(image_embedding: DataFrame, distance: float = DISTANCE, k: int | None = NEIGHBOURS, exact: bool = False, batches: DataFrame | None = None, items: DataFrame | None = None, run: int | None = None) -> DataFrame:
    """deduped_embedding rows: embedding_id, group_id (least id of the group), id_pipeline_batch_item, id_detection; of one run if one is named."""
    rows = of_run(image_embedding, batches, items, run)
    v = rows.select(F.col("id_embedding").alias("id"), F.col("embedding").alias("v"))
    near = neighbours_exact(v, 1 - distance, k) if exact else neighbours_indexed(v, 1 - distance, k)
    groups = assign(v, near.select(F.col("i").alias("a"), F.col("j").alias("b")))
    return rows.join(groups, rows["id_embedding"] == groups["id"]).select(F.col("id").alias("embedding_id"), "group_id", "id_pipeline_batch_item", "id_detection")
