"""Writers: replace by key, dead letters, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replaced(old: DataFrame, fresh: DataFrame, key: str = "id_pipeline_batch_item", keys: DataFrame | None = None) -> DataFrame:
    """old without the rows of the keys redone, and fresh. keys defaults to those of fresh; name them where a redone key may have no row."""
    gone = (fresh if keys is None else keys).select(key).distinct()
    return old.join(gone, key, "left_anti").unionByName(fresh.select(*old.columns))


def cascade(table: DataFrame, gone: DataFrame, key: str = "id_detection") -> DataFrame:
    """A dependent table without the rows of what is deleted."""
    return table.join(gone.select(key).distinct(), key, "left_anti")


def write_dead_letters(rows: DataFrame, path: str) -> None:
    rows.withColumn("at", F.current_timestamp()).write.mode("append").json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with columns that aren't there yet, null."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})
