"""Small things the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def words(text: Column) -> Column:
    """The words of a text, empty for null. One split; leading and trailing white space leave no empty word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
