"""Tables that cut a plan: written once to the folder all executors share, then read back."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: While a table is staged, the shuffle files of its own execution go as soon as it is written.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local session, as in tests, may lack the setting and gets one of its own."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        java = spark.sparkContext._jsc.sc().getCheckpointDir()
        if java.isDefined():
            return java.get()
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="staged_")
        spark.sparkContext.setCheckpointDir(found)
    return found


def _own_dir(spark: SparkSession) -> str:
    """One folder an application, so that clearing it touches no other job."""
    return f"{shared_dir(spark).rstrip('/')}/staged/{spark.sparkContext.applicationId}"


def fresh(spark: SparkSession, tag: str) -> str:
    """A folder of the application's that nothing is in yet."""
    return f"{_own_dir(spark)}/{tag}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A setting of the session for what runs inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def staged(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write df as Parquet to the shared folder and return a frame that reads it.

    Unlike checkpoint() the result carries no partitioning, so a later join deals both of its sides anew and
    adaptive execution can split a hot key. A lost executor loses nothing: the files are in shared storage. The shuffle
    files that only this write needed are removed with it; release() removes the table itself.
    """
    spark = df.sparkSession
    path = fresh(spark, tag)
    schema = df.schema
    with setting(spark, CLEAN_UP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.staged_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(*frames: DataFrame | None) -> None:
    """Remove staged tables that no later step reads. Frames that staged() didn't make are left alone."""
    for df in frames:
        path = getattr(df, "staged_path", None) if df is not None else None
        if path:
            _delete(df.sparkSession, path)


def drop_staged(spark: SparkSession) -> None:
    """Remove every table that this application has staged; those of other running jobs stay."""
    _delete(spark, _own_dir(spark))
