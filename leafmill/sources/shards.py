"""Export shards under their own names: one Parquet file a shard, put in place when the whole job has come through.

A task writes drafts into the job's folder; the driver gives them their names at commit, and removes the folder when the
job is aborted. A shard is there whole or not at all, so a job that runs again writes those that are missing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from leafmill.operators import browse, export
from leafmill.sources.staging import staged
from leafmill.sources.stores import store_of

FORMAT = "leafmill_shards"
SHARD_ROWS, GROUP_ROWS, GROUP_BYTES = 5000, 500, 1_900_000_000
#: Tasks of a job at most; each writes its shards one after the other.
MOST_TASKS = 10_000


@dataclass
class Drafts(WriterCommitMessage):
    files: list[tuple[str, str]]


class ShardWriter(DataSourceArrowWriter):
    """Rows of one value of the column "file" must come together; the columns named in "drop" are not written."""

    def __init__(self, options: dict[str, str]):
        self.path, self.job = options["path"].rstrip("/"), options["job"]
        self.rows, self.bytes = int(options.get("grouprows", GROUP_ROWS)), int(options.get("groupbytes", GROUP_BYTES))
        self.drop = ["file", *filter(None, options.get("drop", "").split(","))]

    def _drafts(self, base: str) -> str:
        return f"{base.rstrip('/')}/_drafts-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Drafts:
        store, base = store_of(self.path)
        store.create_dir(self._drafts(base), recursive=True)
        done: list[tuple[str, str]] = []
        name, writer = None, None
        held: list[pa.RecordBatch] = []

        def flush(whole: bool) -> None:
            """Write full row groups, or all there is."""
            rows = sum(b.num_rows for b in held)
            if rows and (whole or rows >= self.rows):
                t = pa.Table.from_batches(held)
                n = rows if whole else rows // self.rows * self.rows
                writer.write_table(t.slice(0, n), row_group_size=self.rows)
                held[:] = t.slice(n).to_batches()

        for batch in iterator:
            files = batch.column("file").to_pylist()
            kept = [f.name for f in batch.schema if f.name not in self.drop]
            starts = [i for i in range(len(files)) if i == 0 or files[i] != files[i - 1]]
            for lo, hi in zip(starts, [*starts[1:], len(files)], strict=True):
                if files[lo] != name:
                    if writer:
                        flush(True)
                        writer.close()
                    name = files[lo]
                    draft = f"{self._drafts(base)}/{uuid.uuid4().hex}.parquet"
                    done.append((draft, f"{base.rstrip('/')}/{name}"))
                    writer = pq.ParquetWriter(draft, batch.select(kept).schema, filesystem=store, compression="zstd")
                held.append(batch.slice(lo, hi - lo).select(kept))
                flush(sum(b.nbytes for b in held) >= self.bytes)
        if writer:
            flush(True)
            writer.close()
        return Drafts(done)

    def commit(self, messages: list[Drafts | None]) -> None:
        store, base = store_of(self.path)
        for m in messages:
            for draft, final in m.files if m else []:
                store.move(draft, final)
        store.delete_dir(self._drafts(base))

    def abort(self, messages: list[Drafts | None]) -> None:
        store, base = store_of(self.path)
        if store.get_file_info(self._drafts(base)).type != fs.FileType.NotFound:
            store.delete_dir(self._drafts(base))


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter({k.lower(): v for k, v in self.options.items()})


def there(path: str) -> list[str]:
    """Names of the shards in a folder."""
    store, base = store_of(path)
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted(f.base_name for f in found if f.is_file and f.base_name.endswith(".parquet"))


def planned(records: DataFrame, shard_rows: int = SHARD_ROWS, by_split: bool = True, prefix: str | None = None, chunk: int | None = None) -> DataFrame:
    """records with split, shard and file. By split: split-00000-of-00004.parquet. With a prefix: prefix-0000.parquet, and
    prefix-c02-0000.parquet for a chunk.
    """
    out = export.sharded(records, shard_rows, by_split)
    if prefix is None:
        return out
    head = prefix if chunk is None else f"{prefix}-c{chunk:02d}"
    return out.withColumn("file", F.format_string(f"{head}-%04d.parquet", F.col("shard").cast("int")))


def write_shards(spark: SparkSession, plan: DataFrame, path: str, group_rows: int = GROUP_ROWS, dry_run: bool = False) -> dict[str, float]:
    """Write the shards of a plan that aren't there; files, rows, bytes of crops, seconds and rows a second, from one pass.

    A folder with shards that are none of the plan's is that of another export, which is an error.
    """
    have = there(path)
    known = spark.createDataFrame([(n,) for n in have], "file string")
    files = staged(plan.select("file").distinct(), "files")
    odd = known.join(files, "file", "left_anti").limit(1).collect()
    if odd:
        raise ValueError(f"{path} holds {odd[0].file}, a shard of another export")
    missing = files.count() - len(have)
    if not missing:
        return {"files": 0, "bytes": 0} | browse.rate(0, 0.0)
    todo = plan.join(known, "file", "left_anti") if have else plan
    seen = Observation()
    bytes_ = {"binary": "crop_gen", "struct<bytes:binary,path:string>": "crop_gen.bytes"}.get(dict(plan.dtypes).get("crop_gen", ""))
    size = F.octet_length(bytes_) if bytes_ else F.lit(0)
    todo = todo.observe(seen, F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("bytes"))
    began = time.monotonic()
    if dry_run:
        todo.write.format("noop").mode("overwrite").save()
    else:
        spark.dataSource.register(ShardSource)
        n = max(1, min(missing, MOST_TASKS))
        dealt = todo.repartition(n, "file").sortWithinPartitions("file", "id")
        dealt.write.format(FORMAT).mode("append").option("path", path).option("job", uuid.uuid4().hex).option("grouprows", group_rows).option("drop", "split,shard").save()
    seconds = time.monotonic() - began
    return {"files": 0 if dry_run else missing, "bytes": seen.get["bytes"]} | browse.rate(seen.get["rows"], seconds)
