"""Incremental mode: the same operators on streams of files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery


def files(spark: SparkSession, path: str, schema, most_files: int = 100) -> DataFrame:
    """A stream of Parquet files; at most so many a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)


def unseen(stream: DataFrame, key: str = "barcode") -> DataFrame:
    """Each key once over the life of the query."""
    return stream.dropDuplicates([key])


def each_batch(stream: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Work done batch by batch into a folder per batch, so a batch that runs again replaces itself."""

    def run(df: DataFrame, number: int) -> None:
        work(df).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(stream: DataFrame, ts: str = "ts", width: str = "1 hour", late: str = "10 minutes", by: str = "event_type", value: str = "value") -> DataFrame:
    """Counts and sums by window and kind; rows later than the watermark are dropped."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DECIDED = "id_pipeline_batch long, node string, said string, at long"


def once(stream: DataFrame, key: str, ts: str = "ts", late: str = "2 hours") -> DataFrame:
    """Rows delivered again within the time that rows may be late count once."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


class LeaseProcessor(StatefulProcessor):
    """One batch: a claim takes it while it is free, a release by its holder or the end of its time frees it.

    Requests of one delivery are taken by time, then node. By "event" time a claim is over when a later request says so.
    By "processing" time a timer frees the batch and tells, whether or not a request comes.
    """

    def __init__(self, seconds: int, clock: str):
        self.seconds, self.clock = seconds, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.holder = handle.getValueState("holder", "node string, until long, timer long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        (batch,) = key
        # the state is read once and written once, however many requests there are
        before = held = self.holder.get() if self.holder.exists() else None
        for r in sorted(rows, key=lambda r: (r.at, r.node is None, r.node or "", r.action or "")):
            if self.clock == "event" and held and r.at >= held[1]:
                yield Row(id_pipeline_batch=batch, node=held[0], said="expired", at=held[1])
                held = None
            if r.action == "claim":
                yield Row(id_pipeline_batch=batch, node=r.node, said="refused" if held else "granted", at=r.at)
                if not held:
                    timer = timerValues.getCurrentProcessingTimeInMs() + self.seconds * 1000 if self.clock == "processing" else None
                    held = r.node, r.at + self.seconds * 1_000_000, timer
            elif r.action == "release" and held and held[0] == r.node:
                yield Row(id_pipeline_batch=batch, node=r.node, said="released", at=r.at)
                held = None
        if held is not before:
            if before and before[2] is not None:
                self.handle.deleteTimer(before[2])
            if held and held[2] is not None:
                self.handle.registerTimer(held[2])
            if held:
                self.holder.update(held)
            else:
                self.holder.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (batch,) = key
        held = self.holder.get() if self.holder.exists() else None
        if held and held[2] == expiredTimerInfo.getExpiryTimeInMs():
            self.holder.clear()
            yield Row(id_pipeline_batch=batch, node=held[0], said="expired", at=held[1])

    def close(self) -> None:
        pass


def leases(requests: DataFrame, seconds: int = 3600, clock: str = "processing") -> DataFrame:
    """Decisions on claims and releases of batches: id_pipeline_batch, node, said, ts. requests: id_pipeline_batch, node, action, ts (timestamp).

    The state of a batch is its holder, kept in the state store that STATE_STORE names, which must be ROCKS.
    """
    mode = {"processing": "ProcessingTime", "event": "None"}[clock]
    asked = requests.select("id_pipeline_batch", "node", "action", F.unix_micros("ts").alias("at"))
    said = asked.groupBy("id_pipeline_batch").transformWithState(LeaseProcessor(seconds, clock), DECIDED, "append", mode)
    return said.select("id_pipeline_batch", "node", "said", F.timestamp_micros("at").alias("ts"))


def delivered(spark: SparkSession, deliveries: list[DataFrame], work: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """The result of a stream that gets one delivery after the other and stops in between: each time it starts again from its
    checkpoint, where the state and the files read are. work: stream to stream, with state.
    """
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        for df in deliveries:
            df.write.mode("append").parquet(f"{path}/in")
            out = work(spark.readStream.schema(df.schema).parquet(f"{path}/in"))
            q = each_batch(out, lambda d: d, f"{path}/out", f"{path}/checkpoint")
            q.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    return spark.read.schema(out.schema).parquet(f"{path}/out").select(*out.columns)
