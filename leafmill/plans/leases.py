"""Leases of batches: a numbered event for each claim and release, put if it isn't there, so that one holder wins."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.sources.snapshots import names, put_if_absent, read_text

CLAIM, DONE, CRASH = "claim", "done", "crash"


@dataclass(frozen=True)
class Event:
    batch: int
    seq: int
    action: str
    node: str
    at: float
    started: float | None = None


class Leases:
    """Events below a folder, one folder a batch. seconds: how long a claim holds without a release."""

    def __init__(self, spark: SparkSession, path: str, seconds: float = 86_400, clock: Callable[[], float] = time.time):
        self.spark, self.path, self.seconds, self.clock = spark, path.rstrip("/"), seconds, clock

    def _put(self, e: Event) -> bool:
        return put_if_absent(self.spark, f"{self.path}/batch={e.batch}/{e.seq:08d}.json", json.dumps(asdict(e)))

    def last(self, batch: int) -> Event | None:
        at = f"{self.path}/batch={batch}"
        found = [n for n in names(self.spark, at) if n.endswith(".json") and n[0] != "."]
        return Event(**json.loads(read_text(self.spark, f"{at}/{found[-1]}"))) if found else None

    def free(self, e: Event | None, ignore_locks: bool = False) -> bool:
        """Never claimed, crashed, or claimed too long ago; a batch that is done isn't free."""
        return e is None or e.action == CRASH or (e.action == CLAIM and (ignore_locks or self.clock() - e.at > self.seconds))

    def claim(self, batch: int, node: str, ignore_locks: bool = False) -> Event | None:
        """The claim, if the batch was free and nobody else came first."""
        before = self.last(batch)
        if not self.free(before, ignore_locks):
            return None
        e = Event(batch, before.seq + 1 if before else 1, CLAIM, node, self.clock())
        return e if self._put(e) else None

    def release(self, held: Event, crashed: bool = False) -> bool:
        """Whether the claim was still the last word; if not, its time was over and another has the batch."""
        return self._put(Event(held.batch, held.seq + 1, CRASH if crashed else DONE, held.node, self.clock(), held.at))

    def over(self, batches: DataFrame) -> DataFrame:
        """The batch table with node, start, end and crash of each batch's last event."""
        if not names(self.spark, self.path):
            return batches
        events = self.spark.read.schema("batch long, seq long, action string, node string, at double, started double").json(f"{self.path}/*/*.json")
        e = events.groupBy(F.col("batch").alias("id_pipeline_batch")).agg(F.max_by(F.struct("*"), "seq").alias("e"))
        e = e.select("id_pipeline_batch", "e.action", "e.node", F.timestamp_seconds(F.coalesce("e.started", "e.at")).alias("s"), F.timestamp_seconds("e.at").alias("at"))
        said, claimed = F.col("action").isNotNull(), F.col("action") == CLAIM
        cols = {
            "node_name": F.when(said, F.col("node")).otherwise(F.col("node_name")), "started_date": F.when(said, F.col("s")).otherwise(F.col("started_date")),
            "ended_date": F.when(said, F.when(~claimed, F.col("at"))).otherwise(F.col("ended_date")), "has_crashed": F.when(said, F.col("action") == CRASH).otherwise(F.col("has_crashed"))}
        return batches.join(e, "id_pipeline_batch", "left").withColumns(cols).select(*batches.columns)
