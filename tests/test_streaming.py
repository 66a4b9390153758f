import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from leafmill.streaming import incremental


def test_each_batch_and_unseen(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(2):
        spark.createDataFrame([(f"b{i}", k) for i in range(3 + k)], "barcode string, k int").coalesce(1).write.mode("append").parquet(src)
        q = incremental.each_batch(incremental.unseen(incremental.files(spark, src, "barcode string, k int")), lambda df: df.withColumn("done", F.lit(True)), out, str(tmp_path / "cp"))
        q.awaitTermination(60)
    assert sorted(r["barcode"] for r in spark.read.parquet(out).collect()) == ["b0", "b1", "b2", "b3"]


@pytest.mark.filterwarnings("ignore")
def test_windowed_counts(spark, data):
    df = spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    got = incremental.windowed(df).agg(F.sum("n")).first()[0]
    assert got == df.count()


LEASE_ROWS = "id_pipeline_batch long, node string, action string, ts timestamp"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(incremental.STATE_STORE)
    spark.conf.set(incremental.STATE_STORE, incremental.ROCKS)
    yield
    spark.conf.set(incremental.STATE_STORE, before)


def at(seconds):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def plain_leases(rows, seconds):
    """The fold of requests in order."""
    holder, out = {}, []
    for batch, node, action, ts in sorted(rows, key=lambda r: (r[0], r[3], r[1], r[2])):
        h = holder.get(batch)
        if h and ts >= h[1]:
            out.append((batch, h[0], "expired", h[1]))
            h = holder.pop(batch) and None
        if action == "claim":
            out.append((batch, node, "refused" if h else "granted", ts))
            if not h:
                holder[batch] = node, ts + datetime.timedelta(seconds=seconds)
        elif h and h[0] == node:
            out.append((batch, node, "released", ts))
            holder.pop(batch)
    return sorted(out)


def test_leases_over_restarts_equal_a_fold(spark, tmp_path):
    r = random.Random(4)
    rows = [(r.randrange(5), r.choice("abc"), r.choice(["claim", "claim", "release"]), at(i * 7 + r.randrange(3))) for i in range(120)]
    frames = [spark.createDataFrame(rows[lo : lo + 40], LEASE_ROWS) for lo in (0, 40, 80)]
    got = incremental.delivered(spark, frames, lambda s: incremental.leases(s, 60, "event"), str(tmp_path)).collect()
    assert sorted(tuple(x) for x in got) == plain_leases(rows, 60)


def test_a_delivery_that_comes_twice_counts_once(spark, tmp_path):
    schema = "k long, ts timestamp"
    frames = [spark.createDataFrame([(i, at(i)) for i in ids], schema) for ids in ([1, 2, 2], [2, 3], [1, 4])]
    got = incremental.delivered(spark, frames, lambda s: incremental.once(s, "k"), str(tmp_path))
    assert sorted(r.k for r in got.collect()) == [1, 2, 3, 4]


def test_a_batch_that_failed_runs_again(spark, tmp_path):
    src, out, fail = str(tmp_path / "in"), str(tmp_path / "out"), [True]
    spark.range(10).write.parquet(src)

    def work(df):
        if fail.pop() if fail else False:
            raise RuntimeError("killed")
        return df

    go = lambda: incremental.each_batch(incremental.files(spark, src, "id long"), work, out, str(tmp_path / "cp"))
    with pytest.raises(Exception, match="killed"):
        go().awaitTermination(60)
    go().awaitTermination(60)
    go().awaitTermination(60)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(10))


def test_timers_end_leases_without_a_request(spark, tmp_path, rocks):
    src = str(tmp_path / "req")
    rows = [(1, "a", "claim", at(1)), (1, "b", "claim", at(2)), (2, "c", "claim", at(1)), (2, "c", "release", at(3))]
    spark.createDataFrame(rows, LEASE_ROWS).coalesce(1).write.parquet(src)
    stream = incremental.files(spark, src, LEASE_ROWS)
    q = incremental.leases(stream, 3).writeStream.format("memory").queryName("lease_out").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    got, until = set(), time.time() + 90  # a query with timers never says that it is through
    while len(got) < 5 and time.time() < until:
        time.sleep(0.5)
        got = {tuple(r)[:3] for r in spark.sql("select * from lease_out").collect()}
    q.stop()
    assert got == {(1, "a", "granted"), (1, "b", "refused"), (1, "a", "expired"), (2, "c", "granted"), (2, "c", "released")}


def test_state_is_read_and_written_once_for_many_requests():
    from types import SimpleNamespace

    calls = []

    class State:
        def exists(self):
            calls.append("exists")
            return False

        def update(self, value):
            calls.append("update")

    p = incremental.LeaseProcessor(60, "event")
    p.holder = State()
    rows = [SimpleNamespace(node=n, action=a, at=1_000_000 * t) for t, n, a in [(2, "b", "claim"), (1, "a", "claim"), (3, "a", "release"), (4, "b", "claim"), (70, "c", "claim")] * 20]
    said = [(r.node, r.said) for r in p.handleInputRows((7,), iter(rows), None)]
    assert said[:2] == [("a", "granted"), ("a", "refused")] and said.count(("a", "released")) == 1 and said[-21:][:2] == [("b", "expired"), ("c", "granted")]
    assert calls == ["exists", "update"]
