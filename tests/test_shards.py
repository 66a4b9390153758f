"""Shards on disk against their plan, resumed and aborted."""

import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from leafmill.functions import images
from leafmill.plans import stages
from leafmill.sources import shards


def records(spark, n=43):
    rows = [(i, ["Music", "Chart/Graph", None][i % 5 % 3], bytearray(b"x" * i)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, classification_gen string, crop_gen binary").repartition(4)


def on_disk(path):
    return {n: pq.read_table(f"{path}/{n}").column("id").to_pylist() for n in sorted(os.listdir(path)) if n.endswith(".parquet")}


def wanted(plan):
    out = {}
    for r in plan.orderBy("file", "id").collect():
        out.setdefault(r.file, []).append(r.id)
    return out


def test_files_equal_the_plan_and_row_groups_are_set(spark, tmp_path):
    plan, path = shards.planned(records(spark), 7), str(tmp_path / "out")
    told = shards.write_shards(spark, plan, path, 3)
    want = wanted(plan)
    assert on_disk(path) == want and len(want) > 5 and all("-of-" in n for n in want)
    assert told["files"] == len(want) and told["rows"] == 43 and told["bytes"] == sum(range(43)) and told["rows_per_second"] > 0
    assert not [n for n in os.listdir(path) if n.startswith("_")]
    full = next(n for n, ids in want.items() if len(ids) == 7)
    f = pq.ParquetFile(f"{path}/{full}")
    assert [f.metadata.row_group(i).num_rows for i in range(f.metadata.num_row_groups)] == [3, 3, 1] and f.schema_arrow.names == ["id", "classification_gen", "crop_gen"]
    assert spark.read.parquet(path).count() == 43


def test_missing_shards_are_written_again(spark, tmp_path):
    plan, path = shards.planned(records(spark), 7), str(tmp_path / "out")
    shards.write_shards(spark, plan, path)
    lost = shards.there(path)[1]
    os.unlink(f"{path}/{lost}")
    kept = {n: os.stat(f"{path}/{n}").st_mtime_ns for n in shards.there(path)}
    told = shards.write_shards(spark, plan, path)
    assert told["files"] == 1 and told["rows"] == len(wanted(plan)[lost]) and on_disk(path) == wanted(plan)
    assert {n: os.stat(f"{path}/{n}").st_mtime_ns for n in kept} == kept
    assert shards.write_shards(spark, plan, path)["rows"] == 0


def test_an_aborted_job_leaves_nothing_and_can_be_resumed(spark, tmp_path):
    path = str(tmp_path / "out")
    bad = F.udf(lambda i: 1 // (30 - i) * 0 + i, "long")  # fails for id 30
    plan = shards.planned(records(spark), 7)
    with pytest.raises(Exception, match="ZeroDivision"):
        shards.write_shards(spark, plan.withColumn("id", bad("id")), path)
    assert shards.there(path) == []
    w = shards.ShardWriter({"path": path, "job": "j"})
    b = pa.RecordBatch.from_pydict({"file": ["a.parquet"], "id": [1]})
    w.write(iter([b]))
    assert len(os.listdir(f"{path}/_drafts-j")) == 1
    w.abort([None])
    assert os.listdir(path) == []
    shards.write_shards(spark, plan, path)
    assert on_disk(path) == wanted(plan)


def test_another_export_and_a_dry_run(spark, tmp_path):
    path = str(tmp_path / "out")
    assert shards.write_shards(spark, shards.planned(records(spark), 7), path, dry_run=True)["rows"] == 43 and not os.path.exists(path)
    shards.write_shards(spark, shards.planned(records(spark), 7), path)
    with pytest.raises(ValueError):
        shards.write_shards(spark, shards.planned(records(spark), 20), path)


def test_names_of_a_store(spark, tmp_path):
    plan = shards.planned(records(spark), 20, False, "pre", 3)
    shards.write_shards(spark, plan, str(tmp_path / "out"))
    assert shards.there(str(tmp_path / "out")) == ["pre-c03-0000.parquet", "pre-c03-0001.parquet", "pre-c03-0002.parquet"]
    assert {r.file for r in shards.planned(records(spark), 50, False, "pre").select("file").collect()} == {"pre-0000.parquet"}


def test_large_row_groups_close_by_bytes(spark, tmp_path):
    w = shards.ShardWriter({"path": str(tmp_path / "o"), "job": "j", "groupbytes": "100"})
    b = pa.RecordBatch.from_pydict({"file": ["a"] * 2, "id": [1, 2], "crop_gen": [b"x" * 90] * 2})
    w.commit([w.write(iter([b, b])), None])
    assert pq.ParquetFile(f"{tmp_path}/o/a").metadata.num_row_groups == 2


def test_crops_are_turned(spark):
    a = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    png = bytearray(images.encode_png(a))
    rows = [(1, (png, "1.png"), "rotate_180", True), (2, (png, "2.png"), "rotate_180", False), (3, (bytearray(b"no"), "3.png"), "rotate_90_cw", True)]
    r = spark.createDataFrame(rows, "id long, crop_gen struct<bytes:binary,path:string>, orientation_correction_gen string, rotated boolean")
    got = {x.id: bytes(x.crop_gen.bytes) for x in stages.turned(r).collect()}
    assert (images.decode_png(got[1]) == images.rotate(a, "rotate_180")).all() and got[2] == bytes(png) and got[3] == b"no"
