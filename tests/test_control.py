"""Snapshots, leases and a run from archives to deduplicated hashes."""

import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.functions import images
from leafmill.plans import cli, execution, steps
from leafmill.plans.leases import Leases
from leafmill.sources import archives, schemas
from leafmill.sources.snapshots import Conflict, Table, put_if_absent


def test_put_if_absent_has_one_winner(spark, tmp_path):
    won = []
    go = [threading.Thread(target=lambda i=i: put_if_absent(spark, f"{tmp_path}/m/1.json", f"w{i}") and won.append(i)) for i in range(12)]
    [t.start() for t in go]
    [t.join() for t in go]
    assert len(won) == 1 and (tmp_path / "m" / "1.json").read_text() == f"w{won[0]}" and len(os.listdir(tmp_path / "m")) == 1


def test_readers_see_old_or_new_and_conflicts_change_nothing(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "k long, v string")
    t.create()
    t.create()
    assert t.version() == 1 and t.read().count() == 0
    rows = lambda v: spark.createDataFrame([(1, v)], "k long, v string")
    t.commit(rows("a"))
    old = t.read()
    t.commit(rows("b"), expect=2)
    assert [r.v for r in old.collect()] == ["a"] and [r.v for r in t.read().collect()] == ["b"]
    with pytest.raises(Conflict):
        t.commit(rows("c"), expect=2)
    assert [r.v for r in t.read().collect()] == ["b"] and len([n for n in os.listdir(tmp_path / "t") if n.startswith("rows-")]) == 3
    t.commit(rows("d"), append=True)
    assert sorted(r.v for r in t.read().collect()) == ["b", "d"]
    assert len(t.vacuum(2, 0)) == 2 and sorted(r.v for r in t.read().collect()) == ["b", "d"]


def test_a_writer_that_dies_leaves_the_old_table(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "k long")
    t.commit(spark.range(3).withColumnRenamed("id", "k"))

    def bad(it):
        for b in it:
            yield b
            raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        t.commit(spark.range(9, numPartitions=3).withColumnRenamed("id", "k").mapInPandas(bad, "k long"))
    assert t.version() == 1 and sorted(r.k for r in t.read().collect()) == [0, 1, 2]


def test_changes_of_two_writers_both_count(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "k long")
    t.create()
    add = lambda i: t.change(lambda old: old.union(spark.createDataFrame([(i,)], "k long")))
    go = [threading.Thread(target=add, args=(i,)) for i in range(3)]
    [x.start() for x in go]
    [x.join() for x in go]
    assert sorted(r.k for r in t.read().collect()) == [0, 1, 2]


def test_plain_files_are_version_0(spark, tmp_path):
    spark.range(2).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t"))
    t = Table(spark, str(tmp_path / "t"), "k long")
    t.create()
    assert t.version() == 0 and t.read().count() == 2
    t.change(lambda old: old.where("k = 1"))
    assert [r.k for r in t.read().collect()] == [1]


def test_leases(spark, tmp_path):
    now = [1000.0]
    leases = Leases(spark, str(tmp_path), 60, lambda: now[0])
    batch = spark.createDataFrame([(i, 1, None, None, None, None, False) for i in (1, 2, 3)], schemas.schema("pipeline_batch"))
    assert leases.over(batch).where("started_date is null").count() == 3
    a = leases.claim(1, "a")
    assert a and leases.claim(1, "b") is None
    now[0] += 61
    b = leases.claim(1, "b")
    assert b and not leases.release(a) and leases.release(b) and leases.claim(1, "c") is None
    c = leases.claim(2, "c")
    assert leases.claim(2, "d", ignore_locks=True) and not leases.release(c, crashed=True)
    assert leases.release(leases.claim(3, "e"), crashed=True)
    got = {r.id_pipeline_batch: (r.node_name, r.ended_date is not None, r.has_crashed) for r in leases.over(batch).collect()}
    assert got == {1: ("b", True, False), 2: ("d", False, False), 3: ("e", True, True)}
    assert leases.claim(3, "f")


def test_two_processes_never_hold_one_batch(spark, tmp_path):
    won = []
    go = [threading.Thread(target=lambda i=i: [won.append((b, i)) for b in range(4) if Leases(spark, str(tmp_path)).claim(b, f"n{i}")]) for i in range(4)]
    [t.start() for t in go]
    [t.join() for t in go]
    assert sorted(b for b, _ in won) == [0, 1, 2, 3]


@pytest.mark.parametrize("bad", [None, 2])
def test_execute_releases_and_stops_at_a_crash(spark, tmp_path, bad):
    leases, ran, lines = Leases(spark, str(tmp_path)), [], []

    def step(batch):
        assert leases.last(batch).action == "claim" and leases.last(batch).node == "n1"
        ran.append(batch)
        if batch == bad:
            raise RuntimeError("no")

    go = lambda: execution.execute([1, 2, 3], leases, 1, {"one": step, "two": step}, {"all": lambda run: ran.append(-run)}, "n1", log=execution.Log(lines.append))
    ok = go()
    if bad:
        assert not ok and ran == [1, 1, 2] and leases.last(2).action == "crash" and leases.last(3) is None
        bad = None
        ran.clear()
        assert go() and ran == [2, 2, 3, 3, -1]
    else:
        assert ok and ran == [1, 1, 2, 2, 3, 3, -1]
    with pytest.raises(ValueError):
        execution.execute([4], leases, 1, {})
    assert leases.last(4) is None
    assert not execution.run_all({"a": lambda: None, "b": lambda: 1 / 0, "c": lambda: ran.append("c")}, execution.Log(lines.append)) and "c" not in ran


def volumes(path, n):
    os.makedirs(path)
    r = np.random.default_rng(4)
    for v in range(n):
        pages = [(f"p{i}.jpg", images.encode_png(r.integers(0, 256, (24, 32, 3), dtype=np.uint8))) for i in range(3)]
        data = archives.pack_archive([x for x, _ in pages] + ["p0.txt", "p1.jpg.bad.jpg"], [d for _, d in pages] + [b"words", b"no image"])
        with open(f"{path}/v{v:02}.tar.gz", "wb") as f:
            f.write(data)


def test_a_run_from_archives_to_groups_with_a_crash_in_the_middle(spark, tmp_path, monkeypatch):
    root, scans = str(tmp_path / "root"), str(tmp_path / "scans")
    volumes(scans, 12)
    spark.createDataFrame([(f"v{v:02}", "{}") for v in range(12)], "barcode string, metadata string").write.parquet(f"{tmp_path}/src")
    monkeypatch.setattr(cli, "session", lambda *_: spark)
    do = lambda *argv: cli.main([root, *argv])
    do("build", f"{tmp_path}/src")
    do("prepare", "--run", "1", "--items-per-batch", "10")
    with pytest.raises(ValueError):
        do("execute", "--run", "1")
    assert steps.load(spark, root, "pipeline_batch")["pipeline_batch"].where("started_date is not null").count() == 0
    models = ["--archives", scans, "--detector", "tests.doubles:StandIn", "--classifier", "tests.doubles:StandIn", "--embedder", "tests.doubles:StandIn", "--captioner", "tests.doubles:StandIn", "--crops", f"{tmp_path}/crops"]
    classify = steps.classify
    monkeypatch.setitem(cli.BATCH_STEPS, "step02-classify", (lambda spark, root, batch, *more: 1 / 0 if batch == 2 else classify(spark, root, batch, *more), "classifier"))
    with pytest.raises(SystemExit):
        do("execute", "--run", "1", "--node", "here", *models)
    states = lambda: {r.id_pipeline_batch: (r.node_name, r.ended_date is not None, r.has_crashed) for r in steps.load(spark, root, "pipeline_batch")["pipeline_batch"].collect()}
    assert states() == {1: ("here", True, False), 2: ("here", True, True)}
    monkeypatch.setitem(cli.BATCH_STEPS, "step02-classify", (classify, "classifier"))
    do("execute", "--run", "1", *models)
    assert states()[2] == ("", True, False)
    t = steps.load(spark, root)
    n = t["detection"].count()
    assert n > 0 and t["detection"].select("id_detection").distinct().count() == n and t["detection"].select("id_pipeline_batch_item").distinct().count() > 6
    crops = t["classification"].count()
    assert 0 < crops == t["image_hash"].count() == t["image_embedding"].count() == t["deduped_hash"].count() and t["classification"].join(t["detection"], "id_detection", "left_anti").isEmpty()
    want = t["classification"].where(~F.col("pred_class").isin("Ex Libris or Decorative", "Artifact")).count()
    assert t["caption"].count() == want > 0 and t["caption"].where("text = ''").isEmpty()
    assert archives.crops(spark, f"{tmp_path}/crops").select("id_detection").join(t["classification"], "id_detection", "left_anti").isEmpty()
    # a step that runs again replaces itself
    do("step02-classify", "--batch", "1", "--archives", scans, "--classifier", "tests.doubles:StandIn")
    assert steps.load(spark, root, "classification")["classification"].count() == crops
    do("dedupe-embedding", "--run", "1", "--threshold", "0.9")
    assert steps.load(spark, root, "deduped_embedding")["deduped_embedding"].count() == crops
    do("step01-detect", "--batch", "2", "--archives", scans, "--detector", "tests.doubles:StandIn")
    again = steps.load(spark, root)
    assert again["detection"].count() == n and again["classification"].join(again["detection"], "id_detection", "left_anti").isEmpty()


def test_captions_that_fail_are_asked_again_and_marked(spark):
    from leafmill.plans import stages
    from tests.doubles import Broken, StandIn

    png = images.encode_png(np.zeros((4, 4, 3), np.uint8))
    crops = spark.createDataFrame([(1, 1, bytearray(png)), (2, 1, bytearray(b"no"))], "id_detection long, id_pipeline_batch_item long, png binary")
    prompts = spark.createDataFrame([(1, "p"), (2, "p")], "id_detection long, prompt string")
    assert {(r.id_detection, r.text) for r in stages.caption(crops, prompts, Broken, 2).collect()} == {(1, ""), (2, "")}
    assert [r.id_detection for r in stages.classify(crops, StandIn).collect()] == [1]


def test_shape_of_log_probabilities():
    from leafmill.plans import stages

    logs = [{"token": "é", "logprob": -1, "rank": 3, "top_logprobs": [{"token": "e", "logprob": None}]}, "x", {"bytes": [1], "logprob": True}]
    assert stages.shaped(logs) == [{"token": "é", "bytes": [195, 169], "logprob": -1.0, "top_logprobs": [{"token": "e", "bytes": [101], "logprob": None}]}, {"token": "", "bytes": [1], "logprob": None, "top_logprobs": []}]
    assert stages.shaped(None) is None and stages.shaped([]) == []


def test_commands_that_read(spark, tmp_path, monkeypatch, capsys):
    from leafmill.sources.derived import relation

    root = str(tmp_path / "root")
    monkeypatch.setattr(cli, "session", lambda *_: spark)
    for name in schemas.TABLES:
        try:
            df = relation(spark, "/root/testdata/sf0.001", name)
        except KeyError:
            df = spark.createDataFrame([], schemas.schema(name))
        have = {f.name: f.dataType for f in schemas.schema(name)}
        df = df.select(*[(F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in have.items()])
        Table(spark, f"{root}/{name}").commit(df)
    do = lambda *argv: cli.main([root, *argv])
    do("viewer", "--out", f"{tmp_path}/docs")
    do("read-viewer", f"{tmp_path}/docs")
    do("viewer", "--out", f"{tmp_path}/rows", "--detections-only", "--classes", "Music")
    n = spark.read.json(f"{tmp_path}/rows")
    assert n.count() > 0 and {r.pred_class for r in n.select("pred_class").collect()} == {"Music"}
    do("peek", "--n", "3")
    do("peek", "--scope", "volumes", "--sample-type", "first")
    do("peek", "--sample-type", "failed", "--n", "all")
    do("stats", "--out", f"{tmp_path}/stats", "--skip-slow")
    assert spark.read.json(f"{tmp_path}/stats").count() == 19
    do("export", "--out", f"{tmp_path}/hub", "--dry-run", "--limit", "2")
    do("export", "--out", f"{tmp_path}/hub", "--limit", "2", "--shard-size", "4")
    do("export", "--out", f"{tmp_path}/store", "--kind", "store", "--total-chunks", "2", "--chunk-index", "1", "--prefix", "p")
    assert spark.read.parquet(f"{tmp_path}/hub").count() > 0 and all(x.startswith("p-c01-") for x in os.listdir(tmp_path / "store"))
    do("create-view", "--out", f"{tmp_path}/view")
    with pytest.raises(Exception, match="exists"):
        do("create-view", "--out", f"{tmp_path}/view")
    do("create-view", "--out", f"{tmp_path}/view", "--drop-existing")
    do("run-all", "--out", f"{tmp_path}/all", "--skip-tokens", "--sample", "5", "--force")
    assert sorted(os.listdir(tmp_path / "all")) == ["atlas", "view"] and spark.read.parquet(f"{tmp_path}/all/atlas").count() == 5
    do("run-status")
    assert "COMPLETED" in capsys.readouterr().out
    do("vacuum", "--keep", "1")
    assert spark.read.parquet(f"{tmp_path}/hub").count() > 0


def test_thumbnails(spark):
    from leafmill.plans import stages

    r = np.random.default_rng(0)
    a = r.integers(0, 256, (40, 100, 3), dtype=np.uint8)
    small = images.shrunk(a, 50)
    assert small.shape == (20, 50, 3) and (small == np.round(a.reshape(20, 2, 50, 2, 3).mean((1, 3)))).mean() > 0.99
    assert (images.shrunk(a, 500) == a).all() and images.shrunk(a[:1], 10).shape == (1, 10, 3) and images.shrunk(a[:, :, 0], 7).shape == (3, 7)
    crops = spark.createDataFrame([(1, bytearray(images.encode_png(a))), (2, None), (3, bytearray(b"no"))], "id long, png binary")
    got = {x.id: x.png for x in stages.thumbnails(crops, 50).collect()}
    assert images.decode_png(bytes(got[1])).shape == (20, 50, 3) and got[2] is None and got[3] is None
