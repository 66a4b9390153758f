"""Operators against plain Python, properties and plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.operators import backfill, control, embedding_dedupe, export, hash_dedupe, views
from leafmill.operators.components import connected_components
from leafmill.plans import stages
from leafmill.sources import archives, schemas, sinks
from leafmill.sources.derived import relation
from tests.doubles import Orienter, StandIn


def union_find(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], None])
def test_components(spark, edges):
    if edges is None:
        r = random.Random(3)
        edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)]
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == union_find(edges)


def hashes(n=120, seed=5):
    r = random.Random(seed)
    out = []
    for i in range(n):
        if out and r.random() < 0.6:
            h = int(r.choice(out), 16)
            for _ in range(r.choice([0, 1, 4, 5, 6, 16, 20])):
                h ^= 1 << r.randrange(144)
        else:
            h = r.getrandbits(144)
        out.append(f"{h:036x}")
    return out


@pytest.mark.parametrize("threshold", [5, 16])
def test_hash_pairs_against_brute_force(spark, threshold):
    hs = hashes()
    df = spark.createDataFrame(list(enumerate(hs)), "id long, h string")
    band = lambda h: [h[30 - 6 * i : 36 - 6 * i] for i in range(6)]
    want, near = set(), set()
    for i, a in enumerate(hs):
        for j in range(i + 1, len(hs)):
            if (int(a, 16) ^ int(hs[j], 16)).bit_count() <= threshold:
                near.add((i, j))
                if any(x == y for x, y in zip(band(a), band(hs[j]), strict=True)):
                    want.add((i, j))
    assert {tuple(r) for r in hash_dedupe.all_pairs(df, threshold=threshold).collect()} == want
    assert threshold > 5 or want == near  # six bands can't all differ
    groups = {r["id"]: r["group_id"] for r in hash_dedupe.assign(df, hash_dedupe.duplicate_pairs(df, threshold=threshold)).collect()}
    assert groups == {i: i for i in range(len(hs))} | union_find(want)


def test_malformed_hashes(spark):
    df = spark.createDataFrame([(1, "zz"), (2, "zz"), (3, "0" * 36), (4, None)], "id long, h string")
    assert hash_dedupe.all_pairs(df).count() == 0
    assert {tuple(r) for r in hash_dedupe.all_pairs(df, invalid="zero").collect()} == {(a, b) for a in range(1, 5) for b in range(a + 1, 5)}


def test_bucket_bound(spark):
    df = spark.createDataFrame([(i, f"{i:012x}" + "0" * 24) for i in range(6)], "id long, h string")
    assert hash_dedupe.all_pairs(df, max_bucket=5, threshold=144).count() == 0
    assert hash_dedupe.all_pairs(df, max_bucket=None, threshold=144).count() == 15


def test_linked_rows_grow_with_the_table(spark):
    df = spark.createDataFrame([(i, "0" * 36) for i in range(40)] + [(100 + i, "0" * 35 + "1") for i in range(40)] + [(0, "0" * 36)], "id long, h string")
    got = {tuple(r) for r in hash_dedupe.linked(df).collect()}
    assert got == {(0, 100, "near")} | {(0, i, "copy") for i in range(1, 40)} | {(100, 100 + i, "copy") for i in range(1, 40)}


def test_copies_are_linked_whatever_their_number(spark):
    hs = ["0" * 36] * 8 + ["0" * 35 + "1", "f" * 36]
    df = spark.createDataFrame(list(enumerate(hs)), "id long, h string")
    groups = {r["id"]: r["group_id"] for r in hash_dedupe.assign(df, hash_dedupe.duplicate_pairs(df, max_bucket=3)).collect()}
    assert groups == {i: 0 for i in range(9)} | {9: 9}


def test_hash_queries_have_no_bucket_bound(spark, monkeypatch):
    from leafmill.plans import catalog

    rows = [(i, f"{i:06x}" + "0" * 30, i, i) for i in (1, 3, 7, 15)]  # every two share bands and differ in at most three bits
    hashes = spark.createDataFrame(rows, "id_imagehash long, image_hash string, id_pipeline_batch_item long, id_detection long")
    monkeypatch.setattr(catalog, "relation", lambda *_: hashes)
    assert catalog.QUERIES["hash_pairs"](spark, "").count() == 6
    assert {r["group_id"] for r in catalog.QUERIES["hash_groups"](spark, "").collect()} == {1}


def test_hash_pairs_are_all_pairs(spark, monkeypatch):
    from leafmill.plans import catalog

    monkeypatch.setattr(hash_dedupe, "PART", 7)  # a group is several parts
    hs = {i: "0" * 36 for i in range(40)} | {100 + i: "0" * 35 + "1" for i in range(12)} | {i: f"{i:036x}" for i in (200, 201)} | {300 + i: "F" * 36 for i in range(2)} | {400: "f" * 36, 500: "zz"}
    rows = [(i, h, i, i) for i, h in hs.items()]
    df = spark.createDataFrame(rows, "id_imagehash long, image_hash string, id_pipeline_batch_item long, id_detection long")
    monkeypatch.setattr(catalog, "relation", lambda *_: df)
    good = {i: int(h, 16) for i, h in hs.items() if h != "zz"}
    want = {(a, b) for a in good for b in good if a < b and (good[a] ^ good[b]).bit_count() <= 16}
    got = catalog.QUERIES["hash_pairs"](spark, "")
    assert got.columns == ["a", "b"]
    got = [tuple(r) for r in got.collect()]
    assert set(got) == want and len(got) == len(want) > 1000


def test_all_pairs_of_an_id_with_several_hashes(spark):
    rows = [(1, "0" * 36), (1, "0" * 35 + "1"), (1, "0" * 36), (2, "0" * 36), (3, "0" * 35 + "1"), (2, "0" * 35 + "3")]
    got = [tuple(r) for r in hash_dedupe.all_pairs(spark.createDataFrame(rows, "id long, h string")).collect()]
    assert sorted(got) == [(1, 2), (1, 3), (2, 3)]


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 16))
    x[30:40] = x[:10] + rng.normal(size=(10, 16)) * 0.05
    x[50] = x[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if n[i] @ n[j] >= 0.86}
    for rows in (100, 13):
        assert {(r["i"], r["j"]) for r in embedding_dedupe.neighbours_exact(df, 0.86, None, rows).collect()} == want
    got = {(r["i"], r["j"]) for r in embedding_dedupe.neighbours_indexed(df, 0.86, None).collect()}
    assert got <= want and union_find(got) == union_find(want)
    k = {(r["i"], r["j"]) for r in embedding_dedupe.neighbours_exact(df, -1.0, 3, 13).collect()}
    assert k == {(i, int(j)) for i in range(60) for j in np.argsort(-(n[i] @ n.T), kind="stable")[:3] if i < j}


def test_representative_prefers_unknown_confidence(spark):
    h = spark.createDataFrame([(1, 9), (2, 9), (3, 9)], "id_detection long, group_id long")
    d = spark.createDataFrame([(1, 0.9), (2, None), (3, 0.95)], "id_detection long, bbox_conf double")
    assert [r[0] for r in views.representatives(h, h, d).collect()] == [2]
    assert sorted(r[0] for r in views.representatives(h, h, d.where("bbox_conf is not null")).collect()) == [3]
    plan = views.representatives(h, h, d)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan


def test_view_has_its_columns(spark, data):
    t = {n: relation(spark, data, n) for n in schemas.TABLES if n not in ("pipeline_run", "export_allow_list")}
    v = views.filtered_dataset(t)
    assert len(v.columns) == 20
    r = export.records(v, "store")
    assert set(r.columns) | {"crop_gen"} == set(schemas.schema("store").names)
    assert dict(r.dtypes)["caption_chronam_thesauri_matches_exp"] == "map<string,map<string,bigint>>"


def test_prepare_and_numbering_do_not_depend_on_partitions(spark):
    v = spark.createDataFrame([(f"b{i:03d}",) for i in range(57)], "barcode string")
    want = [(i + 1, i // 10 + 1, f"b{i:03d}") for i in range(57)]
    for n in (1, 7):
        b, items = control.prepare_run(v.repartition(n), 1, 10)
        assert sorted(map(tuple, items.collect())) == want
        assert sorted((r["id_pipeline_batch"], r["items"]) for r in b.collect()) == [(k + 1, 10 if k < 5 else 7) for k in range(6)]
    with pytest.raises(ValueError):
        control.prepare_run(v, 1, 5)


def test_lease_and_release(spark):
    b = spark.createDataFrame([(1, None, None, None, True), (2, "n", None, None, False)], "id_pipeline_batch long, node_name string, started_date timestamp, ended_date timestamp, has_crashed boolean")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    one = spark.createDataFrame([(1,)], "id_pipeline_batch long")
    took = control.leased(b, one, "me", now)
    assert [(r["node_name"], r["started_date"] is not None, r["has_crashed"]) for r in took.orderBy("id_pipeline_batch").collect()] == [("me", True, False), ("n", False, False)]
    assert control.released(took, one, now, True).where("has_crashed and ended_date is not null").count() == 1


def test_thesaurus(spark):
    c = spark.createDataFrame([(1, "A C++ bird and a bird's nest; Äpfel"), (2, None), (3, "none")], "id_caption long, text string")
    t = spark.createDataFrame([("animal", "Bird", ["bird's nest", None]), ("food", "äpfel", None)], "category string, keyword string, related_terms array<string>")
    got = {(r["id_caption"], r["category"], r["term"], r["n"]) for r in backfill.thesaurus_counts(c, t).collect()}
    assert got == {(1, "animal", "bird", 1), (1, "animal", "bird's nest", 1), (1, "food", "äpfel", 1)}


def test_stages_and_archives(spark, tmp_path):
    from leafmill.functions import images

    rng = np.random.default_rng(4)
    pages = [(f"p{i}.jpg", images.encode_png(rng.integers(0, 256, (30, 40, 3), dtype=np.uint8))) for i in range(4)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "vol.tar.gz").write_bytes(archives.pack_archive([n for n, _ in pages] + ["p0.txt", "x.bin"], [d for _, d in pages] + [b"words", b"?"]))
    items = spark.createDataFrame([(7, "vol"), (8, "missing")], "id_pipeline_batch_item long, barcode string")
    scans = archives.scans(spark, items, str(tmp_path / "in"))
    assert scans.where("bytes is not null").count() == 4 and scans.where("text = 'words'").count() == 1
    found = stages.detect(scans, StandIn).orderBy("scan_filename", "bbox_conf").collect()
    det = spark.createDataFrame([(i, *r) for i, r in enumerate(found)], "id_detection long, id_pipeline_batch_item long, scan_filename string, bbox_xyxy array<double>, bbox_xywh array<double>, bbox_conf double")
    crops = stages.cut(det, scans)
    n = crops.where("png is not null").count()
    assert stages.classify(crops, StandIn).count() == stages.embed(crops, StandIn).count() == stages.orient(crops, Orienter).count() == n
    assert stages.embed(crops, StandIn).where("size(embedding) <> 512 or length(image_hash) <> 36").count() == 0
    said = stages.caption(crops, crops.select("id_detection", F.lit("Describe.").alias("prompt")), StandIn)
    assert said.where("text = ''").count() == 0 and said.count() == n
    made = archives.crop_archives(crops.withColumn("barcode", F.lit("vol"))).collect()
    assert sum(1 for r in made for _ in archives.members(r["archive"])) == n
