"""Substring deduplication and the similarity join against brute force."""

import hashlib
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import ngram_join, substring_dedup
from tests.llm.helpers import SCHEMA, corpus, frame, shingle_set


def removed(rows):
    """id -> what op1 should say; ids count once for what is earlier."""
    first = {}
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    for i, b in texts:
        if i is not None:
            for k in range(len(b) - 49):
                first[b[k : k + 50]] = min(first.get(b[k : k + 50], i), i)
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        if i is not None:
            for k in range(len(b) - 49):
                if first[b[k : k + 50]] < i:
                    gone[k : k + 50] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [None, 1, 3])
def test_substrings(spark, monkeypatch, hot):
    if hot:  # 1: every minimizer takes the way of the hot ones, and those of eight texts that of the hotter ones
        monkeypatch.setattr(substring_dedup, "HOT_LEAST", hot)
        monkeypatch.setattr(substring_dedup, "HOT_SHARE", 10**9)
    rows = corpus()
    got = substring_dedup.dedup(frame(spark, rows)).drop("kept")
    assert sorted(map(tuple, got.collect()), key=str) == removed(rows)


def test_one_id_with_several_texts(spark):
    passage = "a passage of more than fifty bytes that several of the documents have in common. "
    long_ = "first some words of its own, then " + passage + "and after it some more words that nobody else has said before."
    rows = [(1, passage), (5, long_), (5, "short"), (5, passage), (5, long_[10:]), (7, long_), (7, passage * 3), (7, "other " + passage), (None, long_), (9, None)]
    rows = [(i, t, None, None, None, None, None) for i, t in rows]
    assert sorted(map(tuple, substring_dedup.dedup(frame(spark, rows)).drop("kept").collect()), key=str) == removed(rows)


def test_very_long_and_periodic_texts(spark):
    rng = np.random.default_rng(4)
    prose = rng.integers(97, 123, 1_300_000).astype(np.uint8).tobytes().decode()  # more than one slice
    rows = [(1, prose), (2, "x" * 80 + prose[1_048_500:1_048_700] + "y" * 80), (3, "ab" * 700_000), (4, "ba" * 30 + "end"), (6, prose[:1_100_000] + "z")]
    got = {r["doc_id"]: r for r in substring_dedup.dedup(frame(spark, [(i, t, None, None, None, None, None) for i, t in rows])).collect()}
    assert got[2]["n_removed"] == 200 and got[2]["n_spans"] == 1 and bytes(got[2]["kept"]) == b"x" * 80 + b"y" * 80
    assert got[4]["n_removed"] == 60 and bytes(got[4]["kept"]) == b"end" and got[6]["n_removed"] == 1_100_000 and bytes(got[6]["kept"]) == b"z"
    assert got[1]["n_removed"] == got[3]["n_removed"] == 0 and got[3]["n_bytes"] == 1_400_000


@pytest.mark.parametrize("size", [64, 1000])
def test_slices_cover_every_window_once(monkeypatch, size):
    monkeypatch.setattr(substring_dedup, "SLICE", size)
    b = np.arange(700) % 251
    starts = [at + k for at, part in substring_dedup.sliced(b) for k in range(max(0, len(part) - 49)) if (part[k : k + 50] == b[at + k : at + k + 50]).all()]
    assert starts == list(range(651))


def test_gather_and_removed_runs():
    rng = np.random.default_rng(2)
    blob, starts, sizes = rng.integers(0, 9, 500).astype(np.uint8), rng.integers(0, 400, 60), rng.integers(0, 90, 60)
    assert substring_dedup.gather(blob, starts, sizes, 100).tolist() == [x for a, n in zip(starts, sizes, strict=True) for x in blob[a : a + n].tolist()]
    lo, hi = substring_dedup.removed_runs(90, False, [{"lo": a, "hi": b} for a, b in ((40, 50), (0, 20), (5, 10), (20, 30), (50, 60))])
    assert (lo.tolist(), hi.tolist()) == ([0, 40], [30, 60])


@pytest.mark.parametrize("text", ["random", "periodic"])
def test_windows_of_fragments_cover_shared_ones_only_once(text):
    rng = np.random.default_rng(0)
    b = rng.integers(97, 101, 4000).astype(np.uint8) if text == "random" else np.tile(np.arange(97, 100, dtype=np.uint8), 1400)
    every, none = substring_dedup.minimizers(b), np.zeros(0, np.uint64)
    for hot, hotter in ((none, none), (every, none), (every, every)):
        key, first, count = substring_dedup.fragments(b, every, hot, hotter)
        assert sorted(np.concatenate([np.arange(f, f + n) for f, n in zip(first, count, strict=True)]).tolist()) == list(range(len(b) - 49)) and count.max() <= substring_dedup.RUN
        windows = {}
        for k, f, n in zip(key.tolist(), first.tolist(), count.tolist(), strict=True):
            for w in range(f, f + n):  # equal windows get equal keys
                assert windows.setdefault(b[w : w + 50].tobytes(), k) == k


@pytest.mark.parametrize("letters", [1, 2, 4, 26])
def test_interval_expansion(letters):
    rng = np.random.default_rng(letters)
    base = rng.integers(97, 97 + letters, 300).astype(np.uint8).tobytes()
    frags = [base[a : a + n] for a, n in zip(rng.integers(0, 230, 40), rng.integers(50, 70, 40), strict=True)]
    docs = rng.integers(0, 99, 40)
    sizes = np.array(list(map(len, frags)))
    got = substring_dedup.least_documents(np.frombuffer(b"".join(frags), np.uint8), sizes, docs)
    least = {}
    for f, d in zip(frags, docs, strict=True):
        for k in range(len(f) - 49):
            least[f[k : k + 50]] = min(least.get(f[k : k + 50], 999), d)
    assert got.tolist() == [least[f[k : k + 50]] for f in frags for k in range(len(f) - 49)]


@pytest.mark.parametrize("text", ["random", "periodic", "one letter"])
def test_bounded_order_is_that_of_a_plain_sort(text):
    b = {"random": np.random.default_rng(1).integers(97, 99, 3000), "periodic": np.tile(np.arange(97, 100), 500), "one letter": np.full(700, 97)}[text].astype(np.uint8)
    order, eight = substring_dedup.bounded_order(b)
    # beyond the end lie symbols less than all others
    raw = [b[k : k + 64].tobytes() for k in range(len(b))]
    assert order.tolist() == sorted(range(len(b)), key=lambda k: (raw[k], k))
    first = sorted(x[:8].ljust(8, b"\0") for x in raw)
    assert eight.tolist() == [first.index(x[:8].ljust(8, b"\0")) for x in raw]


def test_a_transform_takes_few_sorts_of_its_length():
    rng = np.random.default_rng(6)
    base = rng.integers(97, 123, 1 << 15).astype(np.uint8)
    blob = np.concatenate([base[k : k + 400] for k in rng.integers(0, len(base) - 400, 1000)])
    took = []
    for _ in range(3):  # the least of three: others run on the machine
        numbers = rng.integers(0, 2**62, 1 << 22)
        began = time.process_time()
        np.sort(numbers)
        middle = time.process_time()
        substring_dedup.classes(blob)
        took.append((middle - began, time.process_time() - middle))
    assert min(c for _, c in took) < 5 * min(s for s, _ in took)  # 2.8; 7.7 and more when tuples and not numbers were sorted


def components(rows):
    sets = [(i, shingle_set(t)) for i, t, *_ in rows]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                up[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted([(i, len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)], key=str)


@pytest.mark.parametrize("list_", [1, 8])
def test_similar(spark, monkeypatch, list_):
    monkeypatch.setattr(ngram_join, "LIST", list_)  # 1: every list is a long one
    rows = corpus(90, 7)
    got = ngram_join.similar(frame(spark, rows)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == components(rows)


@pytest.mark.parametrize(("list_", "num", "den"), [(1, 3, 10), (8, 3, 10), (8, 9, 10)])
def test_similar_at_other_thresholds(spark, monkeypatch, list_, num, den):
    monkeypatch.setattr(ngram_join, "LIST", list_)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:k] + [f"x{k}y{i}" for i in range(60 - k)]) for k in (60, 58, 52, 40, 34, 24)]
    texts += [" ".join([f"z{k}y{i}" for i in range(60 - k)] + base[60 - k :]) for k in (50, 36, 30)]
    sets = [shingle_set(t) for t in texts]
    least = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(len(texts)):
                if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    least[a] = min(least[a], least[b])
    rows = [(i, t, None, None, None, None, None) for i, t in enumerate(texts)]
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.similar(frame(spark, rows), num, den).collect()} == dict(enumerate(least))


def test_nodes_of_one_name_are_told_apart(spark):
    rows = corpus(90, 7)
    got = ngram_join.similar(frame(spark, rows), node_bits=4).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == components(rows)


def test_hot_shingles_go_last_and_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_LEAST", 2)  # whatever two nodes share is hot
    rows = corpus(90, 8)
    got = ngram_join.similar(frame(spark, rows)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == components(rows)


def test_a_common_notice_makes_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAST_BITS", 4)  # the sketch is saturated: it tells nothing
    monkeypatch.setattr(ngram_join, "MOST_BITS", 4)
    compared, real = [], ngram_join._bounded

    def counted(pairs, *rest):
        compared[-1] += pairs.count()
        return real(pairs, *rest)

    monkeypatch.setattr(ngram_join, "_bounded", counted)
    notice = " ".join(f"notice{k}" for k in range(12))
    for n in (200, 400, 800):
        compared.append(0)
        texts = [" ".join(f"w{i}x{k}" for k in range(15)) + f" {notice} " + " ".join(f"v{i}x{k}" for k in range(15)) for i in range(n)]
        got = ngram_join.similar(frame(spark, [(i, t, None, None, None, None, None) for i, t in enumerate(texts)])).collect()
        assert all(r["component_id"] == r["doc_id"] for r in got)
    assert compared[2] <= 4 * max(compared[0], 200) and compared[2] <= 8 * 800


def test_very_long_text(spark):
    words = [f"w{k}" for k in range(250_000)]  # 1.7 MB
    rows = [(1, " ".join(words)), (2, " ".join(words[:240_000])), (3, " ".join(words[:100_000])), (4, "w1 w2 w3")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar(frame(spark, [(i, t, None, None, None, None, None) for i, t in rows])).collect()}
    assert got == {1: (249_996, 1), 2: (239_996, 1), 3: (99_996, 3), 4: (1, 4)}


def test_threshold_is_exact(spark):
    base = [f"w{i}" for i in range(104)]
    rows = [(1, " ".join(base), None, None, None, None, None)]
    for k, d in ((2, 14), (3, 15), (4, 13)):  # the last words differ: 100 shingles, 100 - d common
        rows.append((k, " ".join(base[: 104 - d] + [f"x{k}{i}" for i in range(d)]), None, None, None, None, None))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar(frame(spark, rows)).collect()}
    assert got == {i: c for i, _, c in components(rows)} and got[2] == 1 and got[3] == 3


def test_short_and_case(spark):
    rows = [(5, "Go WEST"), (3, "go west"), (4, "go\twest\n"), (9, "go west now"), (2, "É a b c d"), (1, "é a b c d")]
    rows = [(i, t, None, None, None, None, None) for i, t in rows]
    assert sorted(map(tuple, ngram_join.similar(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()), key=str) == components(rows)


def test_sketch_filter_matches_spark(spark):
    x = spark.range(-3, 500).withColumn("h", F.pmod(F.xxhash64("id"), F.lit(ngram_join.FILTER_BITS))).toPandas()
    assert (ngram_join.spark_hash(x.id.to_numpy()) == x.h.to_numpy()).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.dedup(none).count() == 0
    assert ngram_join.similar(none).count() == 0
