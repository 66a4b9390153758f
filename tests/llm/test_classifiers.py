"""Held-out accuracy of the three classifiers, and the pipeline end to end."""

import numpy as np
import pytest

from leafmill.llm import language_id, quality_classifier, toxicity
from tests.llm.helpers import SCHEMA, frame


@pytest.fixture(scope="module")
def tables(spark):
    d = "/root/testdata/sf0.01"
    return {t: spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels")}


def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable"))
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


def test_language(spark, tables):
    p = language_id.identify(tables["documents"]).join(tables["documents"].select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (p.lang == p.lang_pred).mean() >= 0.97 and p.score.between(0, 1).all()


def test_language_cases(spark):
    rows = [(i, "der und die haus" if i % 2 else "le chat et la maison", "de" if i % 2 else "fr", None, None, None, None) for i in range(40)]
    rows += [(100, None, "de", None, None, None, None), (101, "12 34 !!", "de", None, None, None, None), (102, "", None, None, None, None, None), (None, "und die", None, None, None, None, None), (103, "a", None, None, None, None, None)]
    got = {r["doc_id"]: r for r in language_id.identify(frame(spark, rows)).collect()}
    assert [got[k]["lang_pred"] for k in (100, 101, 102)] == ["und"] * 3 and got[None]["lang_pred"] == "de" and not got[None]["held_out"] and got[103]["lang_pred"] in ("de", "fr")
    assert language_id.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    nolang = language_id.identify(frame(spark, [(1, "words", None, None, None, None, None)])).first()
    assert nolang["lang_pred"] == "und" and nolang["score"] == 0


def test_slices_do_not_change_trigrams(monkeypatch):
    text = "Ab cd, éf 1 g" * 50
    whole = language_id.trigrams(text)
    monkeypatch.setattr(language_id, "SLICE", 7)
    parts = language_id.trigrams(text)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    direct = language_id.bundles([text], 64)[0]
    assert np.allclose(direct, (language_id.trigram_vectors(whole[0], 64).astype(float) * whole[1][:, None]).sum(0))


def test_toxicity(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    p = toxicity.classify(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).join(labels, "doc_id").where("held_out and toxic is not null").toPandas()
    assert p.score.between(0, 1).all() and auc(p.score.to_numpy(), p.toxic.to_numpy()) >= 0.85


@pytest.mark.parametrize(("head", "word"), [("Read before you write: the rules of this forum are set out here. ", "vermin"), ("", "мерзавец")])
def test_every_distinct_text_trains(head, word):
    letters = "абвгдежз" if word > "z" else "abcdefgh"
    said = lambda k: " ".join(letters[int(c)] * 4 for c in f"{k:05o}")
    ordinary, toxic = toxicity.dictionaries([f"{head}{said(k)} {word}".encode() for k in range(20)] * 2, [f"{head}{said(k)}".encode() for k in range(20)])[:2]
    assert word.encode() in toxic and word.encode() not in ordinary


def test_toxicity_cases(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, None, None, None, None, None, None), (2, "", None, None, None, None, None), (3, "text " * 5000, None, None, None, None, None), (3, "text", None, None, None, None, None)]
    got = toxicity.classify(frame(spark, rows), none).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in got)
    assert toxicity.classify(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_quality(spark, tables):
    p = quality_classifier.classify(tables["documents"], tables["labels"]).join(tables["labels"], "doc_id").where("held_out and quality is not null").toPandas()
    assert p.score.between(0, 1).all() and auc(p.score.to_numpy(), p.quality.to_numpy()) >= 0.95


def test_quality_cases(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_classifier.classify(frame(spark, [(1, None, None, None, None, None, None), (2, "", None, None, None, None, None)]), none).collect()
    assert [r["score"] for r in got] == [0.5, 0.5]
    assert quality_classifier.classify(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_isotonic_and_kernel():
    got = quality_classifier.isotonic(np.arange(5), np.array([1, 0, 2, 0, 3.0]), np.array([1, 1, 2, 0, 3.0]))
    assert (np.diff(got) >= -1e-9).all() and abs(got[0] - 0.5) < 1e-3
    x = np.random.default_rng(0).normal(size=(2, len(quality_classifier.NAMES)))
    z = quality_classifier.fourier(x, 20000)[:, :-1]
    assert abs(z[0] @ z[1] - np.exp(-((x[0] - x[1]) ** 2).sum() / 2 / quality_classifier.WIDTH**2)) < 0.03


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").toPandas()
    assert len(out) > 100 and (out.groupby("sequence_id").length.sum() <= 1024).all()


def test_pipeline_stages_survive_odd_rows(spark, tmp_path):
    import corpus_pipeline
    from tests.llm.helpers import corpus

    rows = [r[:5] for r in corpus(50, 4)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, "an item that nobody has quoted anywhere at all, ever")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.staged(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0) == bool(data)
