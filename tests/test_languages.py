"""Languages by trigram profiles, and their names."""

from pyspark.sql import functions as F

from leafmill.functions import language_profiles as lp
from leafmill.functions import rules
from leafmill.operators import backfill
from leafmill.sources import schemas


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) >= 60")
    profiles = lp.train(docs.where("doc_id % 5 <> 0"))
    assert set(profiles) == {"en", "fr", "de", "es"} and all(len(p.weights) <= lp.KEPT for p in profiles.values())
    held = docs.where("doc_id % 5 = 0").select("lang", lp.detector(profiles)(F.col("text")).alias("said"))
    n, right, none = held.agg(F.count("*"), F.count_if(F.col("lang") == F.col("said")), F.count_if(F.col("said").isNull())).first()
    assert n > 100 and right / n > 0.97
    short = docs.where("doc_id % 5 = 0").select("lang", lp.detector(profiles)(F.substring("text", 1, 60)).alias("said"))
    assert short.where("lang = said").count() / n > 0.85


def test_training_is_a_count(spark, monkeypatch):
    rows = [("xx", "Aab aab!"), ("xx", None), (None, "zzz"), ("yy", "zz zz ZZ"), ("yy", "")]
    got = lp.train(spark.createDataFrame(rows, "lang string, text string").repartition(3), kept=4)
    want = {}
    for lang in ("xx", "yy"):
        c = sum((lp.trigrams(t) for k, t in rows if k == lang and t), start=lp.Counter())
        total = sum(c.values())
        want[lang] = lp.Profile(lp.weight(0, total, 4), {g: lp.weight(n, total, 4) for g, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:4]})
    assert got == want and lp.loaded(lp.saved(got)) == got


def test_unknown_texts_are_null(spark):
    profiles = {"xx": lp.Profile(-100, {" ab": -1, "ab ": -1}), "yy": lp.Profile(-100, {" cd": -1, "cd ": -1})}
    said = {"ab ab": "xx", "CD!": "yy", "": None, None: None, "12 34": None, "qqqq rrrr": None, "ab cd": None, "ab " * 100_000: "xx"}
    got = {r.t: r.s for r in spark.createDataFrame([(t,) for t in said], "t string").select("t", lp.detector(profiles)(F.col("t")).alias("s")).collect()}
    assert got == said
    assert lp.told("ab", {}) is None and lp.train(spark.createDataFrame([], "lang string, text string")) == {}


def test_backfill_takes_a_detector(spark):
    rows = [(1, 1, 1, "ab ab", None, None, None, None, None, None), (2, 1, 2, " ", None, None, None, None, None, None), (3, 1, 3, "ab", None, None, "old", None, None, None)]
    c = spark.createDataFrame(rows, schemas.schema("caption"))
    detect = lp.detector({"xx": lp.Profile(-9, {" ab": -1, "ab ": -1})}, {"xx": "xxx"})
    assert {r.id_caption: r.lang_detected for r in backfill.backfill(c, None, detect).collect()} == {1: "xxx", 2: None, 3: "old"}


def test_names_and_codes_of_languages(spark):
    rows = ["English", "Icelandic", "Welsh", "Basque", "sv", "swe", "Chinese", "Klingonese", "", None]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string").orderBy("i").select(rules.language_code(F.col("x"))).collect()]
    assert got == ["eng", "isl", "cym", "eus", "swe", "swe", "zho", None, None, None] and len(rules.language_names()) > 400
    assert [r[0] for r in spark.createDataFrame([("isl",), ("qqq",)], "x string").select(rules.language_name(F.col("x"))).collect()] == ["Icelandic", "English"]


def test_texts_at_once_are_told_as_one_by_one(monkeypatch):
    from collections import Counter

    texts = ["the thing and the other", "le chat et la souris", "der Hund und die Katze", None, "", "a", "1 2", "İz ẞ 漢字 x", "thé the"]
    known = [("en", texts[0]), ("fr", texts[1]), ("de", texts[2])]
    profiles = {k: lp.Profile(-70_000, {g: -10_000 * n for g, n in lp.trigrams(t).items()}) for k, t in known}
    want = [lp.told(t, profiles) for t in texts]
    for cells in (lp.CELLS, 0):
        monkeypatch.setattr(lp, "CELLS", cells)
        assert lp.Judge(profiles).told(texts) == want and want[:3] == ["en", "fr", "de"]
        assert lp.counted([k for k, _ in known], [t for _, t in known]) == {k: dict(Counter(lp.trigrams(t))) for k, t in known}
