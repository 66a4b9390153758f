"""Languages, tokens, execution and short forms."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leafmill.functions import languages, thesaurus, tokens
from leafmill.operators import backfill, browse


def test_language_by_function_words(spark):
    rows = ["The cat and the dog of this house", "le chat et la souris dans une maison", "der Hund und die Katze", "los gatos y las casas del pueblo", "il gatto che non è della casa", "zzz", "", None, "la la"]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string").orderBy("i").select(languages.detected(F.col("x"))).collect()]
    assert got == ["eng", "fra", "deu", "spa", "ita", None, None, None, None]


def test_tokens_by_the_vocabulary(spark):
    rows = [("It's a test, größer 12.5", 1), ("", 2), (None, 3)]
    got = {r["i"]: r["n_tokens"] for r in backfill.token_counts(spark.createDataFrame(rows, "text string, i int")).collect()}
    assert got == {1: tokens.counted([rows[0][0]], tokens.default_path())[0], 2: None, 3: None} and got[1] > 6


def plain_matches(text, terms):
    """The pattern that says the same: all terms, longest first, between word borders."""
    import re
    from collections import Counter

    found = re.findall(r"\b(" + "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True)) + r")\b", (text or "").lower())
    out = {}
    for t, n in Counter(found).items():
        out.setdefault(terms[t], {})[t] = n
    return out or None


@pytest.mark.parametrize("characters", [10_000, 12])
def test_thesaurus_equals_a_pattern_at_every_size(spark, characters):
    rows = [("function", "the", ["of", "and the", "of the"]), ("verb", "is", ["was", "", None]), (None, "and the end", None), ("kin", "Mother-in-law", ["O\u2019Brien", "o'brien", "law"]), ("odd", "(x)", ["c++", "ÉTÉ", "straße", "日本", "_a"]), ("zz", "law", [])]
    thesaurus_ = spark.createDataFrame(rows, "category string, keyword string, related_terms array<string>")
    texts = ["The end and the END of it was and the.", None, "", "nothing", "the the", "of, the mother-in-law of the O'Brien", "mother-in-lawyer law_ law", "a(x)b (x) c++ c++d", "l'été étéé Straße STRASSE", "日本 日本語", "_a a_a", "the" * 3, "\n".join(["and the end"] * 500)]
    r = random.Random(2)
    pieces = [t for _, k, more in rows for t in [k, *(more or [])] if t] + [" ", "-", "'", "x", ",", "_", "é", "(", ")"]
    texts += ["".join(r.choice(pieces) for _ in range(r.randint(1, 9))) for _ in range(200)]
    terms = thesaurus.terms_of(thesaurus_)
    assert terms["law"] == "zz" and terms["and the end"] == "unknown" and "" not in terms
    df = spark.createDataFrame(list(enumerate(texts)), "id_caption long, text string")
    got = {x[0]: x[1] for x in df.select("id_caption", thesaurus.matches(F.col("text"), thesaurus_, characters)).collect()}
    assert got == {i: plain_matches(t, terms) for i, t in enumerate(texts)}
    assert len(thesaurus.shards(terms, characters)) == (1 if characters > 100 else 9)


def test_thesaurus_counts_of_repeated_keys_and_no_terms(spark):
    none = spark.createDataFrame([], "category string, keyword string, related_terms array<string>")
    caption = spark.createDataFrame([(1, "the law"), (1, "law"), (2, None)], "id_caption long, text string")
    assert backfill.thesaurus_counts(caption, none).count() == 0
    one = spark.createDataFrame([("a", "law", None)], none.schema)
    assert [tuple(r) for r in backfill.thesaurus_counts(caption, one).collect()] == [(1, "a", "law", 2)]
    with pytest.raises(ValueError):
        thesaurus.terms_of(one, 2)


def test_wrapped_and_thousands(spark):
    r = spark.sql("select 'aa bb cc  dddddddd e' as x, 1234567 as n, cast(null as string) as z").select(browse.wrapped(F.col("x"), 5), browse.thousands(F.col("n")), browse.wrapped(F.col("z"))).first()
    assert list(r[0]) == ["aa bb", "cc", "dddddddd", "e"] and r[1] == "1,234,567" and list(r[2]) == []
    assert browse.rate(10, 4.0) == {"rows": 10, "seconds": 4.0, "rows_per_second": 2.5} and browse.rate(1, 0.0)["rows_per_second"] == 0.0


def test_header_and_pages_with_elements(spark):
    view = spark.createDataFrame([("a", "Music"), ("a", "Music"), ("a", None), ("b", "Other")], "barcode string, pred_class string")
    volume = spark.createDataFrame([("a", '{"title":"%s","raw":"x","none":null}' % ("t" * 300)), ("b", "not json")], "barcode string, metadata string")
    got = {r["barcode"]: r for r in browse.header(view, volume, 10).collect()}
    assert [(c["label"], c["n"]) for c in got["a"]["classes"]] == [("Music", 2), ("", 1)] and set(got["a"]["metadata"]) == {"title"} and len(got["a"]["metadata"]["title"]) <= 13 and not got["b"]["metadata"]
    scans = spark.createDataFrame([(1, "p1"), (1, "p2")], "id_pipeline_batch_item long, filename string")
    found = spark.createDataFrame([(1, "p2"), (2, "p1")], "id_pipeline_batch_item long, scan_filename string")
    assert [r["filename"] for r in browse.pages_with_elements(scans, found).collect()] == ["p2"]


def test_what_python_holds_of_a_batch_is_bounded(spark, monkeypatch):
    from pyspark.sql import DataFrame

    from leafmill.functions import pieces

    texts = pa.array(["a" * 700, None, "b" * 400, "c" * 3000, "", "d"])
    assert list(pieces.lists(texts, 1000)) == [["a" * 700, None], ["b" * 400], ["c" * 3000], ["", "d"]]
    df: DataFrame = spark.createDataFrame([(i, "the law " * 40_000) for i in range(8)], "id long, text string").coalesce(1)

    def encode(part):  # fails where more than the bound is handed over at once
        assert sum(map(len, part)) <= pieces.MOST_BYTES
        return [len(t) for t in part]

    assert {r.n for r in df.select(tokens.token_count(F.col("text"), encode=encode).alias("n")).collect()} == {320_000}


def test_texts_are_read_once_for_their_terms(spark):
    caption = spark.createDataFrame([(1, "the law"), (2, "none")], "id_caption long, text string")
    one = spark.createDataFrame([("a", "law", None)], "category string, keyword string, related_terms array<string>")
    df = backfill.thesaurus_matches(caption, one)
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1 and [r.id_caption for r in df.collect()] == [1]
