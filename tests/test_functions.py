"""Hand-worked cases of expressions, rules and pixels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.functions import images, rules, text, vectors


def one(spark, column, **values):
    df = spark.range(1).select(*[(F.lit(v) if not isinstance(v, list) else F.array(*map(F.lit, v))).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("x, want", [(0.5, 0), (1.5, 2), (2.5, 2), (-0.5, 0), (None, None)])
def test_halves_go_to_even(spark, x, want):
    assert one(spark, text.half_even(F.col("v").cast("double")), v=x) == want


@pytest.mark.parametrize("date, want", [("1890", 1890), ("18uu", None), ("1399", None), ("2101", None), ("1890-05", 1890), (None, None)])
def test_year(spark, date, want):
    assert one(spark, text.year(F.col("v").cast("string")), v=date) == want


@pytest.mark.parametrize("name, stem, first", [("a.b.jpg", "a.b", "a"), ("plain", "plain", "plain"), (".x", "", "")])
def test_file_names(spark, name, stem, first):
    assert (one(spark, text.strip_extension(F.col("v")), v=name), one(spark, text.first_part(F.col("v")), v=name)) == (stem, first)


def test_slug(spark):
    assert [one(spark, text.slug(F.col("v").cast("string")), v=v) for v in ("Ex Libris/Decorative", "", None)] == ["ex_libris_decorative", "unknown", "unknown"]


@pytest.mark.parametrize("cls, conf, want", [("Music", 0.69, "Other"), ("Music", 0.70, "Music"), ("Music", None, "Music"), ("Chart or Graph", 0.9, "Chart/Graph"), ("Odd", 0.9, "Odd"), (None, 0.9, None), ("", 0.9, None), ("Artifact", 0.1, "Other")])
def test_class_label(spark, cls, conf, want):
    assert one(spark, rules.class_label(F.col("c").cast("string"), F.col("p").cast("double")), c=cls, p=conf) == want


@pytest.mark.parametrize("said, label, want", [("A hymn", "Music", "A hymn"), ("Undetermined.", "Music", rules.FAILED), (None, "Artifact", None), ("", "Ex Libris/Decorative", None), (None, "Other", rules.FAILED), (None, None, rules.FAILED)])
def test_caption(spark, said, label, want):
    assert one(spark, rules.caption(F.col("t").cast("string"), F.col("l").cast("string")), t=said, l=label) == want


@pytest.mark.parametrize("conf, lang, said, want", [(0.991, None, None, "Music"), (0.99, "eng", "A SONG sheet", "Music"), (0.5, "eng", "a map", "Other"), (0.5, "xxx", "song", "Other"), (None, "eng", "", "Other"), (0.5, None, "song", "Other")])
def test_music(spark, conf, lang, said, want):
    got = rules.music(F.lit("Music"), F.col("p").cast("double"), F.col("l").cast("string"), F.col("t").cast("string"), {"eng": ["Song"]})
    assert one(spark, got, p=conf, l=lang, t=said) == want


def test_probabilities_and_ties(spark):
    got = one(spark, rules.probabilities(F.col("p")), p=[0.2, 0.3, 0.3, 0.1, 0.1])
    assert [r["label"] for r in got] == ["Chart/Graph", "Ex Libris/Decorative", "Artifact", "Image/Illustration", "Music"]
    assert one(spark, rules.probabilities(F.col("p")), p=[0.5, 0.5]) is None


@pytest.mark.parametrize("p, want", [([0.0, 0.99, 0.01, 0.0], "rotate_90_cw"), ([0.0, 0.98, 0.02, 0.0], "upright"), ([0.25, 0.25, 0.25, 0.25], "upright")])
def test_orientation(spark, p, want):
    assert one(spark, rules.orientation(F.col("p")), p=p) == want


@pytest.mark.parametrize("logs, want", [(None, None), ("[]", None), ('[{"logprob":null}]', None), ('[{"logprob":-1.0},{"token":"a"},{"logprob":-3}]', float(np.exp(-2)))])
def test_linear_probability(spark, logs, want):
    got = one(spark, rules.linear_probability(F.col("v").cast("string")), v=logs)
    assert got == want or abs(got - want) < 1e-12


def test_stale_lease_counts_days(spark):
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    at = lambda s: F.lit(s).cast("timestamp")
    free = lambda s: rules.batch_available(at(s), F.lit(None).cast("timestamp"), F.lit(False), now, 3600)
    assert spark.range(1).select(free("2024-01-01 23:30:00"), free("2024-01-02 23:30:00"), free(None)).first()[:] == (True, False, True)


def test_hamming_and_bands(spark):
    a, b = "0" * 36, "0" * 35 + "f"
    assert one(spark, vectors.hamming(F.col("a"), F.col("b")), a=a, b=b) == 4
    assert [r["value"] for r in one(spark, vectors.bands(F.col("b")), b=b)] == [15, 0, 0, 0, 0, 0]
    rng = np.random.default_rng(0)
    for _ in range(5):
        x, y = (int.from_bytes(rng.bytes(18), "big") for _ in range(2))
        assert one(spark, vectors.hamming(F.col("a"), F.col("b")), a=f"{x:036x}", b=f"{y:036x}") == (x ^ y).bit_count()


def test_vectors(spark):
    assert one(spark, text.vector(F.col("v")), v="[1, 2.5,x]") == [1.0, 2.5, None]
    assert abs(one(spark, vectors.cosine(F.col("a"), F.col("b")), a=[1.0, 0.0], b=[1.0, 1.0]) - 2**-0.5) < 1e-12
    assert one(spark, vectors.cosine(F.col("a"), F.col("b")), a=[0.0, 0.0], b=[1.0, 1.0]) is None
    assert abs(sum(one(spark, vectors.softmax(F.col("a")), a=[1.0, 2.0])) - 1) < 1e-12


def test_png_round_trip_and_hash():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (40, 60, 3), dtype=np.uint8)
    assert (images.decode_png(images.encode_png(a)) == a).all()
    assert (images.rotate(images.rotate(a, "rotate_90_cw"), "rotate_90_ccw") == a).all()
    smooth = np.kron(rng.integers(0, 256, (8, 8)), np.ones((20, 20))).astype(np.uint8)
    h = int(images.perceptual_hash(smooth), 16)
    near = int(images.perceptual_hash(np.clip(smooth.astype(int) + rng.integers(-3, 4, smooth.shape), 0, 255).astype(np.uint8)), 16)
    other = int(images.perceptual_hash(np.kron(rng.integers(0, 256, (8, 8)), np.ones((20, 20))).astype(np.uint8)), 16)
    assert len(images.perceptual_hash(smooth)) == 36 and (h ^ near).bit_count() <= 16 < (h ^ other).bit_count()
