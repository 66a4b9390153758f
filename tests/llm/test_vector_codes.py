"""Product codes against plain integer arithmetic."""

import math
import random

import numpy as np
import pytest

from leafmill.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int"


def brute(rows, parts, entries, rounds):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for i, v, lab, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    cut = lambda v: [v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)]
    firsts = {}
    for i, v, _ in sorted((k for k in kept if k[0] is not None), key=lambda k: (k[0], k[1])):
        firsts.setdefault(i, v)
    books = [[cut(firsts[i])[p] for i in sorted(firsts)[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            held = {}
            for _, v, _ in kept:
                x = cut(v)[p]
                held.setdefault(near(x, book)[1], []).append(x)
            for j, xs in held.items():
                book[j] = [sum(c) // len(c) for c in zip(*xs, strict=True)]
    out = []
    for i, v, lab in kept:
        d = [near(x, b) for x, b in zip(cut(v), books, strict=True)]
        out.append((i, "".join(f"{j:02x}" for _, j in d), sum(e for e, _ in d), lab))
    total = {}
    for *_, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    return sorted(((i, c, e, total[lab]) for i, c, e, lab in out), key=str), books


def some(seed, n=200, d=16):
    r = random.Random(seed)
    rows = [(i * 7 % 1009, [r.gauss(0, 0.3) for _ in range(d)], r.choice([1, 2, None]), None, None) for i in range(n)]
    return rows


def same(spark, rows, parts=8, entries=16, rounds=6):
    coded, books = vc.compress(spark.createDataFrame(rows, SCHEMA), parts, entries, rounds)
    got = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in vc.by_label(coded).collect()), key=str)
    want, wbooks = brute(rows, parts, entries, rounds)
    assert got == want and [b.tolist() for b in books] == wbooks


def test_equals_plain_arithmetic(spark):
    rows = some(0)
    rows += [rows[3], (rows[4][0], [0.5] * 16, 9, None, None), (None, [0.1] * 16, None, None, None), (2000, None, 1, None, None), (2001, [None] + [0.0] * 15, 1, None, None), (2002, [float("nan")] + [0.0] * 15, 1, None, None), (-5, [float("inf")] + [0.0] * 15, 1, None, None)]
    same(spark, rows)


def test_ties_few_rows_and_many_copies(spark):
    same(spark, [(1, [0.25] * 8, 1, None, None)])
    same(spark, [(i, [0.5 * (i % 2)] * 8, None, None, None) for i in range(40)])
    same(spark, some(2, 60, 8), parts=2, entries=5, rounds=3)


def test_empty_and_odd_dimensions(spark):
    coded, books = vc.compress(spark.createDataFrame([], SCHEMA))
    assert vc.by_label(coded).count() == 0 and books == []
    coded, _ = vc.compress(spark.createDataFrame([(1, [1.0] * 8, 1, None, None), (2, [1.0] * 9, 1, None, None), (3, [], 1, None, None)], SCHEMA))
    assert {r.vec_id: r.code for r in coded.collect()} == {1: "00" * 8, 2: None, 3: None}
    with pytest.raises(ValueError):
        vc.compress(spark.createDataFrame([(1, [1.0] * 9, 1, None, None)], SCHEMA))


def test_annulus_finds_the_nearest_and_skips_the_rest():
    r = np.random.default_rng(1)
    for scale in (3, 1000, 1 << 27):
        e, x = r.integers(-scale, scale, (16, 8)), r.integers(-scale, scale, (500, 8))
        d = ((x[:, None] - e[None]) ** 2).sum(2)
        index, least = vc.Annulus(e).nearest(x)
        assert (least == d.min(1)).all() and (index == d.argmin(1)).all()


def test_huge_components_stop_at_the_bound(spark):
    coded, books = vc.compress(spark.createDataFrame([(1, [3e38] * 8, 1, None, None), (2, [-3e38] * 8, 1, None, None)], SCHEMA))
    assert [r.error for r in coded.collect()] == [0, 0] and books[0].tolist() == [[vc.TOP], [-vc.TOP]]
