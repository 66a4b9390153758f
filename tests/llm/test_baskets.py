"""Closed itemsets and rules against enumeration of all subsets."""

import itertools
import random

import pytest

from leafmill.llm import basket_itemsets as bi

SCHEMA = "basket long, item long, flag string, support long, g string"


def brute(rows, least, share, confidence=30):
    held = {}
    for b, i, *_ in rows:
        if b is not None and i is not None:
            held.setdefault(b, set()).add(i)
    total, need = len(held), max(least, -(-len(held) // share))
    items = sorted({i for s in held.values() for i in s})
    count = lambda s: sum(s <= h for h in held.values())
    support, level = {}, [frozenset([i]) for i in items]
    while level:
        now = {s: n for s in level if (n := count(s)) >= need}
        support |= now
        level = list({s | {i} for s in now for i in items if i not in s})
    closed = {s: n for s, n in support.items() if not any(support.get(s | {i}) == n for i in items if i not in s)}
    out = {}
    for s, n in closed.items():
        told = [(c, support[s - {c}], support[frozenset([c])]) for c in sorted(s)] if len(s) > 1 else []
        out[tuple(sorted(s))] = (n, [(c, a, sc) for c, a, sc in told if 100 * n >= confidence * a and n * total > a * sc])
    return out


def mined(spark, rows, least, share=10_000):
    closed, supports, total = bi.closed_itemsets(spark.createDataFrame(rows, SCHEMA), least, share)
    return {tuple(r["items"]): (r.support, [tuple(x) for x in r.rules], r.n_rules, r.best_item) for r in bi.rules(closed, supports, total).collect()}


def same(spark, rows, least, share=10_000):
    got, want = mined(spark, rows, least, share), brute(rows, least, share)
    assert {k: v[:2] for k, v in got.items()} == want
    for _, told, n, best in got.values():
        assert n == len(told) and best == (min((a, c) for c, a, _ in told)[1] if told else None)
    return got


def shop(seed, n=120, items=9):
    r = random.Random(seed)
    rows = []
    for b in range(n):
        have = {i for i in range(items) if r.random() < 0.25}
        have |= {1, 2, 7} if r.random() < 0.3 else set()  # 1, 2 and 7 often together
        have |= {4} if 3 in have else set()  # 3 never without 4
        rows += [(b, i, None, None, "x") for i in have]
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_equals_enumeration(spark, seed):
    rows = shop(seed)
    got = same(spark, rows + rows[:30] + [(None, 1, None, None, None), (5, None, None, None, None)], 4)
    assert any(len(k) >= 3 for k in got)


def test_items_of_all_baskets(spark):
    rows = shop(3, 60) + [(b, 50, None, None, None) for b in range(60)] + [(b, -3, None, None, None) for b in range(60)]
    got = same(spark, rows, 5)
    assert (-3, 50) in got and all({-3, 50} <= set(k) for k in got)


def test_giant_baskets(spark, monkeypatch):
    monkeypatch.setattr(bi, "BASKET", 2)
    rows = shop(4, 40)
    rows += [(b, i, None, None, None) for b in (900, 901, 902) for i in range(9)]
    same(spark, rows, 4)
    same(spark, rows, 2)


def test_share_of_baskets_and_empty_table(spark):
    same(spark, shop(5), 3, 10)
    assert mined(spark, [], 1) == {}
    assert mined(spark, [(1, 1, None, None, None)], 2) == {}
    assert mined(spark, [(1, 8, None, None, None), (1, 9, None, None, None)], 1) == {(8, 9): (1, [], 0, None)}


def test_digest(spark):
    closed, supports, total = bi.closed_itemsets(spark.createDataFrame([(b, i, None, None, None) for b in range(3) for i in (10, 9)] + [(7, 1, None, None, None)], SCHEMA), 2)
    (r,) = bi.digest(bi.rules(closed, supports, total)).collect()
    import hashlib

    assert (r["items"], r.n_items, r.support, r.n_rules, r.best_item) == ("9,10", 2, 3, 2, 9)
    assert r.rules_sha256 == hashlib.sha256(b"9:3:3;10:3:3").hexdigest()
