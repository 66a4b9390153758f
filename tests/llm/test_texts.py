"""Line rules, PII, URLs, packing, decontamination."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import decontamination, line_rules, packing, url_reputation
from leafmill.llm.queries import oracle_sql, queries
from tests.llm.helpers import SCHEMA, WORD, corpus, frame


def base_counts(text):
    t = text or ""
    w = WORD.findall(t)
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    many = {x for x in wins if wins.count(x) > 1}
    covered = {i + k for i, x in enumerate(wins) if x in many for k in range(5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n, r = len(w), len(covered)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n


def test_line_rules(spark):
    texts = ["a b c d e f a b c d e x", "x x x x x x x x x x x x", "a|b|c d e f g h i j k l m n o p", "good line of ten words that is kept as it is.\nclick here\n| a | b | c |\nanother fine line of words that stays where it was put.", "tab\tand\x0bfeed\x0c nbsp\u00a0stays # $ %% a b c d", "Größe ñ é a b c d e f g h\nGröße ñ é a b c d e f g h"]
    rows = corpus(40, 1) + [(1000 + i, t, None, None, None, None, None) for i, t in enumerate(texts)]
    got = line_rules.judge(frame(spark, rows))
    assert sorted([(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got.collect()], key=str) == sorted([(i, *base_counts(t)) for i, t, *_ in rows], key=str)
    kept = {r["doc_id"]: (r["kept"], r["clean_text"]) for r in got.where("doc_id >= 1000").collect()}
    assert kept[1003] == (True, texts[3].split("\n")[0] + "\n" + texts[3].split("\n")[3]) and not kept[1001][0] and not kept[1002][0]
    assert line_rules.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lines_that_fail(spark):
    fail = ["Home | News | Contact", "Start > Shop > Konto", "Accueil · Actualités · Contact", "« a » b » c", "Read more about our Privacy Policy here.", "Alle Rechte vorbehalten.", "Tous droits réservés, 2020.", "Lea nuestra política de privacidad.", "Conditions d'utilisation du site.", "Our five newest articles today", "Der große Bericht über Wale", "$$$ win !!! now ???", "a b c  "]
    stay = ["A sentence that ends as it should.", "Zwei Wörter", "Ein Satz, der mit einem Komma endet,", "« Une phrase entre guillemets »", "(one in brackets)", "What is this thing here?", "Ten words and more " + "word " * 12 + "without any mark", "x > y with some words.", "", "   "]
    got = spark.createDataFrame([(x,) for x in fail + stay], "line string").select("line", line_rules.line_fails(F.col("line")).alias("f")).collect()
    assert [r["line"] for r in got if r["f"]] == fail


def test_line_rules_on_a_very_long_text(spark):
    text = ("this line has seven words in it.\nread more\n" * 40_000)  # 1.6 MB
    r = line_rules.judge(frame(spark, [(1, text, None, None, None, None, None)])).first()
    assert (r["n_words"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (9 * 40_000, 79_998, 360_000, True)


def test_urls(spark):
    urls = ["http://A.Example.COM/en/7x?q", "http://example.com/en/8", "https://x.net/de/8", "http://www.example.net/de/8/1#t", "http://b.org/es/", "http://b.org/es", "no scheme", None, "x://", "http://h?x/y", "http://com/en/", "http://bexample.com/en/71"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    none = spark.createDataFrame([], "host string, bad int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_reputation.judge(pages, none).collect()}
    assert got == {
        0: ("a.example.com", "/en/7x", "example.com/en/7", "allow"), 1: ("example.com", "/en/8", "com/en/", "block"), 2: ("x.net", "/de/8", "net/de/", "allow"), 3: ("www.example.net", "/de/8/1", "example.net/de/8", "block"),
        4: ("b.org", "/es/", "org/es/", "block"), 5: ("b.org", "/es", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("h", "", None, "allow"), 10: ("com", "/en/", "com/en/", "block"), 11: ("bexample.com", "/en/71", "com/en/", "block")}


def test_sites_domains_and_suffixes(spark):
    hosts = {"user:pw@www.shop.co.uk:8080": ("www.shop.co.uk", "shop.co.uk", "co.uk"), "a.b.example.com": ("a.b.example.com", "example.com", "com"), "me.github.io": ("me.github.io", "me.github.io", "github.io"), "10.1.2.3:80": ("10.1.2.3", "10.1.2.3", "10.1.2.3"),
             "co.uk": ("co.uk", "co.uk", "co.uk"), "x.com.au.": ("x.com.au", "x.com.au", "com.au"), "co.com": ("co.com", "co.com", "com"), "localhost": ("localhost", "localhost", "localhost"), "": ("", "", ""), "[::1]:80": ("[::1]", "[::1]", "[::1]")}
    site = url_reputation.site_of(F.col("h"))
    got = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", site, url_reputation.domain_of(site), url_reputation.suffix_of(site)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == hosts
    assert url_reputation.judge(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "host string, bad int")).count() == 0


def test_reputation_shrinks(spark):
    rows = [("bad.a.com", 1)] * 60 + [("good.a.com", 0)] * 60 + [("new.a.com", 1)] + [(f"h{i}.b.com", i % 2) for i in range(40)] + [("silent.b.com", None)]
    rep = {r["site"]: r for r in url_reputation.reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert rep["bad.a.com"]["bound"] > 0.5 > rep["new.a.com"]["bound"] and rep["good.a.com"]["rate"] < 0.1 and rep["silent.b.com"]["n"] == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_exact_and_tight(seed):
    rng = np.random.default_rng(seed)
    sizes = np.clip(rng.exponential([20, 300, 600, 40][seed], 3000).astype(int) + 1, 1, 1024)
    want = dict(zip(*map(list, np.unique(sizes, return_counts=True)), strict=True))
    plan = packing.plan(want)
    got = {}
    for times, combo in plan:
        assert sum(s * n for s, n in combo) <= 1024
        for s, n in combo:
            got[s] = got.get(s, 0) + n * times
    assert got == want
    over = sum(s > 512 for s in sizes)
    assert sum(t for t, _ in plan) <= 1.02 * max(-(-sizes.sum() // 1024), over) + 1


def test_fullest_against_all_sums():
    rng = np.random.default_rng(1)
    for _ in range(50):
        counts = [0] * 41
        for s in rng.integers(1, 41, 8):
            counts[s] += 1
        longest = max(i for i, c in enumerate(counts) if c)
        combo = packing.fullest(counts, 40, longest)
        left = [s for s, c in enumerate(counts) for _ in range(c - (s == longest))]
        sums = {0}
        for s in left:
            sums |= {x + s for x in sums if x + s <= 40 - longest}
        assert sum(s * n for s, n in combo) == longest + max(sums) and all(n <= counts[s] for s, n in combo)


def test_pieces_round_trip(spark):
    from tokenizers import Tokenizer

    rows = corpus(40, 2) + [(2000 + i, x, None, None, None, None, None) for i, x in enumerate(["<|endoftext|> x", "a<|endoftext|>", "<|endoftext|><|endoftext|>\n y", "<|endoftext |>"])]
    rows += [(2100, "word " * 300_000 + "<|endoftext|>", None, None, None, None, None)]  # longer than a slice
    out = packing.pack_documents(frame(spark, rows)).collect()
    t = Tokenizer.from_file(packing.default_vocabulary())
    want = []
    for i, text, *_ in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want += [(i, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.cuts(len(ids)))]
    assert sorted([tuple(r)[:5] for r in out], key=str) == sorted(want, key=str)
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 1024


def test_slices_and_special_tokens():
    text = "<|endoftext|> it's 12  a\n\n b " + "word " * 3000 + "ünd x"
    assert "".join(packing.slices(text, 100)) == text
    enc = packing._encoder(packing.default_vocabulary())
    assert [i for p in packing.slices(text, 100) for i in enc(p)] == enc(text)
    assert enc("<|endoftext|> x") == [50256, 2124]
    assert packing.cuts(1024) == [(0, 1024)] and packing.cuts(1025) == [(0, 1), (1, 1024)] and packing.cuts(1) == [(0, 1)]


def edits(b, n, rng):
    b = list(b)
    for _ in range(n):
        p = int(rng.integers(0, len(b)))
        k = int(rng.integers(0, 3))
        if k == 0:
            b[p] = "q"
        elif k == 1:
            b.insert(p, "q")
        else:
            del b[p]
    return "".join(b)


def test_leaks(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(chr(97 + int(c)) for c in rng.integers(0, 20, int(rng.integers(2, 9))))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(k, prose(25)) for k in range(8)] + [(50, "tiny"), (51, None), (52, "")]
    rows, want = [], set()
    for i in range(60):
        k = i % 8
        kind = i % 3
        if kind == 0:
            rows.append((i, prose(60)))
        else:
            said = items[k][1].upper().replace(" ", "\n") if kind == 1 else edits(items[k][1], decontamination.allowed(len(items[k][1])) // 2, rng)
            rows.append((i, prose(30) + " " + said + " " + prose(30)))
            want.add((i, k))
    rows += [(98, None), (99, ""), (100, "x tiny y"), (101, (items[0][1][:9] + " ") * 200)]
    want.add((100, 50))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontamination.leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    kept = {r["doc_id"] for r in decontamination.clean(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in want}
    assert decontamination.leaks(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


@pytest.mark.parametrize("length", [10, 12, 20, 30, 40, 60, 96])
def test_sketch_recall(length):
    k = decontamination.allowed(length)
    assert k == length // 10 and decontamination.recall_at(0, length, 20) == 1
    assert decontamination.recall_at(k, length, 200, seed=9) >= 0.95


@pytest.mark.parametrize("length", [12, 20, 30, 40, 81, 120, 200, 394, 800, 1500, 3000, 5000])
def test_items_at_the_limit_of_edits_are_found_at_any_length(length):
    rng = np.random.default_rng(length)
    letters = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    items = [(k, letters(length)) for k in range(24 if length < 1000 else 6)]
    index, found, limit = decontamination.Index(items), 0, decontamination.allowed(length)
    for k, item in items:
        said = letters(500) + decontamination.edited(np.frombuffer(item, np.uint8), limit, rng).tobytes() + letters(500)
        got = index.search(said)
        assert all(d <= limit for d, _ in got.values())
        found += k in got
    assert found >= 0.9 * len(items)


def brute(item, text):
    """Least edits between item and any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != t))
    return min(row)


def test_leaks_against_every_stretch(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(chr(97 + int(c)) for c in rng.integers(0, 12, int(rng.integers(1, 6))))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(k, prose(n)) for k, n in enumerate([2, 3, 4, 5, 6, 8, 10, 14, 20, 30])]
    items += [(3, items[3][1]), (20, items[6][1])]  # a row repeated, and an equal item
    docs = [(i, prose(12) + " " + edits(items[i % 10][1], int(rng.integers(0, 4)), rng) + " " + prose(12)) for i in range(80)]
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(i, k): d for i, t in docs for k, x in items if (d := brute(decontamination.normal(x), decontamination.normal(t))) <= len(decontamination.normal(x)) // 10}
    assert got == want and len(want) > 40


def test_very_long_text_and_item(spark):
    rng = np.random.default_rng(5)
    letters = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    item = letters(20_000)
    far = decontamination.SLICE - 10_000  # across the border of two slices
    docs = [(1, letters(far) + edits(item, 300, rng) + letters(5000)), (2, letters(1_100_000)), (3, item[:9000])]
    got = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(1, 7)] and abs(got[0]["start"] - far) <= 300


def test_alignment():
    b = lambda s: np.frombuffer(s, np.uint8)
    assert decontamination.alignment(b(b"kitten"), b(b"xxsittingyy"))[0] == 2
    assert decontamination.alignment(b(b"abc"), b(b"zzabczz")) == (0, 5)


def test_every_query_is_registered():
    names = set(queries())
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 11)) and set(oracle_sql()) <= names


def repetitive(seed):
    r = random.Random(seed)
    unit = "".join(r.choice("-= ab") for _ in range(r.choice([1, 2, 3, 7, 40]))).strip() or "-"
    item = f"before {unit * (60 // len(unit))} behind it"
    runs = unit * r.randint(20, 4000 // len(unit))
    said = list(item)
    for _ in range(r.randint(0, 9)):
        said[r.randrange(len(said))] = r.choice("-xy")
    text = r.choice(["", "start "]) + runs + r.choice(["", "zz"]) + "".join(said) + runs[: r.randint(0, len(runs))] + r.choice(["", item[10:]]) + unit * r.randint(0, 900 // len(unit))
    return item, text


@pytest.mark.parametrize("seed", range(30))
def test_repetitive_texts_as_every_stretch(monkeypatch, seed):
    item, text = repetitive(seed)
    x, t = decontamination.normal(item), decontamination.normal(text)
    index = decontamination.Index([(1, x)])
    best = brute(x, t)
    want = {0: best} if best <= decontamination.allowed(len(x)) else {}
    got = index.search(t)
    assert {k: d for k, (d, _) in got.items()} == want
    monkeypatch.setattr(decontamination, "squeezed", lambda b, *_: (b, []))
    plain = index.search(t)
    assert {k: d for k, (d, _) in plain.items()} == want
    monkeypatch.setattr(decontamination, "PAIRS", 300)
    assert {k: d for k, (d, _) in index.search(t).items()} == want


def test_megabytes_of_ruled_lines_take_little():
    import resource
    import time

    item = b"the table below " + b"-" * 100 + b" shows the figures"
    index = decontamination.Index([(1, item), (2, b"- " * 60)])
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    half = b"-" * 2_000_000
    assert index.search(half + item.replace(b"---", b"-x-", 2) + half) == {0: (2, 2_000_000)}
    assert time.time() - began < 30 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300 * 1024
