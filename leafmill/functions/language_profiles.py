"""Language of a text by profiles of character trigrams, learned from texts of known language.

A profile holds the most frequent trigrams of a language with whole-number weights (log-probabilities, smoothed), so a
score is a sum that doesn't depend on order. Texts are compared as words of letters in lower case with single spaces.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import pieces

#: Trigrams of a language; the scale of weights; the least share of a text's trigrams that its language must know.
KEPT, SCALE, LEAST_KNOWN, SMOOTHING = 1000, 10_000, 0.5, 0.5
_OTHER = re.compile(r"[\W\d_]+")
#: Cells of a table of all trigrams of an alphabet; with a larger alphabet trigrams are sorted or searched.
CELLS = 1 << 22
_POINTS = 0x110000


def normal(text: str | None) -> str:
    return f" {_OTHER.sub(' ', (text or '').lower()).strip()} "


def trigrams(text: str | None) -> Counter:
    t = normal(text)
    return Counter(t[i : i + 3] for i in range(len(t) - 2))


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts in a row, and where each text's trigrams begin and end."""
    told = [normal(t) for t in texts]
    n = np.array([len(t) for t in told], np.int64)
    first = np.cumsum(n) - n
    return np.frombuffer("".join(told).encode("utf-32-le", "surrogatepass"), np.uint32), first, first + np.maximum(n - 2, 0)


def _joined(c: np.ndarray, base: int) -> np.ndarray:
    """One number for the three that start at each place."""
    c = c.astype(np.int64)
    return (c[:-2] * base + c[1:-1]) * base + c[2:]


def counted(langs: list[str], texts: list[str | None]) -> dict[str, dict[str, int]]:
    """language -> trigram -> count, of texts in a row."""
    c, first, end = _codes(texts)
    names = sorted(set(langs))
    if len(c) < 3:
        return {}
    of = np.full(len(c) - 2, -1, np.int64)
    for n, lang in enumerate(langs):
        of[first[n] : end[n]] = names.index(lang)
    alphabet = np.flatnonzero(np.bincount(c, minlength=_POINTS))
    place = np.zeros(_POINTS, np.int64)
    place[alphabet] = np.arange(len(alphabet))
    grams, k = _joined(place[c], len(alphabet)), len(alphabet)
    out = {}
    for i, lang in enumerate(names):
        own = grams[of == i]
        if k**3 <= CELLS:
            n = np.bincount(own, minlength=1)
            g = np.flatnonzero(n)
            n = n[g]
        else:
            g, n = np.unique(own, return_counts=True)
        letters = [alphabet[x].astype(np.uint32) for x in (g // (k * k), g // k % k, g % k)]
        all_ = np.stack(letters, axis=1).tobytes().decode("utf-32-le", "surrogatepass")
        out[lang] = {all_[3 * x : 3 * x + 3]: m for x, m in enumerate(n.tolist())}
    return out


@dataclass
class Profile:
    unseen: int
    weights: dict[str, int]


def weight(n: float, total: int, kept: int = KEPT) -> int:
    return round(SCALE * math.log((n + SMOOTHING) / (total + SMOOTHING * kept)))


def train(texts: DataFrame, text: str = "text", language: str = "lang", kept: int = KEPT) -> dict[str, Profile]:
    """A profile a language, over whole texts; rows without either are left out. What is collected has kept rows a language."""
    kind = "lang string, gram string, n long"

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for b in batches:
            for at, n in pieces.ranges(b.column(1)):
                for lang, own in counted(b.column(0).slice(at, n).to_pylist(), b.column(1).slice(at, n).to_pylist()).items():
                    found.setdefault(lang, Counter()).update(own)
                if sum(map(len, found.values())) > 200_000:
                    yield _rows(found)
                    found = {}
        yield _rows(found)

    labelled = texts.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(F.col(language).cast("string").alias("lang"), F.col(text).alias("text"))
    all_ = labelled.mapInArrow(counts, kind).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "gram"))), 1, kept)
    # a language's trigrams are cut to the most frequent ones part by part before they meet
    parts = all_.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(64))).groupBy("lang", "part").agg(best.alias("own"), F.sum("n").alias("total"))
    flat = parts.select("lang", "total", F.explode("own").alias("g"))
    totals = {r.lang: r.total for r in parts.groupBy("lang").agg(F.sum("total").alias("total")).collect()}
    rows = flat.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list("g")), 1, kept).alias("own")).collect()
    return {r.lang: Profile(weight(0, totals[r.lang], kept), {g.gram: weight(-g.k, totals[r.lang], kept) for g in r.own}) for r in rows}


def _rows(found: dict[str, Counter]) -> pa.RecordBatch:
    rows = [(lang, g, n) for lang, own in found.items() for g, n in own.items()]
    columns = list(zip(*rows, strict=True)) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], names=["lang", "gram", "n"])


def told(text: str | None, profiles: dict[str, Profile], least: float = LEAST_KNOWN) -> str | None:
    """The language whose profile gives most; null without letters, on a tie, and if it knows too few of the trigrams."""
    grams = trigrams(text)
    total = sum(grams.values())
    if total < 2 or not profiles:
        return None
    scores = sorted(((sum(n * p.weights.get(g, p.unseen) for g, n in grams.items()), lang) for lang, p in profiles.items()), reverse=True)
    best = profiles[scores[0][1]]
    known = sum(n for g, n in grams.items() if g in best.weights)
    tie = len(scores) > 1 and scores[0][0] == scores[1][0]
    return None if tie or known < least * total else scores[0][1]


class Judge:
    """told() of many texts at once: each trigram's number by a table over the profiles' alphabet, sums by running totals."""

    def __init__(self, profiles: dict[str, Profile], least: float = LEAST_KNOWN):
        self.langs, self.least = sorted(profiles, reverse=True), least
        grams = sorted({g for p in profiles.values() for g in p.weights})
        letters = sorted({ord(c) for g in grams for c in g})
        self.place = np.zeros(_POINTS, np.int64)  # 0: in no profile
        self.place[letters] = np.arange(1, len(letters) + 1)
        self.k = len(letters) + 1
        points = np.array([[ord(c) for c in g] for g in grams], np.int64).reshape(-1, 3)
        codes = (self.place[points[:, 0]] * self.k + self.place[points[:, 1]]) * self.k + self.place[points[:, 2]]
        order = np.argsort(codes)
        self.codes, grams = codes[order], [grams[i] for i in order]
        self.table = None
        if self.k**3 <= CELLS:
            self.table = np.zeros(self.k**3, np.int32)
            self.table[self.codes] = np.arange(1, len(grams) + 1)
        self.weights = [np.array([profiles[x].unseen] + [profiles[x].weights.get(g, profiles[x].unseen) for g in grams], np.int64) for x in self.langs]
        self.known = [np.array([False] + [g in profiles[x].weights for g in grams]) for x in self.langs]

    def _numbers(self, c: np.ndarray) -> np.ndarray:
        code = _joined(self.place[c], self.k)
        if self.table is not None:
            return self.table[code]
        at = np.minimum(np.searchsorted(self.codes, code), max(len(self.codes) - 1, 0))
        return np.where(self.codes[at] == code, at + 1, 0) if len(self.codes) else np.zeros(len(code), np.int64)

    def told(self, texts: list[str | None]) -> list[str | None]:
        c, first, end = _codes(texts)
        if not self.langs or len(c) < 3:
            return [None] * len(texts)
        numbers, total = self._numbers(c), end - first

        def sums(of: np.ndarray) -> np.ndarray:
            run = np.zeros(len(numbers) + 1, np.int64)
            np.cumsum(of[numbers], out=run[1:])
            return run[np.minimum(end, len(numbers))] - run[np.minimum(first, len(numbers))]

        scores = np.stack([sums(w) for w in self.weights])
        known = np.stack([sums(w) for w in self.known])
        best = np.argmax(scores, axis=0)
        tie = (scores == scores.max(axis=0)).sum(axis=0) > 1
        sure = (total >= 2) & ~tie & (np.take_along_axis(known, best[None], 0)[0] >= self.least * total)
        return [self.langs[b] if s else None for b, s in zip(best.tolist(), sure.tolist(), strict=True)]


def detector(profiles: dict[str, Profile], names: dict[str, str] | None = None) -> Callable[[Column], Column]:
    """Column of texts to column of languages, by other names if some are given. A profile set is small and goes with the task."""

    @F.arrow_udf("string")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = Judge(profiles)
        for texts in batches:
            out = [x for part in pieces.lists(texts) for x in judge.told(part)]
            yield pa.array([names.get(x, x) if names else x for x in out], pa.string())

    return found


def saved(profiles: dict[str, Profile]) -> str:
    return json.dumps({k: asdict(p) for k, p in sorted(profiles.items())}, ensure_ascii=False)


def loaded(text: str) -> dict[str, Profile]:
    return {k: Profile(**p) for k, p in json.loads(text).items()}


def told_sql(kept: int = KEPT) -> str:
    """CTEs in DuckDB SQL from labelled(lang, text) and asked(id, text) to answered(id, lang)."""
    grams = "unnest(list_transform(range(1, length({t}) - 1), lambda i: substr({t}, i, 3)))"
    clean = "(' ' || trim(regexp_replace(lower(text), '[^\\p{L}\\p{M}\\p{Lm}]+', ' ', 'g')) || ' ')".replace("\\p{M}\\p{Lm}", "")
    w = lambda n: f"cast(round({SCALE} * ln(({n} + {SMOOTHING}) / (total + {SMOOTHING} * {kept}))) as bigint)"
    return f"""g as materialized (select lang, g, count(*) as n from (select lang, {grams.format(t='t')} as g from (select lang, {clean} as t from labelled)) group by 1, 2),
tot as materialized (select lang, sum(n) as total from g group by 1), top as (select * from (select *, row_number() over (partition by lang order by n desc, g) as k from g) where k <= {kept}),
pr as materialized (select lang, g, {w('n')} as w from top join tot using (lang)), un as materialized (select lang, {w('0')} as u from tot),
q as materialized (select id, {grams.format(t='t')} as g from (select id, {clean} as t from asked)), qn as (select id, count(*) as n from q group by 1),
sc as (select id, un.lang, sum(coalesce(w, u)) as s, count(w) as known from q cross join un left join pr on pr.lang = un.lang and pr.g = q.g group by 1, 2),
ranked as (select *, row_number() over (partition by id order by s desc, lang desc) as k, lead(s) over (partition by id order by s desc, lang desc) as second from sc),
answered as (select asked.id, case when n >= 2 and s is distinct from second and known >= {LEAST_KNOWN} * n then lang end as lang from asked left join qn using (id) left join (select * from ranked where k = 1) using (id))"""
