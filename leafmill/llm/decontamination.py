"""Benchmark decontamination: edit-distance search by CGK embeddings and bit-sampling, with an exact check.

Texts and items are compared as UTF-8 of their lower-case form with white space collapsed. An item is found in a
document when a stretch of it is within floor(RATIO * item length) edits of the item, all counted in bytes.

1. Windows. k edits destroy at most q*k of an item's m-q+1 grams of q bytes, so a stretch that matches keeps at least
   m-q+1-q*k of them within m+k bytes, and one diagonal holds at least that many over k+1. q is the greatest up to 8
   that leaves one. Item-sized windows start on such diagonals; no match is lost here, and most texts have no window.
2. CGK. A random walk embeds a string so that few edits change few places of the walk: edit distance becomes Hamming
   distance. Of each window REPEATS walks are sampled in TABLES sets of places; a window whose samples agree with the
   item's in a whole set is a candidate. Walks of long strings drift apart, so items over PIECE bytes are embedded piece
   by piece, at the pieces' places in the window, and one piece that meets is enough. How many places a set has is
   chosen by length so that recall_at(), measured on random strings at the limit of edits, reaches RECALL.
3. Exact check. Candidates are aligned with the item and kept when the distance holds. Those close together share one
   alignment; a verbatim stretch needs none.

The benchmark is taken in blocks of BLOCK_BYTES, one scan of the documents a block, so what is broadcast and indexed is
bounded but for one item. Memory of the walks doesn't depend on the items; an alignment takes rows of an item's length
and time with its square. Documents are never shuffled. Cases: null or empty texts and items match nothing; items too
short for an edit match verbatim; equal items and items that share an id each report; repeated rows each report; of
several places of an item the one of least edits, then the first, is told; a long text is read whole in overlapping
slices, but for the middle of periodic runs, which holds nothing that their beginning doesn't; empty tables give no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.pieces import lists
from leafmill.llm.arrow import id_texts, mapped
from leafmill.llm.language_id import batch_type

RATIO, Q = 0.1, 8
REPEATS, TABLES, MOST_SAMPLED, SEED = 8, 6, 4, 5
PIECE, RECALL = 96, 0.98
BLOCK_BYTES, SLICE = 4 << 20, 4 << 20
BITS = 22
#: Hits by places of an item that are looked at together; the longest period of a run that is cut short.
PAIRS, PERIODS = 1 << 20, 256
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode("utf-8", "surrogatepass")


def allowed(m: int, ratio: float = RATIO) -> int:
    """Edits allowed for an item of m bytes."""
    return int(ratio * m)


def gram_size(m: int, k: int) -> int:
    """The greatest gram of up to Q bytes of which one survives k edits in m bytes; 0 if none does."""
    return max(0, min(Q, m // (k + 1)))


def grams(b: np.ndarray, q: int = Q) -> np.ndarray:
    """The q <= Q bytes from each place as one number."""
    if len(b) < q:
        return np.zeros(0, np.uint64)
    whole = np.concatenate([b, np.zeros(Q - q, np.uint8)]) if q < Q else b
    out = np.lib.stride_tricks.sliding_window_view(whole, Q).copy().view("<u8").ravel()
    return out & np.uint64((1 << 8 * q) - 1) if q < Q else out


def spot(g: np.ndarray) -> np.ndarray:
    return ((g * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)


class Walks:
    """CGK embeddings of strings of up to PIECE bytes, seen only at the sampled places. Equal strings agree.

    One set of random functions serves all lengths; a string of length m walks 2m steps and stays at its end.
    """

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.turn = rng.integers(0, 2, (REPEATS, 2 * PIECE, 257), dtype=np.int8)
        self.share = rng.random((REPEATS, TABLES, MOST_SAMPLED))

    def sketch(self, windows: np.ndarray, r: int, sampled: int) -> np.ndarray:
        """The r-th walk of each window. windows: rows of byte values, 256 beyond a text's end. Returns rows x TABLES x sampled."""
        n, m = windows.shape
        padded = np.hstack([windows.astype(np.int64), np.full((n, 1), 256)])
        row, i, walk = np.arange(n), np.zeros(n, np.int64), np.empty((n, 2 * m), np.int16)
        at = (self.share[r, :, :sampled] * 2 * m).astype(np.int64)
        for j in range(int(at.max()) + 1):
            c = padded[row, i]
            walk[:, j] = c
            i = np.minimum(i + self.turn[r, j][c], m)
        return walk[:, at]

    def meet(self, windows: np.ndarray, own: list[np.ndarray], sampled: int) -> np.ndarray:
        """Which windows agree in a whole set with their row of own (by walk). One that has met walks no further."""
        out = np.zeros(len(windows), bool)
        for r in range(REPEATS):
            left = np.flatnonzero(~out)
            if not len(left):
                break
            out[left] = (self.sketch(windows[left], r, sampled) == own[r][left]).all(-1).any(-1)
        return out


@lru_cache(1)
def walks() -> Walks:
    return Walks()


@lru_cache(256)
def sampled_for(length: int, ratio: float = RATIO) -> int:
    """Places in a set, for pieces of so many bytes: as many as leave the measured recall at the limit of edits at RECALL."""
    for s in range(MOST_SAMPLED, 1, -1):
        if recall_at(allowed(length, ratio), length, 200, sampled=s) >= RECALL:
            return s
    return 1


def cut(m: int) -> list[int]:
    """Where an item's pieces start; the last ends with the item."""
    return [0] if m <= PIECE else [*range(0, m - PIECE, PIECE), m - PIECE]


def alignment(item: np.ndarray, text: np.ndarray, most: int | None = None) -> tuple[int, int]:
    """Least edits between item and a stretch of text, and where the first such stretch ends. Beyond most edits it stops
    early with some number above most: the least of a row never falls from one byte of the item to the next."""
    n = len(text)
    ramp = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)
    for i, c in enumerate(item):
        fresh = row + 1
        np.minimum(fresh[1:], row[:-1] + (text != c), out=fresh[1:])
        row = np.minimum.accumulate(fresh - ramp) + ramp
        if most is not None and i % 16 == 15 and row.min() > most:
            break
    return int(row.min()), int(row.argmin())


def together(starts: list[int], m: int) -> list[tuple[int, int]]:
    """Least and most start of groups of windows that are at most m apart, in order: one alignment serves a group."""
    out: list[tuple[int, int]] = []
    for s in sorted(starts):
        if out and s - out[-1][0] <= m:
            out[-1] = (out[-1][0], s)
        else:
            out.append((s, s))
    return out


def squeezed(b: np.ndarray, reach: int, longest: int = PERIODS) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """b without the middle of long periodic runs, and the cuts (place in what is left, bytes gone), in order.

    A stretch of up to reach bytes within such a run stands in its beginning as well, and one that begins or ends outside
    is kept, so the same stretches are left, each with its first place. Runs are looked for at places reach apart, by
    periods up to longest.
    """
    n = len(b)
    if n < 4 * reach + longest:
        return b, []
    g = grams(b)
    spots = np.arange(reach, n - longest - Q, reach)
    same = g[spots[:, None] + np.arange(1, longest + 1)] == g[spots][:, None]
    cuts, done = [], 0
    keeps: dict[int, np.ndarray] = {}
    for row in np.flatnonzero(same.any(1)).tolist():
        s = int(spots[row])
        if s < done:
            continue
        for p in (np.flatnonzero(same[row]) + 1).tolist():
            w = min(reach, n - s - p)
            if not np.array_equal(b[s : s + w], b[s + p : s + p + w]):
                continue
            if p not in keeps:
                keeps[p] = np.flatnonzero(b[p:] != b[:-p])
            breaks = keeps[p]
            at = int(np.searchsorted(breaks, s))
            low = max(done, int(breaks[at - 1]) + 1 if at else 0)
            high = int(breaks[at]) + p if at < len(breaks) else n
            gone = (high - low - 2 * reach - 2 * p) // p * p
            if gone > 0:
                cuts.append((low + reach + p, gone))
                done = high - reach
                break
    if not cuts:
        return b, []
    parts, told, last, total = [], [], 0, 0
    for at, gone in cuts:
        parts.append(b[last:at])
        told.append((at - total, gone))
        last, total = at + gone, total + gone
    return np.concatenate([*parts, b[last:]]), told


class Grams:
    """The grams of one size of a block of items."""

    def __init__(self, index: "Index", of: np.ndarray, q: int):
        self.index, self.q = index, q
        own = [grams(index.arrays[i], q) for i in of]
        many = [len(x) for x in own]
        g = np.concatenate([*own, np.zeros(0, np.uint64)])
        order = np.argsort(g, kind="stable")
        self.gram, self.first, self.many = np.unique(g[order], return_index=True, return_counts=True)
        self.item = np.repeat(of.astype(np.int32), many)[order]
        self.place = np.concatenate([*[np.arange(n, dtype=np.int32) for n in many], np.zeros(0, np.int32)])[order]
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[spot(self.gram)] = True
        self.need = np.maximum(1, index.size - q + 1 - q * index.k)
        self.votes = -(-self.need // (index.k + 1))

    def windows(self, b: np.ndarray) -> list[tuple[int, int]]:
        """(item, start) of the diagonals that may hold a match, those with most grams first.

        Where a text repeats a gram that an item repeats, hits by places are many; they are worked on PAIRS at a time.
        """
        g = grams(b, self.q)
        hit = np.flatnonzero(self.seen[spot(g)])
        if not len(hit) or not len(self.gram):
            return []
        at = np.searchsorted(self.gram, g[hit]).clip(max=len(self.gram) - 1)
        ok = self.gram[at] == g[hit]
        hit, at = hit[ok], at[ok]
        if not len(hit):
            return []
        ends = np.cumsum(self.many[at])
        if ends[-1] <= PAIRS:
            return self._diagonals(hit, at)
        # a match is shorter than the reach, so it lies in one of the parts
        found: dict[tuple[int, int], int] = {}
        first = 0
        while first < len(hit):
            full = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS))
            last = max(full, int(np.searchsorted(hit, hit[first] + 2 * self.index.reach)), first + 1)
            for i, s, n in self._diagonals(hit[first:last], at[first:last], True):
                found[i, s] = max(found.get((i, s), 0), n)
            if last >= len(hit):
                break
            first = max(first + 1, int(np.searchsorted(hit, hit[last] - self.index.reach)))
        return [pair for pair, _ in sorted(found.items(), key=lambda x: (-x[1], x[0]))]

    def _diagonals(self, hit: np.ndarray, at: np.ndarray, told: bool = False) -> list[tuple]:
        """(item, start), and the number of grams if told, for hits at these places of a text of these grams."""
        size, k = self.index.size, self.index.k
        many = self.many[at]
        where = np.repeat(self.first[at] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        item, pos, place = self.item[where], np.repeat(hit, many), self.place[where]
        # a match keeps so many different places of the item; one repeated word of it is no sign
        longest = int(size.max()) + 1
        own = np.unique(item.astype(np.int64) * longest + place) // longest
        enough = (np.bincount(own, minlength=len(size)) >= self.need)[item]
        item, pos, place = item[enough], pos[enough], place[enough]
        if not len(item):
            return []
        # enough of an item's grams close together
        order = np.lexsort((pos, item))
        item, pos, place = item[order], pos[order], place[order]
        step = self.need[item] - 1
        end = np.arange(len(item)) + step
        good = end < len(item)
        good[good] &= (item[end[good]] == item[good]) & (pos[end[good]] - pos[good] <= size[item[good]] + k[item[good]] - self.q)
        if not good.any():
            return []
        edge = np.zeros(len(item) + 1, np.int64)
        np.add.at(edge, np.flatnonzero(good), 1)
        np.add.at(edge, end[good] + 1, -1)
        held = np.cumsum(edge[:-1]) > 0
        pair, n = np.unique(np.stack([item[held], pos[held] - place[held]]), axis=1, return_counts=True)
        keep = n >= self.votes[pair[0]]
        pair, n = pair[:, keep], n[keep]
        if told:
            return list(zip(pair[0].tolist(), pair[1].tolist(), n.tolist(), strict=True))
        return [(int(i), int(s)) for i, s in pair[:, np.argsort(-n, kind="stable")].T]


class Index:
    """A block of items: their grams by size, and the walks of their pieces."""

    def __init__(self, items: list[tuple], ratio: float = RATIO):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.arrays = [np.frombuffer(t, np.uint8) for t in self.texts]
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.k = np.array([allowed(len(t), ratio) for t in self.texts], np.int64)
        self.ratio, self.walked = ratio, {}
        # items that bear no edit are looked for as they are if they are shorter than a gram
        q = np.array([0 if not k and m < Q else gram_size(int(m), int(k)) for m, k in zip(self.size, self.k, strict=True)], np.int64)
        self.by_size = [Grams(self, np.flatnonzero(q == n), int(n)) for n in np.unique(q[q > 0])]
        self.short = np.flatnonzero(q == 0).tolist()
        self.reach = int((self.size + 2 * self.k).max(initial=0)) + Q

    def own_walks(self, item: int) -> tuple[np.ndarray, int, list[np.ndarray]]:
        """Where its pieces start, the places in a set, and by walk the samples of each piece."""
        if item not in self.walked:
            at = np.array(cut(int(self.size[item])), np.int64)
            long_ = min(PIECE, int(self.size[item]))
            s = sampled_for(long_, self.ratio)
            pieces = self.arrays[item][at[:, None] + np.arange(long_)]
            self.walked[item] = at, s, [walks().sketch(pieces, r, s) for r in range(REPEATS)]
        return self.walked[item]

    def candidates(self, b: np.ndarray, item: int, starts: np.ndarray, most: int = 4096) -> np.ndarray:
        """Those of the windows' starts of which a piece meets the item's. About most pieces walk at once."""
        at, s, own = self.own_walks(item)
        long_ = min(PIECE, int(self.size[item]))
        met = np.zeros(len(starts), bool)
        step = max(1, most // len(at))
        for lo in range(0, len(starts), step):
            for p in range(0, len(at), most):  # an item of very many pieces walks in parts
                part, places = starts[lo : lo + step], at[p : p + most]
                rows = (part[:, None] + places[None, :]).ravel()
                where = rows[:, None] + np.arange(long_)
                inside = (where >= 0) & (where < len(b))
                windows = np.where(inside, b[where.clip(0, len(b) - 1)].astype(np.int16), 256)
                again = [np.tile(x[p : p + most], (len(part), 1, 1)) for x in own]
                met[lo : lo + step] |= walks().meet(windows, again, s).reshape(len(part), -1).any(1)
        return starts[met]

    def search(self, text: bytes) -> dict[int, tuple[int, int]]:
        """item -> (distance, start) of its best stretch in a normalised text."""
        out: dict[int, tuple[int, int]] = {}
        for n in self.short:
            if self.texts[n] and (at := text.find(self.texts[n])) >= 0:
                out[n] = (0, at)
        whole, cuts = squeezed(np.frombuffer(text, np.uint8), self.reach)
        for lo in range(0, max(1, len(whole)), SLICE):
            b = whole[max(0, lo - self.reach) : lo + SLICE]
            base = max(0, lo - self.reach)
            by: dict[int, list[int]] = {}
            for g in self.by_size:
                for item, start in g.windows(b):
                    by.setdefault(item, []).append(start)
            for item, starts in by.items():
                m, k = int(self.size[item]), int(self.k[item])
                met = self.candidates(b, item, np.array(starts, np.int64))
                for least, most in together(met.tolist(), m):  # with k either side of where a match can lie
                    first = max(0, least - 2 * k)
                    near = b[first : max(first, most + m + 2 * k)]
                    at = near.tobytes().find(self.texts[item])
                    d, end = (0, at + m) if at >= 0 else alignment(self.arrays[item], near, k)
                    if d <= k:
                        found = (d, base + first + max(0, end - m))
                        out[item] = min(out.get(item, found), found)
                    if d == 0:
                        break
        return {n: (d, at + sum(gone for place, gone in cuts if place <= at)) for n, (d, at) in out.items()} if cuts else out


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size, whatever the size of the table."""
    out, held = [], 0
    for r in benchmark.select("item_id", "text").where(F.length("text") > 0).toLocalIterator():
        t = normal(r["text"])
        if t:
            out.append((r["item_id"], t))
            held += len(t) + 64
        if held >= most:
            yield out
            out, held = [], 0
    if out:
        yield out


def leaks(documents: DataFrame, benchmark: DataFrame, ratio: float = RATIO) -> DataFrame:
    """doc_id, item_id, distance (edits), start (bytes into the normalised text): one row per document and item it holds."""
    spark = documents.sparkSession
    kind, of = (documents.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString())
    schema = f"doc_id {kind}, item_id {of}, distance int, start long"
    fields = pa.schema([("doc_id", batch_type(kind)), ("item_id", batch_type(of)), ("distance", pa.int32()), ("start", pa.int64())])

    def scan(items: list[tuple]) -> DataFrame:
        shared = spark.sparkContext.broadcast(items)  # at most BLOCK_BYTES and one item

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, ratio)
            for ids, texts in id_texts(batches):
                rows = [(i, index.ids[n], d, s) for i, t in zip(ids, texts, strict=True) if t for n, (d, s) in index.search(normal(t)).items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)

        return mapped(documents.select("doc_id", "text"), run, schema)

    found = [scan(b) for b in blocks(benchmark)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def clean(documents: DataFrame, benchmark: DataFrame, ratio: float = RATIO) -> DataFrame:
    """documents without those that hold an item. Rows are dropped where they are; nothing moves."""
    sc = documents.sparkSession.sparkContext
    at = documents.columns.index("text")

    def without(items: list[tuple]) -> DataFrame:
        shared = sc.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, ratio)
            for b in batches:
                keep = [not (t and index.search(normal(t))) for part in lists(b.column(at)) for t in part]
                yield b.filter(pa.array(keep, pa.bool_()))

        return mapped(documents, run, documents.schema)

    for items in blocks(benchmark):
        documents = without(items)
    return documents


def edited(a: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """A copy with so many random edits."""
    b = list(a)
    for _ in range(edits):
        p, kind = int(rng.integers(0, len(b))), int(rng.integers(0, 3))
        if kind == 0:
            b[p] = int(rng.integers(97, 123))
        elif kind == 1:
            b.insert(p, int(rng.integers(97, 123)))
        elif len(b) > 1:
            del b[p]
    return np.array(b, np.uint8)


def recall_at(distance: int, length: int, trials: int = 200, seed: int = 1, sampled: int | None = None) -> float:
    """Share of random strings of up to PIECE bytes that still meet after so many random edits."""
    rng = np.random.default_rng(seed)
    s = sampled_for(length) if sampled is None else sampled
    a, b = np.zeros((trials, length), np.int16), np.full((trials, length), 256, np.int16)
    for t in range(trials):
        a[t] = rng.integers(97, 123, length)
        x = edited(a[t], distance, rng)[:length]
        b[t, : len(x)] = x
    return float(walks().meet(b, [walks().sketch(a, r, s) for r in range(REPEATS)], s).mean())
