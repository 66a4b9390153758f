"""Similarity join on sets of word shingles by vertical partitioning.

All shingles stand in one global order, rare before frequent (any order gives right results, this one gives short
lists). The order is cut into fragments; a document's set is cut alike, overlaps are counted fragment by fragment and
summed per pair, which decides exactly.

1. Documents with equal sets are one node, named by 64 bits of a hash; nodes whose names would meet are told apart by
   64 more. Only nodes are compared, and only one document of each is read again.
2. The order. Frequency classes come from a count sketch of fixed size over all documents. Where the corpus is far
   larger than the sketch, frequent shingles hide among rare ones; so the first shingles of all nodes are counted
   exactly, and those in many nodes go behind all others. A bitmap of bounded size says which.
3. Candidates. Of two sets that link, the shorter has one of its first a-ceil(6a/7)+1 shingles among the first
   b-ceil(3b/4)+1 of the longer (for 0.75). Nodes that meet so in a list of up to LIST nodes are paired. A longer list
   pairs its nodes with its pivot, a node that is in many such lists.
4. Verification: partial overlaps per fragment, summed.
5. Links give components. In longer lists, nodes that are still in different components are paired and verified as
   well, but for those that the triangle inequality of Jaccard distance rules out through the pivot. So
   components are exact, while large groups of copies cost a pair a node. Links within a component are not all looked
   at: neither links nor their number per document is returned.

Shingles: A-Z lower-cased, words are runs of anything but ASCII white space, five words a shingle, the whole sequence
as one when shorter. Cases: null, empty and blank texts have an empty set and link with nothing; repeated rows and
copies share a node; texts are read whole; ids are cast to long, and one that isn't a number counts as null; a null id
is a row like others, its component the least id of its set; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions import pieces
from leafmill.llm.arrow import mapped
from leafmill.operators.components import connected_components
from leafmill.sources.staging import release, staged

WIDTH = 5
#: Bits of a sketch cell's number: about eight shingles a cell, within bounds; cells that travel together.
LEAST_BITS, MOST_BITS, BLOCK = 18, 24, 1 << 14
BYTES_A_SHINGLE = 5.6
LIST = 8
FRAGMENTS = 4
BUCKET_TEXT = 16 << 20
#: Bytes of texts that are hashed at once; shingles() holds some 60 times as much.
AT_ONCE = 1 << 18
FILTER_BITS = 1 << 24
#: A shingle among the first of HOT_LEAST nodes or more goes behind the others, if the bitmap has room for so many.
HOT_LEAST, HOT_LEAST_BITS, HOT_MOST_BITS = 16, 1 << 16, 1 << 27

_M, _N, _O = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(10).integers(1, 2**63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _O
    return (x ^ (x >> np.uint64(29))) * _N


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _M, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (UTF-8)."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    b = _LOWER[joined]
    space = _SPACE[b]
    word = ~space
    start = np.flatnonzero(word & np.concatenate([[True], space[:-1]]))
    out = [np.zeros(0, np.uint64)] * len(texts)
    if not len(start):
        return out
    # a word's hash: sum of its bytes' numbers times powers of an odd number by place in the word
    ids = np.cumsum(word & np.concatenate([[True], space[:-1]])) - 1
    place = np.arange(len(b)) - start[np.maximum(ids, 0)]
    power = _powers(int(place[word].max()) + 1)
    part = np.where(word, _BYTE[b], np.uint64(0))
    part[word] *= power[place[word]]
    h = mix(np.add.reduceat(part, start))
    ends = np.cumsum([len(t) + 1 for t in texts])
    first = np.searchsorted(start, ends - np.array([len(t) + 1 for t in texts]))
    last = np.searchsorted(start, ends)
    five = h.copy()
    for k in range(1, min(WIDTH, len(h))):  # window hash: words by place
        five[: len(h) - k] = five[: len(h) - k] * _M + h[k:]
    for i, (x, y) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
        n = y - x
        if n >= WIDTH:
            out[i] = np.unique(mix(five[x : y - WIDTH + 1]))
        elif n:
            v = np.uint64(n)
            for w in h[x:y]:
                v = np.uint64((int(v) * int(_M) + int(w)) & (2**64 - 1))
            out[i] = mix(np.array([v], np.uint64))
    return out


def _signed(x: int, bits: int = 64) -> int:
    x &= (1 << bits) - 1
    return x - 2**64 if x >= 2**63 else x


def fingerprint(s: np.ndarray, bits: int = 64) -> tuple[int, int]:
    """Two numbers for a set, equal for equal sets; the first of so many bits."""
    if not len(s):
        return 0, 0
    a, b = int(mix(s).sum(dtype=np.uint64)), int(mix(s ^ _N).sum(dtype=np.uint64))
    c = int(mix(s ^ _O).sum(dtype=np.uint64))
    return _signed(a * int(_M) ^ b, bits), _signed(b * int(_M) ^ c)


def sketch_bits(total: int) -> int:
    """For so many bytes of text."""
    return min(MOST_BITS, max(LEAST_BITS, int(np.log2(max(1.0, total / BYTES_A_SHINGLE / 8)))))


def cells(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * _M) >> np.uint64(64 - bits)).astype(np.int64)


def ranks(h: np.ndarray, order: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Place in the global order: 64 for a hot one plus the frequency class in the top byte, then the hash.

    order: classes by cell of the sketch, and the bitmap of hot ranks (as they are without the 64).
    """
    sketch, hot = order
    kind = sketch[cells(h, len(sketch).bit_length() - 1)].astype(np.uint64)
    out = (kind << np.uint64(56)) | (h >> np.uint64(8))
    if len(hot):
        at = (mix(out) & np.uint64(len(hot) * 8 - 1)).astype(np.int64)
        out |= (((hot[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(62))
    return out


def fragment_of(rank: np.ndarray) -> np.ndarray:
    """Fragments are runs of the global order: the rare class cut in FRAGMENTS - 2, then two of frequent shingles."""
    kind = (rank >> np.uint64(56)).astype(np.int64)
    rare = ((rank >> np.uint64(40)) & np.uint64(0xFFFF)).astype(np.int64) * (FRAGMENTS - 2) >> 16
    return np.where(kind <= 1, rare, np.where(kind <= 4, FRAGMENTS - 2, FRAGMENTS - 1))


def classes_of(counts: np.ndarray) -> np.ndarray:
    """Frequency class by cell: the binary magnitude of its load over the mean, 1 for all up to twice the mean."""
    mean = np.float32(max(float(counts.mean(dtype=np.float64)), 1.0))
    return np.clip(np.floor(np.log2(counts.astype(np.float32) / mean + np.float32(1e-9))) + 1, 1, 60).astype(np.uint8)


def least_overlap(a: int, b: int, num: int = 3, den: int = 4) -> int:
    """The smallest intersection with which sets of a and b elements reach num/den."""
    return -(-num * (a + b) // (num + den))


def prefix(a: int, longer: bool, num: int = 3, den: int = 4) -> int:
    """How many of a set's first shingles to look at, against partners no longer (longer) or no shorter than it."""
    return a - (-(-num * a // den) if longer else least_overlap(a, a, num, den)) + 1


def _batches(batches: Iterator[pa.RecordBatch], most: int = 1 << 20, member: np.ndarray | None = None) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and sets of rows in groups. member: a bitmap of the ids to read; null ids are always read."""
    for b in batches:
        if member is not None:
            ids = b.column(0)
            bit = spark_hash(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            keep = ((member[bit // 32] >> (bit % 32).astype(np.uint32)) & 1 == 1) | ids.is_null().to_numpy(zero_copy_only=False)
            b = b.filter(pa.array(keep))
        for at, n in pieces.ranges(b.column(1), most):
            texts = b.column(1).slice(at, n)
            yield b.column(0).slice(at, n).to_pylist(), [s for part in pieces.lists(texts, AT_ONCE) for s in shingles([t or b"" for t in part])]


def _survey(bits: int, node_bits: int = 64):
    """Rows of kind 0: id, set size, node and its check. Of kind 1: a block of this task's sketch."""

    def run(batches):
        total = np.zeros(1 << bits, np.uint32)
        for ids, sets in _batches(batches):
            named = [fingerprint(s, node_bits) for s in sets]
            yield pa.RecordBatch.from_pydict({"kind": [0] * len(ids), "doc_id": ids, "n": list(map(len, sets)), "node": [x for x, _ in named], "other": [x for _, x in named], "z": [None] * len(ids)}, _SURVEY)
            h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            if len(h):
                c, n = np.unique(cells(h, bits), return_counts=True)
                total[c] += n.astype(np.uint32)
        if total.any():
            blocks = total.reshape(-1, min(BLOCK, len(total)))
            salt = int(total[:64].sum()) % 16
            for at in range(0, len(blocks), 64):
                part = [i for i in range(at, min(at + 64, len(blocks))) if blocks[i].any()]
                yield pa.RecordBatch.from_pydict({"kind": [1] * len(part), "doc_id": [None] * len(part), "n": part, "node": [salt] * len(part), "other": [0] * len(part), "z": [_squeeze(blocks[i]) for i in part]}, _SURVEY)

    return run


def _squeeze(x: np.ndarray) -> bytes:
    """Counts by byte plane, which compresses small ones well."""
    return zstd.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _swell(z: bytes) -> np.ndarray:
    return np.frombuffer(zstd.decompress(z), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


_SURVEY = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("other", pa.int64()), ("z", pa.binary())])


def _add_blocks(batches):
    """Sums of sketch blocks by number; saturates at what 32 bits hold."""
    total: dict[int, np.ndarray] = {}
    salt = 0
    for b in batches:
        for n, node, z in zip(*(c.to_pylist() for c in b.columns), strict=True):
            total[n] = total.get(n, 0) + _swell(z).astype(np.int64)
            salt = node
    if total:
        yield pa.RecordBatch.from_pydict({"n": list(total), "node": [salt] * len(total), "z": [_squeeze(np.minimum(x, 2**32 - 1)) for x in total.values()]}, pa.schema([("n", pa.int64()), ("node", pa.int64()), ("z", pa.binary())]))


def frequency_classes(surveyed: DataFrame, bits: int) -> np.ndarray:
    """Classes by cell, over all documents. At most 2^MOST_BITS cells reach the driver, however large the corpus."""
    kind = "n long, node long, z binary"
    parts = mapped(surveyed.where("kind = 1").select("n", "node", "z").repartition("n", "node"), _add_blocks, kind)
    counts = np.zeros(1 << bits, np.uint32)
    for r in mapped(parts.repartition("n"), _add_blocks, kind).toLocalIterator():
        x = _swell(r["z"])
        counts[r["n"] * len(x) : (r["n"] + 1) * len(x)] = x
    return classes_of(counts)


_ENTRY = np.dtype([("h", "<u8"), ("node", "<i8"), ("n", "<u4"), ("short", "u1")])


class Read:
    """What a scan of the documents needs: the order, which documents stand for a node, and the nodes that need their other name."""

    def __init__(self, order, reps, renamed, node_bits: int = 64):
        self.order, self.reps, self.renamed, self.node_bits = order, reps, renamed, node_bits

    def nodes(self, batches: Iterator[pa.RecordBatch], reps=None) -> Iterator[list[tuple[int, np.ndarray]]]:
        """Nodes and their ranks, in groups; a node may come up again. Copies that aren't read are skipped unseen."""
        member = np.frombuffer((reps or self.reps).value, "<u4")
        for _, sets in _batches(batches, 1 << 20, member):
            out: dict[int, np.ndarray] = {}
            for s in sets:
                if len(s):
                    node, other = fingerprint(s, self.node_bits)
                    out.setdefault(other if node in self.renamed.value else node, s)
            yield [(node, np.sort(ranks(s, self.order.value))) for node, s in out.items()]


def _hot(docs: DataFrame, read: Read, buckets: int, least: int, num: int, den: int) -> DataFrame:
    """rank: shingles among the first ones of so many nodes."""

    def scan(batches):
        for nodes in read.nodes(batches):
            if nodes:
                r = np.sort(np.concatenate([x[: prefix(len(x), True, num, den)] for _, x in nodes]))
                bucket = (mix(r) % np.uint64(buckets)).astype(np.int64)
                at = np.argsort(bucket, kind="stable")
                r, bucket = r[at], bucket[at]
                cut = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(r)]])
                yield pa.RecordBatch.from_pydict({"bucket": bucket[cut[:-1]], "r": [zstd.compress(r[x:y].tobytes(), 1) for x, y in zip(cut[:-1], cut[1:], strict=True)]}, pa.schema([("bucket", pa.int64()), ("r", pa.binary())]))

    def count(held):
        r, many = np.unique(np.concatenate([np.frombuffer(zstd.decompress(x), np.uint64) for x in held]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(r[many >= least].view(np.int64))], ["rank"])

    def meet(batches):
        held, at = [], None
        for b in batches:
            for bucket, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bucket != at and held:
                    yield count(held)
                    held = []
                at = bucket
                held.append(raw)
        if held:
            yield count(held)

    sent = mapped(docs, scan, "bucket long, r binary").repartition("bucket").sortWithinPartitions("bucket")
    return mapped(sent, meet, "rank long")


def hot_bitmap(ranked: DataFrame, bits: int) -> np.ndarray:
    """Bytes of a bitmap of so many bits (a power of two) with a place set for each rank."""
    out = np.zeros(bits // 8, np.uint8)
    for batch in ranked.toArrow().to_batches():  # at most bits / 8 ranks
        at = (mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)
        np.bitwise_or.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return out


def _lists(docs: DataFrame, read: Read, buckets: int, num: int = 3, den: int = 4) -> DataFrame:
    """h, node, n, short, m: prefixes of nodes that share h with another, m nodes in all. A task sends a node once a group of texts."""

    def scan(batches):
        for nodes in read.nodes(batches):
            parts = []
            for node, ranked in nodes:
                r = ranked[: prefix(len(ranked), True, num, den)]
                e = np.empty(len(r), _ENTRY)
                e["h"], e["node"], e["n"], e["short"] = r, node, len(ranked), np.arange(len(r)) < prefix(len(ranked), False, num, den)
                parts.append(e)
            if parts:
                e = np.concatenate(parts)
                bucket = (mix(e["h"]) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                e, bucket = e[order], bucket[order]
                cut = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(e)]])
                # columns one after the other: they compress when moved
                pack = lambda x: b"".join(x[f].tobytes() for f in _ENTRY.names)
                yield pa.RecordBatch.from_pydict({"bucket": bucket[cut[:-1]], "e": [pack(e[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)]}, pa.schema([("bucket", pa.int64()), ("e", pa.binary())]))

    def unpack(raw: bytes) -> np.ndarray:
        k = len(raw) // _ENTRY.itemsize
        out, at = np.empty(k, _ENTRY), 0
        for f in _ENTRY.names:
            size = k * _ENTRY[f].itemsize
            out[f] = np.frombuffer(raw[at : at + size], _ENTRY[f])
            at += size
        return out

    def settle(held):
        e = np.concatenate(list(map(unpack, held)))
        e = e[np.lexsort((e["node"], e["h"]))]
        fresh = np.concatenate([[True], (e["h"][1:] != e["h"][:-1]) | (e["node"][1:] != e["node"][:-1])])
        e = e[fresh]  # copies in other tasks
        cut = np.concatenate([[0], np.flatnonzero(e["h"][1:] != e["h"][:-1]) + 1, [len(e)]])
        m = np.repeat(np.diff(cut), np.diff(cut))  # a bucket has all of a list
        e, m = e[m > 1], m[m > 1]
        return pa.RecordBatch.from_pydict({"h": e["h"].view(np.int64), "node": e["node"], "n": e["n"].astype(np.int64), "short": e["short"].astype(bool), "m": m}, pa.schema([("h", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("short", pa.bool_()), ("m", pa.int64())]))

    def meet(batches):
        held, at = [], None
        for b in batches:
            for bucket, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if bucket != at and held:
                    yield settle(held)
                    held = []
                at = bucket
                held.append(raw)
        if held:
            yield settle(held)

    sent = mapped(docs, scan, "bucket long, e binary").repartition("bucket").sortWithinPartitions("bucket")
    return mapped(sent, meet, "h long, node long, n long, short boolean, m long")


def _may(x: str = "x", y: str = "y", num: int = 3, den: int = 4):
    """Sizes and places allow a link: the shorter's place is within its own prefix."""
    nx, ny, sx, sy = F.col(f"{x}.n"), F.col(f"{y}.n"), F.col(f"{x}.short"), F.col(f"{y}.short")
    return (den * F.least(nx, ny) >= num * F.greatest(nx, ny)) & F.when(nx < ny, sx).when(nx > ny, sy).otherwise(sx & sy)


def _ordered(pairs: DataFrame) -> DataFrame:
    """a, na, b, nb with a < b, each pair once."""
    first = F.col("x.node") < F.col("y.node")
    pick = lambda f: (F.when(first, F.col(f"x.{f}")).otherwise(F.col(f"y.{f}")), F.when(first, F.col(f"y.{f}")).otherwise(F.col(f"x.{f}")))
    (a, b), (na, nb) = pick("node"), pick("n")
    return pairs.select(a.alias("a"), na.alias("na"), b.alias("b"), nb.alias("nb")).distinct()


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, na, nb, overlap: partial overlaps per fragment, summed per pair. sets: node, f, s (array of ranks)."""
    left = pairs.join(sets.select(F.col("node").alias("a"), "f", F.col("s").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), "f", F.col("s").alias("sb")), ["b", "f"])
    part = both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("o"))
    return part.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("overlap"))


def _member_filter(ids: DataFrame) -> bytes:
    """A bitmap of fixed size that the hash of every id (the only column) is in. Others may be too."""
    bit = F.pmod(F.xxhash64(ids.columns[0]), F.lit(FILTER_BITS))
    words = ids.where(F.col(ids.columns[0]).isNotNull()).select(bit.alias("bit")).groupBy(F.expr("bit div 32").alias("w")).agg(F.expr("bit_or(shiftleft(1L, int(bit % 32))) AS v")).toArrow()
    out = np.zeros(FILTER_BITS // 32, "<u4")
    out[words.column("w").to_numpy()] = words.column("v").to_numpy().astype("<u4")
    return out.tobytes()


def _sets(docs: DataFrame, nodes: DataFrame, reps: DataFrame, read: Read) -> DataFrame:
    """node, f, s for the nodes given. Only texts that stand for one of them (or look so in a bitmap) are read."""
    ids = nodes.join(reps, "node").select("least")
    some = docs.sparkSession.sparkContext.broadcast(_member_filter(ids))

    def scan(batches):
        for found in read.nodes(batches, some):
            out: list[list] = [[], [], []]
            for node, r in found:
                f = fragment_of(r)
                cut = np.concatenate([[0], np.flatnonzero(f[1:] != f[:-1]) + 1, [len(f)]])
                for x, y in zip(cut[:-1], cut[1:], strict=True):
                    out[0].append(node)
                    out[1].append(int(f[x]))
                    out[2].append(r[x:y].view(np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.list_(pa.int64())), strict=True)], ["node", "f", "s"])

    rows = mapped(docs, scan, "node long, f int, s array<long>")
    return rows.join(nodes, "node", "left_semi").groupBy("node", "f").agg(F.first("s").alias("s"))


def spark_hash(x: np.ndarray) -> np.ndarray:
    """xxhash64(seed 42) of 64-bit integers, as Spark's function gives it, as non-negative remainder-safe numbers."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    rot = lambda v, r: (v << np.uint64(r)) | (v >> np.uint64(64 - r))
    h = np.full(len(x), np.uint64(42) + p5 + np.uint64(8), np.uint64)
    h ^= rot(x.view(np.uint64) * p2, 31) * p1
    h = rot(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    h ^= h >> np.uint64(32)
    return (h & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _named(surveyed: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """Rows (doc_id, n, node), nodes with their least id, and the nodes of several sets, which go by their other name."""
    rows = surveyed.where("kind = 0").select("doc_id", "n", "node", "other")
    met = rows.where("n > 0").groupBy("node").agg(F.min("other").alias("a"), F.max("other").alias("b")).where("a <> b").select("node")
    renamed = sorted(r["node"] for r in met.collect())  # of 64 bits: none, or a handful
    if renamed:
        rows = rows.withColumn("node", F.when(F.col("node").isin(renamed) & (F.col("n") > 0), F.col("other")).otherwise(F.col("node")))
        if not rows.where("n > 0").groupBy("node").agg(F.min("other").alias("a"), F.max("other").alias("b")).where("a <> b").isEmpty():
            raise RuntimeError("different sets agree in 64 bits of two hashes")
    reps = staged(rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least")), "reps")
    return rows.drop("other"), reps, renamed


def similar(documents: DataFrame, num: int = 3, den: int = 4, node_bits: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id, node. Links where overlap / union >= num / den. node_bits: of a node's first name."""
    docs = documents.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    sc = docs.sparkSession.sparkContext
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits, buckets = sketch_bits(total), max(16, -(-total // BUCKET_TEXT))
    surveyed = staged(mapped(docs, _survey(bits, node_bits), "kind int, doc_id long, n long, node long, other long, z binary"), "survey")
    rows, reps, renamed = _named(surveyed)
    classes = frequency_classes(surveyed, bits)  # 2^bits bytes
    read = Read(sc.broadcast((classes, np.zeros(0, np.uint8))), sc.broadcast(_member_filter(reps.select("least"))), sc.broadcast(frozenset(renamed)), node_bits)
    hot_bits = 1 << int(np.log2(min(HOT_MOST_BITS, max(HOT_LEAST_BITS, total // 64))))
    hot_from = max(HOT_LEAST, int(total / BYTES_A_SHINGLE * (den - num) / den / (hot_bits // 8)))
    many = staged(_hot(docs, read, buckets, hot_from, num, den), "hot")
    hot = hot_bitmap(many, hot_bits)
    release(many)
    read = Read(sc.broadcast((classes, hot)), read.reps, read.renamed, node_bits)
    lists = staged(_lists(docs, read, buckets, num, den), "lists")
    lengthy, few = lists.where(F.col("m") > LIST).drop("m"), lists.where(F.col("m") <= LIST).drop("m")
    # the pivot is the member of most long lists, so that lists of one group of copies tend to share it; then the shortest
    degree = staged(lengthy.groupBy("node").agg((-F.count("*")).alias("d")), "degrees")
    pivots = staged(lengthy.where("short").join(degree, "node").groupBy("h").agg(F.min(F.struct("d", "n", "node", "short")).alias("p")).select("h", F.struct("p.n", "p.node", "p.short").alias("p")), "pivots")
    small = few.alias("x").join(few.alias("y"), "h").where(F.col("x.node") < F.col("y.node")).where(_may("x", "y", num, den))
    long_ = staged(lengthy.join(pivots, "h").select("h", "node", "n", "short", "p"), "long_lists")
    release(degree, pivots)
    starred = long_.where("node <> p.node").select(F.struct("node", "n", "short").alias("x"), F.col("p").alias("y")).where(den * F.least("x.n", "y.n") >= num * F.greatest("x.n", "y.n"))
    pairs = staged(_ordered(small.select(F.struct("x.node", "x.n", "x.short").alias("x"), F.struct("y.node", "y.n", "y.short").alias("y"))).union(_ordered(starred)).distinct(), "pairs")
    prefixes = staged(lists.groupBy("node").agg(F.collect_list("h").alias("hs")), "prefixes")
    release(lists)
    told = staged(_bounded(pairs, prefixes, num, den), "bounded")
    release(pairs)
    likely = told.where("may").select("a", "na", "b", "nb")
    wanted = staged(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    sets = staged(_sets(docs, wanted, reps, read), "sets")
    seen = staged(_overlaps(likely, sets), "overlaps")
    linked = den * F.col("overlap") >= num * (F.col("na") + F.col("nb") - F.col("overlap"))
    comp = staged(connected_components(seen.where(linked).select("a", "b")), "components")
    more = _across(long_, comp, told, seen, prefixes, num, den)
    release(long_, told, prefixes)
    if more is not None:
        rest = staged(more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(wanted, "node", "left_anti"), "wanted_across")
        across = None if rest.isEmpty() else staged(_sets(docs, rest, reps, read), "sets_across")
        both = sets if across is None else sets.union(across)
        again = staged(_overlaps(more, both), "overlaps_across")
        first = comp.select(F.col("node").alias("a"), F.col("component").alias("b"))
        joined = staged(connected_components(first.union(again.where(linked).select("a", "b"))), "components")
        release(comp, rest, across, again, more)
        comp = joined
    release(wanted, sets, seen)
    named = staged(reps.join(comp, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component")), "named")
    of = staged(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    final = staged(named.join(of, "component").select("node", "component_id"), "node_components")
    release(reps, comp, named, of)
    out = rows.join(final, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "node")


def _bounded(pairs: DataFrame, prefixes: DataFrame, num: int = 3, den: int = 4) -> DataFrame:
    """pairs with most, which their overlap can't exceed, and may, whether a link is possible.

    Shared shingles of the two prefixes are counted: beyond the prefix that ends first in the global order, the set
    that it belongs to has only so many shingles left.
    """
    both = pairs.join(prefixes.select(F.col("node").alias("a"), F.col("hs").alias("ha")), "a").join(prefixes.select(F.col("node").alias("b"), F.col("hs").alias("hb")), "b")
    left = lambda n: F.ceil(F.lit(num) * F.col(n) / den) - 1  # noqa: E731  beyond the prefix
    most = F.least(F.size(F.array_intersect("ha", "hb")) + F.greatest(left("na"), left("nb")), "na", "nb")
    need = F.ceil(F.lit(num) * (F.col("na") + F.col("nb")) / (num + den))
    return both.select("a", "na", "b", "nb", most.alias("most")).withColumn("may", F.col("most") >= need)


def _across(long_: DataFrame, comp: DataFrame, told: DataFrame, seen: DataFrame, prefixes: DataFrame, num: int = 3, den: int = 4) -> DataFrame | None:
    """Pairs of long lists whose nodes are in different components and that neither the pivot nor their prefixes rule out.

    With d the Jaccard distance, d(x, y) >= |d(x, p) - d(y, p)|, so a link needs these within a quarter. Where a
    distance to the pivot wasn't worked out, bounds on it serve. None if there are no such pairs.
    """
    of = long_.join(comp, "node", "left").select("h", "node", "n", "short", "p", F.coalesce("component", "node").alias("c"))
    mixed = staged(of.groupBy("h").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("h"), "mixed")
    if mixed.isEmpty():
        return None
    far = lambda o: 1 - F.col(o) / (F.col("na") + F.col("nb") - F.col(o))
    known = told.join(seen.select("a", "b", "overlap"), ["a", "b"], "left").select("a", "b", F.coalesce(far("overlap"), far("most")).alias("lo"), F.coalesce(far("overlap"), F.lit(1.0)).alias("hi"))
    known = known.select(F.col("a").alias("node"), F.col("b").alias("pn"), "lo", "hi").union(known.select(F.col("b").alias("node"), F.col("a").alias("pn"), "lo", "hi"))
    left = of.join(mixed, "h", "left_semi").where("node <> p.node").withColumn("pn", F.col("p.node")).join(known, ["node", "pn"], "left")
    by_size = 1 - F.least("n", "p.n") / F.greatest("n", "p.n")
    left = staged(left.select("h", "node", "n", "short", "c", F.coalesce("lo", by_size).alias("lo"), F.coalesce("hi", F.lit(1.0)).alias("hi")), "left")
    quarter = 1 - num / den + 1e-9
    near = (F.col("x.c") != F.col("y.c")) & (F.col("x.lo") - F.col("y.hi") <= quarter) & (F.col("y.lo") - F.col("x.hi") <= quarter)
    met = left.alias("x").join(left.alias("y"), "h").where((F.col("x.node") < F.col("y.node")) & near).where(_may("x", "y", num, den))
    pairs = _ordered(met.select(F.struct("x.node", "x.n").alias("x"), F.struct("y.node", "y.n").alias("y")))
    pairs = pairs.join(told.select("a", "b"), ["a", "b"], "left_anti")
    pairs = staged(_bounded(pairs, prefixes, num, den).where("may").select("a", "na", "b", "nb"), "across")
    release(mixed, left)
    return None if pairs.isEmpty() else pairs
