"""Exact substring deduplication: bytes that repeat an earlier document go.

A byte is removed when it lies in a string of LENGTH bytes that also starts in a document with a smaller id. Equal
strings are found by threshold-bounded interval expansion on a Burrows-Wheeler transform: breadth-first backward
extension of suffix intervals sets common-prefix values in increasing order and stops at LENGTH; what is left unset
joins equal strings into classes, and the least id of a class decides.

One transform over the corpus would be one task, so strings are dealt to many small transforms by their content:

1. Each window of LENGTH bytes has a minimizer (the least hash of its GRAM-byte strings). Equal windows have equal
   minimizers, so windows whose minimizer stands in one text only can't repeat. Only hashes move in this step.
2. Windows that are left travel as fragments: up to RUN neighbouring windows with one minimizer, which is their key.
   Those of hot minimizers (at most 1/HOT_SHARE of all that are sent, so the list of them is bounded) are cut into
   groups of at most GROUP windows, keyed by the bytes common to all of them and their place relative to the
   minimizer; those of minimizers HOTTER times as frequent go window by window, each its own key. Either way equal
   windows get equal keys, and no key holds more than HOTTER * the hot bound different fragments.
3. Equal fragments collapse to one with its least document (pre-aggregated before they move) and are dealt by key.
   Each shard builds transforms of bounded size and returns the least document for each window.
4. That answer is joined to the fragments' occurrences, whose intervals go back to their row.

Copies of a whole text are settled beforehand by its 128-bit hash; all that remains is decided by a transform.

Rows are known by id and a 64-bit hash of the text, so two texts under one id are two rows with spans of their own.
Cases: null is an empty text; texts shorter than LENGTH keep all; ids may repeat, and a text never loses bytes to
another of its own id; equal rows get equal answers; null ids never remove or get removed; ids are cast to long, and
one that isn't a number counts as null; extra columns are ignored; an empty table gives an empty result. A text is in
memory whole, but what is worked out for each of its bytes only for SLICE bytes at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.arrow import grouped
from leafmill.sources.staging import release, staged

LENGTH, GRAM, GROUP = 50, 24, 8
#: Bytes of text behind one bucket of hashes, and bytes of fragments in one transform.
BUCKET_TEXT, SHARD_BYTES = 16 << 20, 1 << 19
#: A minimizer in more than HOT_LEAST texts and more than one in HOT_SHARE of all sent is hot; HOTTER times that is hotter.
HOT_LEAST, HOT_SHARE, HOTTER = 1000, 1 << 22, 8
#: Bytes of a text worked on at once, most windows of a fragment, and bytes of fragments gathered before they move on.
SLICE, RUN, HELD = 1 << 20, 1024, 8 << 20
SEND_PER_BYTE = 0.065
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _C
    return x ^ (x >> np.uint64(29))


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A 48-bit hash of the GRAM = 24 bytes from each place."""
    if len(b) < GRAM:
        return np.zeros(0, np.uint64)
    w = np.lib.stride_tricks.sliding_window_view(b, 8).copy().view(np.uint64).ravel()
    return mix(mix(w[:-16] * _A + (w[8:-8] ^ (w[8:-8] >> np.uint64(32))) * _B) + w[16:] * _C) >> np.uint64(16)


def window_minima(h: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each window of length bytes, the least hash in it."""
    w = length - GRAM + 1
    if len(h) < w:
        return np.zeros(0, np.uint64)
    span, out = 1, h
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(h) - w + 1], out[w - span : len(h) - span + 1])


def runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values start, and the end."""
    return np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]]) if len(x) else np.zeros(1, np.int64)


def sliced(b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a text and where they start; each window of LENGTH bytes is in one part."""
    for at in range(0, max(1, len(b) - LENGTH + 1), SLICE):
        yield at, b[at : at + SLICE + LENGTH - 1]


def minimizers(b: np.ndarray) -> np.ndarray:
    found = []
    for _, part in sliced(b):
        m = window_minima(gram_hashes(part))
        if len(m):
            found.append(np.unique(m[runs(m)[:-1]]))
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0] if found else np.zeros(0, np.uint64)


def gather(blob: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int = 1 << 18) -> np.ndarray:
    """blob[start : start + size] for each start, put together. Indices are worked out for about most bytes at once."""
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    i = 0
    while i < len(starts):
        lo = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, lo + most, "right")))
        if j == i + 1:
            out[lo : int(ends[i])] = blob[int(starts[i]) : int(starts[i]) + int(sizes[i])]
        else:
            out[lo : int(ends[j - 1])] = blob[spread(starts[i:j], sizes[i:j])]
        i = j
    return out


def _isin(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each of x is in among, which is sorted."""
    if not len(among):
        return np.zeros(len(x), bool)
    return among[np.searchsorted(among, x).clip(max=len(among) - 1)] == x


def _groups(b: np.ndarray, h: np.ndarray, m: np.ndarray, s: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of at most so many of the windows s, keyed by the bytes their groups have in common."""
    view = np.lib.stride_tricks.sliding_window_view(h, LENGTH - GRAM + 1)
    # the leftmost place of the minimum within each window, for blocks of windows
    rel = np.concatenate([view[s[i : i + 65536]].argmin(1) for i in range(0, len(s), 65536)])
    place, group = s + rel, rel // most
    cut = np.concatenate([[0], np.flatnonzero((place[1:] != place[:-1]) | (group[1:] != group[:-1]) | (s[1:] != s[:-1] + 1)) + 1, [len(s)]])
    first, count = s[cut[:-1]], np.diff(cut)
    p, g = place[cut[:-1]], group[cut[:-1]]
    # bytes common to all windows of the group: LENGTH - most + 1 from the place less most * g
    start, common = p - most * g, LENGTH - most + 1
    words = np.lib.stride_tricks.sliding_window_view(b, 8).copy().view(np.uint64).ravel()
    key = mix(m[first] + (g + 1).astype(np.uint64) * _B + np.uint64(most))
    for k in [*range(0, common - 8, 8), common - 8]:
        key = mix(key * _A + words[start + k])
    return key, first, count


def _shortened(key: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of more than RUN windows, as periodic text has them, cut into ones of at most RUN."""
    if not len(count) or count.max() <= RUN:
        return key, first, count
    parts = -(-count // RUN)
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.repeat(key, parts), np.repeat(first, parts) + step * RUN, np.minimum(RUN, np.repeat(count, parts) - step * RUN)


def fragments(b: np.ndarray, shared: np.ndarray, hot: np.ndarray, hotter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first window and number of windows of each fragment whose minimizer is among shared.

    shared, hot and hotter are sorted; hotter ones are among the hot.
    """
    h = gram_hashes(b)
    m = window_minima(h)
    if not len(m):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = runs(m)
    own, many = m[cut[:-1]], np.diff(cut)
    keep = _isin(own, shared)
    burn, glow = keep & _isin(own, hot), keep & _isin(own, hotter)
    plain = np.flatnonzero(keep & ~burn)
    parts = [_shortened(mix(own[plain]), cut[:-1][plain], many[plain])]
    for which, most in ((burn & ~glow, GROUP), (glow, 1)):
        if which.any():
            parts.append(_groups(b, h, m, np.flatnonzero(np.repeat(which, many)), most))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


# ---- the transform


def bounded_order(t: np.ndarray, depth: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first depth symbols (ties by place), and for each place the rank of its first 8.

    Prefix doubling: a rank is the number of suffixes before its group, so groups of one are done and only the rest
    is sorted again by the rank of what follows.
    """
    n = len(t)
    padded = np.concatenate([t, np.zeros(8, np.uint8)])
    key = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view(">u8").ravel().astype(np.uint64)
    order = np.argsort(key)  # of equal ones by chance: the loop puts them by place
    new = key[order]
    new = np.concatenate([[True], new[1:] != new[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    eight, size = rank.copy(), 8
    ahead = np.concatenate([rank, np.full(depth, -1)])
    bits = n.bit_length()
    while size < depth:
        first = np.flatnonzero(new)
        many = np.diff(np.concatenate([first, [n]]))
        open_ = np.repeat(many > 1, many)
        if not open_.any():
            break
        at = order[open_]
        if 3 * bits < 64:  # rank, rank ahead and place fit into one number; plain numbers are sorted much faster
            both = (rank[at] << 2 * bits) | ((ahead[at + size] + 1) << bits) | at
            both.sort()
            at = both & ((1 << bits) - 1)
            both >>= bits
            fresh = np.concatenate([[True], both[1:] != both[:-1]])
        else:
            at = at[np.lexsort((at, ahead[at + size], rank[at]))]
            fresh = np.concatenate([[True], (rank[at[1:]] != rank[at[:-1]]) | (ahead[at[1:] + size] != ahead[at[:-1] + size])])
        order[open_] = at
        new[open_] = fresh
        place = np.flatnonzero(open_)
        changed = place[fresh][np.cumsum(fresh) - 1]
        rank[at] = changed
        ahead[:n] = rank
        size *= 2
    return order, eight


def classes(t: np.ndarray, least: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order and, for each in that order, the number of its class: suffixes that share least symbols.

    Symbols are below 256. The transform of the ordered suffixes is extended backwards breadth first, from the
    intervals of all strings of 8 symbols; an interval of a string of l symbols that ends at a border not yet set
    gives it the common prefix l-1 and is extended on. Borders still unset at least hold equal strings together.
    """
    n = len(t)
    order, eight = bounded_order(t)
    before = t[order - 1]  # the transform; the first suffix takes the last symbol
    by = np.argsort(before, kind="stable")  # LF order: place x of it is the row whose predecessor sorts at x
    bits = n.bit_length()
    lf = np.empty(n, np.int64)
    lf[by] = np.arange(n) << bits  # room for the number of an interval beside it
    symbol = before[by]
    head = eight[order]
    lcp = np.zeros(n + 1, np.uint8)  # 0: unset; else common prefix + 1
    border = np.concatenate([[0], np.flatnonzero(head[1:] != head[:-1]) + 1, [n]])
    lcp[border] = 1
    lo, hi = border[:-1], border[1:]
    for l in range(8, least):
        if not len(lo):
            break
        size = hi - lo
        to = lf[spread(lo, size)] | np.repeat(np.arange(len(lo)), size)
        to.sort()
        near = np.diff(to) == 1 << bits  # the next row, of the same interval
        to >>= bits
        # rows of one interval with one symbol before them lie side by side
        first = symbol[to]
        cut = np.concatenate([[0], np.flatnonzero(~near | (first[1:] != first[:-1])) + 1, [len(to)]])
        a, b = to[cut[:-1]], to[cut[1:] - 1] + 1
        fresh = lcp[b] == 0
        lo, hi = a[fresh], b[fresh]
        lcp[hi] = l + 1
    return order, np.cumsum(lcp[:-1] != 0) - 1


def least_documents(blob: np.ndarray, sizes: np.ndarray, first_docs: np.ndarray) -> np.ndarray:
    """For each window of each fragment in turn, the least document among all fragments with an equal window.

    blob: the fragments' bytes one after the other.
    """
    n = len(sizes)
    starts = np.cumsum(sizes) - sizes
    text = np.zeros(len(blob) + n, np.uint8)  # a byte of 0 after each; what reaches across one is no window and isn't looked at
    own = np.ones(len(text), bool)
    own[np.cumsum(sizes + 1) - 1] = False
    text[own] = blob
    order, cls = classes(text)
    windows = sizes - LENGTH + 1
    inside = spread(starts + np.arange(n), windows)
    doc = np.full(len(text), np.iinfo(np.int64).max)
    doc[inside] = np.repeat(first_docs, windows)
    least = np.minimum.reduceat(doc[order], runs(cls)[:-1])[cls]
    out = np.empty(len(text), np.int64)
    out[order] = least
    return out[inside]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, so many of each."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


# ---- the job

_BYTES = pa.binary()


def _text_batches(batches: Iterator[pa.RecordBatch], text: int, most: int = 4 << 20) -> Iterator[list[tuple]]:
    """Rows in groups with texts (column number text) of about most bytes; a longer text comes alone."""
    for b in batches:
        rows, held = [], 0
        for i in range(b.num_rows):
            r = tuple(c[i].as_py() for c in b.columns)
            rows.append(r)
            held += len(r[text] or b"") + 64
            if held > most:
                yield rows
                rows, held = [], 0
        if rows:
            yield rows


def _packed(documents: DataFrame) -> DataFrame:
    """doc_id, t, z: texts as compressed bytes, for moving."""

    def run(batches):
        c = zstd.ZstdCompressor(level=3)
        for rows in _text_batches(batches, 2):
            ids, t, texts = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(t, pa.int64()), pa.array([c.compress(x) for x in texts], _BYTES)], ["doc_id", "t", "z"])

    return documents.select("doc_id", "t", "text").mapInArrow(run, "doc_id long, t long, z binary")


def _pack(h: np.ndarray, ids: np.ndarray, text: np.ndarray, d: np.ndarray, z: zstd.ZstdCompressor) -> bytes:
    """Hashes of 48 bits with their document (an index into ids and text), small."""
    own, at = np.unique(d, return_inverse=True)
    head = np.array([len(own), len(h)], np.int64).tobytes()
    return z.compress(head + ids[own].tobytes() + text[own].tobytes() + h.view(np.uint8).reshape(-1, 8)[:, :6].tobytes() + at.astype("<u4").tobytes())


def _unpack(raw: bytes, z: zstd.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = z.decompress(raw)
    k, n = map(int, np.frombuffer(raw, np.int64, 2))
    ids, text = np.frombuffer(raw, np.int64, 2 * k, 16).reshape(2, k)
    h = np.zeros((n, 8), np.uint8)
    h[:, :6] = np.frombuffer(raw, np.uint8, 6 * n, 16 + 16 * k).reshape(n, 6)
    at = np.frombuffer(raw, np.uint32, n, 16 + 16 * k + 6 * n)
    return h.view(np.uint64).ravel(), ids[at], text[at]


def shared_minimizers(documents: DataFrame, total: int) -> DataFrame:
    """doc_id, t, h: minimizers of a row's text that stand in another text too; with a null doc_id, hot minimizers (t: 1 hot, 2 hotter).

    documents: doc_id, t, text (binary), of about total bytes. A task sends a minimizer that it sees in two texts itself
    once, with the number of texts; its rows need no answer and go to any bucket.
    """
    buckets = max(16, -(-total // BUCKET_TEXT))
    hot_from = hot_bound(total)

    def scan(batches):
        z = zstd.ZstdCompressor(level=1)
        for rows in _text_batches(batches, 2, 8 << 20):
            rows = [r for r in rows if r[0] is not None and len(r[2]) >= LENGTH]
            if not rows:
                continue
            own = [minimizers(np.frombuffer(r[2], np.uint8)) for r in rows]
            h = np.concatenate(own)
            d = np.repeat(np.arange(len(rows)), list(map(len, own)))
            ids, text = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
            del own, rows
            order = np.argsort(h, kind="stable")
            h, d = h[order], d[order]
            cut = runs(h)
            t = text[d]
            two = np.minimum.reduceat(t, cut[:-1]) != np.maximum.reduceat(t, cut[:-1])
            known = np.repeat(two, np.diff(cut))
            bucket = (mix(h) % np.uint64(buckets)).astype(np.int64)
            # (bucket, kind, payload): 1 what is known, 2 marks of the known, 0 the rest
            out = [(int(bucket[0]), 1, _pack(h[known], ids, text, d[known], z))] if known.any() else []
            for kind, sel in ((0, np.flatnonzero(~known)), (2, cut[:-1][two])):
                sel = sel[np.argsort(bucket[sel], kind="stable")]
                edge = runs(bucket[sel]) if len(sel) else [0]
                many = np.diff(cut)[np.searchsorted(cut, sel)] if kind == 2 else None
                for x, y in zip(edge[:-1], edge[1:], strict=True):
                    part = sel[x:y]
                    load = _pack(h[part], ids, text, d[part], z) if kind == 0 else z.compress(h[part].tobytes() + many[x:y].astype(np.int64).tobytes())
                    out.append((int(bucket[part[0]]), kind, load))
            yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), _BYTES), strict=True)], ["bucket", "kind", "load"])

    def rows_of(i, t, h) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(t, pa.int64()), pa.array(h.view(np.int64))], ["doc_id", "t", "h"])

    def settle(held, marks):
        h, i, t = (np.concatenate([r[k] for r in held] + [np.zeros(0, ty)]) for k, ty in enumerate((np.uint64, np.int64, np.int64)))
        mh, mn = (np.concatenate([r[k] for r in marks] + [np.zeros(0, ty)]) for k, ty in enumerate((np.uint64, np.int64)))
        order = np.argsort(h, kind="stable")
        h, i, t = h[order], i[order], t[order]
        cut = runs(h) if len(h) else np.zeros(1, np.int64)
        own = h[cut[:-1]] if len(h) else h
        marked = np.unique(mh)
        two = ((np.minimum.reduceat(t, cut[:-1]) != np.maximum.reduceat(t, cut[:-1])) if len(h) else np.zeros(0, bool)) | _isin(own, marked)
        keep = np.repeat(two, np.diff(cut))
        yield rows_of(i[keep], t[keep], h[keep])
        every, at = np.unique(np.concatenate([own, mh]), return_inverse=True)
        load = np.bincount(at, np.concatenate([np.diff(cut), mn]), len(every))
        burn = load >= hot_from
        if burn.any():
            yield rows_of(pa.nulls(int(burn.sum()), pa.int64()), np.where(load[burn] >= HOTTER * hot_from, 2, 1), every[burn])

    def meet(batches):
        z, held, marks, at = zstd.ZstdDecompressor(), [], [], None
        for b in batches:
            for bucket, kind, load in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == 1:
                    h, i, t = _unpack(load, z)
                    yield rows_of(i, t, h)
                    continue
                if bucket != at and (held or marks):
                    yield from settle(held, marks)
                    held, marks = [], []
                at = bucket
                if kind == 0:
                    held.append(_unpack(load, z))
                else:
                    raw = z.decompress(load)
                    n = len(raw) // 16
                    marks.append((np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.int64, n, 8 * n)))
        if held or marks:
            yield from settle(held, marks)

    sent = documents.select("doc_id", "t", "text").mapInArrow(scan, "bucket long, kind int, load binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "doc_id long, t long, h long")


def hot_bound(total: int) -> int:
    """From how many texts a minimizer is hot, in a corpus of so many bytes."""
    return max(HOT_LEAST, int(total * SEND_PER_BYTE / HOT_SHARE))


def _binary(blob: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(_BYTES, len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(blob))])


def _blob(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column put together, and the sizes."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], np.diff(offsets)


def _fragment_rows(shared_hot):
    """Rows (doc_id, t, z, shared) to fragments, gathered up to about HELD / 4 bytes before they are handed on."""

    def run(batches):
        un, (hot, hotter) = zstd.ZstdDecompressor(), (np.frombuffer(x, np.uint64) for x in shared_hot.value)
        parts, held = [], 0

        def flush():
            key, doc, t, first, size, blob = (np.concatenate(x) for x in zip(*parts, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc), pa.array(t), pa.array(first), _binary(blob, size)], ["key", "doc_id", "t", "start", "bytes"])

        for rows in _text_batches(batches, 2, 1 << 20):
            for doc, t, z, shared in rows:
                b, among = np.frombuffer(un.decompress(z), np.uint8), np.sort(np.array(shared, np.int64).view(np.uint64))
                for at, part in sliced(b):
                    key, first, count = fragments(part, among, hot, hotter)
                    if not len(key):
                        continue
                    size = count + LENGTH - 1
                    parts.append((key, np.full(len(key), doc, np.int64), np.full(len(key), t, np.int64), first + at, size, gather(part, first, size)))
                    held += len(parts[-1][-1]) + 40 * len(key)
                    if held > HELD // 4:
                        yield flush()
                        parts, held = [], 0
        if parts:
            yield flush()

    return run


class _Fragments:
    """Fragments by key and content hash, each with its least and greatest document."""

    names = ("key", "frag", "first", "last", "size")

    def __init__(self, key, frag, first, last, size, blob):
        order = np.lexsort((frag, key))
        k, f = key[order], frag[order]
        cut = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (f[1:] != f[:-1])]))
        keep = order[cut]
        self.key, self.frag, self.size = key[keep], frag[keep], size[keep]
        self.first, self.last = np.minimum.reduceat(first[order], cut), np.maximum.reduceat(last[order], cut)
        self.blob = gather(blob, (np.cumsum(size) - size)[keep], self.size)

    @classmethod
    def together(cls, parts: list[tuple]) -> "_Fragments":
        return cls(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    def columns(self) -> tuple:
        return (*(getattr(self, n) for n in self.names), self.blob)

    def some(self, mask: np.ndarray) -> tuple:
        at = np.flatnonzero(mask)
        return (*(getattr(self, n)[at] for n in self.names), gather(self.blob, (np.cumsum(self.size) - self.size)[at], self.size[at]))


def _write(columns: tuple, z: zstd.ZstdCompressor) -> bytes:
    *numbers, blob = columns
    return z.compress(np.array([len(numbers[0])], np.int64).tobytes() + b"".join(x.astype(np.int64).tobytes() for x in numbers) + blob.tobytes())


def _read(raw: bytes, z: zstd.ZstdDecompressor) -> tuple:
    raw = z.decompress(raw)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    numbers = np.frombuffer(raw, np.int64, 5 * n, 8).reshape(5, n)
    return (*numbers, np.frombuffer(raw, np.uint8, offset=8 + 40 * n))


def _collapse(shards: int):
    """Equal fragments of a task become one with its least and its greatest document; the rest is packed by shard."""

    def run(batches):
        z, parts, held = zstd.ZstdCompressor(level=1), [], 0

        def flush():
            f = _Fragments.together(parts)
            shard = mix(f.key.view(np.uint64)) % np.uint64(shards)
            own = np.unique(shard).tolist()
            return pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([_write(f.some(shard == s), z) for s in own], _BYTES)], ["shard", "load"])

        for b in batches:
            key, frag, doc = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            blob, size = _blob(b.column(3))
            parts.append((key, frag, doc, doc, size, blob))
            held += len(blob) + 40 * len(key)
            if held > HELD:
                yield flush()
                parts, held = [], 0
        if held:
            yield flush()

    return run


def _settle(f: _Fragments) -> Iterator[pa.RecordBatch]:
    """Answers for fragments whose keys are all here: (key, frag, a, b, least) for windows a to b of a fragment."""
    cut = runs(f.key)[:-1]
    many = np.diff(np.concatenate([cut, [len(f.key)]]))
    several = np.minimum.reduceat(f.first, cut) != np.maximum.reduceat(f.last, cut)  # else one document alone has all
    key, frag, first, last, size, blob = f.some(np.repeat(several, many))
    at = 0
    ends = np.cumsum(size)
    keys = runs(key)[1:]
    while at < len(key):  # transforms of about SHARD_BYTES, cut between keys
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SHARD_BYTES))
        to = int(keys[min(np.searchsorted(keys, max(to, at + 1)), len(keys) - 1)])
        part = slice(at, to)
        lo = int(ends[at - 1]) if at else 0
        x = least_documents(blob[lo : int(ends[to - 1])], size[part], first[part])
        w = size[part] - LENGTH + 1
        own = np.repeat(np.arange(to - at), w)
        start = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (own[1:] != own[:-1])]))
        stop = np.concatenate([start[1:], [len(x)]])
        owner, base = own[start], (np.cumsum(w) - w)[own[start]]
        told = x[start] < last[part][owner]  # some document after the least one has it
        yield _answer(key[part][owner][told], frag[part][owner][told], (start - base)[told].astype(np.int32), (stop - base)[told].astype(np.int32), x[start][told])
        at = to


def _answer(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["key", "frag", "a", "b", "least"])


def _answers(batches):
    """Rows by shard. A shard holds the fragments of about BUCKET_TEXT bytes of text."""
    z, parts, at = zstd.ZstdDecompressor(), [], None
    for b in batches:
        for shard, load in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if shard != at and parts:
                yield from _settle(_Fragments.together(parts))
                parts = []
            at = shard
            parts.append(_read(load, z))
    if parts:
        yield from _settle(_Fragments.together(parts))


def removed_runs(n: int, copied: bool, spans: list) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that spans (lo, hi) cover in a text of n bytes."""
    if copied and n >= LENGTH:
        return np.zeros(1, np.int64), np.full(1, n, np.int64)
    if not spans:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo, hi = np.array([(x["lo"], x["hi"]) for x in spans], np.int64).T
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > reach[:-1]])
    return lo[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(lo) - 1]])]


def _finish(batches):
    un = zstd.ZstdDecompressor()
    for rows in _text_batches(batches, 1, 1 << 20):
        out: list[tuple] = []
        for doc, z, copied, spans in rows:
            raw = un.decompress(z)
            lo, hi = removed_runs(len(raw), copied, spans)
            kept = b"".join(raw[a:b] for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(raw)], strict=True)) if len(lo) else raw
            out.append((doc, len(raw), len(raw) - len(kept), len(lo), hashlib.sha256(kept).hexdigest(), kept))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), _BYTES), strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary, what is left of the text)."""
    docs = documents.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    spark, own = docs.sparkSession, ["doc_id", "t"]
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # copies of a whole text: all but those of its least document
    marks = staged(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "t", F.md5("text").alias("m")), "hashes")
    firsts = staged(marks.groupBy("m").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("m", "first"), "firsts")
    copies = staged(marks.join(firsts, "m").where("doc_id > first").select(*own).distinct(), "copies")
    release(marks, firsts)
    shared = staged(shared_minimizers(docs, total), "shared")
    hot = shared.where("doc_id is null").groupBy("h").agg(F.max("t").alias("t")).toArrow()  # at most HOT_SHARE hashes
    h, level = (hot.column(c).to_numpy() for c in ("h", "t"))
    hot = spark.sparkContext.broadcast([np.sort(h[level >= k].view(np.uint64)).tobytes() for k in (1, 2)])
    by_doc = shared.where("doc_id is not null").join(copies, own, "left_anti").groupBy(*own).agg(F.collect_set("h").alias("shared"))
    found = _packed(docs).join(by_doc, own).select("doc_id", "t", "z", "shared").mapInArrow(_fragment_rows(hot), "key long, doc_id long, t long, start long, bytes binary")
    found = staged(found, "fragments")
    release(shared)
    hashed = found.withColumn("frag", F.xxhash64("bytes"))
    shards = max(16, -(-total // BUCKET_TEXT))
    once = hashed.select("key", "frag", "doc_id", "bytes").mapInArrow(_collapse(shards), "shard long, load binary")
    dealt = once.repartition("shard").sortWithinPartitions("shard")
    answers = staged(dealt.mapInArrow(_answers, "key long, frag long, a int, b int, least long"), "answers")
    hit = hashed.select("key", "frag", "doc_id", "t", "start").join(answers, ["key", "frag"]).where("least < doc_id")
    spans = hit.select("doc_id", "t", (F.col("start") + F.col("a")).alias("lo"), (F.col("start") + F.col("b") + LENGTH - 1).alias("hi"))
    spans = staged(spans.groupBy(*own).agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "spans")
    release(found, answers)
    whole = _packed(docs).join(copies.withColumn("copied", F.lit(True)), own, "left").join(spans, own, "left")
    return whole.select("doc_id", "z", "copied", "spans").mapInArrow(_finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
