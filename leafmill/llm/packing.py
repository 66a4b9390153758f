"""Packing token pieces into sequences: minimum bin slack over the histogram of lengths.

Only how many pieces there are of each length matters for which lengths go together, and there are at most CAPACITY
lengths. The histogram (a bounded table) is packed on the driver: for the longest length left, a bitset subset-sum
over the available lengths finds the fullest bin that holds it, and that combination is removed as often as the
histogram allows. Real pieces then take the places of their length by their rank, which distributed counts give. Pieces
of CAPACITY tokens fill a sequence alone, so they need no rank and don't move.

Cases: a null or empty text is its end token alone; repeated rows are packed each; texts of any length are cut into
pieces of CAPACITY tokens, of which the first may be shorter; an added token of the vocabulary that is spelt out in a
text becomes its id, as the tokenizer file says; an empty table gives no piece; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.arrow import id_texts, mapped
from leafmill.llm.language_id import batch_type
from leafmill.sources.staging import staged

CAPACITY, END = 1024, 2
#: Pieces that are ranked in one task, about.
BUCKET_ROWS, LEAST_BUCKETS = 1 << 18, 64
#: Texts longer than this are tokenised in slices cut at a blank before a letter, where no token of this vocabulary reaches across.
SLICE_CHARS = 1 << 20


def _byte_of() -> dict[str, int]:
    """Character that stands for a byte in a byte-level vocabulary -> byte: printable ones for themselves, the rest in order from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(2)
def _encoder(path: str):
    """Encodes a text to ids as the tokenizer file at path does, without adding special tokens.

    A byte-level vocabulary whose ids follow the order of its merges is run by the faster of two libraries for it (tiktoken,
    with the file's own merges); what it says of a probe must equal what tokenizers says. Any other file is run by tokenizers.
    """
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    slow = lambda text: own.encode(text, add_special_tokens=False).ids
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    model, byte = said["model"], _byte_of()
    added = {x["content"]: x["id"] for x in said.get("added_tokens", [])}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
    vocabulary = {t: i for t, i in model.get("vocab", {}).items() if t not in added} if model.get("type") == "BPE" else {}
    in_order = [vocabulary.get(m.replace(" ", ""), -1) for m in merged]
    if not vocabulary or in_order != sorted(in_order) or not all(c in byte for t in vocabulary for c in t):
        return slow
    import tiktoken

    ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}
    fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    encode = lambda text: fast.encode(text, allowed_special="all")
    probe = " ".join([*added, "It's  Größe\n\n 12,5 \u3053\u3093 x\t\U0001f600 don't ñandú"])
    return encode if encode(probe) == slow(probe) else slow


#: How this vocabulary's tokenizer splits a text before merging (a fixed value of the public format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def slices(text: str, most: int = SLICE_CHARS) -> Iterator[str]:
    """The text in parts whose tokens put together are the whole's: each cut is between a letter and a blank with a letter after it."""
    at = 0
    while len(text) - at > most:
        cut = at + most
        while cut < len(text) - 1 and not (text[cut] == " " and text[cut - 1].isalpha() and text[cut + 1].isalpha()):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def token_ids(text: str | None, path: str) -> np.ndarray:
    encode = _encoder(path)
    return np.array([i for part in slices(text or "") for i in encode(part)] + [END], np.uint32)


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of capacity but the first, which takes the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    fields = pa.schema([("doc_id", batch_type(kind)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in id_texts(batches):
            out = []
            for i, text in zip(ids, texts, strict=True):
                t = token_ids(text, vocabulary).astype("<u4")
                out += [(i, k, s, n, zlib.crc32(t[s : s + n].tobytes())) for k, (s, n) in enumerate(cuts(len(t), capacity))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)], schema=fields)

    return mapped(documents.select("doc_id", "text"), run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def fullest(counts: list[int], capacity: int, longest: int) -> list[tuple[int, int]]:
    """Lengths and how many of each, longest among them, that fill a bin best. counts: left of each length, by length.

    reach is a bitset of the sums so far; each length is offered in powers of two up to what is left of it.
    """
    room = capacity - longest
    full, reach = 1 << room, 1
    steps: list[tuple[int, int, int]] = []  # length, how many at once, sums before
    mask = (full << 1) - 1
    for size in range(min(room, longest), 0, -1):
        left = min(counts[size] - (size == longest), room // size)
        many = 1
        while left > 0:
            many = min(many, left)
            steps.append((size, many, reach))
            reach |= (reach << (size * many)) & mask
            left -= many
            many *= 2
        if reach & full:
            break
    best = reach.bit_length() - 1
    took = {longest: 1}
    for size, many, before in reversed(steps):
        if not before >> best & 1:  # this sum needs the step
            took[size] = took.get(size, 0) + many
            best -= size * many
    return sorted(took.items(), reverse=True)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Combinations, each with how many bins are filled so. Every round uses up a length or all but a few of it."""
    counts = [0] * (capacity + 1)
    for size, n in histogram.items():
        counts[int(size)] = int(n)
    out = []
    for longest in range(capacity, 0, -1):
        while counts[longest]:
            combo = fullest(counts, capacity, longest)
            times = min(counts[size] // n for size, n in combo)
            for size, n in combo:
                counts[size] -= n * times
            out.append((times, combo))
    return out


def _places(histogram: dict[int, int], capacity: int) -> dict[int, tuple[list[int], list[tuple]]]:
    """By length, the ranks at which its places change and what they are: (first rank, pieces a bin, first offset, first bin)."""
    rows: dict[int, list[tuple]] = {}
    used: dict[int, int] = {}
    bins = 0
    for times, combo in plan(histogram, capacity):
        at = 0
        for size, n in combo:
            start = used.get(size, 0)
            rows.setdefault(size, []).append((start, n, at, bins))
            used[size] = start + n * times
            at += size * n
        bins += times
    return {k: ([r[0] for r in v], v) for k, v in rows.items()}


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """parts with sequence_id and offset. parts needs doc_id, piece, start, length, ids_crc32 and must read the same each time."""
    spark = parts.sparkSession
    full, rest = parts.where(F.col("length") == capacity), parts.where(F.col("length") != capacity)
    # a full piece is a sequence; its number, by its place in the table, is below all others
    full = full.withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    buckets = max(LEAST_BUCKETS, -(-rest.count() // BUCKET_ROWS))
    rest = rest.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    held = rest.groupBy("length", "_bucket").agg(F.count("*").alias("n"))
    before = held.select("length", "_bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("n")).alias("before"), "n")
    before = staged(before, "lengths")
    histogram = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(_places(histogram, capacity))  # bounded by the number of lengths, not rows
    own = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = rest.withColumn("_rank", F.row_number().over(own) - 1).join(before.drop("n"), ["length", "_bucket"])
    ranked = ranked.select(*parts.columns, (F.col("_rank") + F.col("before")).alias("_rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seq, off = [], []
            for size, rank in zip(b.column("length").to_pylist(), b.column("_rank").to_pylist(), strict=True):
                starts, table = shared.value[size]
                start, n, at, first = table[bisect_right(starts, rank) - 1]
                seq.append(first + (rank - start) // n)
                off.append(at + (rank - start) % n * size)
            kept = [b.column(c) for c in b.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(seq, pa.int64()), pa.array(off, pa.int64())], names=[*(c for c in b.schema.names if c != "_rank"), "sequence_id", "offset"])

    return mapped(ranked, place, schema).unionByName(full)


def pack_documents(documents: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(staged(pieces(documents, vocabulary or default_vocabulary(), capacity), "pieces"), capacity)
