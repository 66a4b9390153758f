"""Terms of a thesaurus in texts: one automaton over all of them, read once along each text.

A match is a term between word borders: a border is where a word character (letter, digit or underscore, of any script)
meets another one or the end of the text. Of overlapping matches the first counts, of those that start together the
longest. Texts and terms are compared in lower case.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import pieces

#: Characters of terms in one automaton, which takes some 60 bytes for each. A larger thesaurus has several, and a task holds one.
CHARACTERS = 4_000_000
#: Bytes of a thesaurus that are sent to the tasks at most; beyond it is no dictionary.
MOST_BYTES = 1 << 28

FOUND = "map<string,map<string,bigint>>"
_FOUND = pa.map_(pa.string(), pa.map_(pa.string(), pa.int64()))


def word(c: str) -> bool:
    return c.isalnum() or c == "_"


class Automaton:
    def __init__(self, terms: Iterable[tuple[str, str]]):
        import ahocorasick

        self.a = ahocorasick.Automaton()
        for term, category in terms:
            self.a.add_word(term, (term, category))
        self.empty = len(self.a) == 0
        self.a.make_automaton()

    def hits(self, low: str) -> Iterator[tuple[int, int, str, str]]:
        """start, -length, term, category of all matches between borders."""
        if self.empty or not low:
            return
        for last, (term, category) in self.a.iter(low):
            start = last + 1 - len(term)
            if word(low[last]) != (last + 1 < len(low) and word(low[last + 1])) and word(low[start]) != (start > 0 and word(low[start - 1])):
                yield start, -len(term), term, category


def settled(hits: Iterable[tuple[int, int, str, str]]) -> dict[str, dict[str, int]]:
    """category -> term -> count of the matches that don't overlap an earlier or longer one."""
    out: dict[str, dict[str, int]] = {}
    end = 0
    for start, length, term, category in sorted(hits):
        if start >= end:
            end = start - length
            own = out.setdefault(category, {})
            own[term] = own.get(term, 0) + 1
    return {c: dict(sorted(own.items())) for c, own in sorted(out.items())}


def shards(terms: dict[str, str], characters: int = CHARACTERS) -> list[list[tuple[str, str]]]:
    """Terms in runs of so many characters; at least one run."""
    out, held = [[]], 0
    for t, c in sorted(terms.items()):
        if held and held + len(t) > characters:
            out.append([])
            held = 0
        out[-1].append((t, c))
        held += len(t)
    return out


def terms_of(thesaurus: DataFrame, most_bytes: int = MOST_BYTES) -> dict[str, str]:
    """Term in lower case -> category, from category, keyword, related_terms. A term of several categories takes the last by name."""
    rows = thesaurus.select(F.coalesce("category", F.lit("unknown")).alias("category"), F.explode(F.concat(F.array("keyword"), F.coalesce("related_terms", F.array().cast("array<string>")))).alias("t"))
    rows = rows.where(F.coalesce("t", F.lit("")) != "").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t") + F.octet_length("category")), F.lit(0))).first()[0]
    if size > most_bytes:
        raise ValueError(f"a thesaurus of {size} bytes is no dictionary (at most {most_bytes})")
    out: dict[str, str] = {}
    for r in rows.collect():
        out[r.t.lower()] = max(out.get(r.t.lower(), ""), r.category)
    return out


_held: tuple[tuple[str, int], Automaton] | None = None


def _automaton(shard: Broadcast, key: tuple[str, int]) -> Automaton:
    """The one automaton that this worker holds."""
    global _held
    if _held is None or _held[0] != key:
        _held = None
        _held = key, Automaton(shard.value)
    return _held[1]


def matches(text: Column, thesaurus: DataFrame, characters: int = CHARACTERS) -> Column:
    """Map of category to map of term to count; null for a text without a match."""
    import uuid

    context, name = thesaurus.sparkSession.sparkContext, uuid.uuid4().hex
    sent = [context.broadcast(s) for s in shards(terms_of(thesaurus), characters)]

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            if len(sent) == 1:  # a text is settled as soon as it is read
                a = _automaton(sent[0], (name, 0))
                told = [settled(a.hits((x or "").lower())) for part in pieces.lists(b) for x in part]
            else:  # one automaton after the other over the batch, each hit held in three words
                hits = [(array("q"), [], []) for _ in range(len(b))]
                for i, shard in enumerate(sent):
                    a, own = _automaton(shard, (name, i)), iter(hits)
                    for x in (x for part in pieces.lists(b) for x in part):
                        starts, terms, categories = next(own)
                        for start, _, term, category in a.hits((x or "").lower()):
                            starts.append(start)
                            terms.append(term)
                            categories.append(category)
                told = [settled((s, -len(t), t, c) for s, t, c in zip(*h, strict=True)) for h in hits]
            yield pa.array([[(c, list(own.items())) for c, own in m.items()] if m else None for m in told], _FOUND)

    # a filter on the column would otherwise be pushed below it, and every text be read twice
    return found.asNondeterministic()(text)
