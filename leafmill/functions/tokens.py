"""Token counts by a public tokenizer's vocabulary file."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions import pieces

#: The vocabulary that serves where none is named.
DEFAULT = "byte_bpe_50k.json"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


@lru_cache(4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def counted(texts: list[str], path: str) -> list[int]:
    """Tokens of each text, no special ones added. path: a tokenizer's JSON file, which every worker can read."""
    return [len(e.ids) for e in _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def token_count(column: Column, path: str | None = None, encode: Callable[[list[str]], list[int]] | None = None) -> Column:
    """Tokens of a text, null for no text. A worker loads the vocabulary once and encodes about a megabyte at a time: what the
    tokenizer holds for a text is some thirty times the text."""
    at = (path or default_path()) if encode is None else ""

    @F.arrow_udf("long")
    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array([n for part in pieces.lists(texts) for n in (encode or (lambda t: counted(t, at)))(part)], pa.int64())

    return F.when(F.coalesce(column, F.lit("")) != "", count(F.coalesce(column, F.lit("")))).cast("long")
