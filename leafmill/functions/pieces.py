"""Parts of an Arrow batch, so that what Python holds of it at once is bounded by bytes and not by rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of the texts that are worked on at once; a longer text comes alone.
MOST_BYTES = 1 << 20


def ranges(texts: pa.Array, most: int = MOST_BYTES) -> Iterator[tuple[int, int]]:
    """Start and number of rows of each part, in order."""
    start, held = 0, 0
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), np.int64) + 64
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > most:
            yield start, i - start
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield start, len(sizes) - start


def lists(texts: pa.Array, most: int = MOST_BYTES) -> Iterator[list[str | None]]:
    for at, n in ranges(texts, most):
        yield texts.slice(at, n).to_pylist()
