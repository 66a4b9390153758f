"""Row batches in and out of Python, with a bound on the bytes worked on at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Texts are handed on in groups of about so many bytes; a longer text comes alone.
GROUP_BYTES = 4 << 20
#: Spark hands rows to Python in batches of 10,000, or of this setting's bytes, 256 MB if nothing is set; of texts a task has
#: a batch twice in the executor's memory outside the heap, and again in its Python worker.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def mapped(df: DataFrame, run: Callable, schema) -> DataFrame:
    """df.mapInArrow with batches of about BATCH_BYTES; a longer row comes alone. Spark reads the setting when the frame
    is run, so it stays in the session; one that was made there before is kept."""
    conf = df.sparkSession.conf
    if conf.get(BATCH, None) is None:
        conf.set(BATCH, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def grouped(rows: list, size: Callable, most: int = GROUP_BYTES) -> Iterator[list]:
    out, held = [], 0
    for r in rows:
        n = size(r)
        if out and held + n > most:
            yield out
            out, held = [], 0
        out.append(r)
        held += n
    if out:
        yield out


def id_texts(batches: Iterator[pa.RecordBatch], most: int = GROUP_BYTES) -> Iterator[tuple[list, list]]:
    """Ids and texts (None stays None) of bounded groups of rows, in order."""
    for b in batches:
        rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        for part in grouped(list(rows), lambda r: len(r[1] or "") + 64, most):
            yield [r[0] for r in part], [r[1] for r in part]
