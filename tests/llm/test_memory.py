"""What Python, and the memory outside the heap, hold at once of a table of texts."""

import tracemalloc

import numpy as np
import pyarrow as pa

from leafmill.llm import decontamination, language_id, ngram_join, packing
from leafmill.llm.arrow import BATCH, BATCH_BYTES, mapped


def test_batches_are_bounded_by_bytes(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('abcd ', 1600) AS text").coalesce(1)  # 24 MB in one task

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [b.nbytes], "n": [b.num_rows]})

    got = mapped(docs, sizes, "bytes long, n long").collect()
    assert sum(r["n"] for r in got) == 3000 and max(r["bytes"] for r in got) < 1.1 * BATCH_BYTES


def test_operators_bound_their_batches_and_keep_a_setting(spark):
    docs = spark.createDataFrame([(1, "one two three", "en")], "doc_id long, text string, lang string")
    items = spark.createDataFrame([(1, "something else entirely")], "item_id long, text string")
    runs = [
        lambda: decontamination.clean(docs, items), lambda: decontamination.leaks(docs, items), lambda: language_id.annotate(docs, ["en"], np.ones((1, language_id.DIMENSIONS))),
        lambda: language_id.train(docs), lambda: ngram_join.similar(docs), lambda: packing.pieces(docs, packing.default_vocabulary()),
    ]
    before = spark.conf.get(BATCH, None)
    try:
        for run in runs:
            spark.conf.unset(BATCH)
            run()
            assert spark.conf.get(BATCH) == str(BATCH_BYTES)
        spark.conf.set(BATCH, "12345")
        decontamination.clean(docs, items)
        assert spark.conf.get(BATCH) == "12345"
    finally:
        spark.conf.unset(BATCH)
        if before is not None:
            spark.conf.set(BATCH, before)


def test_shingles_of_a_batch_are_made_part_by_part():
    rng = np.random.default_rng(1)
    texts = [None, b"", b"a b", *(b" ".join(b"w%d" % x for x in rng.integers(0, 9999, 700)) for _ in range(3000))]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.binary())})
    got = [(i, s) for ids, sets in ngram_join._batches(iter([batch])) for i, s in zip(ids, sets, strict=True)]
    assert [i for i, _ in got] == list(range(len(texts)))
    assert all(np.array_equal(s, ngram_join.shingles([t or b""])[0]) for (_, s), t in zip(got[::50], texts[::50], strict=True))
    tracemalloc.start()
    for _ in ngram_join._batches(iter([batch])):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 24 << 20  # 53 MB on a megabyte of texts at once
