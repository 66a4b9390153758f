"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one holds ordinary text, the other the same ground and, in the place nearest
to what is compressed, what marks toxic text. A document is cut into windows of whole words. Each is compressed with
either dictionary; a window that the toxic dictionary shortens more is suspicious. How much it must be shortened is
calibrated by a logistic fit over the strongest windows of held-back training documents.

Training uses at most SAMPLE documents of either label, of at most SAMPLE_CHARS characters each (a documented bound;
ids by hash, so the same rows at any cluster size). Scoring reads every text whole.

Cases: null and empty texts have no window and get the score of no evidence; labels that are null don't train; with
one label absent every score is the prior; repeated rows are each scored; very long texts go window by window; an
empty table gives an empty result; extra columns are ignored, and labels, lang, source and id never reach a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.arrow import id_texts
from leafmill.llm.common import fold
from leafmill.llm.language_id import batch_type

SAMPLE, SAMPLE_CHARS = 4000, 16384
WINDOW = 48
#: A term marks toxic text when it stands in so many and in so large a share of its texts, and its log odds are so high. Few pure marks do better than many.
GROUND_BYTES, MARK_BYTES, LEAST_TEXTS, LEAST_SHARE, LEAST_ODDS = 100_000, 768, 4, 0.01, 3.0
#: Ends either dictionary and starts each window, so that each is stored as matches and a short one counts too.
PRIMER = b"\n=|primer|of|windows|=\n"
PRIOR = 0.3

_WINDOW = re.compile(rb"(?s).{1,%d}\S*" % WINDOW)
_TERM = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]{4,32}")


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    how = zstd.ZstdCompressionParameters(window_log=17, hash_log=17, chain_log=16, search_log=6, min_match=4, target_length=64, strategy=zstd.STRATEGY_LAZY, write_checksum=False, write_content_size=False, write_dict_id=False)
    words = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(compression_params=how)
    return zstd.ZstdCompressor(dict_data=words, compression_params=how)


def _fill(terms: list[bytes], size: int) -> bytes:
    """The first of terms that fit, best last (nearest), padded to size in front."""
    took, held = [], 0
    for t in terms:
        if held + len(t) + 1 > size:
            break
        took.append(t)
        held += len(t) + 1
    return (b" ".join(reversed(took)) + b" ").rjust(size)


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Contents for ordinary and for toxic text, from the number of distinct texts that hold a term."""
    toxic, ordinary = sorted(set(toxic)), sorted(set(ordinary))  # copies, equal from end to end, would make their own words look telling
    a, b = Counter(), Counter()
    for texts, n in ((toxic, a), (ordinary, b)):
        for t in texts:
            n.update(set(_TERM.findall(t)))
    odds = {t: math.log((n + 0.5) / len(toxic)) - math.log((b.get(t, 0) + 0.5) / max(1, len(ordinary))) for t, n in a.items()}
    ranked = sorted((t for t, n in a.items() if n >= max(LEAST_TEXTS, LEAST_SHARE * len(toxic)) and odds[t] > LEAST_ODDS), key=lambda t: (-odds[t] * math.sqrt(a[t]), t))
    marks, stems = [], Counter()
    for t in ranked:  # a few terms of one stem cover the stem
        if stems[t[:5]] < 3:
            stems[t[:5]] += 1
            marks.append(t)
    common = sorted((t for t in b if odds.get(t, 0) <= 0.7), key=lambda t: (-b[t], t))
    ground = _fill(common, GROUND_BYTES)
    held = len(ground.split())
    return ground + _fill(common[held:], MARK_BYTES) + PRIMER, ground + _fill(marks, MARK_BYTES) + PRIMER


class Scorer:
    def __init__(self, ordinary: bytes, toxic: bytes, weights: np.ndarray | None = None):
        self.ordinary, self.toxic, self.weights = _compressor(ordinary), _compressor(toxic), weights

    def features(self, text: str | None) -> np.ndarray:
        """1, the best, the three best, the gains above noise, and the log of the number of windows."""
        parts = [PRIMER + w for w in _WINDOW.findall((text or "").encode("utf-8", "surrogatepass"))]
        if not parts:
            return np.array([1.0, 0, 0, 0, 0])
        a, b = self.ordinary.compress, self.toxic.compress
        gain = np.fromiter((len(a(w)) - len(b(w)) for w in parts), np.int32, len(parts))
        top = np.sort(gain)[::-1]
        return np.array([1.0, top[0], top[:3].clip(0).sum(), math.log1p(np.clip(gain - 4, 0, 8).sum()), math.log(len(parts))])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights, -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton's steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        pull = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + pull, x.T @ (weight * (y - p)) - pull @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(toxic: list[str], ordinary: list[str], prior: float = PRIOR) -> tuple[bytes, bytes, np.ndarray]:
    """Dictionaries from two thirds of the documents, thresholds from the rest."""
    flat = np.array([math.log(prior / (1 - prior)), 0, 0, 0, 0])
    if not toxic or not ordinary:
        return PRIMER, PRIMER, flat
    rest = lambda a: [t for i, t in enumerate(a) if i % 3]
    held = lambda a: a[::3]
    o, t = dictionaries([x.encode() for x in rest(toxic)], [x.encode() for x in rest(ordinary)])
    s = Scorer(o, t)
    x = np.array([s.features(d) for d in held(toxic) + held(ordinary)])
    n1, n0 = len(held(toxic)), len(held(ordinary))
    y = np.array([1.0] * n1 + [0.0] * n0)
    return o, t, logistic(x, y, np.where(y == 1, prior / n1, (1 - prior) / n0) * (n1 + n0))


def training_texts(documents: DataFrame, labels: DataFrame, label: int, folds: int, held: int) -> list[str]:
    """Texts with a label, at most SAMPLE, in the order of a hash of their ids."""
    ids = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where((F.col("toxic") == label) & (fold("doc_id", folds) != held))
    ids = ids.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    drawn = documents.where(fold("doc_id", folds) != held).where(F.length("text").between(1, SAMPLE_CHARS)).join(F.broadcast(ids), "doc_id")
    drawn = drawn.groupBy("doc_id").agg(F.max("text").alias("text")).select(F.xxhash64("doc_id").alias("h"), F.col("doc_id").cast("string").alias("i"), "text")
    return [r["text"] for r in sorted(drawn.collect(), key=lambda r: (r["h"], r["i"]))]


def classify(documents: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = fit(*(training_texts(documents, labels, k, folds, held) for k in (1, 0)))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(*shared.value)
        for ids, texts in id_texts(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "score": [s.score(t) for t in texts]}, pa.schema([("doc_id", batch_type(kind)), ("score", pa.float64())]))

    out = documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
