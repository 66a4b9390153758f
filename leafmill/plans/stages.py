"""Model stages. A model is any object with the method its stage calls; load makes it, once a task."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions import images, rules


class Detector(Protocol):
    def detect(self, image: np.ndarray) -> list[tuple[list[float], float]]: ...  # (xyxy, confidence)


class Classifier(Protocol):
    def probabilities(self, crop: np.ndarray) -> list[float]: ...


class Embedder(Protocol):
    def embed(self, crop: np.ndarray) -> list[float]: ...


class Captioner(Protocol):
    def caption(self, crop: np.ndarray, prompt: str) -> tuple[str, list[dict] | None]: ...


class Orienter(Protocol):
    def probabilities(self, crop: np.ndarray) -> list[float]: ...


def detect(scans: DataFrame, load: Callable[[], Detector], decode: Callable[[bytes], np.ndarray] = images.decode_png) -> DataFrame:
    """id_pipeline_batch_item, scan_filename, bbox_xyxy, bbox_xywh (centre, sides), bbox_conf. A model is loaded once a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            rows = []
            for item, name, data in zip(pdf.id_pipeline_batch_item, pdf.filename, pdf.bytes, strict=True):
                try:
                    image = decode(data)
                except Exception:  # noqa: BLE001  an unreadable page has no element
                    continue
                for (x1, y1, x2, y2), conf in model.detect(image):
                    rows.append((item, name, [x1, y1, x2, y2], [(x1 + x2) / 2, (y1 + y2) / 2, x2 - x1, y2 - y1], conf))
            yield pd.DataFrame(rows, columns=["id_pipeline_batch_item", "scan_filename", "bbox_xyxy", "bbox_xywh", "bbox_conf"])

    return scans.where("bytes is not null").select("id_pipeline_batch_item", "filename", "bytes").mapInPandas(run, "id_pipeline_batch_item long, scan_filename string, bbox_xyxy array<double>, bbox_xywh array<double>, bbox_conf double")


def cut(detection: DataFrame, scans: DataFrame, decode: Callable[[bytes], np.ndarray] = images.decode_png) -> DataFrame:
    """id_detection, id_pipeline_batch_item, scan_filename, png (null where the page is missing or the box is empty)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for box, data in zip(pdf.bbox_xyxy, pdf.bytes, strict=True):
                try:
                    image = decode(data)
                    h, w = image.shape[:2]
                    x1, y1, x2, y2 = (int(max(0, min(round(v), m))) for v, m in zip(box, (w, h, w, h), strict=True))
                    out.append(images.encode_png(images.crop(image, x1, y1, x2, y2)) if x2 > x1 and y2 > y1 else None)
                except Exception:  # noqa: BLE001
                    out.append(None)
            yield pdf[["id_detection", "id_pipeline_batch_item", "scan_filename"]].assign(png=out)

    page = scans.where("bytes is not null").select("id_pipeline_batch_item", F.col("filename").alias("scan_filename"), "bytes")
    rows = detection.join(page, ["id_pipeline_batch_item", "scan_filename"], "left").select("id_detection", "id_pipeline_batch_item", "scan_filename", "bbox_xyxy", "bytes")
    return rows.mapInPandas(run, "id_detection long, id_pipeline_batch_item long, scan_filename string, png binary")


def _over(crops: DataFrame, schema: str, load: Callable, answer: Callable, decode=images.decode_png) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            rows = []
            for *head, png in pdf.itertuples(index=False):
                try:
                    crop = decode(png)
                except Exception:  # noqa: BLE001  an unreadable crop has no answer
                    continue
                rows.append((*head, *answer(model, crop)))
            yield pd.DataFrame(rows, columns=["id_detection", "id_pipeline_batch_item", *names])

    return crops.where("png is not null").select("id_detection", "id_pipeline_batch_item", "png").mapInPandas(run, f"id_detection long, id_pipeline_batch_item long, {schema}")


def classify(crops: DataFrame, load: Callable[[], Classifier]) -> DataFrame:
    """pred_idx, pred_class, pred_conf, probs; an element without probabilities has no row."""
    raw = {v: k for k, v in rules.CLASS_LABELS.items()}

    def answer(model, crop):
        p = model.probabilities(crop)
        k = int(np.argmax(p)) if len(p) else -1
        return k, raw[rules.PROBABILITY_LABELS[k]] if k >= 0 else None, float(p[k]) if k >= 0 else None, list(map(float, p))

    return _over(crops, "pred_idx int, pred_class string, pred_conf double, probs array<double>", load, answer).where("pred_idx >= 0")


def embed(crops: DataFrame, load: Callable[[], Embedder]) -> DataFrame:
    """embedding and perceptual hash of each crop."""
    return _over(crops, "embedding array<float>, image_hash string", load, lambda m, c: (list(map(float, m.embed(c))), images.perceptual_hash(c)))


def orient(crops: DataFrame, load: Callable[[], Orienter], threshold: float = rules.ORIENTATION_THRESHOLD) -> DataFrame:
    """orientation_correction_gen, ..._confidence_gen, ..._probs_gen (JSON of label and probability, likeliest first)."""

    def answer(model, crop):
        return (list(map(float, model.probabilities(crop))),)

    rows = _over(crops, "p array<double>", load, answer)
    return rows.select("id_detection", "id_pipeline_batch_item", rules.orientation(F.col("p"), threshold).alias("orientation_correction_gen"), F.array_max("p").alias("orientation_correction_confidence_gen"), F.to_json(rules.probabilities(F.col("p"), rules.ORIENTATION_LABELS)).alias("orientation_correction_probs_gen"))


def shaped(logs: list[dict] | None) -> list[dict] | None:
    """Log-probabilities as they are kept: token, its UTF-8 bytes, logprob and the likeliest others of each, whatever else a model says."""

    def one(x: dict, top: bool) -> dict:
        token, p = str(x.get("token", "")), x.get("logprob")
        out = {"token": token, "bytes": list(x.get("bytes") or token.encode()), "logprob": float(p) if isinstance(p, (int, float)) and not isinstance(p, bool) else None}
        return out | ({"top_logprobs": [one(t, False) for t in x.get("top_logprobs") or []]} if top else {})

    return None if logs is None else [one(x, True) for x in logs if isinstance(x, dict)]


def caption(crops: DataFrame, prompts: DataFrame, load: Callable[[], Captioner], attempts: int = 3, most_side: int | None = None) -> DataFrame:
    """text and logprobs (JSON) of each crop with a prompt (id_detection, prompt). A call that fails is made again; the last failure
    gives "" and null. Crops are shrunk to most_side first, if one is given.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            rows = []
            for i, item, png, prompt in pdf.itertuples(index=False):
                said, logs = "", None
                for _ in range(attempts):
                    try:
                        crop = images.decode_png(png)
                        said, logs = model.caption(crop if most_side is None else images.shrunk(crop, most_side), prompt)
                        break
                    except Exception:  # noqa: BLE001  the row says that it failed
                        continue
                rows.append((i, item, said.strip(), None if logs is None else json.dumps(shaped(logs), separators=(",", ":"))))
            yield pd.DataFrame(rows, columns=["id_detection", "id_pipeline_batch_item", "text", "logprobs"])

    rows = crops.where("png is not null").join(prompts, "id_detection").select("id_detection", "id_pipeline_batch_item", "png", "prompt")
    return rows.mapInPandas(run, "id_detection long, id_pipeline_batch_item long, text string, logprobs string")


def thumbnails(crops: DataFrame, most: int = 320) -> DataFrame:
    """crops with their PNG shrunk so that neither side is above most; null where there is none or it can't be read."""

    @F.arrow_udf("binary")
    def small(png: pa.Array) -> pa.Array:
        out = []
        for data in png.to_pylist():
            try:
                out.append(images.encode_png(images.shrunk(images.decode_png(data), most)) if data else None)
            except Exception:  # noqa: BLE001
                out.append(None)
        return pa.array(out, pa.binary())

    return crops.withColumn("png", small(F.col("png")))


def turned(records: DataFrame) -> DataFrame:
    """Export records with their crops turned upright where rotated says so; a crop that can't be read stays. rotated goes."""

    @F.arrow_udf("binary")
    def turn(png: pa.Array, correction: pa.Array) -> pa.Array:
        out = []
        for data, how in zip(png.to_pylist(), correction.to_pylist(), strict=True):
            try:
                out.append(images.encode_png(images.rotate(images.decode_png(data), how)) if how else data)
            except Exception:  # noqa: BLE001
                out.append(data)
        return pa.array(out, pa.binary())

    hub = "struct" in dict(records.dtypes)["crop_gen"]
    png = F.col("crop_gen.bytes") if hub else F.col("crop_gen")
    made = turn(png, F.when(F.col("rotated"), F.col("orientation_correction_gen")))
    return records.withColumn("crop_gen", F.struct(made.alias("bytes"), F.col("crop_gen.path").alias("path")) if hub else made).drop("rotated")
