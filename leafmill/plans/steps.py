"""Steps of a batch over the relations of a folder: detect, classify, embed, caption, store; and orientation.

Each step reads the batch's items, runs one model stage and commits the rows of those items in place of earlier ones, so a
step that runs again replaces itself. Ids go on from the greatest there is, in the order of what they name; a commit that
another writer came before is worked out anew.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.operators import control, export, views
from leafmill.plans import stages
from leafmill.plans.leases import Leases
from leafmill.sources import archives, schemas, sinks
from leafmill.sources.snapshots import Table
from leafmill.sources.staging import release, staged

#: Tables that follow from a detection, with the name of their id.
DEPENDENT = {"classification": "id_classification", "image_embedding": "id_embedding", "image_hash": "id_imagehash", "caption": "id_caption"}
PROMPT = "Describe this element of a scanned page. Text of the page: "


def table(spark: SparkSession, root: str, name: str) -> Table:
    return Table(spark, f"{root}/{name}", schemas.schema(name))


def leases(spark: SparkSession, root: str, seconds: float = 86_400) -> Leases:
    return Leases(spark, f"{root}/pipeline_batch_leases", seconds)


def load(spark: SparkSession, root: str, *names: str) -> dict[str, DataFrame]:
    """Relations by name, batches as their leases have them."""
    out = {n: table(spark, root, n).read() for n in names or schemas.TABLES}
    if "pipeline_batch" in out:
        out["pipeline_batch"] = leases(spark, root).over(out["pipeline_batch"])
    return out


def loader(name: str) -> Callable:
    """The function "module:name" that makes a model, once a task."""
    module, _, f = name.partition(":")
    if not f:
        raise ValueError(f"{name!r} is not module:function")
    return getattr(importlib.import_module(module), f)


def items_of(spark: SparkSession, root: str, batch: int) -> DataFrame:
    return load(spark, root, "pipeline_batch_item")["pipeline_batch_item"].where(F.col("id_pipeline_batch") == batch)


def replace(spark: SparkSession, root: str, name: str, fresh: DataFrame, items: DataFrame, key: str, order: list[str]) -> None:
    """Commit fresh in place of the rows of items, with new ids."""
    rows = staged(fresh, name)

    def made(old: DataFrame) -> DataFrame:
        kept = old.join(items.select("id_pipeline_batch_item"), "id_pipeline_batch_item", "left_anti")
        top = old.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
        own = control.numbered(rows, order, key).withColumn(key, F.col(key) + top + 1)
        new = sinks.add_columns(own, {f.name: f.dataType.simpleString() for f in old.schema} | {"created": "timestamp"})
        new = new.withColumn("created", F.current_timestamp()) if "created" in old.columns else new
        return kept.unionByName(new.select(*[F.col(f.name).cast(f.dataType) for f in old.schema]))

    table(spark, root, name).change(made)
    release(rows)


def _crops(spark: SparkSession, root: str, items: DataFrame, path: str) -> DataFrame:
    own = load(spark, root, "detection")["detection"].join(items.select("id_pipeline_batch_item"), "id_pipeline_batch_item", "left_semi")
    return staged(stages.cut(own, archives.scans(spark, items, path)), "crops")


def detect(spark: SparkSession, root: str, batch: int, path: str, model: Callable) -> None:
    """Elements of the batch's pages; what followed from earlier ones goes."""
    items = items_of(spark, root, batch)
    found = stages.detect(archives.scans(spark, items, path), model)
    replace(spark, root, "detection", found, items, "id_detection", ["id_pipeline_batch_item", "scan_filename", "bbox_xyxy"])
    for name in DEPENDENT:
        table(spark, root, name).change(lambda old: old.join(items.select("id_pipeline_batch_item"), "id_pipeline_batch_item", "left_anti"))


def classify(spark: SparkSession, root: str, batch: int, path: str, model: Callable) -> None:
    items = items_of(spark, root, batch)
    replace(spark, root, "classification", stages.classify(_crops(spark, root, items, path), model), items, "id_classification", ["id_detection"])


def embed(spark: SparkSession, root: str, batch: int, path: str, model: Callable) -> None:
    """Embeddings and perceptual hashes."""
    items = items_of(spark, root, batch)
    both = staged(stages.embed(_crops(spark, root, items, path), model), "embedded")
    replace(spark, root, "image_embedding", both.drop("image_hash"), items, "id_embedding", ["id_detection"])
    replace(spark, root, "image_hash", both.drop("embedding"), items, "id_imagehash", ["id_detection"])


def caption(spark: SparkSession, root: str, batch: int, path: str, model: Callable, prompt: str = PROMPT) -> None:
    """Captions of the elements of a class that has one, asked for with the text of their page."""
    items = items_of(spark, root, batch)
    t = load(spark, root, "detection", "classification")
    own = control.captionable(t["detection"], t["classification"]).join(items.select("id_pipeline_batch_item"), "id_pipeline_batch_item", "left_semi")
    texts = archives.scans(spark, items, path).where("text is not null").select("id_pipeline_batch_item", "filename", "text")
    prompts = export.page_context(own, texts).select("id_detection", F.concat(F.lit(prompt), "page_text").alias("prompt"))
    replace(spark, root, "caption", stages.caption(_crops(spark, root, items, path), prompts, model), items, "id_caption", ["id_detection"])


def store(spark: SparkSession, root: str, batch: int, path: str, out: str) -> None:
    """An archive of crops for each item: OUT/item/barcode.tar.gz."""
    items = items_of(spark, root, batch)
    crops = _crops(spark, root, items, path).join(items.select("id_pipeline_batch_item", "barcode"), "id_pipeline_batch_item")
    archives.write_archives(crops, out)


def orient(spark: SparkSession, root: str, path: str, model: Callable, force: bool = False, limit: int | None = None) -> None:
    """Orientation of the elements of the view that have none yet, written to their detections. path: archives of pages."""
    t = load(spark, root)
    pending = control.pending_orientation(views.filtered_dataset(t), force).select("id_detection")
    pending = staged(pending if limit is None else pending.orderBy("id_detection").limit(limit), "pending")
    own = t["detection"].join(pending, "id_detection", "left_semi")
    items = t["pipeline_batch_item"].join(own, "id_pipeline_batch_item", "left_semi")
    told = staged(stages.orient(stages.cut(own, archives.scans(spark, items, path)), model).drop("id_pipeline_batch_item"), "orientation")
    new = [c for c in told.columns if c != "id_detection"]

    def made(old: DataFrame) -> DataFrame:
        both = old.join(told.select(F.col("id_detection"), *[F.col(c).alias(f"_{c}") for c in new], F.lit(True).alias("_told")), "id_detection", "left")
        return both.withColumns({c: F.when(F.col("_told"), F.col(f"_{c}")).otherwise(F.col(c)) for c in new}).select(*old.columns)

    table(spark, root, "detection").change(made)
