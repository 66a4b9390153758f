"""What a reader of a run looks at: volumes with their header, pages, groups by size, short forms of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import text
from leafmill.operators.control import numbered

#: Metadata that a volume's header leaves out.
HIDDEN = ["text_by_page_gen", "text_by_page_src", "embedding", "raw"]


def batch_volumes(items: DataFrame, volume: DataFrame, batch: int | None = None) -> DataFrame:
    """Items of a batch, or of all, with their volumes, in order of the item."""
    rows = items if batch is None else items.where(F.col("id_pipeline_batch") == batch)
    return rows.join(volume, "barcode").orderBy("id_pipeline_batch", "id_pipeline_batch_item", "barcode")


def run_batches(batch: DataFrame, run: int) -> DataFrame:
    """Batches of a run in order."""
    return batch.where(F.col("id_pipeline_run") == run).orderBy("id_pipeline_batch")


def of_volume(view: DataFrame, barcode: str) -> DataFrame:
    """The elements of one volume; the filter reaches the scan."""
    return view.where(F.col("barcode") == barcode)


def workers(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    """rows with worker, dealt in turn in order."""
    return numbered(rows, order).withColumn("worker", F.pmod("ordinal", F.lit(n)).cast("int")).drop("ordinal")


def groups_by_size(groups: DataFrame, least: int = 2) -> DataFrame:
    """group_id, n: groups of so many members or more, the largest first."""
    return groups.groupBy("group_id").agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "group_id")


def with_vectors(groups: DataFrame, embedding: DataFrame) -> DataFrame:
    """Members of duplicate groups with their vectors, which the groups' table doesn't repeat."""
    return groups.select("embedding_id", "group_id", "id_detection").join(embedding.select("id_detection", "embedding"), "id_detection")


def scaled(box: Column, factor: Column | float) -> Column:
    """A box on a picture of another size."""
    return F.transform(box, lambda v: v * factor)


def thumbnail_factor(width: Column, height: Column, most: int) -> Column:
    """By how much a picture shrinks so that neither side is above most; never above 1."""
    return F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(width, height))


def vector_preview(vector: Column, n: int = 5) -> Column:
    """Struct of the first numbers and how many there are."""
    return F.struct(F.slice(vector, 1, n).alias("first"), F.size(vector).alias("dimensions"))


def pages(view: DataFrame) -> DataFrame:
    """barcode, scan_filename, place (of the page in the volume, in first-seen order, from 1), elements."""
    seen = view.groupBy("barcode", "scan_filename").agg(F.min("id_detection").alias("_seen"), F.count("*").alias("elements"))
    order = seen.groupBy("barcode").agg(F.sort_array(F.collect_list("_seen")).alias("_all"))
    place = F.array_position(F.col("_all"), F.col("_seen")).cast("int")
    return seen.join(order, "barcode").select("barcode", "scan_filename", place.alias("place"), "elements")


def pages_with_elements(scans: DataFrame, detection: DataFrame) -> DataFrame:
    """Pages that hold an element. scans: id_pipeline_batch_item, filename."""
    on = (F.col("s.id_pipeline_batch_item") == F.col("d.id_pipeline_batch_item")) & (F.col("s.filename") == F.col("d.scan_filename"))
    return scans.alias("s").join(detection.alias("d"), on, "left_semi")


def header(view: DataFrame, volume: DataFrame, most: int = 200, hidden: list[str] = HIDDEN) -> DataFrame:
    """barcode, classes (label, n, share; the largest first), metadata (without the hidden ones, cut to most characters).

    A volume that isn't known, or whose metadata isn't JSON, has an empty header.
    """
    n = view.groupBy("barcode", F.coalesce("pred_class", F.lit("")).alias("label")).agg(F.count("*").alias("n"))
    entry = F.struct((-F.col("n")).alias("by"), "label", "n")
    by = n.groupBy("barcode").agg(F.sort_array(F.collect_list(entry)).alias("c"), F.sum("n").alias("total"))
    classes = F.transform("c", lambda c: F.struct(c["label"].alias("label"), c["n"].alias("n"), (c["n"] / F.col("total")).alias("share")))
    known = volume.select("barcode", F.from_json("metadata", "map<string,string>").alias("m"))
    shown = F.map_filter("m", lambda k, v: ~k.isin(*hidden) & v.isNotNull() & (v != ""))
    cut = F.transform_values(shown, lambda k, v: text.clip(v, most))
    return by.join(known, "barcode", "left").select("barcode", classes.alias("classes"), F.coalesce(cut, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("metadata"))


def wrapped(words: Column, width: int = 100) -> Column:
    """Lines of at most so many characters, broken between words; a longer word has a line of its own."""
    ws = F.filter(F.split(F.coalesce(words, F.lit("")), r"\s+"), lambda w: w != "")

    def step(s: Column, w: Column) -> Column:
        fits = F.length(s["line"]) + 1 + F.length(w) <= width
        first = s["line"] == ""
        line = F.when(first, w).when(fits, F.concat(s["line"], F.lit(" "), w)).otherwise(w)
        done = F.when(first | fits, s["done"]).otherwise(F.concat(s["done"], F.array(s["line"])))
        return F.struct(done.alias("done"), line.alias("line"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("line"))
    return F.aggregate(ws, start, step, lambda s: F.when(s["line"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["line"]))))


def thousands(n: Column) -> Column:
    """A whole number with a comma between groups of three digits."""
    return F.format_number(n, 0)


def rate(rows: int, seconds: float) -> dict[str, float]:
    """Counters of an export: rows, seconds and rows a second."""
    return {"rows": rows, "seconds": round(seconds, 3), "rows_per_second": round(rows / seconds, 3) if seconds > 0 else 0.0}
