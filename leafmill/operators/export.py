"""Export records, splits and shards, the atlas and the viewer's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import rules, text
from leafmill.operators.control import numbered


def records(view: DataFrame, kind: str = "hub", class_threshold: float = rules.CLASS_THRESHOLD, keywords: dict[str, list[str]] | None = None, rotate_classes: list[str] | None = None, crops: DataFrame | None = None) -> DataFrame:
    """Rows of the filtered dataset as export records of a kind ("hub" or "store").

    keywords (language code to words) turns on the music rule. With crops (id_detection, png) rows without a crop are
    left out and the crop joins the record; rotated says whether it is to be turned.
    """
    c = F.col
    label = rules.class_label(c("pred_class"), c("classification_conf"), class_threshold)
    t = view.withColumn("_label", label).withColumn("_caption", rules.caption(c("caption_text"), c("_label")))
    valid = lambda x: rules.if_captioned(c("_caption"), x)
    t = t.withColumn("_lang", valid(c("caption_lang_detected"))).withColumn("_passed", valid(F.when(F.coalesce("caption_text", F.lit("")) != "", rules.language_code(c("caption_lang")))))
    shown = c("_label") if keywords is None else rules.music(c("_label"), c("classification_conf"), c("_passed"), c("_caption"), keywords)
    boxed = F.size("bbox_xywh") >= 4
    side = lambda i: F.when(boxed, text.half_even(F.get("bbox_xywh", F.lit(i))))
    thesaurus = valid(rules.thesaurus_json(c("caption_thesaurus_matches")))
    if kind == "store":
        thesaurus = F.from_json(thesaurus, "map<string,map<string,bigint>>")
    t = t.withColumns({"_w": side(2), "_h": side(3)})
    out = [
        c("id_detection").alias("id"), c("barcode").alias("barcode_src"), c("scan_filename").alias("page_filename_src"), c("bbox_xyxy").alias("bbox_xyxy_gen"), c("_w").alias("width_gen"), c("_h").alias("height_gen"),
        rules.megapixels(c("_w"), c("_h")).alias("pixel_count_mpx_gen"), c("bbox_conf").alias("detection_confidence_gen"), shown.alias("classification_gen"),
        c("classification_conf").alias("classification_confidence_gen"), rules.probabilities(c("classification_probs")).alias("classification_probs_gen"), c("image_hash").alias("phash_gen"),
        c("embedding").cast("array<double>").alias("embedding_gen"), c("_caption").alias("caption_exp"), valid(c("caption_linear_prob")).alias("caption_linear_prob_exp"), c("_passed").alias("caption_lang_passed_exp"),
        c("_lang").alias("caption_lang_detected_exp"), thesaurus.alias("caption_chronam_thesauri_matches_exp"), "orientation_correction_gen", "orientation_correction_confidence_gen", "orientation_correction_probs_gen",
    ]
    if crops is None:
        return t.select(*out)
    classes = ["Image/Illustration", "Chart/Graph"] if rotate_classes is None and kind == "hub" else rotate_classes
    t = t.join(crops.where("png is not null"), "id_detection")
    crop = F.struct(c("png").alias("bytes"), F.concat(c("id_detection").cast("string"), F.lit(".png")).alias("path")) if kind == "hub" else c("png")
    return t.select(*out[:1], crop.alias("crop_gen"), *out[1:], rules.rotates(c("_label"), c("orientation_correction_gen"), classes).alias("rotated"))


def missing_crops(view: DataFrame, crops: DataFrame) -> DataFrame:
    """Dead letters: rows whose crop is missing."""
    return view.join(crops.where("png is not null"), "id_detection", "left_anti").select("id_detection", F.col("pipeline_batch_item_id").alias("item_id"), "barcode", "scan_filename")


def with_split(records_: DataFrame) -> DataFrame:
    return records_.withColumn("split", text.slug(F.col("classification_gen")))


def sharded(records_: DataFrame, shard_size: int = 5000, by_split: bool = True) -> DataFrame:
    """records with split, shard (from 0) and file name, by id within a split. Rank within a split is a sum of sizes of
    id ranges and a rank within one, so the largest split is never one task's.
    """
    r = with_split(records_) if by_split else records_.withColumn("split", F.lit("train"))
    if not by_split:
        r = numbered(r, ["id"]).withColumn("shard", F.floor(F.col("ordinal") / shard_size)).drop("ordinal")
    else:
        all_ = numbered(r, ["split", "id"])
        low = all_.groupBy("split").agg(F.min("ordinal").alias("_low"))
        r = all_.join(F.broadcast(low), "split").withColumn("shard", F.floor((F.col("ordinal") - F.col("_low")) / shard_size)).drop("ordinal", "_low")
    n = r.groupBy("split").agg((F.max("shard") + 1).alias("_of"))
    return r.join(F.broadcast(n), "split").withColumn("file", text.shard_name(F.col("split"), F.col("shard"), F.col("_of"))).drop("_of")


def not_exported(records_: DataFrame, done: DataFrame) -> DataFrame:
    """Resuming: rows whose id isn't in what was written."""
    return records_.join(done.select("id"), "id", "left_anti")


def atlas(view: DataFrame, sample: int | None = 10_000, seed: int = 42) -> DataFrame:
    """Rows with an embedding for a map of it: eleven columns, a seeded sample. Zero sides give no size."""
    c = F.col
    w, h = (F.when(F.size("bbox_xywh") >= 4, text.half_even(F.get("bbox_xywh", F.lit(i)))) for i in (2, 3))
    rows = view.where(c("embedding").isNotNull())
    if sample is not None:
        rows = rows.orderBy(F.xxhash64("id_detection", F.lit(seed))).limit(sample)
    return rows.select(
        c("id_detection").alias("id"), "barcode", "scan_filename", c("pred_class").alias("classification"), "classification_conf", c("caption_text").alias("caption"), c("caption_lang_detected").alias("language"),
        w.alias("width"), h.alias("height"), F.nullif(rules.megapixels(w, h), F.lit(0.0)).alias("megapixels"), c("embedding").cast("array<float>").alias("embedding"))


def volume_stats(view: DataFrame) -> DataFrame:
    """Per volume: elements, pages, captions, failed captions, elements to caption, and elements by class."""
    can = ~F.coalesce(F.col("pred_class").isin(*rules.UNCAPTIONED_CLASSES), F.lit(False))
    has = ~text.blank(F.col("caption_text"))
    return view.groupBy("barcode").agg(
        F.count("*").alias("detections"), F.count_distinct("scan_filename").alias("pages"), F.count_if(has).alias("captions"), F.count_if(can).alias("captionable"), F.count_if(can & ~has).alias("failed_captions"))


def viewer_documents(view: DataFrame) -> DataFrame:
    """barcode, json: a volume's pages in first-seen order, and its elements. One volume is one row, as its document is one file."""
    first = view.groupBy("barcode", "scan_filename").agg(F.min("id_detection").alias("seen"))
    pages = first.groupBy("barcode").agg(F.transform(F.sort_array(F.collect_list(F.struct("seen", "scan_filename"))), lambda x: x["scan_filename"]).alias("pages"))
    item = F.struct("id_detection", "scan_filename", "bbox_xyxy", "bbox_conf", "pred_class", "classification_conf", F.col("caption_text").alias("caption"), F.col("caption_lang").alias("lang"), "image_hash")
    rows = view.groupBy("barcode").agg(F.sort_array(F.collect_list(item)).alias("detections"))
    return rows.join(pages, "barcode").select("barcode", F.to_json(F.struct("barcode", "pages", "detections")).alias("json"))


def viewer_index(view: DataFrame) -> DataFrame:
    """barcode, pages, detections, cover (the page seen first): what a reader chooses a document from."""
    return view.groupBy("barcode").agg(F.count_distinct("scan_filename").alias("pages"), F.count("*").alias("detections"), F.min_by("scan_filename", "id_detection").alias("cover"))


VIEWER = "barcode string, pages array<string>, detections array<struct<id_detection:bigint,scan_filename:string,bbox_xyxy:array<double>,bbox_conf:double,pred_class:string,classification_conf:double,caption:string,lang:string,image_hash:string>>"


def viewer_rows(documents: DataFrame, volumes: list[str] | None = None, classes: list[str] | None = None) -> DataFrame:
    """The elements in viewer documents, with page (place from 0) and pages of their volume; of some volumes and classes if named.

    A document that isn't one gives no row.
    """
    d = documents if volumes is None else documents.where(F.col("barcode").isin(*volumes))
    rows = d.select(F.from_json("json", VIEWER).alias("d")).select("d.barcode", "d.pages", F.explode("d.detections").alias("e"))
    rows = rows if classes is None else rows.where(F.col("e.pred_class").isin(*classes))
    return rows.select("barcode", (F.array_position("pages", F.col("e.scan_filename")).cast("int") - 1).alias("page"), F.size("pages").alias("pages"), "e.*")


def viewer_pages(documents: DataFrame) -> DataFrame:
    """barcode, page (place from 0), scan_filename, elements: what a reader leafs through."""
    rows = viewer_rows(documents)
    return rows.groupBy("barcode", "page", "scan_filename").agg(F.count("*").alias("elements"))


def page_details(view: DataFrame) -> DataFrame:
    """Elements with their place on the page (from 1), percent, size, and short forms for a table."""
    place = Window.partitionBy("barcode", "scan_filename").orderBy("id_detection")
    why = F.when(~text.blank(F.col("caption_text")), text.clip(F.col("caption_text"), 80)).when(F.col("pred_class").isin(*rules.UNCAPTIONED_CLASSES), F.lit("(excluded class)")).otherwise(F.lit("(missing)"))
    return view.select(
        "id_detection", "barcode", "scan_filename", F.row_number().over(place).alias("place"), F.format_string("%.1f%%", F.col("bbox_conf") * 100).alias("confidence"),
        F.when(F.size("bbox_xywh") >= 4, F.format_string("%d x %d", F.get("bbox_xywh", F.lit(2)).cast("int"), F.get("bbox_xywh", F.lit(3)).cast("int"))).alias("size"),
        F.left("image_hash", F.lit(12)).alias("hash"), why.alias("caption"))


def class_shares(view: DataFrame) -> DataFrame:
    """barcode, pred_class, n, share of the volume."""
    n = view.groupBy("barcode", "pred_class").agg(F.count("*").alias("n"))
    total = n.groupBy("barcode").agg(F.sum("n").alias("total"))
    return n.join(total, "barcode").select("barcode", "pred_class", "n", (F.col("n") / F.col("total")).alias("share"))


def sample(df: DataFrame, n: int | str, key: str, seed: int = 42) -> DataFrame:
    """n rows by a hash of key, the same rows for a seed; "all" takes all."""
    return df if n == "all" else df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(int(n))


def page_context(detection: DataFrame, pages: DataFrame) -> DataFrame:
    """Elements with the text of their page (file name up to its first dot, .txt), empty if there is none. pages: id_pipeline_batch_item, filename, text."""
    name = F.concat(text.first_part(F.col("scan_filename")), F.lit(".txt"))
    p = pages.select("id_pipeline_batch_item", F.col("filename").alias("_name"), F.col("text").alias("page_text"))
    out = detection.withColumn("_name", name).join(p, ["id_pipeline_batch_item", "_name"], "left")
    return out.withColumn("page_text", F.coalesce("page_text", F.lit(""))).drop("_name")
