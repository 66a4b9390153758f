"""The statistics suite: each function is one aggregate query over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import rules, text
from leafmill.functions.tokens import token_count
from leafmill.operators.control import numbered
from leafmill.operators.quantiles import quantiles
from leafmill.sources.staging import staged


def summary(x: Column, prefix: str = "", total: bool = False) -> list[Column]:
    """count, mean, (room for the) median, min, max, population deviation; nulls don't count."""
    out = [F.count(x).alias(f"{prefix}count"), F.avg(x).alias(f"{prefix}mean"), F.lit(None).cast("double").alias(f"{prefix}median"), F.min(x).alias(f"{prefix}min"), F.max(x).alias(f"{prefix}max"), F.stddev_pop(x).alias(f"{prefix}std")]
    return out + ([F.sum(x).alias(f"{prefix}total")] if total else [])


def with_quantiles(row: DataFrame, df: DataFrame, asked: dict[str, tuple[Column, float]]) -> DataFrame:
    """The one-row frame with its columns of these names filled with exact quantiles of df, which are found first, by histograms."""
    found = quantiles(df, asked)
    return row.select(*[F.lit(found[c]).cast("double").alias(c) if c in found else F.col(c) for c in row.columns])


def summaries(df: DataFrame, columns: dict[str, Column], *more: Column, total: tuple[str, ...] = ()) -> DataFrame:
    """summary() of each column by its prefix, in one row, medians included."""
    row = df.agg(*[a for p, x in columns.items() for a in summary(x, p, p in total)], *more)
    return with_quantiles(row, df, {f"{p}median": (x, 0.5) for p, x in columns.items()})


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in sorted(tables.items())])


def class_distribution(classification: DataFrame) -> DataFrame:
    label = rules.lookup(rules.CLASS_LABELS, F.col("pred_class"), F.concat(F.lit("unknown_"), F.col("pred_class")))
    return classification.groupBy(label.alias("label")).agg(F.count("*").alias("n"))


def confidence(df: DataFrame, column: str) -> DataFrame:
    return summaries(df, {"": F.col(column)})


def crop_dimensions(detection: DataFrame) -> DataFrame:
    box = detection.where(F.size("bbox_xywh") == 4).select(F.col("bbox_xywh")[2].alias("w"), F.col("bbox_xywh")[3].alias("h"))
    return summaries(box, {"width_": F.col("w"), "height_": F.col("h"), "area_": F.col("w") * F.col("h")})


def captions(caption: DataFrame, tokens: Column | None = None) -> DataFrame:
    """Lengths in characters, words and (if given) tokens of captions with text, and tokens per word."""
    t = caption.where(F.coalesce("text", F.lit("")) != "")
    cols = [F.length("text").alias("chars"), text.words(F.col("text")).alias("words")] + ([tokens.alias("tokens")] if tokens is not None else [])
    t = t.select(*cols)
    lengths = {"chars_": F.col("chars"), "words_": F.col("words")}
    if tokens is None:
        return summaries(t, lengths)
    t = staged(t, "lengths")  # tokens are dear, and looked at more than once
    per_word = F.avg(F.when(F.col("words") > 0, F.col("tokens") / F.col("words"))).alias("tokens_per_word")
    return summaries(t, lengths | {"tokens_": F.col("tokens")}, per_word, total=("tokens_",))


def languages(df: DataFrame, column: str = "lang") -> DataFrame:
    """Rows by language; nothing and the empty name don't count."""
    return df.where(F.coalesce(column, F.lit("")) != "").groupBy(F.col(column).alias("language")).agg(F.count("*").alias("n"))


def group_sizes(deduped: DataFrame) -> DataFrame:
    return deduped.groupBy("group_id").agg(F.count("*").alias("size"))


def dedupe(deduped: DataFrame) -> DataFrame:
    n = F.col("size")
    return group_sizes(deduped).agg(
        F.count("*").alias("total_groups"), F.coalesce(F.sum(n), F.lit(0)).alias("total_items"), F.count_if(n == 1).alias("singleton_groups"), F.count_if(n > 1).alias("duplicate_groups"),
        F.coalesce(F.max(n), F.lit(0)).alias("largest_group"), F.avg(n).alias("avg_group_size"), F.median(n).alias("median_group_size"), (100 * (1 - F.count("*") / F.sum(n))).alias("reduction_percent"))


def size_histogram(deduped: DataFrame, most: int | None = None) -> DataFrame:
    rows = group_sizes(deduped)
    return (rows if most is None else rows.where(F.col("size") <= most)).groupBy("size").agg(F.count("*").alias("n"))


def batches(batch: DataFrame) -> DataFrame:
    """Lifecycle counts; crashed among the completed, and among all."""
    started, ended = F.col("started_date").isNotNull(), F.col("ended_date").isNotNull()
    done = F.count_if(started & ended)
    crashed = F.count_if(started & ended & F.col("has_crashed"))
    return batch.agg(
        F.count("*").alias("total"), done.alias("completed"), F.count_if(started & ~ended).alias("in_progress"), F.count_if(~started).alias("pending"),
        crashed.alias("crashed"), F.count_if(F.col("has_crashed")).alias("crashed_all"), ((done - crashed) / F.nullif(done, F.lit(0))).alias("success_rate"))


def processing_minutes(batch: DataFrame) -> DataFrame:
    m = text.minutes(F.col("started_date"), F.col("ended_date"))
    return summaries(batch, {"": F.when(m > 0, m)})


def batches_by_node(batch: DataFrame) -> DataFrame:
    done = batch.where("started_date is not null and ended_date is not null")
    return done.where(F.coalesce("node_name", F.lit("")) != "").groupBy("node_name").agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: Column, k: int, name: str = "value") -> DataFrame:
    """The k most frequent values, ties by value."""
    counted = df.select(column.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(name)).limit(k)


def topics(volume: DataFrame, k: int = 50) -> DataFrame:
    return top_values(volume, text.metadata(F.col("metadata"), "topic_or_subject_gen"), k, "topic")


def topic_counts(volume: DataFrame) -> DataFrame:
    """Different topics, and volumes that have one."""
    n = volume.select(text.metadata(F.col("metadata"), "topic_or_subject_gen").alias("topic")).where("topic is not null").groupBy("topic").agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("topics"), F.coalesce(F.sum("n"), F.lit(0)).alias("volumes"))


def years(volume: DataFrame) -> DataFrame:
    """Volumes with a year, first and last year, the median over distinct years and, for weight, over volumes."""
    y = volume.select(text.year(text.metadata(F.col("metadata"), "date1_src")).alias("y")).where("y is not null")
    return y.groupBy("y").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("volumes_with_date"), F.min("y").alias("first_year"), F.max("y").alias("last_year"), F.median("y").cast("int").alias("median_year"))


def year_distribution(volume: DataFrame) -> DataFrame:
    y = volume.select(text.year(text.metadata(F.col("metadata"), "date1_src")).alias("year")).where("year is not null")
    return y.groupBy("year").agg(F.count("*").alias("n"))


def volume_languages(volume: DataFrame) -> DataFrame:
    return languages(volume.select(text.metadata(F.col("metadata"), "language_src").alias("lang")))


def detections_per_item(items: DataFrame, detection: DataFrame, mode: str = "sum") -> DataFrame:
    """barcode, n with zeros. mode "sum" adds a volume's items up; "last_item" keeps the one with the greatest id."""
    n = detection.groupBy("id_pipeline_batch_item").agg(F.count("*").alias("n"))
    each = items.join(n, "id_pipeline_batch_item", "left").select("barcode", "id_pipeline_batch_item", F.coalesce("n", F.lit(0)).alias("n"))
    return each.groupBy("barcode").agg((F.sum("n") if mode == "sum" else F.max_by("n", "id_pipeline_batch_item")).alias("n"))


PERCENTILES = (0.25, 0.5, 0.75, 0.9, 0.99)


def detections_per_volume(items: DataFrame, detection: DataFrame, mode: str = "sum") -> DataFrame:
    n = F.col("n")
    each = detections_per_item(items, detection, mode)
    row = each.agg(
        F.count("*").alias("volumes_processed"), F.coalesce(F.sum(n), F.lit(0)).alias("total_detections"), *summary(n)[1:], F.count_if(n == 0).alias("volumes_with_zero"),
        F.count_if(n > 100).alias("volumes_with_over_100"), *[F.lit(None).cast("double").alias(f"p{round(100 * q)}") for q in PERCENTILES])
    return with_quantiles(row, each, {"median": (n, 0.5)} | {f"p{round(100 * q)}": (n, q) for q in PERCENTILES})


def tokens(counts: DataFrame, column: str = "n") -> DataFrame:
    """Corpus token statistics: sample deviation (0 below two), linear percentiles; null counts are empty documents."""
    n = F.col(column)
    p = lambda q: F.percentile(n, F.lit(q))
    return counts.agg(
        F.count("*").alias("total_docs"), F.count_if(n.isNull()).alias("empty_docs"), F.coalesce(F.sum(n), F.lit(0)).alias("total_tokens"), F.avg(n).alias("mean"), F.median(n).alias("median"),
        F.coalesce(F.stddev_samp(n), F.lit(0.0)).alias("stdev"), F.min(n).alias("min"), F.max(n).alias("max"), p(0.05).alias("p5"), p(0.25).alias("p25"), p(0.75).alias("p75"), p(0.95).alias("p95"), p(0.99).alias("p99"))


def histogram(df: DataFrame, x: Column, bins: int = 50) -> DataFrame:
    """bin (1 to bins), n over the data's range, the last bin closed. Bounds are one row, found first."""
    v = df.select(x.cast("double").alias("x")).where("x is not null")
    lo, hi = v.agg(F.min("x"), F.max("x")).first()
    if lo is None:
        return v.select(F.lit(1).cast("long").alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    spot = F.least(F.width_bucket(F.col("x"), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)) if hi > lo else F.lit(1)
    return v.groupBy(spot.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def failures(detection: DataFrame, classification: DataFrame, caption: DataFrame) -> DataFrame:
    """Elements without classification, and those that should have a caption and have none."""
    c = classification.groupBy("id_detection").agg(F.max_by("pred_class", "id_classification").alias("pred_class"))
    t = caption.groupBy("id_detection").agg(F.max_by("text", "id_caption").alias("text"))
    rows = detection.select("id_detection").join(c, "id_detection", "left").join(t, "id_detection", "left")
    return rows.agg(F.count("*").alias("detections"), F.count_if(F.col("pred_class").isNull()).alias("failed_classifications"), F.count_if(~F.coalesce(F.col("pred_class").isin(*rules.UNCAPTIONED_CLASSES), F.lit(False)) & text.blank(F.col("text"))).alias("failed_captions"))


#: Keys of a range of running sums.
SPAN = 1024


def cumulative(df: DataFrame, key: str) -> DataFrame:
    """key, n, running: rows so far in order of key. Ranges of keys are summed apart and offset by the sums before them."""
    n = numbered(df.groupBy(key).agg(F.count("*").alias("n")), [key])
    span = F.floor(F.col("ordinal") / SPAN)
    parts = n.groupBy(span.alias("_span")).agg(F.sum("n").alias("_n"))
    higher = parts.groupBy(F.floor(F.col("_span") / SPAN).alias("_high")).agg(F.sum("_n").alias("_n"))
    # sums of sums: the one window without a partition has a row for 2^20 keys
    high = higher.select("_high", (F.sum("_n").over(Window.orderBy("_high")) - F.col("_n")).alias("_h"))
    low = parts.select("_span", F.floor(F.col("_span") / SPAN).alias("_high"), (F.sum("_n").over(Window.partitionBy(F.floor(F.col("_span") / SPAN)).orderBy("_span")) - F.col("_n")).alias("_l"))
    before = low.join(high, "_high").select("_span", (F.col("_l") + F.col("_h")).alias("_before"))
    own = F.sum("n").over(Window.partitionBy("_span").orderBy(key))
    return n.withColumn("_span", span).join(before, "_span").select(key, "n", (F.col("_before") + own).alias("running"))


def all_statistics(tables: dict[str, DataFrame], skip_slow: bool = False, vocabulary: str | None = None) -> DataFrame:
    """One row of JSON a block: every block above, each computed once. With a tokenizer's vocabulary captions are counted in tokens too."""
    t = tables
    counted = None if vocabulary is None else token_count(F.col("text"), vocabulary)
    one = {
        "detection_confidence": confidence(t["detection"], "bbox_conf"), "classification_confidence": confidence(t["classification"], "pred_conf"), "crop_dimensions": crop_dimensions(t["detection"]),
        "captions": captions(t["caption"], counted), "hash_based": dedupe(t["deduped_hash"]), "embedding_based": dedupe(t["deduped_embedding"]), "batches": batches(t["pipeline_batch"]),
        "processing_time_minutes": processing_minutes(t["pipeline_batch"]), "publication_dates": years(t["volume"]), "topic_counts": topic_counts(t["volume"]),
    }
    many = {
        "table_counts": table_counts(t), "classification_distribution": class_distribution(t["classification"]), "language_distribution": languages(t["caption"]),
        "batches_by_node": batches_by_node(t["pipeline_batch"]), "topics": topics(t["volume"]), "volume_languages": volume_languages(t["volume"]), "year_distribution": year_distribution(t["volume"]), "hash_group_sizes": size_histogram(t["deduped_hash"]), "embedding_group_sizes": size_histogram(t["deduped_embedding"]),
    }
    if not skip_slow:
        one["detections_per_volume"] = detections_per_volume(t["pipeline_batch_item"], t["detection"])
    parts = [df.select(F.lit(k).alias("block"), F.to_json(F.struct("*")).alias("json")) for k, df in one.items()]
    parts += [df.agg(F.to_json(F.sort_array(F.collect_list(F.struct(*df.columns)))).alias("json")).select(F.lit(k).alias("block"), "json") for k, df in many.items()]
    return reduce(DataFrame.unionByName, parts)
