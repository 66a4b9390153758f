"""Every registered query of the engine itself, with its DuckDB equivalent.

A query takes (spark, folder of Parquet tables). It runs an operator over the relations of leafmill.sources.derived,
whole tables always; oracle SQL says the same over the same tables. Floating-point results are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions import language_profiles, languages, rules, text, vectors
from leafmill.operators import backfill, browse, control, embedding_dedupe, embedding_index, export, hash_dedupe, statistics, views
from leafmill.sources import sinks, staging
from leafmill.sources.derived import prelude, relation
from leafmill.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

NOW = "2024-01-15 00:00:00"
#: Keywords and terms that occur in the text at hand stand in for a real dictionary.
KEYWORDS = {"eng": ["thing", "and the"], "deu": ["und"], "fra": ["que"], "spa": ["que la"]}
TERMS = [("function", "the", ["of", "and the"]), ("verb", "is", ["was"]), ("german", "und", ["der", "die", "für"]), ("accents", "é", ["è", "ción"])]
VIEW = ("detection", "pipeline_batch_item", "volume", "classification", "caption", "image_hash", "image_embedding", "deduped_hash", "deduped_embedding")


def query(sql: str | None = None, *tables: str, name: str | None = None):
    """Register f(tables by name) under its name. sql follows a WITH clause that gives the tables."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(f({t: relation(spark, sf_dir, t) for t in tables}, spark, sf_dir))

        QUERIES[name or f.__name__] = run
        if sql:
            told = sql.replace("count_if(", "count(*) filter (where ")  # of the type Spark gives
            ORACLES[name or f.__name__] = (prelude(*tables) + " " + told) if tables else told
        return run

    return register


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


SUMMARY = "count({x}) as {p}count, round(avg({x}),6) as {p}mean, round(median({x}),6) as {p}median, round(min({x}),6) as {p}min, round(max({x}),6) as {p}max, round(stddev_pop({x}),6) as {p}std"
SUMMARY_INT = "count({x}) as {p}count, round(avg({x}),6) as {p}mean, round(median({x}),6) as {p}median, min({x}) as {p}min, max({x}) as {p}max, round(stddev_pop({x}),6) as {p}std"
REPS = "reps as (select id_detection from (select h.id_detection, row_number() over (partition by h.group_id, e.group_id order by d.bbox_conf desc nulls first, h.id_detection) as rn from deduped_hash h join deduped_embedding e using (id_detection) join detection d using (id_detection)) where rn = 1)"
VIEW_SQL = f"{REPS}, view as (select d.id_detection, d.id_pipeline_batch_item as pipeline_batch_item_id, i.barcode, d.scan_filename, d.bbox_xyxy, d.bbox_xywh, d.bbox_conf, d.orientation_correction_gen, c.pred_class, c.pred_conf as classification_conf, c.probs as classification_probs, t.text as caption_text, t.lang as caption_lang, t.lang_detected as caption_lang_detected, t.linear_prob as caption_linear_prob, t.thesaurus_matches as caption_thesaurus_matches, ih.image_hash, ie.embedding from detection d join reps using (id_detection) join pipeline_batch_item i on i.id_pipeline_batch_item = d.id_pipeline_batch_item join volume v on v.barcode = i.barcode join classification c on c.id_detection = d.id_detection left join caption t on t.id_detection = d.id_detection left join image_hash ih on ih.id_detection = d.id_detection left join image_embedding ie on ie.id_detection = d.id_detection where d.bbox_conf >= 0.75)"
LABEL = "case {c} when 'Image or Illustration' then 'Image/Illustration' when 'Ex Libris or Decorative' then 'Ex Libris/Decorative' when 'Chart or Graph' then 'Chart/Graph' else {c} end"
LANGUAGE = "case caption_lang when 'English' then 'eng' when 'French' then 'fra' when 'German' then 'deu' when 'Spanish' then 'spa' end"


def view_query(sql: str, name: str | None = None):
    return query(", " + VIEW_SQL + " " + sql, *VIEW, name=name)


VIEW_COLUMNS = "id_detection, pipeline_batch_item_id, barcode, scan_filename, bbox_conf, orientation_correction_gen, pred_class, classification_conf, caption_text, caption_lang, caption_lang_detected, caption_linear_prob, caption_thesaurus_matches, image_hash"


@view_query(f"select {VIEW_COLUMNS}, len(embedding) as dimensions from view")
def filtered_dataset(t, *_):
    v = views.filtered_dataset(t)
    return v.select(*VIEW_COLUMNS.split(", "), F.when(F.col("embedding").isNotNull(), F.size("embedding").cast("bigint")).alias("dimensions"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["filtered_dataset"](spark, sf_dir)


@query(f", {REPS} select id_detection from reps", "deduped_hash", "deduped_embedding", "detection")
def group_representatives(t, *_):
    return views.representatives(t["deduped_hash"], t["deduped_embedding"], t["detection"])


# ---- statistics


@query("select 'caption' as table_name, count(*) as n from caption union all select 'classification', count(*) from classification union all select 'detection', count(*) from detection union all select 'volume', count(*) from volume", "caption", "classification", "detection", "volume")
def table_counts(t, *_):
    return statistics.table_counts(t)


@query(f"select case when pred_class = 'Unheard of' then 'unknown_Unheard of' else {LABEL.format(c='pred_class')} end as label, count(*) as n from classification group by 1", "classification")
def class_distribution(t, *_):
    return statistics.class_distribution(t["classification"])


@query("select " + SUMMARY.format(x="bbox_conf", p="") + " from detection", "detection")
def detection_confidence(t, *_):
    return statistics.confidence(t["detection"], "bbox_conf")


@query("select " + SUMMARY.format(x="pred_conf", p="") + " from classification", "classification")
def classification_confidence(t, *_):
    return statistics.confidence(t["classification"], "pred_conf")


@query("select " + ", ".join(SUMMARY.format(x=x, p=p) for x, p in (("bbox_xywh[3]", "width_"), ("bbox_xywh[4]", "height_"), ("bbox_xywh[3] * bbox_xywh[4]", "area_"))) + " from detection where len(bbox_xywh) = 4", "detection")
def crop_dimensions(t, *_):
    return statistics.crop_dimensions(t["detection"])


WORDS = "len(list_filter(regexp_split_to_array({x}, '[\\x09-\\x0D\\x20\\x{{85}}\\x{{A0}}]+'), lambda w: w <> ''))"


@query("select " + SUMMARY_INT.format(x="cast(length(text) as int)", p="chars_") + ", " + SUMMARY_INT.format(x="cast(" + WORDS.format(x="text") + " as int)", p="words_") + " from (select text from caption where text <> '')", "caption")
def caption_lengths(t, *_):
    return statistics.captions(t["caption"])


@query("select lang as language, count(*) as n from caption where lang <> '' group by 1", "caption")
def caption_languages(t, *_):
    return statistics.languages(t["caption"])


DEDUPE = "select count(*) as total_groups, cast(coalesce(sum(size),0) as bigint) as total_items, count_if(size = 1) as singleton_groups, count_if(size > 1) as duplicate_groups, coalesce(max(size),0) as largest_group, round(avg(size),6) as avg_group_size, round(median(size),6) as median_group_size, round(100 * (1 - count(*) / sum(size)),6) as reduction_percent from (select count(*) as size from {t} group by group_id)"


@query(DEDUPE.format(t="deduped_hash"), "deduped_hash")
def hash_group_statistics(t, *_):
    return statistics.dedupe(t["deduped_hash"])


@query(DEDUPE.format(t="deduped_embedding"), "deduped_embedding")
def embedding_group_statistics(t, *_):
    return statistics.dedupe(t["deduped_embedding"])


@query("select size, count(*) as n from (select count(*) as size from deduped_hash group by group_id) group by 1", "deduped_hash")
def group_size_histogram(t, *_):
    return statistics.size_histogram(t["deduped_hash"])


DONE = "started_date is not null and ended_date is not null"


@query(f"select count(*) as total, count_if({DONE}) as completed, count_if(started_date is not null and ended_date is null) as in_progress, count_if(started_date is null) as pending, count_if({DONE} and has_crashed) as crashed, count_if(has_crashed) as crashed_all, round((count_if({DONE}) - count_if({DONE} and has_crashed)) / nullif(count_if({DONE}),0),6) as success_rate from pipeline_batch", "pipeline_batch")
def batch_lifecycle(t, *_):
    return statistics.batches(t["pipeline_batch"])


@query("select " + SUMMARY.format(x="m", p="") + " from (select (epoch_us(ended_date) - epoch_us(started_date)) / 6e7 as m from pipeline_batch) where m > 0", "pipeline_batch")
def processing_minutes(t, *_):
    return statistics.processing_minutes(t["pipeline_batch"])


@query(f"select node_name, count(*) as n from pipeline_batch where {DONE} and node_name <> '' group by 1", "pipeline_batch")
def batches_by_node(t, *_):
    return statistics.batches_by_node(t["pipeline_batch"])


META = "case when json_valid(metadata) then json_extract_string(metadata, '$.{f}') end"


@query(f"select topic, count(*) as n from (select {META.format(f='topic_or_subject_gen')} as topic from volume) where topic <> '' group by 1 order by 2 desc, 1 limit 50", "volume")
def topic_histogram(t, *_):
    return statistics.topics(t["volume"])


@query(f"select count(distinct topic) as topics, count(topic) as volumes from (select nullif({META.format(f='topic_or_subject_gen')}, '') as topic from volume)", "volume")
def topic_counts(t, *_):
    return statistics.topic_counts(t["volume"])


YEARS = f"years as (select try_cast(substr({META.format(f='date1_src')}, 1, 4) as int) as y from volume)"


@query(f", {YEARS} select cast(coalesce(sum(n),0) as bigint) as volumes_with_date, min(y) as first_year, max(y) as last_year, cast(floor(median(y)) as int) as median_year from (select y, count(*) as n from years where y between 1400 and 2100 group by y)", "volume")
def publication_years(t, *_):
    return statistics.years(t["volume"])


@query(f", {YEARS} select y as year, count(*) as n from years where y between 1400 and 2100 group by y", "volume")
def year_distribution(t, *_):
    return statistics.year_distribution(t["volume"])


@query(f"select language, count(*) as n from (select {META.format(f='language_src')} as language from volume) where language <> '' group by 1", "volume")
def volume_languages(t, *_):
    return statistics.volume_languages(t["volume"])


PER_VOLUME = "n as (select barcode, {how} as n from (select i.barcode, i.id_pipeline_batch_item, count(d.id_detection) as c from pipeline_batch_item i left join detection d using (id_pipeline_batch_item) group by all) group by barcode)"
VOLUME_STATS = "select count(*) as volumes_processed, cast(sum(n) as bigint) as total_detections, round(avg(n),6) as mean, round(median(n),6) as median, min(n) as min, max(n) as max, round(stddev_pop(n),6) as std, count_if(n = 0) as volumes_with_zero, count_if(n > 100) as volumes_with_over_100, " + ", ".join(f"round(quantile_cont(n, {q}),6) as p{round(q * 100)}" for q in (0.25, 0.5, 0.75, 0.9, 0.99)) + " from n"


@query(", " + PER_VOLUME.format(how="cast(sum(c) as bigint)") + " " + VOLUME_STATS, "pipeline_batch_item", "detection")
def detections_per_volume(t, *_):
    return statistics.detections_per_volume(t["pipeline_batch_item"], t["detection"])


@query(", " + PER_VOLUME.format(how="arg_max(c, id_pipeline_batch_item)") + " " + VOLUME_STATS, "pipeline_batch_item", "detection")
def detections_per_volume_last_item(t, *_):
    return statistics.detections_per_volume(t["pipeline_batch_item"], t["detection"], "last_item")


@query("select count(*) as total_docs, count_if(n is null) as empty_docs, cast(coalesce(sum(n),0) as bigint) as total_tokens, round(avg(n),6) as mean, round(median(n),6) as median, round(coalesce(stddev_samp(n),0),6) as stdev, min(n) as min, max(n) as max, " + ", ".join(f"round(quantile_cont(n, {q}),6) as p{round(q * 100)}" for q in (0.05, 0.25, 0.75, 0.95, 0.99)) + " from (select case when text <> '' then " + WORDS.format(x="text") + " end as n from documents)")
def word_statistics(t, spark, d):
    return statistics.tokens(backfill.word_counts(documents(spark, d)), "n_words")


@query()
def token_statistics(t, spark, d):
    return statistics.tokens(backfill.token_counts(documents(spark, d)), "n_tokens")


@query("select cast(least(50, floor((bbox_conf - lo) / (hi - lo) * 50) + 1) as bigint) as bin, count(*) as n from detection, (select min(bbox_conf) as lo, max(bbox_conf) as hi from detection) b where bbox_conf is not null group by 1", "detection", name="confidence_histogram")
def confidence_histogram(t, *_):
    return statistics.histogram(t["detection"], F.col("bbox_conf"))


@query("select count(*) as detections, count_if(pred_class is null) as failed_classifications, count_if(coalesce(pred_class not in ('Ex Libris or Decorative', 'Artifact'), true) and trim(coalesce(text,'')) = '') as failed_captions from detection left join classification using (id_detection) left join caption using (id_detection)", "detection", "classification", "caption")
def failure_counts(t, *_):
    return statistics.failures(t["detection"], t["classification"], t["caption"])


@query("select id_pipeline_batch_item, n, cast(sum(n) over (order by id_pipeline_batch_item) as bigint) as running from (select id_pipeline_batch_item, count(*) as n from detection group by 1)", "detection")
def cumulative_rows(t, *_):
    return statistics.cumulative(t["detection"], "id_pipeline_batch_item")


# ---- control plane


@query("select row_number() over (order by barcode) as id_pipeline_batch_item, cast(floor((row_number() over (order by barcode) - 1) / 10) as bigint) + 1 as id_pipeline_batch, barcode from volume", "volume")
def prepare_run(t, *_):
    return control.prepare_run(t["volume"], 1, 10)[1]


@query("select row_number() over (order by barcode) as id_pipeline_batch_item, cast(floor((row_number() over (order by barcode) - 1) / 10) as bigint) + 1 as id_pipeline_batch, barcode from (select barcode from (select barcode from volume order by barcode limit 15 offset 2) where barcode not in (select barcode from pipeline_batch_item where id_pipeline_batch_item % 3 = 0))", "volume", "pipeline_batch_item")
def prepare_run_append(t, *_):
    return control.prepare_run(t["volume"], 2, 10, 2, 15, t["pipeline_batch_item"].where("id_pipeline_batch_item % 3 = 0"))[1]


@query("select barcode, metadata from volume where barcode not in (select barcode from pipeline_batch_item where id_pipeline_batch_item % 4 = 1)", "volume", "pipeline_batch_item")
def unseen_volumes(t, *_):
    return control.unseen_volumes(t["volume"], t["pipeline_batch_item"].where("id_pipeline_batch_item % 4 = 1"))


@query("select id_pipeline_batch, id_pipeline_run, case when ended_date is not null and not has_crashed then 'COMPLETED' when has_crashed then 'CRASHED' when started_date is not null then 'RUNNING/LOCKED' else 'PENDING' end as status from pipeline_batch", "pipeline_batch")
def batch_status(t, *_):
    return control.status(t["pipeline_batch"])


@query(f"select id_pipeline_batch from pipeline_batch where not (ended_date is not null and not has_crashed) and (started_date is null or has_crashed or (epoch_us(timestamp '{NOW}') // 1000000 - epoch_us(started_date) // 1000000) > 86400)", "pipeline_batch")
def available_batches(t, *_):
    return control.available(t["pipeline_batch"], F.lit(NOW).cast("timestamp"), 86400).select("id_pipeline_batch")


@query("select * from pipeline_batch_item where id_pipeline_batch_item in (select id_pipeline_batch_item from detection where bbox_conf > 0.9)", "pipeline_batch_item", "detection")
def items_with_detections(t, *_):
    return control.items_with_detections(t["pipeline_batch_item"], t["detection"].where("bbox_conf > 0.9"))


@query("select distinct id_detection, d.id_pipeline_batch_item, scan_filename, pred_class from detection d join classification c using (id_detection) where pred_class not in ('Ex Libris or Decorative', 'Artifact')", "detection", "classification")
def captionable_detections(t, *_):
    return control.captionable(t["detection"], t["classification"])


@query("select distinct d.id_pipeline_batch_item from detection d where id_detection % 6 = 0", "detection")
def allowed_items(t, *_):
    return control.allowed_items(t["detection"].where("id_detection % 6 = 0").select(F.col("id_detection").alias("detection_id")), t["detection"])


@view_query("select id_detection, scan_filename from view where pred_class in ('Image or Illustration', 'Chart or Graph') and orientation_correction_gen is null")
def pending_orientation(t, *_):
    return control.pending_orientation(views.filtered_dataset(t)).select("id_detection", "scan_filename")


@query("select id_caption, text from caption where lang_detected is null", "caption")
def pending_backfill(t, *_):
    return control.pending_backfill(t["caption"]).select("id_caption", "text")


@query(f"select id_caption, case when trim(text) <> '' then {languages.detected_sql('text')} end as lang_detected from caption", "caption")
def detected_languages(t, *_):
    return backfill.backfill(t["caption"], force=True).select("id_caption", "lang_detected")


CODES = {"en": "eng", "fr": "fra", "de": "deu", "es": "spa"}


@query(f", labelled as (select lang, text from documents where lang is not null and text is not null), asked as (select id_caption as id, text from caption), {language_profiles.told_sql()} select id as id_caption, case lang {' '.join(f"when '{k}' then '{v}'" for k, v in CODES.items())} else lang end as lang_detected from answered", "caption")
def profiled_languages(t, spark, d):
    """Captions told by trigram profiles that were learned from the documents; held-out accuracy is tested apart."""
    profiles = language_profiles.train(documents(spark, d))
    out = backfill.backfill(t["caption"], None, language_profiles.detector(profiles, CODES), True)
    return out.select("id_caption", "lang_detected")


@query("select i.id_pipeline_batch, i.id_pipeline_batch_item, barcode from pipeline_batch_item i join volume v using (barcode)", "pipeline_batch_item", "volume")
def batch_volumes(t, *_):
    return browse.batch_volumes(t["pipeline_batch_item"], t["volume"]).select("id_pipeline_batch", "id_pipeline_batch_item", "barcode")


@query("select id_pipeline_batch_item, barcode, cast((row_number() over (order by id_pipeline_batch_item, barcode) - 1) % 4 as int) as worker from pipeline_batch_item", "pipeline_batch_item")
def worker_shares(t, *_):
    return browse.workers(t["pipeline_batch_item"], 4, ["id_pipeline_batch_item", "barcode"]).select("id_pipeline_batch_item", "barcode", "worker")


@query("select group_id, count(*) as n from deduped_hash group by 1 having count(*) >= 2", "deduped_hash")
def groups_by_size(t, *_):
    return browse.groups_by_size(t["deduped_hash"])


@query("select d.embedding_id, d.group_id, d.id_detection, len(e.embedding) as dimensions, round(cast(e.embedding[1] as double), 5) as x1, round(cast(e.embedding[5] as double), 5) as x5 from deduped_embedding d join image_embedding e using (id_detection)", "deduped_embedding", "image_embedding")
def group_vectors(t, *_):
    v = browse.with_vectors(t["deduped_embedding"], t["image_embedding"]).withColumn("p", browse.vector_preview(F.col("embedding")))
    x = lambda i: F.round(F.get("p.first", F.lit(i)).cast("double"), 5)
    return v.select("embedding_id", "group_id", "id_detection", F.col("p.dimensions").cast("long").alias("dimensions"), x(0).alias("x1"), x(4).alias("x5"))


@query("select id_detection, round(bbox_xyxy[3] * f, 4) as x2, round(bbox_xyxy[4] * f, 4) as y2 from (select *, least(1.0, 320.0 / greatest(bbox_xyxy[3], bbox_xyxy[4])) as f from detection)", "detection")
def thumbnail_boxes(t, *_):
    side = lambda i: F.get("bbox_xyxy", F.lit(i))
    box = browse.scaled(F.col("bbox_xyxy"), browse.thumbnail_factor(side(2), side(3), 320))
    return t["detection"].withColumn("b", box).select("id_detection", F.round(F.get("b", F.lit(2)), 4).alias("x2"), F.round(F.get("b", F.lit(3)), 4).alias("y2"))


@view_query("select barcode, scan_filename, cast(row_number() over (partition by barcode order by seen) as int) as place, elements from (select barcode, scan_filename, min(id_detection) as seen, count(*) as elements from view group by 1, 2)")
def volume_pages(t, *_):
    return browse.pages(views.filtered_dataset(t))


@view_query("select barcode, label, cast(row_number() over (partition by barcode order by n desc, label) as int) as place, n, round(n / sum(n) over (partition by barcode), 6) as share from (select barcode, coalesce(pred_class, '') as label, count(*) as n from view group by 1, 2)")
def volume_headers(t, *_):
    h = browse.header(views.filtered_dataset(t), t["volume"])
    rows = h.select("barcode", F.posexplode("classes").alias("at", "c"))
    return rows.select("barcode", "c.label", (F.col("at") + 1).cast("int").alias("place"), "c.n", "c.share")


@query("select barcode, max(id_pipeline_batch_item) as id_pipeline_batch_item from pipeline_batch_item group by 1", "pipeline_batch_item")
def latest_items(t, *_):
    return control.latest_item(t["pipeline_batch_item"])


@query("select barcode, case when barcode like '%1%' then 'fresh' else metadata end as metadata from volume union all select 'new', 'fresh'", "volume")
def upsert_volumes(t, spark, _):
    fresh = t["volume"].where("barcode like '%1%'").select("barcode", F.lit("fresh").alias("metadata"))
    return control.index_volumes(t["volume"], fresh.unionByName(fresh.limit(1).withColumn("barcode", F.lit("new"))))


@query("select id_detection, id_pipeline_batch_item, case when id_pipeline_batch_item % 2 = 0 then 'redone' else scan_filename end as scan_filename from detection where not (id_pipeline_batch_item % 2 = 0 and bbox_conf is null)", "detection")
def replace_by_item(t, *_):
    old = t["detection"].select("id_detection", "id_pipeline_batch_item", "scan_filename")
    even = t["detection"].where("id_pipeline_batch_item % 2 = 0")
    return sinks.replaced(old, even.where("bbox_conf is not null").select("id_detection", "id_pipeline_batch_item", F.lit("redone").alias("scan_filename")), keys=even)


@query("select id_caption, id_detection from caption where id_detection not in (select id_detection from detection where bbox_conf < 0.2)", "caption", "detection")
def cascade_delete(t, *_):
    return sinks.cascade(t["caption"], t["detection"].where("bbox_conf < 0.2")).select("id_caption", "id_detection")


@query("select s.i as part, count(*) as n, min(id_detection) as first_id from (select id_detection, (row_number() over (order by id_detection) - 1) // ((count(*) over () + 6) // 7) as i from detection) s where s.i = 2 group by 1", "detection")
def export_chunk(t, *_):
    part = control.chunk(t["detection"].select(F.col("id_detection").alias("id")), 2, 7)
    return part.agg(F.lit(2).cast("bigint").alias("part"), F.count("*").alias("n"), F.min("id").alias("first_id"))


# ---- scalar functions and rules


@query("select id_detection, regexp_replace(scan_filename, '\\.[^.]*$', '') as stem, split_part(scan_filename, '.', 1) as first, case when length(scan_filename) > 8 then left(scan_filename, 8) || '...' else scan_filename end as short, regexp_matches(scan_filename, '\\.(jpg|tif|tiff|jp2)$') as image from detection", "detection")
def file_names(t, *_):
    n = F.col("scan_filename")
    return t["detection"].select("id_detection", text.strip_extension(n).alias("stem"), text.first_part(n).alias("first"), text.clip(n, 8).alias("short"), text.is_image(n).alias("image"))


@query("select id_detection, cast(round_even(bbox_xywh[3], 0) as bigint) as width, cast(round_even(bbox_xywh[4], 0) as bigint) as height, round(cast(round_even(bbox_xywh[3], 0) as bigint) * cast(round_even(bbox_xywh[4], 0) as bigint) / 1000000, 6) as mpx from detection where len(bbox_xywh) = 4", "detection")
def half_even_sizes(t, *_):
    d = t["detection"].where(F.size("bbox_xywh") == 4).select("id_detection", text.half_even(F.col("bbox_xywh")[2]).alias("width"), text.half_even(F.col("bbox_xywh")[3]).alias("height"))
    return d.withColumn("mpx", rules.megapixels(F.col("width"), F.col("height")))


@query("select id_detection, cast(greatest(0, least(round_even(bbox_xyxy[1], 0), 600)) as int) as x1, cast(greatest(0, least(round_even(bbox_xyxy[4], 0), 400)) as int) as y2 from detection", "detection")
def crop_boxes(t, *_):
    box = rules.crop_box(F.col("bbox_xyxy"), F.lit(600), F.lit(400))
    return t["detection"].select("id_detection", box["x1"].alias("x1"), box["y2"].alias("y2"))


@query("select id_detection, case when len(probs) = 5 then l[list_position(probs, list_max(probs))] end as likeliest, case when len(probs) = 5 then round(list_max(probs), 6) end as prob, case when len(probs) = 5 then round(list_sort(probs, 'desc')[5], 6) end as least from classification, (select ['Artifact', 'Chart/Graph', 'Ex Libris/Decorative', 'Image/Illustration', 'Music'] as l)", "classification")
def class_probabilities(t, *_):
    p = t["classification"].select("id_detection", rules.probabilities(F.col("probs")).alias("p"))
    return p.select("id_detection", F.get("p", F.lit(0))["label"].alias("likeliest"), F.get("p", F.lit(0))["prob"].alias("prob"), F.get("p", F.lit(4))["prob"].alias("least"))


@query("select id_detection, case when list_max(p) >= 0.9 then ['upright', 'rotate_90_cw', 'rotate_180', 'rotate_90_ccw'][list_position(p, list_max(p))] else 'upright' end as label from (select id_detection, probs[1:4] as p from classification where len(probs) >= 4)", "classification")
def orientation_labels(t, *_):
    return t["classification"].where(F.size("probs") >= 4).select("id_detection", rules.orientation(F.slice("probs", 1, 4), 0.9).alias("label"))


@query("select id_caption, round(exp((-cast(id_caption % 9 as double) / 8 - 0.5) / 2), 6) as linear_prob from caption where id_caption % 19 > 1 union all select id_caption, null from caption where id_caption % 19 < 2", "caption")
def linear_probabilities(t, *_):
    return t["caption"].select("id_caption", rules.linear_probability(F.col("logprobs")).alias("linear_prob"))


def _thesaurus(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TERMS, "category string, keyword string, related_terms array<string>")


#: Characters that are no part of a word stand twice, so that each match has its own on both sides.
BORDER = "[^\\p{L}\\p{N}_]"
_ALL_TERMS = {t: c for c, k, more in TERMS for t in [k, *more]}
FOUND_TERMS = f"found as (select id_caption, replace(unnest(regexp_extract_all(' ' || regexp_replace(lower(text), '({BORDER})', '\\1\\1', 'g') || ' ', '{BORDER}({'|'.join(sorted((t.replace(' ', '  ') for t in _ALL_TERMS), key=lambda t: -len(t)))}){BORDER}', 1)), '  ', ' ') as term from caption), counted as (select id_caption, case term {' '.join(f"when '{t}' then '{c}'" for t, c in _ALL_TERMS.items())} end as category, term, count(*) as n from found group by all)"


@query(f", {FOUND_TERMS} select id_caption, category, term, n from counted", "caption")
def thesaurus_counts(t, spark, _):
    return backfill.thesaurus_counts(t["caption"], _thesaurus(spark))


@query(f", {FOUND_TERMS} select id_caption, '{{' || string_agg(said, ',' order by category) || '}}' as matches from (select id_caption, category, '\"' || category || '\":{{' || string_agg('\"' || term || '\":' || n, ',' order by term) || '}}' as said from counted group by id_caption, category) group by id_caption", "caption")
def thesaurus_maps(t, spark, _):
    return backfill.thesaurus_matches(t["caption"], _thesaurus(spark)).select("id_caption", F.to_json("thesaurus_matches").alias("matches"))


# ---- export

RECORDS = f"rec as (select *, case when label is null then null else label end as gen, case when coalesce(caption_text,'') <> '' then case when caption_text in ('Undetermined', 'Undetermined.') then 'CAPTION FAILED' else caption_text end when label in ('Artifact', 'Ex Libris/Decorative') then null else 'CAPTION FAILED' end as cap from (select *, {LABEL.format(c='cls')} as label from (select *, case when classification_conf < 0.7 then 'Other' else pred_class end as cls from view)))"


@view_query(f"""select id, barcode_src, page_filename_src, width_gen, height_gen, pixel_count_mpx_gen, classification_gen, caption_exp, caption_lang_passed_exp, caption_lang_detected_exp, caption_linear_prob_exp, caption_chronam_thesauri_matches_exp from (with {RECORDS} select id_detection as id, barcode as barcode_src, scan_filename as page_filename_src,
case when len(bbox_xywh) >= 4 then cast(round_even(bbox_xywh[3],0) as bigint) end as width_gen, case when len(bbox_xywh) >= 4 then cast(round_even(bbox_xywh[4],0) as bigint) end as height_gen,
case when len(bbox_xywh) >= 4 then round(cast(round_even(bbox_xywh[3],0) as bigint) * cast(round_even(bbox_xywh[4],0) as bigint) / 1000000, 6) end as pixel_count_mpx_gen,
case when label = 'Music' then case when coalesce(classification_conf > 0.99, false) or coalesce(cap <> 'CAPTION FAILED' and cap <> '' and case {LANGUAGE} when 'eng' then contains(lower(cap), 'thing') or contains(lower(cap), 'and the') when 'deu' then contains(lower(cap), 'und') when 'fra' then contains(lower(cap), 'que') when 'spa' then contains(lower(cap), 'que la') else false end, false) then 'Music' else 'Other' end else label end as classification_gen,
cap as caption_exp, case when cap <> 'CAPTION FAILED' then {LANGUAGE} end as caption_lang_passed_exp, case when cap <> 'CAPTION FAILED' then caption_lang_detected end as caption_lang_detected_exp, case when cap <> 'CAPTION FAILED' then round(caption_linear_prob,6) end as caption_linear_prob_exp, case when cap <> 'CAPTION FAILED' and caption_thesaurus_matches not in ('', 'null', '{{}}') then caption_thesaurus_matches end as caption_chronam_thesauri_matches_exp from rec)""")
def export_records(t, *_):
    r = export.records(views.filtered_dataset(t), keywords=KEYWORDS)
    return r.select("id", "barcode_src", "page_filename_src", "width_gen", "height_gen", "pixel_count_mpx_gen", "classification_gen", "caption_exp", "caption_lang_passed_exp", "caption_lang_detected_exp", "caption_linear_prob_exp", "caption_chronam_thesauri_matches_exp")


@view_query(f"select split, shard, n, first_id, split || '-' || lpad(cast(shard as varchar), 5, '0') || '-of-' || lpad(cast(cnt as varchar), 5, '0') || '.parquet' as file from (with {RECORDS} select split, shard, count(*) as n, min(id) as first_id, max(of_) as cnt from (select *, max(shard) over (partition by split) + 1 as of_ from (select id_detection as id, case when coalesce(label,'') = '' then 'unknown' else replace(replace(lower(label), '/', '_'), ' ', '_') end as split, cast((row_number() over (partition by label order by id_detection) - 1) // 7 as bigint) as shard from rec)) group by split, shard)")
def export_shards(t, *_):
    s = export.sharded(export.records(views.filtered_dataset(t)), 7)
    return s.groupBy("split", "shard", "file").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@view_query("select id_detection as id from view where id_detection % 5 <> 0")
def resume_export(t, *_):
    r = export.records(views.filtered_dataset(t))
    return export.not_exported(r, r.where("id % 5 = 0")).select("id")


@view_query("select id_detection, pipeline_batch_item_id as item_id, barcode, scan_filename from view where id_detection % 3 = 0")
def missing_crops(t, *_):
    v = views.filtered_dataset(t)
    return export.missing_crops(v, v.select("id_detection", F.when(F.col("id_detection") % 3 != 0, F.lit(b"x")).alias("png")))


@view_query("select barcode, count(*) as detections, count(distinct scan_filename) as pages, count_if(trim(coalesce(caption_text,'')) <> '') as captions, count_if(pred_class not in ('Ex Libris or Decorative', 'Artifact')) as captionable, count_if(pred_class not in ('Ex Libris or Decorative', 'Artifact') and trim(coalesce(caption_text,'')) = '') as failed_captions from view group by 1")
def volume_statistics(t, *_):
    return export.volume_stats(views.filtered_dataset(t))


@view_query("select barcode, pred_class, count(*) as n, round(count(*) / sum(count(*)) over (partition by barcode), 6) as share from view group by 1, 2")
def class_shares(t, *_):
    return export.class_shares(views.filtered_dataset(t))


@view_query("select id_detection, barcode, scan_filename, cast(row_number() over (partition by barcode, scan_filename order by id_detection) as int) as place, case when len(bbox_xywh) >= 4 then cast(trunc(bbox_xywh[3]) as int) || ' x ' || cast(trunc(bbox_xywh[4]) as int) end as size, left(image_hash, 12) as hash, case when trim(coalesce(caption_text,'')) <> '' then case when length(caption_text) > 80 then left(caption_text, 80) || '...' else caption_text end when pred_class in ('Ex Libris or Decorative', 'Artifact') then '(excluded class)' else '(missing)' end as caption from view")
def page_details(t, *_):
    return export.page_details(views.filtered_dataset(t)).drop("confidence")


@view_query("select id_detection as id, barcode, pred_class as classification, caption_lang_detected as language, case when len(bbox_xywh) >= 4 then nullif(round(cast(round_even(bbox_xywh[3],0) as bigint) * cast(round_even(bbox_xywh[4],0) as bigint) / 1000000, 6), 0) end as megapixels, len(embedding) as dimensions from view where embedding is not null")
def atlas(t, *_):
    return export.atlas(views.filtered_dataset(t), None).select("id", "barcode", "classification", "language", "megapixels", F.size("embedding").cast("bigint").alias("dimensions"))


def _field(name: str, value: str, text_: bool = False) -> str:
    """A member of a JSON object, null if there is no value."""
    return f"'\"{name}\":' || " + (f"cast(to_json({value}) as varchar)" if text_ else f"cast({value} as varchar)")


_BOX = "case when bbox_xyxy is not null then '[' || array_to_string(list_transform(bbox_xyxy, lambda x: cast(x as varchar)), ',') || ']' end"
_ELEMENT = ", ".join([
    _field("id_detection", "id_detection"), _field("scan_filename", "scan_filename", True), f"'\"bbox_xyxy\":' || {_BOX}", _field("bbox_conf", "bbox_conf"), _field("pred_class", "pred_class", True),
    _field("classification_conf", "classification_conf"), _field("caption", "caption_text", True), _field("lang", "caption_lang", True), _field("image_hash", "image_hash", True)])


@view_query(f"""select barcode, '{{"barcode":' || to_json(barcode) || ',"pages":[' || (select string_agg(cast(to_json(scan_filename) as varchar), ',' order by seen) from (select scan_filename, min(id_detection) as seen from view v where v.barcode = w.barcode group by 1)) || '],"detections":[' || string_agg('{{' || concat_ws(',', {_ELEMENT}) || '}}', ',' order by id_detection) || ']}}' as json from view w group by barcode""")
def viewer_documents(t, *_):
    return export.viewer_documents(views.filtered_dataset(t))


@view_query("select barcode, count(distinct scan_filename) as pages, count(*) as detections, min(scan_filename) filter (where id_detection = first_id) as cover from (select *, min(id_detection) over (partition by barcode) as first_id from view) group by barcode")
def viewer_index(t, *_):
    return export.viewer_index(views.filtered_dataset(t))


@view_query("select barcode, cast(dense_rank() over (partition by barcode order by seen) - 1 as int) as page, (select cast(count(distinct v.scan_filename) as int) from view v where v.barcode = w.barcode) as pages, id_detection, scan_filename, bbox_xyxy[3] as right_edge, bbox_conf, pred_class, caption_text as caption, image_hash from (select *, min(id_detection) over (partition by barcode, scan_filename) as seen from view) w")
def viewer_elements(t, *_):
    """Viewer documents written and read back."""
    rows = export.viewer_rows(export.viewer_documents(views.filtered_dataset(t)))
    return rows.select("barcode", "page", "pages", "id_detection", "scan_filename", F.get("bbox_xyxy", F.lit(2)).alias("right_edge"), "bbox_conf", "pred_class", "caption", "image_hash")


@query("select id_detection, coalesce(p.text, '') as page_text from detection d left join (select distinct id_pipeline_batch_item, split_part(scan_filename, '.', 1) || '.txt' as f, 'page ' || split_part(scan_filename, '.', 1) as text from detection where id_detection % 2 = 0) p on p.id_pipeline_batch_item = d.id_pipeline_batch_item and p.f = split_part(d.scan_filename, '.', 1) || '.txt'", "detection")
def page_context(t, *_):
    d = t["detection"]
    base = text.first_part(F.col("scan_filename"))
    pages = d.where("id_detection % 2 = 0").select("id_pipeline_batch_item", F.concat(base, F.lit(".txt")).alias("filename"), F.concat(F.lit("page "), base).alias("text")).distinct()
    return export.page_context(d, pages).select("id_detection", "page_text")


# ---- near-duplicates

BANDS = "bands as (select id_imagehash as id, image_hash as h, b as band, cast('0x' || substr(image_hash, 31 - 6 * b, 6) as bigint) as value from image_hash, (select unnest([0, 1, 2, 3, 4, 5]) as b) where regexp_matches(image_hash, '^[0-9a-fA-F]{36}$'))"
BITS = " + ".join(f"bit_count(xor(cast('0x' || substr({{a}}, {at}, {n}) as bigint), cast('0x' || substr({{b}}, {at}, {n}) as bigint)))" for at, n in ((1, 12), (13, 12), (25, 12)))
PAIRS = f"pairs as (select distinct x.id as a, y.id as b from bands x join bands y on x.band = y.band and x.value = y.value and x.id < y.id where {BITS.format(a='x.h', b='y.h')} <= 16)"
COMPONENTS = "edges as (select a, b from pairs union all select b, a from pairs), reach(id, root) as (select id_imagehash, id_imagehash from image_hash union select e.b, r.root from reach r join edges e on e.a = r.id), groups as (select id, min(root) as group_id from reach group by id)"


@query(f", {BANDS} select id, cast(band as int) as band, value from bands", "image_hash")
def hash_bands(t, *_):
    return hash_dedupe.banded(t["image_hash"].select(F.col("id_imagehash").alias("id"), F.col("image_hash").alias("h"))).select("id", "band", "value")


@query(f", {BANDS}, {PAIRS} select a, b from pairs", "image_hash")
def hash_pairs(t, *_):
    return hash_dedupe.all_pairs(t["image_hash"].select(F.col("id_imagehash").alias("id"), F.col("image_hash").alias("h")), max_bucket=None)


@query(("" + f", {BANDS}, {PAIRS}, {COMPONENTS} select g.id as hash_id, group_id, id_pipeline_batch_item, id_detection, image_hash from groups g join image_hash h on h.id_imagehash = g.id"), "image_hash")
def hash_groups(t, *_):
    return hash_dedupe.dedupe_by_hash(t["image_hash"], max_bucket=None)


ORACLES["hash_groups"] = ORACLES["hash_groups"].replace("WITH ", "WITH RECURSIVE ", 1)

NEAR = "near as (select x.id_embedding as i, y.id_embedding as j, list_cosine_similarity(cast(x.embedding as double[]), cast(y.embedding as double[])) as sim from image_embedding x join image_embedding y on x.id_embedding < y.id_embedding)"


@query(f", {NEAR} select i, j, round(sim, 4) as sim from near where sim >= 0.3", "image_embedding")
def embedding_neighbours(t, *_):
    v = t["image_embedding"].select(F.col("id_embedding").alias("id"), F.col("embedding").alias("v"))
    return embedding_dedupe.neighbours_exact(v, 0.3, None).withColumn("sim", F.round("sim", 4))


@query(f", {NEAR}, pairs as (select i as a, j as b from near where sim >= 0.4), edges as (select a, b from pairs union all select b, a from pairs), reach(id, root) as (select id_embedding, id_embedding from image_embedding union select e.b, r.root from reach r join edges e on e.a = r.id) select g.id as embedding_id, g.group_id, id_pipeline_batch_item, id_detection from (select id, min(root) as group_id from reach group by id) g join image_embedding v on v.id_embedding = g.id", "image_embedding")
def embedding_groups(t, *_):
    return embedding_dedupe.dedupe_by_embedding(t["image_embedding"], 0.6, None, exact=True)


ORACLES["embedding_groups"] = ORACLES["embedding_groups"].replace("WITH ", "WITH RECURSIVE ", 1)


@query("select id_embedding, round(sqrt(list_sum(list_transform(cast(embedding as double[]), lambda x: x * x))), 5) as norm, cast(list_position(embedding, list_max(embedding)) - 1 as int) as top from image_embedding", "image_embedding")
def vector_norms(t, *_):
    e = F.col("embedding")
    return t["image_embedding"].select("id_embedding", F.round(vectors.norm(e), 5).alias("norm"), vectors.argmax(e).alias("top"))


@query(f", {NEAR.replace('x.id_embedding < y.id_embedding', 'true')} select i, j, round(sim, 4) as sim from (select *, row_number() over (partition by i order by sim desc, j) as place from near) where place <= 10 and sim >= 0.2 and i < j", "image_embedding")
def embedding_neighbours_hashed(t, *_):
    """The index gives what must be beaten, an exact check by blocks the lists."""
    v = t["image_embedding"].select(F.col("id_embedding").alias("id"), F.col("embedding").alias("v"))
    return embedding_index.neighbours_searched(v, 0.2, 10, planned=0.5).withColumn("sim", F.round("sim", 4))


@query(None, *VIEW, "pipeline_batch")
def all_statistics(t, *_):
    return statistics.all_statistics(t)


# ---- incremental

#: Claims and releases of batches, from a table of events; a delivery holds a third of the time and an hour of the one before again.
REQUESTS = "select event_id, user_id as id_pipeline_batch, concat('node', cast(event_id % 3 as {text})) as node, case when event_type = 'purchase' or event_type = 'error' then 'release' else 'claim' end as action, cast(ts as timestamp{zone}) as ts from {events}"
DELIVERIES = [("0001-01-01", "2024-01-11"), ("2024-01-10 23:00:00", "2024-01-21"), ("2024-01-20 23:00:00", "9999-01-01")]


@query(f"""with recursive r as (select *, row_number() over (partition by id_pipeline_batch order by ts, node, action, event_id) as i from ({REQUESTS.format(text='varchar', zone='', events='events')})),
f as (select id_pipeline_batch, i, node as who, ts, case when action = 'claim' then node end as holder, case when action = 'claim' then ts + interval 43200 second end as until, case when action = 'claim' then ['granted'] else cast([] as varchar[]) end as said, cast(null as varchar) as gone, cast(null as timestamp) as gone_at from r where i = 1
 union all select r.id_pipeline_batch, r.i, r.node, r.ts,
 case when action = 'claim' and (holder is null or r.ts >= until) then r.node when action = 'release' and holder = r.node or r.ts >= until then null else holder end,
 case when action = 'claim' and (holder is null or r.ts >= until) then r.ts + interval 43200 second when action = 'release' and holder = r.node or r.ts >= until then null else until end,
 case when action = 'claim' and (holder is null or r.ts >= until) then ['granted'] when action = 'claim' then ['refused'] when holder = r.node and r.ts < until then ['released'] else cast([] as varchar[]) end,
 case when r.ts >= until then holder end, case when r.ts >= until then until end from f join r on r.id_pipeline_batch = f.id_pipeline_batch and r.i = f.i + 1)
select id_pipeline_batch, who as node, unnest(said) as said, ts from f union all select id_pipeline_batch, gone, 'expired', gone_at from f where gone is not null""")
def stream_leases(t, spark, d):
    """Twelve-hour leases over a stream of requests that stops and starts again, some requests delivered twice."""
    events = spark.read.parquet(f"{d.rstrip('/')}/events.parquet")
    rows = spark.sql(REQUESTS.format(text="string", zone="_ntz", events="{e}"), e=events).withColumn("ts", F.col("ts").cast("timestamp"))
    parts = [rows.where((F.col("ts") >= F.lit(lo).cast("timestamp")) & (F.col("ts") < F.lit(hi).cast("timestamp"))) for lo, hi in DELIVERIES]
    work = lambda s: incremental.leases(incremental.once(s, "event_id"), 43_200, "event")
    out = incremental.delivered(spark, parts, work, staging.fresh(spark, "stream"))
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
