"""The pipeline's relations made from general tables, in a dialect that Spark and DuckDB share.

They let every query run, and be compared, on tables that are at hand. All columns follow from ids by arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CLASSES = ["Image or Illustration", "Chart or Graph", "Music", "Artifact", "Ex Libris or Decorative", "Other"]


class Dialect:
    """What differs between the two."""

    def __init__(self, spark: bool):
        self.spark = spark

    def array(self, *xs: str) -> str:
        return f"array({', '.join(xs)})" if self.spark else f"[{', '.join(xs)}]"

    def floats(self, column: str) -> str:
        return column

    def minutes(self, ts: str, n: str) -> str:
        return f"({ts} + make_interval(0, 0, 0, 0, 0, {n}, 0))" if self.spark else f"({ts} + to_minutes({n}))"

    def ts(self, x: str) -> str:
        return f"cast({x} as timestamp)"


def relations(d: Dialect) -> dict[str, str]:
    """Relation -> SELECT over the general tables."""
    pick = "case doc_id * 31 % 7 " + " ".join(f"when {i} then '{c}'" for i, c in enumerate(CLASSES)) + " else 'Unheard of' end"
    conf = "cast(doc_id * 37 % 101 as double) / 100"
    prob = [f"cast(doc_id * {k} % 97 as double) / 97" for k in (3, 5, 7, 11, 13)]
    item = "cast(substr(source, 4) as bigint) * 2 + doc_id % 2 + 1"
    name = "case lang when 'en' then 'English' when 'fr' then 'French' when 'de' then 'German' when 'es' then 'Spanish' else 'Nowhere' end"
    code = "case lang when 'en' then 'eng' when 'fr' then 'fra' when 'de' then 'deu' when 'es' then 'spa' end"
    digits = "substr(concat(md5(text), md5(concat(text, 'x'))), 1, 36)"
    moved = f"case when doc_id % 3 = 0 then concat('{{0}}', substr({digits}, 3)) else {digits} end".format("0f")
    logs = "concat('[{\"token\":\"a\",\"logprob\":', cast(-cast(doc_id % 9 as double) / 8 as varchar(20)), '},{\"token\":\"b\",\"logprob\":null},{\"token\":\"c\",\"logprob\":-0.5}]')"
    logs = logs.replace("varchar(20)", "string") if d.spark else logs
    return {
        "volume": "select source as barcode, case when source = 'src3' then null when source = 'src5' then 'not json' else concat('{\"topic_or_subject_gen\":\"topic ', cast(count(*) % 4 as " + ("string" if d.spark else "varchar") + "), '\",\"language_src\":\"', min(lang), '\",\"date1_src\":\"', case when source = 'src7' then '18uu' when source = 'src9' then '1399' else cast(1700 + min(doc_id) * 7 % 300 as " + ("string" if d.spark else "varchar") + ") end, '\"}') end as metadata from documents group by source",
        "pipeline_batch": f"select event_id as id_pipeline_batch, event_id % 5 + 1 as id_pipeline_run, case when user_id % 7 = 0 then '' when user_id % 7 = 1 then null else concat('node', cast(user_id % 7 as {'string' if d.spark else 'varchar'})) end as node_name, {d.ts('ts')} as created_date, case when event_id % 11 = 0 then null else {d.ts('ts')} end as started_date, case when event_id % 11 = 0 or event_id % 6 = 0 then null when event_id % 13 = 0 then {d.ts('ts')} else {d.minutes(d.ts('ts'), 'cast(event_id % 90 + 1 as int)')} end as ended_date, event_type = 'error' as has_crashed from events",
        "pipeline_batch_item": "select distinct cast(substr(source, 4) as bigint) * 2 + k + 1 as id_pipeline_batch_item, k + 1 as id_pipeline_batch, source as barcode from documents, (select 0 as k union all select 1 as k union all select 60 as k) ks",
        "detection": f"select doc_id as id_detection, {item} as id_pipeline_batch_item, concat(source, '.p', cast(doc_id % 97 as {'string' if d.spark else 'varchar'}), '.jpg') as scan_filename, {d.array('cast(doc_id % 50 as double)', 'cast(doc_id % 70 as double)', 'doc_id % 50 + n_chars % 701 + 0.5', 'doc_id % 70 + n_chars % 499 + 0.25')} as bbox_xyxy, case when doc_id % 41 = 0 then null when doc_id % 43 = 0 then {d.array('cast(1 as double)', 'cast(2 as double)', 'cast(3 as double)')} else {d.array('cast(doc_id % 50 as double)', 'cast(doc_id % 70 as double)', 'cast(n_chars % 701 + 0.5 as double)', 'cast(n_chars % 499 + 0.25 as double)')} end as bbox_xywh, case when doc_id % 53 = 0 then null else {conf} end as bbox_conf, case doc_id % 5 when 0 then null when 1 then 'upright' when 2 then 'rotate_90_cw' else 'rotate_180' end as orientation_correction_gen, case when doc_id % 5 = 0 then null else cast(doc_id % 100 as double) / 100 end as orientation_correction_confidence_gen from documents",
        "classification": f"select doc_id as id_classification, {item} as id_pipeline_batch_item, doc_id as id_detection, cast(doc_id * 31 % 7 as int) as pred_idx, {pick} as pred_class, case when doc_id % 59 = 0 then null when doc_id % 17 = 0 then 0.991 else cast(doc_id * 71 % 101 as double) / 100 end as pred_conf, case when doc_id % 61 = 0 then {d.array(*prob[:4])} when doc_id % 67 = 0 then null else {d.array(*prob)} end as probs from documents",
        "caption": f"select doc_id as id_caption, {item} as id_pipeline_batch_item, doc_id as id_detection, case doc_id % 23 when 0 then null when 1 then '' when 2 then 'Undetermined' when 3 then 'Undetermined.' when 4 then '  ' else text end as text, {name} as lang, case doc_id % 19 when 0 then null when 1 then '[]' else {logs} end as logprobs, case when doc_id % 13 = 0 then null else {code} end as lang_detected, case when doc_id % 29 = 0 then null else cast(doc_id % 1000 as double) / 1000 end as linear_prob, case doc_id % 31 when 0 then null when 1 then 'null' else '{{\"place\":{{\"the\":2}}}}' end as thesaurus_matches from documents where doc_id % 9 <> 0",
        "image_hash": f"select doc_id + 1000 as id_imagehash, {item} as id_pipeline_batch_item, doc_id as id_detection, case when doc_id % 83 = 0 then 'zz' else {moved} end as image_hash from documents",
        "image_embedding": "select vec_id as id_embedding, vec_id % 40 + 1 as id_pipeline_batch_item, vec_id as id_detection, embedding from embeddings",
        "deduped_hash": f"select doc_id + 1000 as hash_id, min(doc_id) over (partition by md5(text)) + 1000 as group_id, {item} as id_pipeline_batch_item, doc_id as id_detection from documents where doc_id % 37 <> 0",
        "deduped_embedding": f"select doc_id + 5000 as embedding_id, doc_id - doc_id % 4 + 5000 as group_id, {item} as id_pipeline_batch_item, doc_id as id_detection from documents where doc_id % 47 <> 0",
    }


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One relation, from the Parquet tables in a folder."""
    text = relations(Dialect(True))[name]
    general = {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("documents", "events", "embeddings") if f"from {t}" in text}
    for t in general:
        text = text.replace(f"from {t}", f"from <{t}>")
    # the braces of JSON text are not fields
    text = text.replace("{", "{{").replace("}", "}}")
    for t in general:
        text = text.replace(f"<{t}>", "{" + t + "}")
    return spark.sql(text, **general)


def prelude(*names: str) -> str:
    """WITH clause that gives DuckDB the relations named."""
    own = relations(Dialect(False))
    return "WITH " + ", ".join(f"{n} AS ({own[n]})" for n in names)
