"""A corpus from raw documents to packed sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import decontamination, language_id, ngram_join, packing, pii
from leafmill.llm.common import fold, table
from leafmill.sources.staging import release, staged

#: A text whose best cosine is below this resembles no learned language.
LEAST_SCORE = 0.05
#: Bits of the bitmap of ids that may go: 2 MB, in words of 64.
MARKS = 1 << 24


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of no learned language go; a missing lang is filled in."""
    langs, prototypes = language_id.train(docs.where(fold("doc_id", 5) != 0))
    told = language_id.annotate(docs, langs, prototypes).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each linked group stays. Rows that repeat an id are one document, of which the least row
    (by its columns in order, nulls first) stays; rows without id stay."""
    told = ngram_join.similar(docs).where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.col("doc_id") == F.col("component_id")).alias("first"))
    told = staged(told.select("doc_id", "n", "first", (F.col("first") & (F.col("n") == 1)).alias("stays")), "told")
    # texts aren't dealt to be told that they stay: a bitmap that every other id is in lets most of them pass as they are read
    words = staged(told.where("not stays").select(_mark("doc_id").alias("bit")).groupBy(F.floor(F.col("bit") / 64).alias("mark_word")).agg(F.expr("bit_or(shiftleft(1L, int(bit % 64)))").alias("mark_bits")), "marks")
    alike = staged(_marked(told.where("stays").select("doc_id"), words, True), "alike")
    repeated = staged(told.where("first and n > 1").select("doc_id"), "repeated")
    release(told)
    kept, rest = _marked(docs, words, False), _marked(docs, words, True)
    copies = rest.join(repeated, "doc_id", "left_semi")
    least = copies.groupBy("doc_id").agg(F.min(F.struct(*[c for c in docs.columns if c != "doc_id"])).alias("r")).select("doc_id", "r.*").select(*docs.columns)
    return kept.unionByName(rest.join(alike, "doc_id", "left_semi").select(*docs.columns)).unionByName(least)


def _mark(key: str) -> Column:
    """An id's place in the bitmap; null for null."""
    number = F.col(key).try_cast("long")
    return F.when(number.isNotNull(), F.pmod(F.xxhash64(number), F.lit(MARKS)))


def _marked(rows: DataFrame, words: DataFrame, is_in: bool) -> DataFrame:
    """The rows whose doc_id is in the bitmap, as some others seem to be, or the rest. At most MARKS / 64 words are broadcast."""
    found = rows.join(F.broadcast(words), F.floor(_mark("doc_id") / 64) == F.col("mark_word"), "left")
    hit = F.coalesce(F.getbit("mark_bits", (_mark("doc_id") % 64).cast("int")) == 1, F.lit(False))
    return found.where(hit if is_in else ~hit).select(*rows.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def anonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to surrogates."""
    return pii.replace_entities(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [("language_id", identify), ("ngram_join", deduplicate), ("decontamination", decontaminate), ("pii", anonymise), ("packing", pack)]

#: Language profiles, similarity links, edit search and bin packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
