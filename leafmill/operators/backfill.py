"""Caption features: thesaurus matches, linear probability, language, token counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import languages, rules, text, thesaurus, tokens

def thesaurus_matches(caption: DataFrame, thesaurus_: DataFrame, key: str = "id_caption") -> DataFrame:
    """key, thesaurus_matches: map of category to map of term to count; captions without a match have no row."""
    return caption.select(key, thesaurus.matches(F.col("text"), thesaurus_).alias("thesaurus_matches")).where("thesaurus_matches is not null")


def thesaurus_counts(caption: DataFrame, thesaurus_: DataFrame, key: str = "id_caption") -> DataFrame:
    """key, category, term, n."""
    by = thesaurus_matches(caption, thesaurus_, key).select(key, F.explode("thesaurus_matches").alias("category", "own"))
    return by.select(key, "category", F.explode("own").alias("term", "n")).groupBy(key, "category", "term").agg(F.sum("n").alias("n"))


def backfill(caption: DataFrame, thesaurus_: DataFrame | None = None, detect: Callable[[Column], Column] | None = None, force: bool = False, limit: int | None = None) -> DataFrame:
    """caption with lang_detected, linear_prob and thesaurus_matches (JSON) worked out where pending.

    detect gives ISO 639-3 codes for a column of texts, as a detector of trigram profiles does; without it, function words decide. Blank texts and unsure ones are
    null. Rows that aren't pending pass through.
    """
    todo = F.lit(True) if force else F.col("lang_detected").isNull()
    pending = caption.where(todo) if limit is None else caption.where(todo).limit(limit)
    rest = caption.where(~todo) if limit is None else caption.join(pending.select("id_caption"), "id_caption", "left_anti")
    out = pending.withColumn("linear_prob", rules.linear_probability(F.col("logprobs")))
    found = (languages.detected if detect is None else detect)(F.col("text"))
    out = out.withColumn("lang_detected", F.when(~text.blank(F.col("text")), found))
    if thesaurus_ is not None:
        out = out.withColumn("thesaurus_matches", F.to_json(thesaurus.matches(F.col("text"), thesaurus_)))
    return out.select(*caption.columns).unionByName(rest.select(*caption.columns))


def token_counts(df: DataFrame, column: str = "text", encode: Callable[[list[str]], list[int]] | None = None, vocabulary: str | None = None) -> DataFrame:
    """df with n_tokens, null for no text. vocabulary: a tokenizer's JSON file; encode gives counts of texts in its place."""
    return df.withColumn("n_tokens", tokens.token_count(F.col(column), vocabulary, encode))


def word_counts(df: DataFrame, column: str = "text") -> DataFrame:
    """df with n_words, null for no text."""
    return df.withColumn("n_words", F.when(F.coalesce(column, F.lit("")) != "", text.words(F.col(column))).cast("long"))
