"""Business rules of enrichment and export as expressions."""

from __future__ import annotations

from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Class names as predicted and as shown, the order of a classifier's probabilities, orientation labels.
CLASS_LABELS = {
    "Other": "Other",
    "Image or Illustration": "Image/Illustration",
    "Ex Libris or Decorative": "Ex Libris/Decorative",
    "Music": "Music",
    "Chart or Graph": "Chart/Graph",
    "Artifact": "Artifact",
}
PROBABILITY_LABELS = ["Artifact", "Chart/Graph", "Ex Libris/Decorative", "Image/Illustration", "Music"]
ORIENTATION_LABELS = ["upright", "rotate_90_cw", "rotate_180", "rotate_90_ccw"]
UNCAPTIONED_CLASSES = ["Ex Libris or Decorative", "Artifact"]
UNCAPTIONED_LABELS = ["Artifact", "Ex Libris/Decorative"]
CLASS_THRESHOLD, MUSIC_THRESHOLD, DETECTION_THRESHOLD, ORIENTATION_THRESHOLD = 0.70, 0.99, 0.75, 0.99
FAILED = "CAPTION FAILED"
#: Language names to ISO 639-3, for the languages a caption is asked for in.
LANGUAGES = {
    "English": "eng", "French": "fra", "German": "deu", "Spanish": "spa", "Italian": "ita", "Latin": "lat", "Russian": "rus", "Portuguese": "por",
    "Dutch": "nld", "Danish": "dan", "Swedish": "swe", "Norwegian": "nor", "Polish": "pol", "Czech": "ces", "Hungarian": "hun", "Greek": "ell",
    "Hebrew": "heb", "Arabic": "ara", "Japanese": "jpn", "Chinese": "zho",
}


@cache
def codes() -> dict[str, str]:
    """Two-letter code -> ISO 639-3, of all languages that the JVM knows."""
    locale = SparkContext._active_spark_context._jvm.java.util.Locale
    return {c: locale(c).getISO3Language() for c in locale.getISOLanguages()}


@cache
def language_names() -> dict[str, str]:
    """English name, two-letter or three-letter code -> ISO 639-3: the fixed names first, then those that the JVM knows."""
    locale = SparkContext._active_spark_context._jvm.java.util.Locale
    named = {locale(c).getDisplayLanguage(locale.ENGLISH): three for c, three in codes().items()}
    return named | codes() | {three: three for three in codes().values()} | LANGUAGES


def lookup(table: dict[str, str], key: Column, default: Column | None = None) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    got = F.try_element_at(m, key)
    return got if default is None else F.coalesce(got, default)


def class_label(pred_class: Column, confidence: Column, threshold: float = CLASS_THRESHOLD) -> Column:
    """Label shown: Other below the threshold; a null confidence keeps the class; no class is null."""
    kept = F.when(confidence < threshold, F.lit("Other")).otherwise(pred_class)
    return F.when(F.coalesce(kept, F.lit("")) != "", lookup(CLASS_LABELS, kept, kept))


def caption(text: Column, label: Column) -> Column:
    """Text to export: a caption that could not be made is marked, unless the (thresholded) class has none."""
    empty = F.coalesce(text, F.lit("")) == ""
    return F.when(~empty, F.when(text.isin("Undetermined", "Undetermined."), F.lit(FAILED)).otherwise(text)).when(F.coalesce(label.isin(*UNCAPTIONED_LABELS), F.lit(False)), F.lit(None)).otherwise(F.lit(FAILED))


def if_captioned(exported: Column, value: Column) -> Column:
    return F.when(exported != FAILED, value)


def language_code(name: Column) -> Column:
    """ISO 639-3 of a language's English name or code; null for an unknown one."""
    return lookup(language_names(), name)


def language_name(code: Column) -> Column:
    """Name of a code; English for any other."""
    named = {v: k for k, v in language_names().items() if len(k) > 3 or k in LANGUAGES}
    return lookup(named | {v: k for k, v in LANGUAGES.items()}, code, F.lit("English"))


def music(label: Column, confidence: Column, language: Column, text: Column, keywords: dict[str, list[str]], threshold: float = MUSIC_THRESHOLD) -> Column:
    """Music stays so when certain, or when its caption holds a keyword of its language; else it is Other."""
    lists = F.create_map(*[x for k, v in keywords.items() for x in (F.lit(k), F.array(*[F.lit(w.lower()) for w in v]))]) if keywords else None
    low = F.lower(text)
    found = F.exists(F.try_element_at(lists, language), lambda w: F.contains(low, w)) if lists is not None else F.lit(False)
    kept = F.coalesce(confidence > threshold, F.lit(False)) | F.coalesce(found & (text != ""), F.lit(False))
    return F.when(label == "Music", F.when(kept, F.lit("Music")).otherwise(F.lit("Other"))).otherwise(label)


def probabilities(probs: Column, labels: list[str] = PROBABILITY_LABELS) -> Column:
    """Structs (label, prob) by falling probability, ties by place; null unless there is one for each label."""
    names = F.array(*map(F.lit, labels))
    placed = F.transform(probs, lambda p, i: F.struct((-p.cast("double")).alias("k"), i.alias("i"), F.get(names, i).alias("label"), p.cast("double").alias("prob")))
    return F.when(F.size(probs) == len(labels), F.transform(F.sort_array(placed), lambda x: F.struct(x["label"].alias("label"), x["prob"].alias("prob"))))


def orientation(probs: Column, threshold: float = ORIENTATION_THRESHOLD) -> Column:
    """Likeliest label if it is likely enough, else upright."""
    return F.when(F.array_max(probs) >= threshold, F.get(F.array(*map(F.lit, ORIENTATION_LABELS)), F.array_position(probs, F.array_max(probs)).cast("int") - 1)).otherwise(F.lit("upright"))


def rotates(label: Column, correction: Column, classes: list[str] | None = None) -> Column:
    """Whether a crop is turned on export: its correction isn't upright, and its class is among those given."""
    turned = F.coalesce(correction != "upright", F.lit(False))
    return turned if classes is None else turned & F.coalesce(label.isin(*classes), F.lit(False))


def batch_status(started: Column, ended: Column, crashed: Column) -> Column:
    return F.when(ended.isNotNull() & ~F.coalesce(crashed, F.lit(False)), "COMPLETED").when(F.coalesce(crashed, F.lit(False)), "CRASHED").when(started.isNotNull(), "RUNNING/LOCKED").otherwise("PENDING")


def batch_available(started: Column, ended: Column, crashed: Column, now: Column, timeout_seconds: int, ignore_locks: bool = False) -> Column:
    """A batch may be taken when it isn't finished, and nobody holds it or its holder's time is over (whole days count)."""
    done = ended.isNotNull() & ~F.coalesce(crashed, F.lit(False))
    stale = (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(started.cast("timestamp"))) > timeout_seconds
    return ~done & (F.lit(ignore_locks) | started.isNull() | F.coalesce(crashed, F.lit(False)) | F.coalesce(stale, F.lit(False)))


def megapixels(width: Column, height: Column) -> Column:
    return width * height / 1_000_000


def crop_box(xyxy: Column, width: Column, height: Column) -> Column:
    """Rounded box within the page: x1, y1, x2, y2."""
    at = lambda i, most: F.greatest(F.lit(0), F.least(F.bround(F.get(xyxy, F.lit(i))).cast("int"), most))
    return F.when(F.size(xyxy) == 4, F.struct(at(0, width).alias("x1"), at(1, height).alias("y1"), at(2, width).alias("x2"), at(3, height).alias("y2")))


def linear_probability(logprobs: Column) -> Column:
    """exp of the mean log-probability of a JSON list of tokens; entries without a number don't count."""
    values = F.filter(F.transform(F.from_json(logprobs, "array<struct<logprob:double>>"), lambda x: x["logprob"]), lambda x: x.isNotNull())
    return F.when(F.size(values) > 0, F.exp(F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)))


def thesaurus_json(matches: Column) -> Column:
    """JSON text of matches; null for nothing, the word null and an empty object."""
    return F.when(~F.coalesce(matches, F.lit("")).isin("", "null", "{}"), matches)
