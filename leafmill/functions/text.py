"""Text, JSON, date and number expressions. All are Column -> Column and stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """Number of words between runs of Unicode white space."""
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))


def strip_extension(name: Column) -> Column:
    """Up to the last dot: a.b.jpg -> a.b."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def first_part(name: Column) -> Column:
    """Up to the first dot: a.b.jpg -> a."""
    return F.substring_index(name, ".", 1)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def slug(label: Column) -> Column:
    """Name of an export split: lower case, blanks and slashes to underscores; nothing is "unknown"."""
    made = F.replace(F.replace(F.lower(label), F.lit("/"), F.lit("_")), F.lit(" "), F.lit("_"))
    return F.when(F.coalesce(label, F.lit("")) == "", F.lit("unknown")).otherwise(made)


def clip(text: Column, most: int) -> Column:
    """The first characters and an ellipsis, if there are more."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit("..."))).otherwise(text)


def blank(text: Column) -> Column:
    """No text: null, empty or white space only."""
    return F.coalesce(F.trim(text), F.lit("")) == ""


def without_scan_suffix(name: Column) -> Column:
    return F.regexp_replace(name, r"\.(?:jp2|tiff?)", "")


def is_image(path: Column, fold_case: bool = False) -> Column:
    """Page images by suffix. The suffix's case counts unless folded."""
    return (F.lower(path) if fold_case else path).rlike(r"\.(?:jpg|tif|tiff|jp2)$")


def vector(text: Column) -> Column:
    """Numbers of "[1,2]", "{1,2}" or "1,2"."""
    return F.transform(F.split(F.regexp_replace(text, r"[\[\]{}\s]", ""), ","), lambda x: x.try_cast("double"))


def year(date: Column) -> Column:
    """Year of the first four characters, if from 1400 to 2100."""
    y = F.substring(date.cast("string"), 1, 4).try_cast("int")
    return F.when(y.between(1400, 2100), y)


def minutes(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 6e7


def ago(then: Column, now: Column) -> Column:
    """3 days ago, 2 hours ago, ... in whole units."""
    s = F.unix_timestamp(now) - F.unix_timestamp(then)
    unit = lambda n, name: F.concat(F.floor(s / n).cast("string"), F.lit(f" {name}"), F.when(F.floor(s / n) == 1, "").otherwise("s"), F.lit(" ago"))
    return F.when(s < 60, F.lit("just now")).when(s < 3600, unit(60, "minute")).when(s < 86400, unit(3600, "hour")).otherwise(unit(86400, "day"))


def metadata(json: Column, field: str) -> Column:
    """A field of an object that may be missing, null or no JSON at all; null and empty are null."""
    got = F.get_json_object(json, f"$.{field}")
    return F.when(F.coalesce(got, F.lit("")) != "", got)


def half_even(x: Column) -> Column:
    """Nearest integer, halves to the even one."""
    return F.bround(x).cast("bigint")


def shard_name(split: Column, at: Column, of: Column) -> Column:
    """split-00001-of-00042.parquet"""
    return F.format_string("%s-%05d-of-%05d.parquet", split, at.cast("int"), of.cast("int"))


def prompt(language: Column, context: Column) -> Column:
    """Instruction for a captioner, in the language named."""
    head = F.format_string("Describe this element of a scanned book page in one or two sentences, in %s.", F.coalesce(language, F.lit("English")))
    return F.when(blank(context), head).otherwise(F.concat(head, F.lit(" Text of the page: "), context))
