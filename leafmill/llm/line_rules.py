"""Line-first cleaning and document quality rules [DataFrame operations only].

Rules look at one line at a time, in English, French, German and Spanish. Punctuation: a line with more odd marks than
its words bear, or a short one that ends in no mark at all, as headings and menus do. Navigation: a row of links between
bars, arrows or dots. Boilerplate: a fixed phrase of page furniture. Lines that fail are removed; a document is rejected
when what is left holds too small a part of the characters it had in words. Base counts (short texts, repeated five-word
windows) reject first.

Cases: null and empty texts have no words, so they fail the base rule and come back with empty clean text; a text
without line breaks is one line; repeated rows are judged each by itself; extra columns are ignored. Work is row by
row without a shuffle; a very long text costs one sort of its windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import SPACE, WORD

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\f\r"
#: Marks that running prose seldom has.
ODD = r"[#*$%&|<>!?=~^@{}\[\]\\]"
#: Marks a sentence or a part of one ends with, at the end of a line.
TERMINAL = r"[.!?…:;,\"»”’)\]][\x20\x09-\x0D]*\z"
#: The same marks, each for a cheap look at the very end.
ENDS = ".!?…:;,\"»”’)]"
#: What stands between links of a row.
LINK_SIGNS = "|>·»•›→"
BETWEEN_LINKS = f"[{LINK_SIGNS}]"
#: Fixed phrases of page furniture, in lower case: English, French, German, Spanish.
BOILERPLATE = [
    "lorem ipsum", "javascript", "cookie", "privacy policy", "terms of use", "terms of service", "all rights reserved", "click here", "sign in", "log in", "read more", "share this", "subscribe", "newsletter",
    "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "mentions légales", "cliquez ici", "lire la suite", "abonnez-vous", "se connecter",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "impressum", "hier klicken", "weiterlesen", "jetzt abonnieren", "jetzt anmelden",
    "todos los derechos reservados", "política de privacidad", "condiciones de uso", "aviso legal", "haga clic", "leer más", "suscríbete", "iniciar sesión",
]
ODD_PER_WORD, LINK_MARKS, BARE_WORDS, KEEP_SHARE = 0.3, 2, (3, 12), 0.5


def let(value: Column, body) -> Column:
    """body(value) with value worked out once: a lambda's variable is bound, an expression would be run for each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without(text: Column, which: str) -> Column:
    for c in which:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def chars_of(text: Column, which: str) -> Column:
    return F.length(text) - F.length(without(text, which))


def in_words(text: Column) -> Column:
    return F.length(without(text, WHITE))


def words_in(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_words(ws: Column, width: int = 5) -> Column:
    """Words that lie in a window of so many words which occurs at least twice."""

    def covered(starts: Column) -> Column:
        # what a start adds is the way to the next one, at most the width
        gaps = F.zip_with(starts, F.slice(starts, F.lit(2), F.greatest(F.size(starts), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)

    def starts(s: Column) -> Column:
        # s: windows by (hash, place); a window is repeated if a neighbour has its hash
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def hashes(w: Column) -> Column:
        # sequence() runs backwards when its end is below its start, hence the guard outside
        return F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

    def count(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(placed, lambda s: let(starts(s), covered)))

    return F.when(F.size(ws) < width, F.lit(0).cast("long")).otherwise(let(ws, lambda w: let(hashes(w), count)))


def line_fails(line: Column) -> Column:
    """True for a line to remove."""
    either = lambda tests: reduce(lambda a, b: a | b, tests)
    boiler = let(F.lower(line), lambda low: either(low.contains(phrase) for phrase in BOILERPLATE))
    odd = line.rlike(ODD) & (F.regexp_count(line, F.lit(ODD)) > ODD_PER_WORD * F.size(words_in(line)))
    # the patterns are dear: what comes before them settles most lines
    ends = either(line.endswith(mark) for mark in ENDS) | line.rlike(TERMINAL)
    bare = ~ends & F.size(words_in(line)).between(*BARE_WORDS)
    links = either(line.contains(sign) for sign in LINK_SIGNS) & (F.regexp_count(line, F.lit(BETWEEN_LINKS)) >= LINK_MARKS)
    return odd | links | bare | boiler


def judge(documents: DataFrame, repeat_percent: int = 20, least_words: int = 10, keep_share: float = KEEP_SHARE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, clean_text, clean_chars."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n")
    worded = lambda a: F.filter(a, lambda x: x.rlike(WORD))
    ws = words_in(text)
    base = documents.select(
        "doc_id", in_words(text).cast("long").alias("word_chars"), chars_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        let(worded(lines), lambda w: (F.size(w) - F.size(F.array_distinct(w))).cast("long")).alias("n_dup_lines"),
        let(ws, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))).alias("w"),
        let(F.array_join(F.filter(lines, lambda x: ~line_fails(x)), "\n"), lambda c: F.struct(c.alias("text"), in_words(c).cast("long").alias("chars"))).alias("c"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    out = base.select("doc_id", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("w.r").alias("n_repeat_words"), F.col("c.text").alias("clean_text"), F.col("c.chars").alias("clean_chars"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("clean_chars") >= keep_share * F.col("word_chars")))
