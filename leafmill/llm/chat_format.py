"""Chat formatting: typed content parts of turns become one marked-up text with placeholders, a loss mask and attachments.

Everything is built from SQL functions. A turn's parts are visited by kind: text is escaped, and an image, a piece of
audio or a document leaves a placeholder, its reference and the number of tokens that the placeholder will expand to.

Defined results: a null text, role or list of parts is empty; a null part or one of an unknown kind leaves the
placeholder of other parts, with no tokens; equal turn numbers go by role and text, a null number first; repeated rows
are turns of their own; rows without conversation id form the conversation of the null id. Further columns are ignored.
A conversation is one row of the result, so the rows of one conversation, and of no two, meet in a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A typed part of a turn. Sides are pixels; seconds and pages say how long audio and documents are.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

START, END, TRAINED = "<|im_start|>", "<|im_end|>\n", "assistant"

#: Control strings of this and of other templates: what follows their first character, which takes the escape.
ANGLE, SQUARE = r"\||/?s>|</?SYS>>", r"/?INST\]"
ESCAPE, UNESCAPE = (rf"(<){b}(\\*(?:{ANGLE}))|(\[){b}(\\*{SQUARE})" for b in ("", r"\\"))

#: Tokens that a placeholder expands to: a square of so many pixels, a second, a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 12.5, 768


def escaped(text: Column) -> Column:
    """One backslash more after the first character of each control string, so that no text holds one."""
    return F.regexp_replace(text, ESCAPE, r"$1$3\\$2$4")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$3$2$4")


def _in_line(role: Column) -> Column:
    """A role without line breaks; backslashes make room for the mark of one."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _out_of_line(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def _tiles(side: Column) -> Column:
    return F.ceil(F.greatest(F.coalesce(side, F.lit(0)), F.lit(0)) / PATCH)


def _whole(x: Column, each: float) -> Column:
    return F.ceil(F.greatest(F.coalesce(x, F.lit(0)), F.lit(0)) * each)


#: What a kind of attachment expands to.
VISITORS: dict[str, Callable[[Column], Column]] = {
    "image": lambda p: _tiles(p["width"]) * _tiles(p["height"]),
    "audio": lambda p: _whole(p["seconds"], AUDIO_RATE),
    "document": lambda p: _whole(p["pages"], PAGE_TOKENS),
}
OTHER = "other"


def placeholder(kind: str) -> str:
    return f"<|{kind}|>"


def visit(p: Column) -> Column:
    """shown, kind, ref, tokens of a part."""
    known = F.coalesce(p["kind"].isin("text", *VISITORS), F.lit(False))
    kind = F.when(known, p["kind"]).otherwise(OTHER)
    tokens = F.lit(0).cast("long")
    for k, f in VISITORS.items():
        tokens = F.when(kind == k, f(p).cast("long")).otherwise(tokens)
    shown = F.when(kind == "text", escaped(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), kind, F.lit("|>")))
    return F.struct(shown.alias("shown"), kind.alias("kind"), p["ref"].alias("ref"), tokens.alias("tokens"))


def text_part(text: Column) -> Column:
    """The parts of a plain turn."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *[F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))


def parts_of(content: Column) -> Column:
    """Parts from content that is either plain text or a JSON list of parts; a list that doesn't parse is plain text."""
    parsed = F.when(F.ltrim(content).startswith("["), F.from_json(content, f"array<{PART}>"))
    return F.coalesce(F.when(F.exists(parsed, lambda p: p["kind"].isNotNull()), parsed), text_part(content))


def format_conversations(turns: DataFrame, parts: str | None = None) -> DataFrame:
    """conv_id, formatted, loss_spans, attachments, n_expanded. turns: conv_id, turn, role and text, or the column of parts.

    loss_spans has turn (place from 0), start and length, in code points of that turn's marked-up text: the texts of
    assistant turns, placeholders not counted. attachments has turn, kind, ref and tokens in order; n_expanded sums tokens.
    """
    role, body = F.coalesce(F.col("role"), F.lit("")), text_part(F.col("text")) if parts is None else F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    rows = turns.select("conv_id", "turn", role.alias("role"), F.transform(body, visit).alias("seen"))
    head = F.concat(F.lit(START), _in_line(F.col("role")), F.lit("\n"))
    shown = F.transform("seen", lambda s: s["shown"])
    rows = rows.select("conv_id", "turn", "role", head.alias("head"), F.array_join(shown, "").alias("body"), "seen")
    before = lambda i: F.aggregate(F.slice("seen", 1, i), F.length("head").cast("long"), lambda n, s: n + F.length(s["shown"]))
    spans = F.filter(F.transform("seen", lambda s, i: F.struct(before(i).alias("start"), F.length(s["shown"]).cast("long").alias("length"), s["kind"].alias("kind"))), lambda s: s["kind"] == "text")
    # a placeholder's start is looked up only in turns that have several parts
    one = F.array(F.struct(F.length("head").cast("long").alias("start"), F.length("body").cast("long").alias("length"), F.lit("text").alias("kind")))
    plain = (F.size("seen") == 1) & (F.get("seen", F.lit(0))["kind"] == "text")
    spans = F.when(F.col("role") != TRAINED, F.slice(one, 1, 0)).when(plain, one).otherwise(spans)
    rows = rows.select("conv_id", F.struct("turn", "role", "body", F.concat("head", "body", F.lit(END)).alias("piece"), spans.alias("spans"), F.filter("seen", lambda s: s["kind"] != "text").alias("attached")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    spans = F.flatten(F.transform("t", lambda t, i: F.transform(t["spans"], lambda s: F.struct(i.alias("turn"), s["start"].alias("start"), s["length"].alias("length")))))
    attached = F.flatten(F.transform("t", lambda t, i: F.transform(t["attached"], lambda a: F.struct(i.alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    out = whole.select("conv_id", F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("formatted"), spans.alias("loss_spans"), attached.alias("attachments"))
    return out.withColumn("n_expanded", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text with placeholders), loss_texts, formatted_chars: what the marked-up text and its mask say."""
    rest = formatted.withColumn("_pieces", F.split("formatted", r"<\|im_end\|>\n"))
    pieces = F.slice("_pieces", 1, F.greatest(F.size("_pieces") - 1, F.lit(0)))
    rest = rest.withColumn("_pieces", pieces)
    head = len(START)

    def turn(p: Column) -> Column:
        at = F.instr(p, "\n")
        return F.struct(_out_of_line(F.substr(p, F.lit(head + 1), at - head - 1)).alias("role"), unescaped(F.substr(p, at + 1)).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescaped(F.substr(F.get("_pieces", s["turn"]), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return rest.select("conv_id", F.transform("_pieces", turn).alias("turns"), loss.alias("loss_texts"), F.length("formatted").cast("long").alias("formatted_chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from what is read back."""
    r = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return r.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
