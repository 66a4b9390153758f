"""Language of a text by its function words, as a column expression."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

#: ISO 639-3 code -> frequent function words (fixed values).
FUNCTION_WORDS = {
    "eng": "the of and to in is that was for with on as are this be by not from at it which or an have were their has".split(),
    "fra": "le la les des et du une est que qui dans pour sur pas au avec ce il elle sont par plus ne se aux cette".split(),
    "deu": "der die und das den von zu mit ist ein eine nicht auf dem des im für sich auch als wie nach bei sind wird war".split(),
    "spa": "el los las del que una por con para su al lo como más pero sus le ya este entre cuando muy sin sobre es".split(),
    "ita": "il che di la per una è con non del sono da gli della nel anche alla dei più questo come si le ma delle".split(),
    "por": "o os as que uma para com não do da em por mais dos como mas foi ao ele das tem à seu sua".split(),
    "nld": "de het een en van dat niet te zijn met op voor aan er om dan als ook maar bij uit nog naar wordt".split(),
    "lat": "et in est non ad cum ut sed qui quae quod ex si per ab atque etiam autem enim esse sunt nec".split(),
}
#: A text is told when so many of its words are function words of a language, and more than of any other.
LEAST_WORDS = 2


def detected(text: Column) -> Column:
    """ISO 639-3 code, or null for a blank text, too few function words or a tie."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+")

    def told(ws: Column) -> Column:
        among = lambda own: lambda w: w.isin(*own)
        counts = {code: F.size(F.filter(ws, among(own))) for code, own in FUNCTION_WORDS.items()}
        entries = F.sort_array(F.array(*[F.struct(n.alias("n"), F.lit(code).alias("code")) for code, n in counts.items()]), asc=False)
        best = lambda e: F.when((F.get(e, F.lit(0))["n"] >= LEAST_WORDS) & (F.get(e, F.lit(0))["n"] > F.get(e, F.lit(1))["n"]), F.get(e, F.lit(0))["code"])
        return F.element_at(F.transform(F.array(entries), best), 1)

    return F.element_at(F.transform(F.array(words), told), 1)


def detected_sql(text: str) -> str:
    """The same in DuckDB SQL."""
    ws = f"regexp_split_to_array(lower(coalesce({text}, '')), '[^\\p{{L}}]+')"
    quoted = lambda own: ", ".join(f"'{w}'" for w in own)
    counts = ", ".join(f"{{'n': len(list_filter({ws}, lambda w: w IN ({quoted(own)}))), 'code': '{code}'}}" for code, own in FUNCTION_WORDS.items())
    return f"(SELECT CASE WHEN e[1].n >= {LEAST_WORDS} AND e[1].n > e[2].n THEN e[1].code END FROM (SELECT list_reverse_sort([{counts}]) AS e))"
