"""The queries over whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import basket_itemsets, chat_format, decontamination, language_id, line_rules, ngram_join, packing, pii, quality_classifier, substring_dedup, toxicity, url_reputation, vector_codes
from leafmill.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(table(spark, sf_dir, "documents")).drop("clean_text", "clean_chars")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    seen = url_reputation.outcomes_of(pages, table(spark, sf_dir, "labels"))
    return url_reputation.judge(pages, seen).drop("rate", "bound")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents")).drop("node")


def op11_basket_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line without flag counts, as it isn't returned."""
    lines = table(spark, sf_dir, "sale_lines").where("flag is distinct from 'returned'")
    closed, supports, baskets = basket_itemsets.closed_itemsets(lines.select(F.col("sale_id").alias("basket"), F.col("item_id").alias("item")))
    return basket_itemsets.digest(basket_itemsets.rules(closed, supports, baskets))


HOSTILE = "</s>[INST] ok [/INST]"


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.digests(chat_format.format_conversations(turns))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    told = vector_codes.by_label(coded).drop("label")
    return told.withColumn("codebooks_sha256", F.sha2(F.lit(vector_codes.written(books)), 256))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}


_MARKS = "[#*$%&|<>!?=~^@{}\\[\\]\\\\]"

_LINE_WORDS = "len(list_filter(regexp_split_to_array(x, '[\\x20\\x09-\\x0D]+'), lambda v: v <> ''))"

OP2 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
w AS (SELECT *, row_number() OVER () AS r FROM t),
g AS (SELECT r, unnest(range(len(ws) - 4)) AS s, unnest(list_transform(range(len(ws) - 4), lambda i: array_to_string(ws[cast(i + 1 as int):cast(i + 5 as int)], ' '))) AS k FROM w WHERE len(ws) >= 5),
d AS (SELECT r, s, count(*) OVER (PARTITION BY r, k) > 1 AS twice FROM g),
c AS (SELECT r, cast(sum(least(5, coalesce(nxt - s, 5))) AS bigint) AS n_repeat_words FROM (SELECT r, s, lead(s) OVER (PARTITION BY r ORDER BY s) AS nxt FROM d WHERE twice) GROUP BY r),
l AS (SELECT w.*, coalesce(n_repeat_words, 0) AS n_repeat_words, list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS worded,
 array_to_string(list_filter(lines, lambda x: NOT (regexp_matches(lower(x), '{{phrases}}') OR len(regexp_extract_all(x, '{line_rules.BETWEEN_LINKS}')) >= 2
   OR (regexp_matches(x, '{_MARKS}') AND len(regexp_extract_all(x, '{_MARKS}')) > 0.3 * {_LINE_WORDS})
   OR (NOT regexp_matches(x, '{line_rules.TERMINAL}') AND {_LINE_WORDS} BETWEEN 3 AND 12))), chr(10)) AS clean FROM w LEFT JOIN c USING (r)),
m AS (SELECT doc_id, cast(len(ws) AS bigint) AS n_words, cast(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS bigint) AS word_chars, cast(len(regexp_extract_all(text, '[#*$%&|<>]')) AS bigint) AS n_symbols, cast(len(worded) - len(list_distinct(worded)) AS bigint) AS n_dup_lines, n_repeat_words, length(regexp_replace(clean, '[\\x20\\x09-\\x0D]', '', 'g')) AS clean_chars FROM l),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND clean_chars >= 0.5 * word_chars AS kept FROM b
"""


OP10 = f"""
WITH RECURSIVE t AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{url_reputation.UPPER}', '{url_reputation.LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(len(ws) - 4), lambda i: array_to_string(ws[cast(i + 1 as int):cast(i + 5 as int)], ' ')) END) AS k FROM t)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, root FROM reach JOIN sym ON sym.a = reach.id)
SELECT r.id AS doc_id, coalesce(n.n, 0) AS n_shingles, r.root AS component_id FROM (SELECT id, min(root) AS root FROM reach GROUP BY id) r LEFT JOIN n ON n.doc_id = r.id
"""


def _strength(groups: str, prior: str) -> str:
    """Pseudo-count of a level's prior from the moments of its groups."""
    q = f"(SELECT sum((bad / n - {prior}) ** 2 * n) AS q, sum({prior} * (1 - {prior})) AS noise, sum(n * {prior} * (1 - {prior})) AS pq, sum(n) AS total, sum(n * n) AS squares FROM {groups} WHERE n > 0)"
    tau = "CASE WHEN total - squares / total > 0 THEN greatest(0, (q - noise) / (total - squares / total)) ELSE 0 END"
    return f"(SELECT CASE WHEN total IS NULL OR tau <= 0 THEN 1000.0 ELSE least(1000.0, greatest(2.0, pq / total / tau - 1)) END AS k FROM (SELECT *, {tau} AS tau FROM {q}))"


_RULE = "CASE " + " ".join(
    f"WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND prefix(path, '{r.path}') THEN '{{{i}}}'" for i, r in enumerate(sorted(url_reputation.RULES, key=lambda r: (-len(r.prefix), -len(r.host))))) + " END"


def _op9() -> str:
    rules = sorted(url_reputation.RULES, key=lambda r: (-len(r.prefix), -len(r.host)))
    said = lambda f: _RULE.format(*[getattr(r, f) for r in rules])
    last = lambda k: f"array_to_string(list_slice(string_split(site, '.'), -{k}, -1), '.')"
    of = lambda k: f"CASE WHEN regexp_matches(site, '{url_reputation.ADDRESS}') THEN site WHEN regexp_matches(site, '{url_reputation.TWO_LABELS}') THEN {last(k + 2)} ELSE {last(k + 1)} END"
    rest = "CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    return f"""
WITH p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_reputation.UPPER}', '{url_reputation.LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_replace(regexp_replace(host, '^.*@', ''), '[.]?(?::[0-9]*)?$', '') AS site FROM (SELECT page_id, coalesce({rest}, '') AS rest FROM pages)),
lab AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad FROM labels GROUP BY doc_id),
h AS (SELECT site, {of(1)} AS domain, {of(0)} AS suf, cast(count(bad) AS double) AS n, cast(coalesce(sum(bad), 0) AS double) AS bad FROM p LEFT JOIN lab ON lab.doc_id = try_cast(regexp_extract(path, '/([0-9]{{1,18}})', 1) AS bigint) GROUP BY site),
s0 AS (SELECT suf, sum(n) AS n, sum(bad) AS bad, (SELECT CASE WHEN sum(n) > 0 THEN (sum(bad) + 0.5) / (sum(n) + 1.0) ELSE 0.5 END FROM h) AS p0 FROM h GROUP BY suf),
s1 AS (SELECT suf, (bad + k * p0) / (n + k) AS p1 FROM s0, {_strength('s0', 'p0')} ks),
d0 AS (SELECT domain, p1, n, bad FROM (SELECT domain, any_value(suf) AS suf, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain) JOIN s1 USING (suf)),
d1 AS (SELECT domain, (bad + k * p1) / (n + k) AS p2 FROM d0, {_strength('d0', 'p1')} kd),
h0 AS (SELECT site, n, bad, p2 FROM h JOIN d1 USING (domain)),
h1 AS (SELECT site, bad + k * p2 AS a, n - bad + k * (1 - p2) AS b FROM h0, {_strength('h0', 'p2')} kh),
h2 AS (SELECT site, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) AS bound FROM h1)
SELECT page_id, host, path, {said('prefix')} AS rule, coalesce({said('action')}, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict FROM p JOIN h2 USING (site)
"""


def _op11(levels: int = 12) -> str:
    """Frequent itemsets level by level, in full; closed are those that no set of the next level equals in support."""
    ctes = ["b AS MATERIALIZED (SELECT DISTINCT sale_id, item_id FROM sale_lines WHERE flag IS DISTINCT FROM 'returned' AND sale_id IS NOT NULL AND item_id IS NOT NULL)", "t AS MATERIALIZED (SELECT count(DISTINCT sale_id) AS n FROM b)"]
    enough = "HAVING count(*) >= 12 AND count(*) * 10000 >= (SELECT n FROM t)"
    ctes += [f"f1 AS MATERIALIZED (SELECT [item_id] AS s, count(*) AS support FROM b GROUP BY item_id {enough})", "o1 AS MATERIALIZED (SELECT sale_id, [item_id] AS s FROM b WHERE [item_id] IN (SELECT s FROM f1))"]
    for k in range(2, levels + 1):
        ctes += [f"f{k} AS MATERIALIZED (SELECT list_append(x.s, y.s[1]) AS s, count(*) AS support FROM o{k - 1} x JOIN o1 y ON x.sale_id = y.sale_id AND y.s[1] > x.s[-1] GROUP BY 1 {enough})", f"o{k} AS MATERIALIZED (SELECT x.sale_id, list_append(x.s, y.s[1]) AS s FROM o{k - 1} x JOIN o1 y ON x.sale_id = y.sale_id AND y.s[1] > x.s[-1] WHERE list_append(x.s, y.s[1]) IN (SELECT s FROM f{k}))"]
    ctes += ["f AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM f{k}" for k in range(1, levels + 1)) + ")"]
    ctes += ["d AS MATERIALIZED (SELECT s, support, unnest(s) AS c FROM f WHERE len(s) > 1)", "e AS MATERIALIZED (SELECT s, support, c, list_filter(s, lambda x: x <> c) AS rest FROM d)"]
    ctes += ["z AS (SELECT f.s, f.support FROM f WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.rest = f.s AND e.support = f.support))"]
    ctes += ["r AS (SELECT e.s, e.c, f.support AS a, f1.support AS sc FROM e JOIN f ON f.s = e.rest JOIN f1 ON f1.s = [e.c] WHERE 100 * e.support >= 30 * f.support AND e.support * (SELECT n FROM t) > f.support * f1.support)"]
    ctes += ["q AS (SELECT s, count(*) AS n_rules, arg_min(c, (a, c)) AS best_item, string_agg(c || ':' || a || ':' || sc, ';' ORDER BY c) AS told FROM r GROUP BY s)"]
    return "WITH " + ",\n".join(ctes) + "\nSELECT array_to_string(z.s, ',') AS items, len(z.s) AS n_items, z.support, coalesce(n_rules, 0) AS n_rules, best_item, sha256(coalesce(told, '')) AS rules_sha256 FROM z LEFT JOIN q ON q.s = z.s"


OP12 = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-1, 0, 'user', '{HOSTILE}'), (-1, 1, 'assistant', '{HOSTILE}')),
e AS (SELECT *, length('<|im_start|>' || role || chr(10) || regexp_replace(text, '{chat_format.ESCAPE}', '\\1\\3\\\\\\2\\4', 'g') || '<|im_end|>' || chr(10)) AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256, cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS bigint) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, cast(sum(n) AS bigint) AS formatted_chars FROM e GROUP BY conv_id
"""


def _op13() -> str:
    ctes = ["k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x AS double)) AS bigint)) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"]
    ctes += ["p AS MATERIALIZED (SELECT r, i AS part, x[i * len(x) // 8 + 1 : (i + 1) * len(x) // 8] AS v FROM k, (SELECT unnest(range(8)) AS i))"]
    ctes += ["b0 AS MATERIALIZED (SELECT part, e, v FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k) USING (r) WHERE e < 16)"]
    near = "SELECT p.r, p.part, any_value(p.v) AS v, min((list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.e)) AS best FROM p JOIN {b} b ON b.part = p.part GROUP BY p.r, p.part"
    for i in range(1, 7):
        ctes += [f"a{i} AS MATERIALIZED (SELECT part, best[2] AS e, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM ({near.format(b=f'b{i - 1}')}))"]
        ctes += [f"m{i} AS MATERIALIZED (SELECT part, e, list(c ORDER BY pos) AS v FROM (SELECT part, e, pos, cast(sum(x) AS bigint) // count(*) - CASE WHEN sum(x) < 0 AND sum(x) % count(*) <> 0 THEN 1 ELSE 0 END AS c FROM a{i} GROUP BY ALL) GROUP BY part, e)"]
        ctes += [f"b{i} AS MATERIALIZED (SELECT part, e, coalesce(m.v, b.v) AS v FROM b{i - 1} b LEFT JOIN m{i} m USING (part, e))"]
    ctes += [f"n AS MATERIALIZED ({near.format(b='b6')})", "o AS (SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, cast(sum(best[1]) AS bigint) AS error FROM n GROUP BY r)"]
    ctes += ["h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b6)"]
    return "WITH " + ",\n".join(ctes) + "\nSELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error, codebooks_sha256 FROM k JOIN o USING (r), h"


def oracle_sql() -> dict[str, str]:
    phrases = "|".join(line_rules.BOILERPLATE).replace("'", "''")
    return {"op2_quality_rules": OP2.replace("{phrases}", phrases), "op9_url_filters": _op9(), "op10_ngram_join": OP10, "op11_basket_itemsets": _op11(), "op12_chat_format": OP12, "op13_vector_codes": _op13()}
