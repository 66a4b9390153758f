"""URL filtering by host reputation under empirical-Bayes shrinkage [DataFrame operations only].

Labelled outcomes (1 = bad page) are counted per host. The bad rate of a public suffix is shrunk to the global
rate, that of a registered domain to its suffix, that of a host to its domain, each by a beta-binomial prior whose
strength comes from the moments of the groups below it. A host is blocked when the lower end of its posterior's
credible bound lies above the threshold, so hosts with few labels are never blocked by bad luck alone.

The site whose reputation counts is the host without user, port and last dot. Its public suffix is the last label, or
the last two where the first of them is one that registries of countries sell under (co.uk, com.au) or the two are a
hoster's (github.io); the registered domain has one label more. An IP address is its own domain and suffix.

Cases: a url that is null or lacks "://" has empty host and path, and takes the verdict of the empty host; repeated
pages each get a row and each count; null outcomes count nowhere; with no outcomes at all every page is allowed;
columns other than the ones named are ignored, so clashing names do no harm; empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.sources.staging import staged

#: Labels below a country's that domains are registered under, and suffixes of hosters: fixed values.
SECOND_LEVEL = "ac asn co com edu go gob gouv gov gv id info ltd me mil ne net nhs nom or org plc sch".split()
HOSTERS = "appspot.com blogspot.com github.io gitlab.io herokuapp.com netlify.app pages.dev vercel.app web.app wordpress.com".split()
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    prefix: str  # host, then the start of the path: example.com/en/

    @property
    def host(self) -> str:
        return self.prefix.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.prefix[len(self.host):]


RULES = [Rule("block", "com/en/"), Rule("allow", "example.com/en/7"), Rule("allow", "net/de/"), Rule("block", "example.net/de/8"), Rule("block", "org/es/")]


def host_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1))
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1))
    return F.coalesce(rest, F.lit(""))


#: Patterns of a site: an address in numbers or brackets, and a public suffix of two labels.
ADDRESS = r"^(?:[0-9.]+|\[.*)$"
TWO_LABELS = rf"(?:^|\.)(?:(?:{'|'.join(SECOND_LEVEL)})\.[a-z][a-z]|{'|'.join(x.replace('.', '[.]') for x in HOSTERS)})$"


def site_of(host: Column) -> Column:
    """The host without user, port and last dot."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"[.]?(?::[0-9]*)?$", "")


def suffix_of(site: Column) -> Column:
    return F.when(site.rlike(ADDRESS), site).when(site.rlike(TWO_LABELS), F.substring_index(site, ".", -2)).otherwise(F.substring_index(site, ".", -1))


def domain_of(site: Column) -> Column:
    return F.when(site.rlike(ADDRESS), site).when(site.rlike(TWO_LABELS), F.substring_index(site, ".", -3)).otherwise(F.substring_index(site, ".", -2))


def rule_for(host: Column, path: Column, rules: list[Rule] = RULES) -> Column:
    """Struct (rule, action) of the longest rule that fits, or null. Equal lengths: the longer host wins."""
    out = None
    for r in sorted(rules, key=lambda r: (len(r.prefix), len(r.host)), reverse=True):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        said = F.struct(F.lit(r.prefix).alias("rule"), F.lit(r.action).alias("action"))
        out = F.when(fits, said) if out is None else out.when(fits, said)
    return out if out is not None else F.lit(None).cast("struct<rule:string,action:string>")


def _strength(groups: DataFrame, prior: str, least: float, most: float) -> float:
    """Pseudo-count of the prior: p(1-p)/tau2 - 1, tau2 the excess of the groups' variance over binomial noise."""
    n, bad, p = F.col("n"), F.col("bad"), F.col(prior)
    row = groups.where(n > 0).agg(
        F.sum((bad / n - p) ** 2 * n).alias("q"), F.sum(p * (1 - p)).alias("noise"), F.sum(n * p * (1 - p)).alias("pq"),
        F.sum(n).alias("all"), F.sum(n * n).alias("squares"),
    ).first()
    if row is None or not row["all"]:
        return most
    spread = row["all"] - row["squares"] / row["all"]
    tau2 = max(0.0, (row["q"] - row["noise"]) / spread) if spread > 0 else 0.0
    return most if tau2 <= 0 else min(most, max(least, row["pq"] / row["all"] / tau2 - 1))


def reputation(outcomes: DataFrame, z: float = 1.645, least: float = 2.0, most: float = 1000.0) -> DataFrame:
    """site -> n, bad, rate (posterior mean), bound (lower end). outcomes: host, bad (0, 1 or null), one row a page.

    Statistics are over all rows; only sums over all groups (a handful of numbers) reach the driver.
    """
    hosts = staged(
        outcomes.groupBy(site_of(F.col("host")).alias("site")).agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .select("site", domain_of(F.col("site")).alias("domain"), suffix_of(F.col("site")).alias("suffix"), "n", "bad"), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    base = (total["bad"] + 0.5) / (total["n"] + 1.0) if total and total["n"] else 0.5
    sums = lambda key: (F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.first("suffix").alias("suffix") if key == "domain" else F.lit(base).alias("p0"))
    suffixes = hosts.groupBy("suffix").agg(*sums("suffix"))
    k = _strength(suffixes, "p0", least, most)
    suffixes = suffixes.select("suffix", ((F.col("bad") + k * base) / (F.col("n") + k)).alias("p_suffix"))
    domains = hosts.groupBy("domain").agg(*sums("domain")).join(suffixes, "suffix")
    k = _strength(domains, "p_suffix", least, most)
    domains = domains.select("domain", ((F.col("bad") + k * F.col("p_suffix")) / (F.col("n") + k)).alias("p_domain"))
    known = staged(hosts.join(domains, "domain"), "reputation")
    k = _strength(known, "p_domain", least, most)
    a, b = F.col("bad") + k * F.col("p_domain"), F.col("n") - F.col("bad") + k * (1 - F.col("p_domain"))
    mean = a / (a + b)
    return known.select("site", "n", "bad", mean.alias("rate"), (mean - z * F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule] = RULES, threshold: float = 0.5, z: float = 1.645) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, rate, bound. outcomes: host, bad."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = staged(reputation(outcomes, z).select("site", "rate", "bound"), "bounds")
    hit = rule_for(F.col("host"), F.col("path"), rules)
    return (
        parts.withColumn("site", site_of(F.col("host"))).join(known, "site", "left").withColumn("hit", hit)
        .select(
            "page_id", "host", "path", F.col("hit.rule").alias("rule"),
            F.coalesce(F.col("hit.action"), F.when(F.col("bound") > threshold, "block").otherwise("allow")).alias("verdict"), "rate", "bound")
    )


def outcomes_of(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host and bad of each page: the first number in a url's path is the document the page shows; it is bad when labelled of low quality or toxic."""
    shown = pages.select(host_of(F.col("url")).alias("host"), F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})", 1).try_cast("bigint").alias("doc_id"))
    bad = labels.groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)).alias("bad"))
    return shown.join(bad, "doc_id", "left").select("host", "bad")
