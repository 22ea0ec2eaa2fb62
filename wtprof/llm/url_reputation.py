"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes (good or not) are counted by host, registered domain
and public suffix. Each level's rate is shrunk towards the level above by a
beta-binomial prior: the suffix towards the whole table, the domain towards
its suffix, the host towards its domain. The strength of a level's prior is
estimated from the spread of that level's counts around the means above it
(method of moments). A host passes if the lower posterior bound of its rate
of good pages reaches ``min_good``. Explicit rules come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Suffixes of two labels under which domains are registered (a parameter).
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp",
                      "or.jp", "co.nz", "co.in", "com.br", "com.cn", "com.mx", "co.za", "com.tr", "co.kr")
MIN_GOOD = 0.5
Z = 1.645                      # one-sided 95 % bound
STRENGTH = (1.0, 10_000.0)     # range of a prior's strength, in pages


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/``, ``?``, ``#`` or
    the end, A-Z lower-cased; path from there up to ``?``, ``#`` or the end.
    Both are empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_and_verdict(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. ``rules``
    holds (allow|block, host/path); a rule fits its host and all subdomains
    if the path starts with the rule's path."""
    rule = verdict = None
    for what, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def host_levels(host: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column, Column]:
    """(name, registered domain, suffix) of a host, without user and port."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.?(:[^:]*)?$", "")
    last2 = F.substring_index(name, ".", -2)
    long = last2.isin(*two_label)
    return (name, F.when(long, F.substring_index(name, ".", -3)).otherwise(last2),
            F.when(long, last2).otherwise(F.substring_index(name, ".", -1)))


def _strength(level: DataFrame) -> float:
    """Prior strength from counts (n, k) around the means m above: with
    within-group correlation r, E (k - nm)^2 = n m (1-m) (1 + (n-1) r), and
    the strength is 1/r - 1."""
    var = F.col("m") * (1 - F.col("m"))
    row = level.agg(F.sum((F.col("k") - F.col("n") * F.col("m")) ** 2 - F.col("n") * var).alias("over"),
                    F.sum(F.col("n") * (F.col("n") - 1) * var).alias("pairs")).first()
    if not row["pairs"] or row["over"] is None:
        return STRENGTH[0]
    r = max(row["over"] / row["pairs"], 1e-9)
    return min(max(1 / r - 1, STRENGTH[0]), STRENGTH[1])


def reputation(pages: DataFrame, outcomes: DataFrame, url_col: str = "url", outcome_url: str = "url",
               outcome: str = "good", z: float = Z) -> DataFrame:
    """One row per host name of ``pages``: name, n and good labelled pages,
    rate (posterior mean), bound (lower posterior bound).

    ``outcomes`` has a url and a 0/1 outcome for each labelled page (null
    outcomes don't count). Hosts without labels get their domain's prior.
    Counts are pre-aggregated before each shuffle, so a hot host is a few
    rows; only three prior strengths reach the driver.
    """
    o = outcomes.select(*(c.alias(a) for c, a in zip(host_levels(url_parts(F.col(outcome_url))[0]),
                                                     ("name", "domain", "suffix"))), F.col(outcome).alias("y"))
    hosts = (o.where(F.col("y").isNotNull()).groupBy("name", "domain", "suffix")
             .agg(F.count("*").cast("double").alias("n"), F.sum(F.col("y").cast("double")).alias("k")))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = ((total["k"] or 0.0) + 0.5) / ((total["n"] or 0.0) + 1.0)
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]

    def shrunk(level: DataFrame, keys: list[str], out: str) -> tuple[DataFrame, float]:
        s = _strength(level)
        return level.select(*keys, ((F.col("k") + s * F.col("m")) / (F.col("n") + s)).alias(out)), s

    suffixes, _ = shrunk(hosts.groupBy("suffix").agg(*counts).withColumn("m", F.lit(mean)), ["suffix"], "m_suffix")
    domains, _ = shrunk(hosts.groupBy("domain", "suffix").agg(*counts).join(suffixes, "suffix")
                        .withColumnRenamed("m_suffix", "m"), ["domain"], "m_domain")
    s_host = _strength(hosts.join(domains, "domain").withColumnRenamed("m_domain", "m"))
    names = pages.select(*(c.alias(a) for c, a in zip(host_levels(url_parts(F.col(url_col))[0]),
                                                      ("name", "domain", "suffix")))).distinct()
    m = F.coalesce(F.col("m_domain"), F.col("m_suffix"), F.lit(mean))
    n, k = F.coalesce(F.col("n"), F.lit(0.0)), F.coalesce(F.col("k"), F.lit(0.0))
    a, b = F.col("a"), F.col("b")
    return (names.join(hosts.select("name", "n", "k"), "name", "left").join(domains, "domain", "left")
            .join(suffixes, "suffix", "left")
            .select("name", n.cast("long").alias("n"), k.cast("long").alias("good"),
                    (k + s_host * m).alias("a"), (n - k + s_host * (1 - m)).alias("b"))
            .select("name", "n", "good", (a / (a + b)).alias("rate"),
                    (a / (a + b) - z * F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))).alias("bound")))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id",
                url_col: str = "url", min_good: float = MIN_GOOD, z: float = Z) -> DataFrame:
    """Judge every url: id_col, host, path, rule, verdict, rate, bound.

    verdict is the longest fitting rule's (allow or block), else allow where
    the host's lower posterior bound reaches ``min_good``, else block. Null
    urls and urls without ``://`` have empty host and path and are judged as
    the empty host; null ids and repeated rows stay; an empty table gives an
    empty result; without any labels every host has the uniform prior's mean.
    The join on the host name is left to AQE, which splits a hot host.
    """
    host, path = url_parts(F.col(url_col))
    judged = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_and_verdict(F.col("host"), F.col("path"), rules)
    rep = reputation(pages, outcomes, url_col, z=z).select("name", "rate", "bound")
    out = (judged.select("*", rule.alias("rule"), verdict.alias("ruled"), host_levels(F.col("host"))[0].alias("name"))
           .join(rep, "name", "left"))
    own = F.when(F.col("bound") >= min_good, "allow").otherwise("block")
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule",
                      F.coalesce("ruled", own).alias("verdict"), "rate", "bound")
