"""URL filters: fixed rules, then empirical-Bayes host reputation.

Labelled page outcomes (good or bad) are shrunk through beta-binomial priors: the corpus rate is
the prior of a suffix, the suffix's posterior mean that of a registered domain, the domain's that
of a host. The strength of the prior of each level is fitted by moments to the spread of its
groups; their sums are exact, so that no order of addition moves a verdict. A host is blocked if a lower
bound of its posterior bad rate, Z standard deviations of the beta posterior under its mean, exceeds a limit.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is
judged as host ''. A host without labels gets its domain's rate. Null outcomes count as no label.
Repeated rows are judged one by one. Without any label there is no reputation and nothing is blocked. An
empty table gives an empty result. Other columns are not read.

Hosts and domains may be hot: counts are aggregated before any shuffle and joined back salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.llm.common import BROADCAST_BYTES, cut

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
SALTS = 16
#: Standard deviations below the posterior mean, and the rate that the bound must exceed.
Z, MAX_BAD = 1.0, 0.35
STRENGTH_RANGE = (1.0, 1000.0)
#: The categories under which countries register domains, as in co.uk, com.au, ac.jp.
CATEGORIES = ("ac", "co", "com", "edu", "gob", "gov", "gouv", "mil", "ne", "net", "nom", "or", "org", "sch")
SUFFIX = rf"(?:(?:{'|'.join(CATEGORIES)})\.[a-z][a-z]|[^.]*)"


def host_of(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    return F.when(F.contains(u, F.lit("://")), F.translate(
        F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def path_of(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    return F.when(F.contains(u, F.lit("://")), F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits; null if none does."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def suffix_of(host: Column) -> Column:
    """The suffix under which domains are registered: the last label, or two of a country with such a category."""
    return F.regexp_extract(host, rf"(?:^|\.)({SUFFIX})\z", 1)


def domain_of(host: Column) -> Column:
    """The registered domain of a host: its suffix and a label more; a bare suffix is its own."""
    return F.regexp_extract(host, rf"(?:^|\.)((?:[^.]*\.)?{SUFFIX})\z", 1)


def salted_join(left: DataFrame, right: DataFrame, key: str, salt: Column) -> DataFrame:
    """left join whose hot keys are dealt over SALTS tasks; right has one row a key.

    A small right side is broadcast as it is, as hot keys don't matter then. A larger one gets SALTS rows a key, of which Spark knows
    nothing when it compares sizes with its threshold, before and during the run: it would send the driver SALTS times that.
    """
    size = right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = right.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if size <= min(limit, BROADCAST_BYTES):
        return left.join(F.broadcast(right), key, "left")
    spread = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int")).join(spread.hint("merge"), [key, "_salt"], "left").drop("_salt")


def _strength(groups: DataFrame) -> Column:
    """A literal: how many labels the prior of a level weighs, by moments over its groups' n and bad."""
    low, high = STRENGTH_RANGE
    some = groups.where("n > 0")
    total = some.agg(F.sum("n").alias("tn"), F.sum("bad").alias("tb"), F.count("*").alias("m"), F.sum((F.col("bad") * F.col("bad") / F.col("n")).cast("decimal(38,9)")).cast("double").alias("sq"))
    p, m = F.col("tb") / F.col("tn"), F.col("m")
    spread = (F.col("sq") - F.col("tb") * p) / F.col("tn")
    beyond = spread - p * (1 - p) * m / F.col("tn")  # more spread than chance gives
    k = F.when(beyond > 0, F.greatest(F.lit(low), F.least(F.lit(high), (p * (1 - p) - spread) / beyond)))
    return F.lit(total.select(F.coalesce(k, F.lit(high))).first()[0])


def reputations(pages: DataFrame, outcomes: DataFrame, url: str = "url") -> DataFrame:
    """(host, n, bad, rate, bound) for every host of pages; outcomes: (url, bad boolean)."""
    seen = pages.select(host_of(F.col(url)).alias("host"), F.lit(None).cast("boolean").alias("bad")).unionByName(
        outcomes.select(host_of(F.col("url")).alias("host"), "bad"))
    hosts = cut(seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad")).select(
        "host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "bad"))
    domains = cut(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    suffixes = cut(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    p0 = F.lit(suffixes.agg(F.try_divide(F.sum("bad"), F.sum("n"))).first()[0]).cast("double")
    ks, kd, kh = map(_strength, (suffixes, domains, hosts))
    suffixes = suffixes.select("suffix", ((ks * p0 + F.col("bad")) / (ks + F.col("n"))).alias("ps"))
    domains = salted_join(domains, suffixes, "suffix", F.xxhash64("domain")).select("domain", ((kd * F.col("ps") + F.col("bad")) / (kd + F.col("n"))).alias("pd"))
    t = kh + F.col("n")
    mean = (kh * F.col("pd") + F.col("bad")) / t
    return salted_join(hosts, domains, "domain", F.xxhash64("host")).select(
        "host", "n", "bad", mean.alias("rate"), (mean - Z * F.sqrt(mean * (1 - mean) / (t + 1))).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict)."""
    known = reputations(pages, outcomes, url).select("host", (F.col("bound") > MAX_BAD).alias("blocked"))
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = salted_join(rows, known, "host", F.xxhash64(key, "path")).withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    return rows.select(key, "host", "path", F.col("r.rule").alias("rule"),
                       F.coalesce("r.verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))
