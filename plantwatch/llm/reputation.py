"""Empirical-Bayes host reputation.

Labelled outcomes of pages are counted per host, registered domain and suffix. Each level's
rate is shrunk to its parent's posterior mean through a beta prior whose strength is fitted by
moments over all groups of the level. A host is blocked when the lower bound of its posterior
bad rate exceeds a limit. Native: only DataFrame functions; rows reach the driver only as one
sum per level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plantwatch.llm.frames import LOWER, UPPER

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MAX_BAD = 0.35
Z = 1.645
# Prior strength where nothing at all is labelled: wide enough to block nobody.
NO_EVIDENCE = 2.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://`` or url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def first_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Verdict and text of the longest rule that fits, else nulls."""
    verdict = text = F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
    return verdict, text


def domain_parts(host: Column) -> tuple[Column, Column]:
    """Registered domain (last two labels) and suffix (last label), without a port."""
    bare = F.regexp_replace(host, ":\\d*$", "")
    return F.substring_index(bare, ".", -2), F.substring_index(bare, ".", -1)


def _strength(groups: DataFrame) -> float:
    """Strength of the beta prior around ``prior`` that fits (n, bad) best by moments.

    Var(bad) = n m (1 - m) (1 + (n - 1) / (s + 1)) is solved for s over all groups together.
    """
    m = F.col("prior")
    row = groups.where(F.col("n") > 0).agg(
        F.sum((F.col("bad") - F.col("n") * m) ** 2 / (m * (1 - m)) - F.col("n")).alias("excess"),
        F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"),
    ).first()
    if row["pairs"] is None:
        return NO_EVIDENCE
    if not row["pairs"]:
        return 1e6
    rho = min(max(row["excess"] / row["pairs"], 1e-6), 0.999)
    return 1 / rho - 1


def _shrink(groups: DataFrame) -> DataFrame:
    """Adds the posterior ``mean`` and ``weight`` (pseudo-observations) of each group."""
    s = F.lit(_strength(groups))
    return groups.withColumn("weight", F.col("n") + s).withColumn(
        "mean", (F.col("bad") + s * F.col("prior")) / F.col("weight")
    )


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = Z) -> DataFrame:
    """(host, n, bad, mean, bound) of every host of ``pages`` (page_id, host).

    ``outcomes``: (page_id, bad 0/1); several of one page count as bad if any is; nulls are no
    outcomes. Hosts without outcomes get their domain's rate, and so on up to the overall rate.
    """
    labelled = outcomes.where(F.col("bad").isNotNull() & F.col("page_id").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    domain, suffix = domain_parts(F.col("host"))
    hosts = (
        pages.join(labelled, "page_id", "left")
        .groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("domain", domain).withColumn("suffix", suffix)
    )
    up = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*up)
    suffixes = domains.groupBy("suffix").agg(*up)
    total = suffixes.agg(*up).first()
    overall = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)
    top = _shrink(suffixes.withColumn("prior", F.lit(float(overall)))).select("suffix", F.col("mean").alias("prior"))
    middle = _shrink(domains.join(top, "suffix")).select("domain", F.col("mean").alias("prior"))
    low = _shrink(hosts.join(middle, "domain"))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return low.select("host", "n", "bad", "mean", F.greatest(F.lit(0.0), F.col("mean") - z * spread).alias("bound"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules=RULES, max_bad: float = MAX_BAD, z: float = Z
) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate and bound of every page.

    A rule decides first (the longest that fits); else the host is blocked if the lower bound
    of its bad rate exceeds ``max_bad``. Repeated rows stay repeated.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    known = host_reputation(rows, outcomes, z).select("host", F.col("mean").alias("bad_rate"), "bound")
    verdict, rule = first_rule(F.col("host"), F.col("path"), rules)
    return rows.join(known, "host").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("bound") > max_bad, "block").otherwise("allow")).alias("verdict"),
        "bad_rate", "bound",
    )
