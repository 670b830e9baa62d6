"""URL filter: rules first, else an empirical-Bayes reputation of the host.

Labelled page outcomes (1 bad, 0 good) are counted per host, registered domain
and suffix.  Each level's bad rate has a beta prior centred on the posterior
mean of the level above; the prior's strength is fitted to the spread between
groups of that level (beta-binomial, method of moments).  A host is blocked if
the lower bound of its posterior bad rate, mean minus ``z`` standard
deviations, exceeds ``excess`` times the bad rate of all labelled pages: a host is
judged by how much worse than the rest it surely is, whatever the base rate.

Only DataFrame functions run here.  Counts are combined before they are
shuffled and the reputation table is written once, so the join back to the
pages is between two plain scans and AQE can split a host that holds a third
of them.  Three numbers per level reach the driver.

Defined results: a null url or one without ``://`` has empty host and path; the
empty host has a reputation like any other; null labels and labels of unknown
pages count nothing; several labels of one page count once, bad if any is bad;
repeated pages stay repeated, each counting; without labels every page that no
rule fits is allowed; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

# Public suffixes of two labels that the domain split knows (a parameter).
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au",
                      "co.jp", "co.nz", "co.za", "com.br", "co.in", "co.kr", "com.mx")
AZ, az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str  # "allow" or "block"
    pattern: str  # host, then a path that starts with "/"

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), AZ, az), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def match_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(pattern, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<pattern:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        out = F.when(r.fits(host, path), F.struct(
            F.lit(r.pattern).alias("pattern"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def suffix_of(host: Column, two_label=TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*two_label), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, two_label=TWO_LABEL_SUFFIXES) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*two_label),
                  F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _strength(groups: DataFrame, mean: float) -> float:
    """Prior strength of groups (n, bad) around ``mean``, by moments.

    ``rho = (S - v (m - 1)) / (v (N - sum n^2 / N - (m - 1)))`` with
    ``S = sum n (bad/n - mean)^2`` and ``v = mean (1 - mean)``, held to
    [0.001, 0.999]; the strength is ``1/rho - 1``.  S is taken as
    ``sum bad^2/n - 2 mean sum bad + mean^2 sum n``."""
    r = groups.where("n > 0").agg(
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"), F.sum("bad").alias("b"),
        F.sum(F.round(F.col("bad").cast("double") * F.col("bad") / F.col("n"), 6)
              .cast("decimal(38,6)")).alias("bb"),
    ).first()
    m, n, v = r["m"], float(r["n"] or 0), mean * (1 - mean)
    free = n - (r["nn"] or 0.0) / n - (m - 1) if n else 0.0
    if m < 2 or v <= 0 or free <= 0:
        return 1 / 0.001 - 1
    s = float(r["bb"]) - 2 * mean * float(r["b"]) + mean * mean * n
    rho = min(0.999, max(0.001, (s - v * (m - 1)) / (v * free)))
    return 1 / rho - 1


def host_reputation(hosts: DataFrame, z: float = 1.645) -> DataFrame:
    """From (host, n, bad), one row per host: its bad rate's posterior mean
    ``rate``, standard deviation ``sd`` and lower bound ``lower``, and ``base``, the rate
    of all labelled pages."""
    hosts = cut(hosts.select("host", domain_of(F.col("host")).alias("domain"),
                             suffix_of(F.col("host")).alias("suffix"), "n", "bad"), "hosts")
    domains = cut(hosts.groupBy("domain", "suffix").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = (float(total["bad"] or 0) + 0.5) / (float(total["n"] or 0) + 1.0)
    k_suffix, k_domain, k_host = (_strength(g, mean) for g in (suffixes, domains, hosts))

    def rate(parent, k):
        return (F.lit(k) * parent + F.col("bad")) / (F.lit(k) + F.col("n"))

    s = suffixes.select("suffix", rate(F.lit(mean), k_suffix).alias("suffix_rate"))
    d = domains.join(s, "suffix").select("domain", "suffix", rate(F.col("suffix_rate"), k_domain)
                                         .alias("domain_rate"))
    h = hosts.join(d, ["domain", "suffix"]).select(
        "host", "n", rate(F.col("domain_rate"), k_host).alias("rate"),
        (F.lit(k_host) + F.col("n")).alias("weight"))
    sd = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))
    return h.select("host", "n", "rate", sd.alias("sd"), (F.col("rate") - F.lit(z) * sd).alias("lower"),
                    F.lit(mean).alias("base"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], id_col: str = "page_id",
                url_col: str = "url", excess: float = 1.5, z: float = 1.645) -> DataFrame:
    """Judge every page.  ``outcomes``: (page_id, bad 0/1 or null).

    Returns page_id, host, path, rule, verdict, bad_rate, bad_lower."""
    url = F.col(url_col)
    judged = pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"),
                          url_path(url).alias("path"))
    known = (outcomes.where("page_id is not null and bad is not null")
             .groupBy("page_id").agg(F.max("bad").alias("bad")))
    hosts = (judged.select("page_id", "host").join(known, "page_id", "left")
             .groupBy("host").agg(F.count("bad").alias("n"),
                                  F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad")))
    reputation = cut(host_reputation(hosts, z), "reputation")
    rule = match_rule(F.col("host"), F.col("path"), rules)
    held = judged.withColumn("_rule", rule).join(
        reputation.select("host", "rate", "lower", "base"), "host", "left")
    return held.select(
        "page_id", "host", "path", F.col("_rule.pattern").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("lower") > F.lit(excess) * F.col("base"), "block")
                   .otherwise("allow")).alias("verdict"),
        F.col("rate").alias("bad_rate"), F.col("lower").alias("bad_lower"))
