"""URL filter: explicit rules, then empirical-Bayes host reputation.

Labelled page outcomes are counted per host.  A host's good rate is shrunk
toward its registered domain's, the domain's toward its suffix's, the
suffix's toward the overall rate, each through a beta prior whose strength is
estimated from how much the rates at that level differ (method of moments of
the beta-binomial).  A host is blocked when even the upper bound of its
posterior good rate stays below ``cut``: few labels leave a wide posterior,
so unknown hosts are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import ascii_lower
from fundflow.operators.stage import stage

#: (verdict, host and path prefix) of the explicit rules.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
#: Second-level labels under which names are registered, as in "co.uk".
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
CUT = 0.7
#: Standard deviations from the posterior mean to its bound.
Z = 1.645
#: Bounds of a prior's strength, in pages.
STRENGTH = (1.0, 1000.0)
_NUMBER = r"/([0-9]{1,18})(?:\.[a-z]+)?/?\z"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://`` or for NULL."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' as for the host."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def shown_document(url: Column) -> Column:
    """Number of the document a page shows: the last part of its path, an
    ending such as ``.html`` aside; NULL where that is no number."""
    return F.nullif(F.regexp_extract(url_path(url), _NUMBER, 1), F.lit("")).cast("long")


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, NULL if none does.  A
    rule fits its host and all subdomains, where the path starts with the
    rule's.  The rules are a hand-written policy, compiled into one CASE."""
    rule = verdict = F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        h, p = r.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def domain_of(host: Column) -> Column:
    """Registered domain: the last two labels, three under a second-level
    label such as co.uk; a port, user name or IPv4 address is no label."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    second = "|".join(SECOND_LEVEL)
    three = F.regexp_extract(bare, rf"([^.]+\.(?:{second})\.[a-z]{{2}})$", 1)
    two = F.regexp_extract(bare, r"([^.]+\.[^.]+)$", 1)
    return F.when(bare.rlike(r"^[\d.]+$") | (two == ""), bare).when(three != "", three).otherwise(two)


def suffix_of(domain: Column) -> Column:
    return F.when(domain.rlike(r"^[\d.]+$") | ~domain.contains("."), F.lit("")).otherwise(
        F.regexp_extract(domain, r"^[^.]*\.(.*)$", 1))


def _strength(groups: DataFrame, name: str) -> DataFrame:
    """One row: the prior strength of a level whose groups have ``n`` labelled
    and ``k`` good pages, by moments, within :data:`STRENGTH`."""
    tot = groups.agg(F.sum("n").alias("N"), F.sum("k").alias("K"), F.count(F.lit(1)).alias("G"),
                     F.sum(F.col("n") * F.col("n")).alias("NN"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("KK"))
    p = F.col("K") / F.col("N")
    within = p * (1.0 - p)
    spread = F.col("KK") - F.col("N") * p * p
    between = (spread - (F.col("G") - 1) * within) / F.nullif(F.col("N") - F.col("NN") / F.col("N"), F.lit(0.0))
    s = F.when(between > 0, within / between - 1.0).otherwise(F.lit(STRENGTH[1]))
    s = F.least(F.greatest(F.coalesce(s, F.lit(STRENGTH[1])), F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))
    return tot.select(s.alias(name), F.coalesce(p, F.lit(0.5)).alias(f"{name}_mean"))


def host_reputation(hosts: DataFrame, cut: float = CUT, z: float = Z) -> DataFrame:
    """``hosts`` has ``host, n, k`` (labelled and good pages, n may be 0), one
    row per host.  Adds ``reputation`` (posterior mean of the good rate),
    ``bound`` (its upper bound) and ``verdict``."""
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain")))
    seen = hosts.filter("n > 0")
    domains = seen.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    # One row each, keyed by a constant.
    one = lambda df: df.withColumn("__one", F.lit(1))
    priors = (one(_strength(seen, "s_host")).join(F.broadcast(one(_strength(domains, "s_domain"))), "__one")
              .join(F.broadcast(one(_strength(suffixes, "s_suffix"))), "__one")
              .drop("s_domain_mean", "s_suffix_mean"))
    shrunk = lambda k, n, s, m: (k + s * m) / (n + s)
    suffixes = suffixes.select("suffix", F.col("n").alias("ns"), F.col("k").alias("ks"))
    domains = domains.select("domain", F.col("n").alias("nd"), F.col("k").alias("kd"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    x = (hosts.join(domains, "domain", "left").join(suffixes, "suffix", "left")
         .withColumn("__one", F.lit(1)).join(F.broadcast(priors), "__one")
         .withColumn("m_suffix", shrunk(zero("ks"), zero("ns"), F.col("s_suffix"), F.col("s_host_mean")))
         .withColumn("m_domain", shrunk(zero("kd"), zero("nd"), F.col("s_domain"), F.col("m_suffix")))
         .withColumn("a", F.col("k") + F.col("s_host") * F.col("m_domain"))
         .withColumn("b", F.col("n") - F.col("k") + F.col("s_host") * (1.0 - F.col("m_domain"))))
    mean = F.col("a") / (F.col("a") + F.col("b"))
    sd = F.sqrt(mean * (1.0 - mean) / (F.col("a") + F.col("b") + 1.0))
    return (x.withColumn("reputation", mean).withColumn("bound", F.least(mean + z * sd, F.lit(1.0)))
            .withColumn("verdict", F.when(F.col("bound") < cut, F.lit("block")).otherwise(F.lit("allow")))
            .select("host", "domain", "suffix", "n", "k", "reputation", "bound", "verdict"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, cut: float = CUT,
               z: float = Z) -> DataFrame:
    """One row per row of ``pages (page_id, url)``: ``page_id, host, path,
    rule, verdict, reputation``.

    ``outcomes (page_id, good)`` holds 0/1 outcomes of some pages; a page id
    that repeats there is good if any row says so, NULL outcomes are unknown.
    NULL urls and urls without ``://`` have empty host and path and are one
    host.  Without any outcome every reputation is 0.5 and the prior at its
    strongest, so only the rules and ``cut`` decide.  Repeated pages are
    judged alike; an empty table gives no rows.
    """
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    parts = stage(parts, "urls")
    good = outcomes.filter("good IS NOT NULL").groupBy("page_id").agg(F.max("good").alias("good"))
    counts = (parts.select("page_id", "host").join(good, "page_id", "left").groupBy("host")
              .agg(F.count("good").alias("n"), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("k")))
    hosts = stage(host_reputation(counts, cut, z), "hosts")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return (parts.join(hosts.select("host", "reputation", F.col("verdict").alias("__v")), "host")
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("__v")).alias("verdict"),
                    F.round("reputation", 6).alias("reputation")))
