"""URL filter: explicit rules, then empirical-Bayes host reputation.

Labelled pages give each host a count of good and bad outcomes.  Rates are
shrunk through three levels of beta-binomial priors: a suffix's rate towards
the overall one, a registered domain's towards its suffix's posterior mean, a
host's towards its domain's.  Each level's prior strength comes from the
labelled counts by the method of moments.  A host is blocked when even the
lower bound of its posterior bad rate is above ``max_bad``; a host without
labels has its domain's prior.

Defined cases: a null url or one without ``://`` has empty host and path, no
rule, and the reputation of the empty host; a null page_id carries no label;
labels other than 0/1 or null carry no outcome; several label rows of one page
count as one, bad if any is; without any labels every host is allowed.
Repeated pages give repeated rows; of equally long rules the later in code-point
order wins; urls of any length are judged whole; an empty table gives an empty
result; columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstar.llm.common import staged

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Labels that together with a two-letter top level form a public suffix (co.uk, com.au, ...).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def suffix_labels(host: Column) -> Column:
    """How many of the host's labels form its public suffix (0 for a host of one label or an IPv4 address)."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    last, second = F.element_at(parts, -1), F.try_element_at(parts, F.lit(-2))
    return (
        F.when((n < 2) | last.rlike(r"^[0-9:]*\]?$"), 0)
        .when((n > 2) & (F.length(last) == 2) & second.isin(*SECOND_LEVEL), 2)
        .otherwise(1)
    )


def levels(df: DataFrame) -> DataFrame:
    """Adds ``domain`` (registered domain) and ``suffix`` to rows with a ``host``."""
    parts = F.split("host", r"\.")
    k = suffix_labels(F.col("host"))
    tail = lambda m: F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - m + 1), m), ".")
    return df.withColumn("suffix", F.when(k == 0, "").otherwise(tail(F.greatest(k, F.lit(1))))).withColumn(
        "domain", F.when(k == 0, F.col("host")).otherwise(tail(k + 1))
    )


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest of ``rules`` (action, "host/path") that fits; null where none does."""
    rule = action = F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0])):
        rule_host, _, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        rule, action = F.when(fits, text).otherwise(rule), F.when(fits, act).otherwise(action)
    return rule, action


def _strength(groups: DataFrame) -> float:
    """Prior strength (alpha + beta) by the method of moments; ``groups`` has n, bad and the prior mean ``mu``."""
    excess = F.col("n") * (F.pow(F.col("bad") - F.col("n") * F.col("mu"), 2) / (F.col("n") * F.col("mu") * (1 - F.col("mu"))) - 1)
    row = groups.where("n > 0").agg(F.sum(excess).alias("top"), F.sum(F.col("n") * (F.col("n") - 1)).alias("base")).first()
    rho = (row["top"] or 0.0) / row["base"] if row["base"] else 0.0
    rho = min(max(rho, 1e-3), 0.5)  # between about one and a thousand pseudo-pages
    return 1.0 / rho - 1.0


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction."""
    from math import lgamma

    lg = np.vectorize(lgamma, otypes=[float])
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    with np.errstate(divide="ignore"):
        front = np.exp(lg(p + q) - lg(p) - lg(q) + p * np.log(y) + q * np.log1p(-y)) / p
    tiny = 1e-300
    c = np.ones_like(y)
    d = 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 200):
        for num in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + num * d
            c = 1 + num / c
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = np.where(np.abs(c) < tiny, tiny, c)
            h *= d * c
        if np.all(np.abs(d * c - 1) < 1e-10):
            break
    return np.where(swap, 1 - front * h, front * h)


def beta_quantile(prob: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    lo, hi = np.zeros_like(a), np.ones_like(a)
    for _ in range(40):
        mid = (lo + hi) / 2
        below = beta_cdf(mid, a, b) < prob
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return (lo + hi) / 2


def _bounds(tail: float):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            a, b = p["a"].to_numpy(float), p["b"].to_numpy(float)
            # hosts share few (a, b) pairs: those without labels all have their domain's prior
            pairs, at = np.unique(np.stack([a, b], 1), axis=0, return_inverse=True)
            at = at.reshape(-1)
            yield p.assign(bad_rate=a / (a + b), bad_lower=beta_quantile(tail, pairs[:, 0], pairs[:, 1])[at])

    return run


def host_reputation(hosts: DataFrame, outcomes: DataFrame, tail: float = 0.05) -> DataFrame:
    """Posterior of every host in ``hosts``; ``outcomes`` has (host, bad 0/1) per labelled page.

    Returns host, domain, suffix, n, bad, bad_rate (posterior mean) and bad_lower (posterior ``tail`` quantile).
    """
    counts = outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    by_host = staged(levels(hosts.select("host").distinct().join(counts, "host", "left").na.fill(0, ["n", "bad"])), "url_hosts")
    by_domain = by_host.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    by_suffix = by_domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = by_suffix.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    n, bad = total["n"] or 0, total["bad"] or 0
    mu = (bad + 0.5) / (n + 1.0) if n else 0.0
    post = lambda k: (F.col("bad") + k * F.col("mu")) / (F.col("n") + k)
    by_suffix = by_suffix.withColumn("mu", F.lit(min(max(mu, 1e-9), 1 - 1e-9)))
    suffixes = by_suffix.select("suffix", post(_strength(by_suffix)).alias("mu"))
    by_domain = by_domain.join(suffixes, "suffix")
    domains = by_domain.select("domain", "suffix", post(_strength(by_domain)).alias("mu"))
    by_host = by_host.join(domains, ["domain", "suffix"])
    k = _strength(by_host)
    posterior = by_host.withColumn("a", F.col("bad") + k * F.col("mu")).withColumn("b", F.col("n") - F.col("bad") + k * (1 - F.col("mu")))
    schema = "domain string, suffix string, host string, n bigint, bad bigint, mu double, a double, b double, bad_rate double, bad_lower double"
    return posterior.mapInPandas(_bounds(tail), schema).drop("mu", "a", "b")


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    max_bad: float = 0.35,
    tail: float = 0.05,
) -> DataFrame:
    """Every page with host, path, the rule that fits (or null) and the verdict, allow or block.

    ``labels`` has doc_id, quality and toxic per labelled page; a page is bad if it is toxic or of low quality.
    """
    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")
    known = (
        labels.select(F.col("doc_id").alias("page_id"), F.coalesce(bad, F.when((F.col("toxic") == 0) | (F.col("quality") == 1), 0)).alias("bad"))
        .where("bad is not null")
        .groupBy("page_id")
        .agg(F.max("bad").alias("bad"))
    )
    reputation = host_reputation(parsed.select("host"), parsed.join(known, "page_id").select("host", "bad"), tail)
    rule, action = match_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_lower") > max_bad, "block").otherwise("allow")
    return (
        parsed.join(reputation, "host")
        .withColumns({"rule": rule, "action": action})
        .withColumn("verdict", F.coalesce("action", method))
        .select("page_id", "host", "path", "rule", "verdict", "bad_rate", "bad_lower")
    )
