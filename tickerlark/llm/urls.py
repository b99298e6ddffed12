"""URL rules and empirical-Bayes host reputation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlark.llm.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Reputation:
    """A host is blocked if its bad rate is above ``max_bad`` with the confidence of ``z``."""

    max_bad: float = 0.25
    z: float = 1.645
    least_rho: float = 0.001  # bounds of the correlation inside a group; strength is 1 / rho - 1
    most_rho: float = 0.5
    long_suffixes: tuple[str, ...] = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; empty without."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule], of: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits; else null. Equal lengths: the first given."""
    out = F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        inside = (host == r.host) | F.endswith(host, F.lit("." + r.host))
        out = F.when(inside & F.startswith(path, F.lit(r.path)), F.lit(getattr(r, of))).otherwise(out)
    return out


def registered_domain(host: Column, long_suffixes: tuple[str, ...]) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), F.substring_index(host, ".", -3)).otherwise(two)


def public_suffix(host: Column, long_suffixes: tuple[str, ...]) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), two).otherwise(F.substring_index(host, ".", -1))


def _strength(groups: DataFrame, p: Reputation) -> float:
    """The prior's weight in pages: by the spread of group rates about their parents' means.

    Under a beta-binomial model the squared misses, over mean * (1 - mean), add up to
    sum(n) + rho * sum(n * (n - 1)).
    """
    miss = F.pow(F.col("k") - F.col("n") * F.col("mean"), F.lit(2)) / (F.col("mean") * (1 - F.col("mean")))
    seen, n, pairs = groups.agg(F.sum(miss), F.sum("n"), F.sum(F.col("n") * (F.col("n") - 1))).first()
    rho = (seen - n) / pairs if pairs else 0.0
    return 1 / min(p.most_rho, max(p.least_rho, rho)) - 1


def _shrunk(k: str, n: str, mean: str, weight: float) -> Column:
    return (F.col(k) + F.lit(weight) * F.col(mean)) / (F.col(n) + F.lit(weight))


def host_reputation(outcomes: DataFrame, p: Reputation | None = None) -> DataFrame:
    """(host, domain, suffix, n, k, mean, bound) for each host of ``outcomes(host, bad)``.

    ``bad`` is 0 or 1; null outcomes are not counted (n = 0 keeps the host, with its domain's
    mean). A suffix is shrunk to the overall rate, a domain to its suffix, a host to its domain;
    ``bound`` is the lower bound of the host's posterior bad rate. Counts are partial aggregates;
    seven numbers reach the driver. No rows give no hosts.
    """
    p = p or Reputation()
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    hosts = stored(
        hosts.select("host", registered_domain(F.col("host"), p.long_suffixes).alias("domain"), public_suffix(F.col("host"), p.long_suffixes).alias("suffix"), "n", "k"), "hosts"
    )
    n, k = hosts.agg(F.sum("n"), F.sum("k")).first()
    overall = ((k or 0) + 1) / ((n or 0) + 2)
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("mean", F.lit(overall))
    suffixes = suffixes.select("suffix", _shrunk("k", "n", "mean", _strength(suffixes, p)).alias("mean"))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).join(suffixes, "suffix")
    domains = domains.select("domain", "suffix", _shrunk("k", "n", "mean", _strength(domains, p)).alias("mean"))
    known = hosts.join(domains, ["domain", "suffix"])
    weight = _strength(known, p)
    a = F.col("k") + F.lit(weight) * F.col("mean")
    b = F.col("n") - F.col("k") + F.lit(weight) * (1 - F.col("mean"))
    known = known.select("host", "domain", "suffix", "n", "k", a.alias("a"), b.alias("b"))
    mean = F.expr("a / (a + b)")
    deviation = F.sqrt(F.expr("a * b / ((a + b) * (a + b) * (a + b + 1))"))
    return known.select("host", "domain", "suffix", "n", "k", mean.alias("mean"), (mean - F.lit(p.z) * deviation).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], p: Reputation | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages(page_id, url)``.

    ``outcomes(page_id, bad)`` labels some pages; a page labelled more than once counts as bad if
    any label does, labels without a page and null labels don't count. Null urls and urls without
    ``://`` have an empty host and path, and share the reputation of the empty host. Repeated
    pages are judged row by row. Other columns are ignored.
    """
    p = p or Reputation()
    named = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    told = outcomes.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    rated = host_reputation(named.select("page_id", "host").join(told, "page_id", "left"), p).select("host", (F.col("bound") > p.max_bad).alias("bad_host"))
    own = F.when(F.col("bad_host"), F.lit("block")).otherwise("allow")
    host, path = F.col("host"), F.col("path")
    return named.join(rated, "host").select(
        "page_id", "host", "path", fitting_rule(host, path, rules, "text").alias("rule"), F.coalesce(fitting_rule(host, path, rules, "verdict"), own).alias("verdict")
    )
