"""Empirical-Bayes reputation of hosts, and url rules before it.

Labelled pages are counted by host.  The share of bad pages of a host is shrunk to
that of its registered domain, the domain's to its suffix and the suffix's to the
whole: each level is a beta prior whose strength is fitted to the spread of the
counts (moments of the beta-binomial).  A host is blocked if the lower bound of its
posterior share is above ``max_bad``, so a few bad pages block nothing.

Defined results: a null url, or one without ``://``, has the empty host and path and is
judged with all such; labels with a null outcome or page count for nothing; repeated
labels each count; without any label every host has the even prior and is allowed;
repeated pages each give a row; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import host_of, path_of, staged

MAX_BAD = 0.3
Z = 1.645
STRENGTHS = (2.0, 1000.0)
# Second labels that belong to the suffix below a country's label.
SHARED_LABELS = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def matching_rule(rules: list[Rule], host: Column, path: Column, field: str) -> Column:
    """A field of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        out = F.when(rule.fits(host, path), getattr(rule, field)).otherwise(out)
    return out


def suffix_of(host: Column) -> Column:
    """The last label, or two below a country's label; an address of digits is its own suffix."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    parts = F.split(bare, r"\.")
    last, before = F.try_element_at(parts, F.lit(-1)), F.try_element_at(parts, F.lit(-2))
    two = (F.char_length(last) == 2) & before.isin(*SHARED_LABELS)
    return (
        F.when(bare.rlike(r"^[0-9.]+$") | bare.contains("["), bare)
        .when(two, F.concat_ws(".", before, last))
        .otherwise(last)
    )


def domain_of(host: Column) -> Column:
    """The suffix and one label before it."""
    bare = F.regexp_replace(host, ":[0-9]*$", "")
    suffix = suffix_of(host)
    head = F.substring(bare, F.lit(1), F.char_length(bare) - F.char_length(suffix) - 1)
    label = F.try_element_at(F.split(head, r"\."), F.lit(-1))
    return F.when(F.char_length(head) > 0, F.concat_ws(".", label, suffix)).otherwise(bare)


def _strength(spread: float | None, chance: float | None, pairs: float | None) -> float:
    """Prior strength from the spread of counts around their parents' shares."""
    low, high = STRENGTHS
    if not pairs or spread is None or chance is None:
        return high
    within = (spread - chance) / pairs
    return high if within <= 1 / (1 + high) else max(low, 1 / min(within, 1.0) - 1)


def _fitted(level: DataFrame) -> float:
    """One row of sums is all that reaches the driver."""
    m = F.col("parent")
    row = level.select(
        F.sum((F.col("bad") - F.col("n") * m) ** 2).alias("spread"),
        F.sum(F.col("n") * m * (1 - m)).alias("chance"),
        F.sum(F.col("n") * (F.col("n") - 1) * m * (1 - m)).alias("pairs"),
    ).first()
    return _strength(row["spread"], row["chance"], row["pairs"])


def _shrunk(level: DataFrame, strength: float) -> Column:
    return (F.col("bad") + F.lit(strength) * F.col("parent")) / (F.col("n") + F.lit(strength))


def host_reputation(pages: DataFrame, outcomes: DataFrame, max_bad: float = MAX_BAD, z: float = Z) -> DataFrame:
    """(host, n, bad, share, bound, blocked) for every host of ``pages`` (page_id, host).

    ``outcomes``: (page_id, bad int).  The bound is the posterior mean less ``z``
    standard deviations of the posterior.
    """
    known = outcomes.select("page_id", "bad").where("page_id IS NOT NULL AND bad IS NOT NULL")
    labelled = (
        known.groupBy("page_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
        .join(pages.select("page_id", "host"), "page_id")
    )
    seen = labelled.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    every = pages.select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad")).distinct()
    hosts = staged(
        seen.unionByName(every)
        .groupBy("host")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}),
        "host-counts",
    )
    totals = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    whole = ((totals["bad"] or 0) + 1) / ((totals["n"] or 0) + 2)

    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = suffixes.withColumn("parent", F.lit(whole))
    suffixes = suffixes.select("suffix", _shrunk(suffixes, _fitted(suffixes)).alias("parent"))

    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = domains.join(suffixes, "suffix")
    domains = domains.select("domain", _shrunk(domains, _fitted(domains)).alias("parent"))

    level = hosts.join(domains, "domain")
    strength = _fitted(level)
    a = F.col("bad") + F.lit(strength) * F.col("parent")
    total = F.col("n") + F.lit(strength)
    share = a / total
    bound = share - F.lit(z) * F.sqrt(share * (1 - share) / (total + 1))
    return staged(
        level.select("host", "n", "bad", share.alias("share"), bound.alias("bound")).withColumn(
            "blocked", F.col("bound") > max_bad
        ),
        "host-reputation",
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[Rule],
    max_bad: float = MAX_BAD,
    z: float = Z,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, bound): the rule's verdict, else the reputation's."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.fillna("", ["host", "path"])
    reputation = host_reputation(parts, outcomes, max_bad, z).select("host", "bound", "blocked")
    host, path = F.col("host"), F.col("path")
    return (
        parts.join(reputation, "host")
        .withColumns(
            {
                "rule": matching_rule(rules, host, path, "text"),
                "verdict": F.coalesce(
                    matching_rule(rules, host, path, "verdict"),
                    F.when(F.col("blocked"), "block").otherwise("allow"),
                ),
            }
        )
        .select("page_id", "host", "path", "rule", "verdict", "bound")
    )
