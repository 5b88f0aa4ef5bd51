"""Empirical-Bayes host reputation: outcomes of labelled pages are shrunk along
suffix -> registered domain -> host with beta-binomial priors; hosts whose posterior share of bad
pages is surely high are blocked. Rules on host and path go first. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Suffixes of two labels under which names are registered; ``judge`` takes others.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rules_of(*lines: str) -> tuple[Rule, ...]:
    """Rules from lines such as ``block example.org/es/``."""
    parsed = []
    for line in lines:
        verdict, pattern = line.split(" ", 1)
        host, slash, path = pattern.partition("/")
        parsed.append(Rule(verdict, host, slash + path))
    return tuple(parsed)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; both '' for a null url or one without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(rules: tuple[Rule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; both null where none does.

    A rule fits its host and every subdomain if the path starts with the rule's path.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def site_of(host: Column) -> Column:
    """The host without a user before ``@`` and a port behind ``:``: whose reputation it has."""
    return F.regexp_replace(F.regexp_replace(host, "(?s)^.*@", ""), ":[0-9]*$", "")


def suffix_and_domain(
    host: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES
) -> tuple[Column, Column]:
    """Public suffix and registered domain; a host with too few labels is its own domain."""
    last_two = F.substring_index(host, ".", -2)
    long_suffix = last_two.isin(*two_label)
    suffix = F.when(long_suffix, last_two).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(long_suffix, F.substring_index(host, ".", -3)).otherwise(last_two)
    return suffix, domain


def _strength(children: DataFrame, least: float = 1.0, most: float = 1000.0) -> float:
    """Weight of a level's prior in pages, by moments of the counts ``n``, ``k`` around ``mu``.

    With fewer than two children, or one page each, nothing tells how they differ, and the prior
    is weak. One row comes to the driver. Rounded, so that the order of summing can't change a
    verdict.
    """
    n, k, mu = F.col("n"), F.col("k"), F.col("mu")
    within = mu * (1 - mu)
    got = children.agg(
        F.sum((k - n * mu) ** 2 - n * within).alias("over"),
        F.sum(n * (n - 1) * within).alias("pairs"),
        F.count("*").alias("children"),
    ).first()
    if got.children < 2 or not got.pairs:
        return least
    if got.over <= 0:
        return most
    return round(min(max(got.pairs / got.over - 1, least), most), 6)


def host_posteriors(
    hosts: DataFrame, outcomes: DataFrame, stage,
    two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """Posterior of the share of bad pages for each host in ``hosts``.

    ``outcomes`` holds host and bad (0 or 1), one row per labelled page. The global share is the
    prior of a suffix, a suffix's posterior mean that of its domains, a domain's that of its hosts;
    how much a prior counts is estimated per level. A host without labelled pages has its domain's
    prior; one of an unknown domain the suffix's, which counts only as much as suffixes tell about
    domains; one of an unknown suffix the global one in the same way. Labelled rows are summed by host, map-side, before anything else.
    """
    suffix, domain = suffix_and_domain(F.col("host"), two_label)
    bad = F.col("bad").cast("long")
    by_host = stage(
        outcomes.filter(F.col("bad").isNotNull() & F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum(bad).alias("k"))
        .withColumns({"suffix": suffix, "domain": domain}),
        "host_counts",
    )
    total = by_host.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                        F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    share = (total.k + 1) / (total.n + 2)

    def summed(key: str, *more: str) -> DataFrame:
        return by_host.groupBy(key, *more).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))

    def shrunk(strength: float) -> Column:
        return (F.col("k") + strength * F.col("mu")) / (F.col("n") + strength)

    suffixes = summed("suffix").withColumn("mu", F.lit(share))
    by_suffix = _strength(suffixes)
    suffixes = stage(suffixes.withColumn("suffix_mean", shrunk(by_suffix)), "suffixes").select("suffix", "suffix_mean")
    domains = summed("domain", "suffix").join(suffixes, "suffix").withColumnRenamed(
        "suffix_mean", "mu")
    by_domain = _strength(domains)
    domains = stage(domains.withColumn("domain_mean", shrunk(by_domain)), "domains").select(
        "domain", "domain_mean")
    by_own = _strength(by_host.join(domains, "domain").withColumnRenamed("domain_mean", "mu"))
    n, k = F.coalesce("n", F.lit(0)), F.coalesce("k", F.lit(0))
    mu = F.coalesce("domain_mean", "suffix_mean", F.lit(share))
    weight = (F.when(F.col("domain_mean").isNotNull(), by_own)
              .when(F.col("suffix_mean").isNotNull(), by_domain).otherwise(by_suffix))
    a, b = F.col("a"), F.col("b")
    return (
        hosts.select("host").withColumns({"suffix": suffix, "domain": domain})
        .join(by_host.select("host", "n", "k"), "host", "left")
        .join(domains, "domain", "left")
        .join(suffixes, "suffix", "left")
        .select("host", n.alias("n_labelled"), k.alias("n_bad"),
                (k + weight * mu).alias("a"), (n - k + weight * (1 - mu)).alias("b"))
        .withColumn("mean", a / (a + b))
        .withColumn("sd", F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))))
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: tuple[Rule, ...],
    stage,
    worst: float = 0.2,
    z: float = 1.645,
    two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """page_id, host, path, rule, verdict and n_labelled for every page.

    ``outcomes`` holds page_id and bad. The longest fitting rule decides; without one a page is
    blocked when the lower posterior bound (mean - z * sd) of its host's share of bad pages is over
    ``worst``. A null url, or one without ``://``, has the empty host, which is judged like any
    other. Every page gives one row, repeated pages and those without an id too; outcomes of unknown
    pages do not count, and an empty table gives no rows. Reputation is that of the host without user
    and port; rules look at the host as it is. ``two_label`` are the suffixes of two labels under
    which names are registered. Other columns of both tables are not read.
    """
    host, path = host_and_path(F.col("url"))
    named = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "site", site_of(F.col("host")))
    labelled = outcomes.select("page_id", "bad").join(
        named.select("page_id", F.col("site").alias("host")), "page_id").select("host", "bad")
    sites = named.groupBy(F.col("site").alias("host")).agg(F.count("*").alias("n_pages"))
    posterior = host_posteriors(sites, labelled, stage, two_label)
    blocked = F.round(F.col("mean") - z * F.col("sd"), 9) > worst
    by_site = stage(
        posterior.select(F.col("host").alias("site"), "n_labelled", blocked.alias("blocked")),
        "hosts")
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    method = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return named.join(by_site, "site", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, method).alias("verdict"),
        F.coalesce("n_labelled", F.lit(0)).alias("n_labelled"),
    )
