"""URL filter by host reputation: beta-binomial shrinkage from suffix to registered domain to host.

Outcomes of labelled pages (good or bad) are counted per host. A host's rate of
bad pages is shrunk towards its registered domain, that one towards its suffix,
and that one towards all pages. The prior strength of each level is estimated
from the counts (moments of the beta-binomial distribution), so hosts that
differ a lot are shrunk less.

One strength for all hosts would hide a single bad host among many ordinary
ones, since those make the strength high. So the prior of each level has two
parts: that of ordinary members, and a wide one for the few that are odd
(``ODD_SHARE`` of them, with a strength of ``ODD_STRENGTH``). How much of the
posterior each part gets follows from how well it explains the member's counts;
a member that ordinary ones cannot explain is hardly shrunk.

A host is blocked if even the lower bound of its posterior rate is bad: if its
odds are ``odds`` times those of all pages, or most pages are bad at the bound.
Listed rules go before that verdict.

Null or odd urls have an empty host, which counts as a host like any other.
Ids that several labels name count once, as bad if one label says so; labels
without a value are left out. Without any label every page is allowed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import let
from ledgerloom.session import cut_lineage, scratch_scope

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Suffixes of two parts under which names are registered.
TWO_PART_SUFFIXES = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "org.au", "org.uk")

Rule = tuple[str, str, str]  # verdict, host, path

ODD_SHARE, ODD_STRENGTH = 0.01, 2.0
# Rates of 0 and 1 have no beta distribution.
LEAST_RATE = 1e-6


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of verdict and rule; null if none does."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [
        F.when(
            ((host == name) | host.endswith(f".{name}")) & path.startswith(start),
            F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule")),
        )
        for verdict, name, start in longest_first
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<verdict:string,rule:string>"))


def host_suffix(host: Column, two_part: Sequence[str] = TWO_PART_SUFFIXES) -> Column:
    """Public suffix: the last label, or the last two where ``two_part`` lists them."""
    name = F.regexp_replace(host, r":\d*$", "")
    last_two = F.substring_index(name, ".", -2)
    return F.when(last_two.isin(list(two_part)), last_two).otherwise(F.substring_index(name, ".", -1))


def registered_domain(host: Column, two_part: Sequence[str] = TWO_PART_SUFFIXES) -> Column:
    """Suffix and the label before it."""
    name = F.regexp_replace(host, r":\d*$", "")
    long = F.substring_index(name, ".", -2).isin(list(two_part))
    return F.when(long, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))


def _strength(children: DataFrame, parent: str) -> float:
    """Prior strength of one level.

    With n_i labelled pages in child i of parent p, the weighted sum of squared
    deviations has a mean that is linear in the correlation rho within a child;
    it is solved for rho, and the strength of the beta prior is (1 - rho) / rho.
    """
    per_parent = (
        children.where("n > 0")
        .groupBy(parent)
        .agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("bad").alias("bad"),
             F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("q"), F.sum(F.col("n") * F.col("n")).alias("nn"))
    )
    mean = F.col("bad") / F.col("n")
    unit = mean * (1 - mean)
    sums = per_parent.agg(
        F.sum(F.col("q") - F.col("bad") * mean - (F.col("k") - 1) * unit).alias("excess"),
        F.sum(unit * (F.col("n") - F.col("nn") / F.col("n") - (F.col("k") - 1))).alias("scale"),
    )
    rho = F.when(F.col("scale") > 0, F.col("excess") / F.col("scale")).otherwise(F.lit(0.0))
    bounded = F.least(F.greatest(rho, F.lit(0.001)), F.lit(0.5))
    return sums.select(((1 - bounded) / bounded).alias("strength")).first()["strength"]


def _log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series seven steps further up."""

    def series(y: Column) -> Column:
        return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12.0 * y) - 1 / (360.0 * y * y * y)

    steps = F.aggregate(F.sequence(F.lit(0), F.lit(6)), F.lit(0.0), lambda total, i: total + F.ln(x + i))
    return let(x + 7.0, series) - steps


def _evidence(n: Column, bad: Column, mean: Column, strengths: Sequence[float]) -> Column:
    """For each strength the log probability of the outcomes under a beta prior, for one order of them."""

    def of(strength: Column) -> Column:
        a, b = strength * mean, strength * (1.0 - mean)
        g = F.transform(F.array(a + bad, b + n - bad, strength, strength + n, a, b), _log_gamma)
        return let(g, lambda g: g[0] + g[1] + g[2] - g[3] - g[4] - g[5])

    return F.transform(F.array(*[F.lit(s) for s in strengths]), of)


def _posterior(level: DataFrame, strength: float) -> DataFrame:
    """Mean and variance of each row's rate, from the prior mean in ``above``.

    Without labelled pages both parts of the prior explain the row equally
    well, and its mean is that of the row above.
    """
    prior = F.least(F.greatest(F.col("above"), F.lit(LEAST_RATE)), F.lit(1 - LEAST_RATE))
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")

    def part(size: float) -> tuple[Column, Column]:
        mean = (size * F.col("above") + bad) / (size + n)
        return mean, mean * (1.0 - mean) / (size + n + 1.0)

    gain = let(_evidence(n, bad, prior, (strength, ODD_STRENGTH)), lambda e: e[0] - e[1])
    odd = F.col("odd")
    (usual, usual_spread), (own, own_spread) = part(strength), part(ODD_STRENGTH)
    weighed = level.withColumn("odd", 1.0 / (1.0 + F.exp(F.least(gain, F.lit(700.0))) * ((1 - ODD_SHARE) / ODD_SHARE)))
    within = (1.0 - odd) * usual_spread + odd * own_spread
    between = odd * (1.0 - odd) * (usual - own) * (usual - own)
    return weighed.withColumns({"mean": (1.0 - odd) * usual + odd * own, "variance": within + between})


def host_reputation(pages: DataFrame, labels: DataFrame, z: float = 1.645) -> DataFrame:
    """One row per host: host, n, bad, mean and lower bound of the posterior rate of bad pages, and base, the rate over all pages.

    ``pages`` needs page_id and url, ``labels`` doc_id, quality and toxic. Only
    counts per host are shuffled; tables per domain and suffix are made of them.
    """
    outcome = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 0)
    outcomes = labels.select(F.col("doc_id").alias("id"), outcome.alias("bad")).where("id is not null and bad is not null").groupBy("id").agg(F.max("bad").alias("bad"))
    judged = pages.select(F.col("page_id").alias("id"), url_host(F.col("url")).alias("host")).join(outcomes, "id", "left")
    counts = judged.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    with scratch_scope(pages.sparkSession):
        hosts = cut_lineage(counts.withColumns({"domain": registered_domain(F.col("host")), "suffix": host_suffix(F.col("host"))}))

        sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        domains = hosts.groupBy("suffix", "domain").agg(*sums)
        suffixes = domains.groupBy("suffix").agg(*sums)
        # Four numbers: the rate over all pages and the strength of each level.
        total = suffixes.agg(*sums).first()
        overall = total["bad"] / total["n"] if total["n"] else 0.0

        def means(level: DataFrame, key: str) -> DataFrame:
            return level.select(key, F.col("mean").alias("above"))

        by_suffix = _posterior(suffixes.withColumn("above", F.lit(overall)), _strength(suffixes.withColumn("root", F.lit("")), "root"))
        by_domain = _posterior(domains.join(means(by_suffix, "suffix"), "suffix"), _strength(domains, "suffix"))
        by_host = _posterior(hosts.join(means(by_domain, "domain"), "domain"), _strength(hosts, "domain"))
        lower = F.greatest(F.col("mean") - F.lit(z) * F.sqrt("variance"), F.lit(0.0))
        return cut_lineage(by_host.select("host", "n", "bad", "mean", lower.alias("lower"), F.lit(overall).alias("base")), outlive=True)


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], odds: float = 3.0, z: float = 1.645) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate and bad_lower for every page.

    Repeated pages are judged each; repeated ids share a label.

    The join on the host is a plain one: hosts are unique on one side, and a
    host with a third of all pages is split by the adaptive skew join.
    """
    limit = F.least(F.lit(odds) * F.col("base") / (1.0 - F.col("base") + F.lit(odds) * F.col("base")), F.lit(0.5))
    scored = host_reputation(pages, labels, z).select("host", F.col("mean").alias("bad_rate"), F.col("lower").alias("bad_lower"), (F.col("lower") > limit).alias("bad_host"))
    named = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    fitting = named.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)).join(scored, "host", "left")
    own = F.when(F.col("bad_host"), F.lit("block")).otherwise(F.lit("allow"))
    return fitting.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"), "bad_rate", "bad_lower")
