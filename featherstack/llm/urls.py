"""URL filter: allow and block rules, then empirical-Bayes host reputation.

Labelled page outcomes (1 good, 0 bad, NULL unlabelled) are counted by host,
registered domain and suffix.  Each level's good rate has a beta-binomial
prior: its mean is the posterior mean of the level above, its strength comes
from the spread of the level's rates around their parents (method of moments).
A host without outcomes so takes its domain's rate, and so on up.  A url is
allowed if the lower posterior bound of its host, ``mean - z * sd`` of the beta
posterior, reaches ``threshold``; rules override.

Only built-in expressions: counts are combined map-side, the host table is
written once and the levels are aggregates of it, one number of each level (the
strength of its prior) passes through the driver, and pages meet their host's
row in one equi-join of narrow rows.

Cases: a NULL url or one without ``://`` has an empty host and path and is
judged with that empty host; no outcomes at all leave the uniform prior (mean
0.5); of rules of one length the first given wins; repeated rows are judged
each for itself; input columns with an output's name are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage_table, without

Z = 1.645
THRESHOLD = 0.5
RHO = (0.001, 0.999)  # bounds of the correlation within a group; 1 / rho - 1 is the prior's strength
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARKUP = "(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>"
UNUSUAL = "[^\\p{L}\\p{N} \\t\\n\\r.,;:'\"()-]"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def domain_of(host: Column, labels: int = 2) -> Column:
    """The last ``labels`` labels of a host."""
    return F.substring_index(host, ".", -labels)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest (verdict, rule) that fits, as a struct; NULL if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def readable(html: Column, percent: int = 90) -> Column:
    """1 if at least ``percent`` of a page's visible characters are letters, digits,
    white space or usual punctuation, else 0; NULL if nothing is visible."""
    text = F.regexp_replace(html, MARKUP, "")
    usual = F.length(F.regexp_replace(text, UNUSUAL, ""))
    return F.when(F.length(text) > 0, (usual * 100 >= F.length(text) * percent).cast("int"))


def _posterior(level: DataFrame, mean: str) -> DataFrame:
    """``level`` (n, k, prior mean) with the beta posterior's ``a`` and ``b``."""
    m, n, k = F.col(mean), F.col("n"), F.col("k")
    var = m * (1 - m)
    fit = level.agg(F.sum(F.when(n > 0, (k - n * m) * (k - n * m) / n - var)).alias("over"),
                    F.sum(F.when(n > 0, var * (n - 1))).alias("room")).first()
    rho = min(max(fit["over"] / fit["room"] if fit["room"] else RHO[0], RHO[0]), RHO[1])
    strength = 1 / rho - 1
    return level.select(*level.columns, (k + m * strength).alias("a"), (n - k + (1 - m) * strength).alias("b"))


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """(host, n, k, mean, bound) from rows (host, good); ``good`` may be NULL."""
    count = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("k"))
    hosts = stage_table(hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", domain_of(F.col("host"), 1)))
    domains = hosts.groupBy("domain", "suffix").agg(*count)
    suffixes = domains.groupBy("suffix").agg(*count)
    every = suffixes.agg(((F.sum("k") + 1) / (F.sum("n") + 2)).alias("mean")).first()["mean"]
    rate = (F.col("a") / (F.col("a") + F.col("b"))).alias("mean")
    suffixes = _posterior(suffixes.withColumn("mean", F.lit(0.5 if every is None else every)), "mean").select("suffix", rate)
    domains = _posterior(domains.join(suffixes, "suffix"), "mean").select("domain", rate)
    done = _posterior(hosts.join(domains, "domain"), "mean")
    a, b = F.col("a"), F.col("b")
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return done.select("host", "n", "k", rate, (a / (a + b) - z * sd).alias("bound"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], url_col: str = "url", good: Column | None = None,
          z: float = Z, threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and the host's ``bound``.

    ``good`` is the outcome of a labelled page.
    """
    pages = without(pages, "host", "path", "rule", "verdict", "bound", "__rule")
    host = host_of(F.col(url_col))
    reputation = host_reputation(pages.select(host.alias("host"), (F.lit(None).cast("int") if good is None else good).alias("good")), z)
    found = pages.withColumn("host", host).withColumn("path", path_of(F.col(url_col)))
    found = found.withColumn("__rule", matching_rule(F.col("host"), F.col("path"), rules))
    judged = found.join(reputation.select("host", "bound"), "host", "left")
    method = F.when(F.col("bound") >= threshold, "allow").otherwise("block")
    return judged.select(*[pages[c] for c in pages.columns], "host", "path", F.col("__rule.rule").alias("rule"),
                         F.coalesce("__rule.verdict", method).alias("verdict"), "bound")
