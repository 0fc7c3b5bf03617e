"""URL filter: empirical-Bayes host reputation.

Labelled page outcomes are counted per host, registered domain and suffix. Each
level's bad rate is a beta posterior whose prior mean is the level above and
whose prior strength comes from the spread between its members (method of
moments). A page is blocked when the lower posterior bound of its host's bad
rate exceeds the limit; explicit rules win over the reputation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.common import broadcast_if_small
from leasegrid.session import cut_lineage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def _labels(host: Column) -> Column:
    """Host labels without user part, port and trailing dot."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r"\.?(:[0-9]*)?$", "")
    return F.split(bare, r"\.")


def suffix_of(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """Public suffix: the longest of ``suffixes`` that ends the host, else its last label."""
    parts = _labels(host)
    known = [F.when(F.concat(F.lit("."), F.array_join(parts, ".")).endswith("." + s), F.lit(s))
             for s in sorted(suffixes, key=lambda s: (-len(s), s))]
    return F.coalesce(*known, F.element_at(parts, -1))


def domain_of(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """Registered domain: the suffix and one label before it (a bare suffix is its own domain)."""
    parts = _labels(host)
    depth = F.size(F.split(suffix_of(host, suffixes), r"\.")) + 1
    return F.array_join(F.when(F.size(parts) > depth, F.slice(parts, -depth, depth)).otherwise(parts), ".")


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest ``(host, path, verdict)`` rule that fits, else null.

    A rule fits its host and every subdomain if the path starts with the rule's
    path. Among rules of one length the longer host wins, then the rule text.
    The rules are a short literal list, tested in order of precedence.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))
    found: Column = F.lit(None)
    for rule_host, rule_path, verdict in reversed(ordered):
        fits = F.concat(F.lit("."), host).endswith("." + rule_host) & path.startswith(rule_path)
        hit = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def _strength(level: DataFrame, n: str, k: str, mean: str) -> float:
    """Prior strength a + b by the method of moments over the members of a level.

    The pooled squared deviation from the prior mean, less its binomial part, is
    the share rho = 1 / (strength + 1) of what members of these sizes can add.
    Held within [1, 1000], so one odd level cannot switch shrinkage off; 1000
    where members show no spread.
    """
    spread = F.col(mean) * (1 - F.col(mean))
    dev, base, excess = level.agg(
        F.sum((F.col(k) - F.col(n) * F.col(mean)) ** 2 / F.col(n)), F.sum(spread), F.sum(spread * (F.col(n) - 1))
    ).first()
    rho = (dev - base) / excess if excess else 0.0
    return min(1000.0, max(1.0, 1 / rho - 1)) if rho > 0 else 1000.0


def reputation(
    outcomes: DataFrame, url_col: str, bad_col: str, suffixes: Sequence[str] = (), z: float = 1.645
) -> DataFrame:
    """Posterior bad rate per host of labelled outcomes.

    Columns: host, domain, suffix, n, bad, prior_mean, post_mean, post_low (mean
    minus ``z`` posterior deviations, at least 0). Rows with a null outcome or
    without a host are no evidence. No outcomes give no rows. The driver reads
    one total and one strength per level.
    """
    host = host_of(F.col(url_col))
    seen = outcomes.where(F.col(bad_col).isNotNull() & (host != "")).select(
        host.alias("host"), F.col(bad_col).cast("double").alias("bad")
    )
    hosts = seen.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    hosts = cut_lineage(hosts.select(
        "host", domain_of(F.col("host"), suffixes).alias("domain"), suffix_of(F.col("host"), suffixes).alias("suffix"), "n", "bad"
    ))
    domains = cut_lineage(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("bad").alias("dbad")))
    tails = cut_lineage(domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dbad").alias("sbad")))
    n, bad = tails.agg(F.sum("sn"), F.sum("sbad")).first()

    def shrunk(level: DataFrame, n: str, bad: str, above: str, out: str) -> tuple[DataFrame, float]:
        m = _strength(level, n, bad, above)
        return level.withColumn(out, (F.col(bad) + m * F.col(above)) / (F.col(n) + m)), m

    whole = tails.withColumn("m0", F.lit(((bad or 0.0) + 0.5) / ((n or 0) + 1)))
    tails, _ = shrunk(whole, "sn", "sbad", "m0", "sm")
    tails = broadcast_if_small(cut_lineage(tails.select("suffix", "sm")))
    domains, _ = shrunk(domains.join(tails, "suffix"), "dn", "dbad", "sm", "dm")
    hosts, m = shrunk(cut_lineage(hosts.join(domains.select("domain", "dm"), "domain")), "n", "bad", "dm", "post_mean")
    mean = F.col("post_mean")
    sd = F.sqrt(mean * (1 - mean) / (F.col("n") + m + 1))
    return hosts.select(
        "host", "domain", "suffix", "n", "bad", F.col("dm").alias("prior_mean"), "post_mean",
        F.greatest(F.lit(0.0), mean - z * sd).alias("post_low"),
    )


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str, str]] = (),
    id_col: str = "page_id",
    url_col: str = "url",
    outcome_url: str = "url",
    bad_col: str = "bad",
    max_bad: float = 0.5,
    suffixes: Sequence[str] = (),
    z: float = 1.645,
) -> DataFrame:
    """Verdict per page row: ``id, host, path, rule, verdict, n_labelled, post_low``.

    The longest fitting rule decides; else a page is blocked if its host's lower
    bound of the bad rate exceeds ``max_bad``. Hosts without outcomes, null urls
    and urls without ``://`` (host and path empty) have no evidence and are
    allowed. Repeated rows are judged alike, one output row each; further
    columns of the inputs are ignored. Empty tables give empty results.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    known = reputation(outcomes, outcome_url, bad_col, suffixes, z)
    known = cut_lineage(known.select(F.col("host").alias("of_host"), F.col("n").alias("n_labelled"), "post_low"))
    joined = rows.join(known, F.col("host") == F.col("of_host"), "left")
    rule = matching_rule(F.col("host"), F.col("path"), rules) if rules else F.lit(None).cast("struct<rule:string,verdict:string>")
    bad = F.coalesce(F.col("post_low"), F.lit(0.0)) > max_bad
    return joined.withColumn("__rule", rule).select(
        id_col, "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce(F.col("__rule.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("n_labelled", F.lit(0)).alias("n_labelled"), "post_low",
    )
