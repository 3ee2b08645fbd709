"""Host reputation by empirical Bayes, and rules on hosts and paths.

Labelled outcomes of pages are counted per host, registered domain and suffix. Each
level's beta prior has the mean of the level above it, and a strength found by the
method of moments from the spread of that level's rates. A page is blocked when the
lower bound of its host's posterior rate of bad pages is over a limit.

Nulls: a null url, or one without ``://``, has an empty host and path, and the host's
reputation is that of the empty host. A null outcome is no outcome. Repeated pages count
each time. An empty table gives no rows. Very long urls are read whole. Ties between rules
are settled in ``rule_of``. Columns of the names that are added are replaced, all others
are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sahaf.session import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels under which names are registered; any other suffix is the last label. Fixed values.
TWO_LABELS = [
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "com.cn", "com.mx",
    "com.tr", "gov.tr", "org.tr", "co.in", "co.jp", "ne.jp", "or.jp", "co.kr", "co.nz", "co.za",
]
#: Posterior bound: so many standard deviations below the mean; and the largest rate of bad pages it may show.
DEVIATIONS, MAX_BAD = 2.0, 0.3
#: Strength of a prior where the rates of a level don't differ more than chance, and its least value.
MOST_STRENGTH, LEAST_STRENGTH = 1000.0, 1.0

Rule = tuple[str, str, str]


def with_host(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path, both empty for a null url or one without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return pages.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_of(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The rule that fits with the longest text, and its verdict; null where none fits.

    A rule is (verdict, host, path): it fits the host itself and its subdomains where the
    url's path starts with the rule's. Of two equally long ones, a block comes first.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1:]))
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in reversed(ordered):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        text, verdict = F.when(fits, name + start).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


#: User information and a port, which name no host; hosts that are addresses.
USER, PORT, ADDRESS = r"^.*@", r":[0-9]*$", r"^(\[.*|[0-9]+(\.[0-9]+){3})$"


def name_of(host: Column) -> Column:
    """The host without user information and port."""
    return F.regexp_replace(F.regexp_replace(host, USER, ""), PORT, "")


def suffix(host: Column, two_labels: list[str] = TWO_LABELS) -> Column:
    """The suffix under which a host's name is registered; an address is its own."""
    name = name_of(host)
    two = F.substring_index(name, ".", -2)
    named = F.when(two.isin(two_labels), two).otherwise(F.substring_index(name, ".", -1))
    return F.when(name.rlike(ADDRESS), name).otherwise(named)


def domain(host: Column, two_labels: list[str] = TWO_LABELS) -> Column:
    """The registered domain: one label more than the suffix; an address is its own."""
    name = name_of(host)
    two = F.substring_index(name, ".", -2)
    named = F.when(two.isin(two_labels), F.substring_index(name, ".", -3)).otherwise(two)
    return F.when(name.rlike(ADDRESS), name).otherwise(named)


def shrunk(own: DataFrame, key: str, above: DataFrame, parent: str) -> DataFrame:
    """(key, parent.., bad, n, mean, strength): rates of a level drawn towards its parent's mean.

    Strength by moments: with rates r = bad / n around parent means m, the excess of
    sum n (r - m)^2 over its value under pure chance gives the share rho of the variance
    that lies between the units; the strength is 1 / rho - 1.
    """
    joined = own.join(above.select(parent, F.col("mean").alias("_m")), parent)
    chance = F.col("_m") * (1 - F.col("_m"))
    r = F.col("bad") / F.col("n")
    # Both sums have one row per unit of the level below, so they are combined before they meet.
    sums = joined.where("n > 0").agg(
        F.sum(F.col("n") * (r - F.col("_m")) * (r - F.col("_m"))).alias("_s"),
        F.sum(chance).alias("_c"),
        F.sum(F.col("n") * chance).alias("_t"),
    )
    rho = (F.col("_s") - F.col("_c")) / (F.col("_t") - F.col("_c"))
    strength = F.when((F.col("_t") > F.col("_c")) & (F.col("_s") > F.col("_c")), 1 / rho - 1).otherwise(MOST_STRENGTH)
    bounded = F.least(F.greatest(strength, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))
    one = sums.select(F.coalesce(bounded, F.lit(MOST_STRENGTH)).alias("strength"))
    # One row, so the broadcast has a fixed size.
    level = joined.join(F.broadcast(one))
    mean = (F.col("bad") + F.col("strength") * F.col("_m")) / (F.col("n") + F.col("strength"))
    return level.withColumn("mean", mean).withColumnRenamed("_m", "prior")


def reputation(pages: DataFrame, deviations: float = DEVIATIONS, two_labels: list[str] = TWO_LABELS) -> DataFrame:
    """(host, labelled, bad_pages, posterior, bound) from rows (host, bad): 1, 0 or null where not labelled."""
    counts = pages.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    counts = counts.withColumn("domain", domain(F.col("host"), two_labels)).withColumn("suffix", suffix(F.col("host"), two_labels))
    counts = staged(counts, "host-counts")
    domains = counts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # Half a page of each outcome keeps the root's mean inside (0, 1).
    root = suffixes.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1.0)).alias("mean")).withColumn("root", F.lit(0))
    top = shrunk(suffixes.withColumn("root", F.lit(0)), "suffix", root, "root").select("suffix", "mean")
    middle = shrunk(domains, "domain", top, "suffix").select("domain", "mean")
    last = shrunk(counts, "host", middle, "domain")
    a = F.col("bad") + F.col("strength") * F.col("prior")
    b = F.col("n") - F.col("bad") + F.col("strength") * (1 - F.col("prior"))
    spread = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return last.select(
        "host", F.col("n").alias("labelled"), F.col("bad").alias("bad_pages"), F.col("mean").alias("posterior"),
        F.greatest(F.lit(0.0), F.col("mean") - deviations * spread).alias("bound"),
    )


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: list[Rule], deviations: float = DEVIATIONS, max_bad: float = MAX_BAD,
    two_labels: list[str] = TWO_LABELS,
) -> DataFrame:
    """Adds host, path, rule, verdict and the host's reputation to pages (page_id, url).

    ``outcomes`` is (page_id, bad): a page with several outcomes takes its worst. The
    pages meet their host's row in a join that Spark splits where one host has very many.
    """
    known = outcomes.where("page_id IS NOT NULL").groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row")
    named = with_host(pages.select("page_id", "url", row))
    scored = reputation(named.select("page_id", "host").join(known, "page_id", "left"), deviations, two_labels)
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    own = F.when(F.col("bound") > max_bad, "block").otherwise("allow")
    added = {"host": F.col("host"), "path": F.col("path"), "rule": rule, "verdict": F.coalesce(verdict, own)}
    added |= {c: F.col(c) for c in ("labelled", "bad_pages", "posterior", "bound")}
    kept = [F.col(f"row.`{c}`").alias(c) for c in pages.columns if c not in added]
    return named.join(scored, "host").select(*kept, *[v.alias(c) for c, v in added.items()])
