"""URL filter: host reputation by empirical Bayes, and host/path rules, with DataFrame functions only.

Labelled pages give each host a number of outcomes and of bad ones. The share of bad pages is shrunk through beta-binomial priors: all
pages -> suffix -> registered domain -> host; each level's posterior mean is the next level's prior mean, and how strongly a level pulls is
estimated from how much the level's shares differ (method of moments). A host is blocked when the lower bound of its posterior share of
bad pages is above `limit`; a host without labels has its domain's (suffix's, all pages') posterior mean and a wide bound. In this hierarchy, not
in the result, a host stands without user name and port; its suffix is its last label or, if they are in SUFFIXES, its last two; its
registered domain has one label more; a numeric address is its own domain under the suffix "(address)".

Scale: pages are summed by host with map-side combining before anything is joined; the host table is joined back with a broadcast only if
its counted size allows, else by a shuffle whose hot hosts adaptive execution splits.

Defined results: a null url or one without :// has an empty host and path, no rule and the posterior of all pages (so has an empty host); null
labels are no outcome; repeated rows count each; an empty label table leaves the prior of all pages (half bad, no certainty): allow;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, checkpoint, join_checked

#: (host, path, verdict) of the rules in force.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Public suffixes of two labels under which domains are registered; a parameter, to be replaced by a fuller list where there is one.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "org.uk", "plc.uk", "sch.uk", "com.au", "edu.au", "gov.au", "net.au", "org.au", "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz",
    "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "ac.kr", "co.kr", "go.kr", "or.kr", "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn", "com.hk", "com.tw", "org.tw", "com.sg", "edu.sg", "com.my", "co.id", "or.id", "co.th",
    "in.th", "com.vn", "com.ph", "ac.in", "co.in", "gov.in", "net.in", "org.in", "com.pk", "co.il", "org.il", "com.tr", "gov.tr", "org.tr", "com.sa", "ac.ir", "co.ir", "ac.za", "co.za", "gov.za", "org.za", "com.eg", "com.ng",
    "co.ke", "com.br", "gov.br", "net.br", "org.br", "com.ar", "com.mx", "gob.mx", "org.mx", "com.co", "com.pe", "com.ve", "com.uy", "com.ua", "com.pl", "net.pl", "org.pl", "com.ru", "com.gr", "com.pt", "com.es", "co.at", "or.at",
)
ADDRESS = "(address)"
#: Posterior share of bad pages whose lower bound blocks a host, and how many standard deviations that bound is below the mean.
LIMIT, DEVIATIONS = 0.5, 1.645
#: Bounds of the prior's strength in pages.
LEAST, MOST = 2.0, 1000.0


def url_host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty if there is none."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), ASCII_UPPER, ASCII_LOWER)).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ? # or the end; empty if there is no ://."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def hierarchy(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column, Column]:
    """The host without user name and port, its registered domain and its suffix."""
    bare = F.regexp_replace(host, "^.*@|:[0-9]*$", "")
    address = bare.rlike(r"^([0-9.]+|\[.*)$")
    last = lambda n: F.substring_index(bare, ".", -n)
    double = last(2).isin(list(suffixes))
    return bare, F.when(address, bare).when(double, last(3)).otherwise(last(2)), F.when(address, F.lit(ADDRESS)).when(double, last(2)).otherwise(last(1))


def rule_fit(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule whose host is the url's or a parent of it and whose path begins the url's; else null."""
    fit = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):  # a longer rule is tested first
        fit = F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fit)
    return fit


def _strength(level: DataFrame) -> float:
    """Prior strength in pages by the method of moments, from a level's n, k and prior mean m."""
    p = F.col("k") / F.col("n")
    spread = F.sum(F.col("n") * (p - F.col("m")) * (p - F.col("m")))
    noise = F.sum(F.col("m") * (1 - F.col("m")))
    weight = F.sum("n") - F.count(F.lit(1))
    between = (spread - noise) / weight
    row = level.filter("n > 0").agg(F.when(weight > 0, F.when(between > 0, F.sum(F.col("m") * (1 - F.col("m"))) / F.count(F.lit(1)) / between - 1).otherwise(F.lit(MOST))).alias("s")).first()
    return round(min(MOST, max(LEAST, MOST if row.s is None else row.s)), 6)


def host_posteriors(outcomes: DataFrame, limit: float = LIMIT, deviations: float = DEVIATIONS, suffixes: Sequence[str] = SUFFIXES) -> tuple[DataFrame, float, float]:
    """From outcomes (host, bad 0/1 or null): for each bare host n, k, mean, deviation and low; and the mean and low of a page without a host."""
    counted = outcomes.groupBy(hierarchy(F.col("host"), suffixes)[0].alias("host")).agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    _, domain, suffix = hierarchy(F.col("host"), suffixes)
    every = checkpoint(counted.withColumn("domain", domain).withColumn("suffix", suffix))
    top = every.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    mean = (top.k + 1) / (top.n + 2)
    hosts = every.filter("host <> ''")

    def shrunk(level: DataFrame) -> tuple[DataFrame, float]:
        s = _strength(level)
        return level.withColumn("mean", (F.col("m") * s + F.col("k")) / (F.lit(s) + F.col("n"))), s

    suffixes, _ = shrunk(hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("m", F.lit(mean)))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains, _ = shrunk(join_checked(domains, suffixes.select("suffix", F.col("mean").alias("m")), "suffix"))
    own, s = shrunk(join_checked(hosts, domains.select("domain", F.col("mean").alias("m")), "domain"))
    size = F.lit(s) + F.col("n")
    own = own.withColumn("deviation", F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1)))
    own = own.withColumn("low", F.round(F.col("mean") - F.lit(deviations) * F.col("deviation"), 9))
    unknown = round(mean - deviations * (mean * (1 - mean) / (s + 1)) ** 0.5, 9)
    return own.select("host", "n", "k", "mean", "deviation", "low"), mean, unknown


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", limit: float = LIMIT, deviations: float = DEVIATIONS, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's posterior mean and lower bound. outcomes: (id, bad)."""
    parts = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    labelled = parts.select("page_id", "host").join(outcomes.select(F.col(outcomes.columns[0]).alias("page_id"), F.col(outcomes.columns[1]).alias("bad")), "page_id", "left")
    posteriors, mean, low = host_posteriors(labelled, limit, deviations, suffixes)
    fit = rule_fit(F.col("host"), F.col("path"), rules)
    known = checkpoint(posteriors.select(F.col("host").alias("bare"), "mean", "low"))
    judged = join_checked(parts.withColumn("fit", fit).withColumn("bare", hierarchy(F.col("host"), suffixes)[0]), known, "bare", "left")
    mean, low = F.coalesce("mean", F.lit(mean)), F.coalesce("low", F.lit(low))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(low > limit, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), F.round(mean, 6).alias("bad_share"), F.round(low, 6).alias("bad_share_low"))
