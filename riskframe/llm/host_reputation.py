"""URL filters by empirical-Bayes host reputation.

Labelled pages of a host are few, so its rate of bad pages is shrunk towards
its registered domain's, that towards its suffix's, and that towards the rate
of all pages: each level is a beta-binomial whose prior has the parent's mean
and a strength estimated from how much the level's groups differ (method of
moments).  A host without labelled pages has its domain's, suffix's or all
pages' rate, with the variance that hosts have around it.  A host is blocked
if a lower posterior bound of its rate of bad pages lies above the rate of all
pages by ``margin`` of what is left to 1.  Built-in functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import scratch_table

# Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "or.jp",
                      "co.nz", "com.br", "com.cn", "co.in", "co.za"]
# Hand rules (rule, verdict).
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
MARGIN, BOUND_Z = 0.15, 1.645
#: Prior strengths stay within these, in pages.
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0
LEVELS = ["suffix", "domain", "host"]


def url_parts(url):
    """(host, path) columns: after the first ``://`` up to ``/ ? #``, A-Z
    lower-cased; then up to ``? #``.  Null or without ``://``: both empty."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), string.ascii_uppercase, string.ascii_lowercase), part(2)


def bare_name(host):
    """The host without user name and port: what is registered."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def is_address(name):
    return name.rlike(r"^[0-9.]+$") | name.startswith("[")


def suffix_of(host):
    """The last label, or two listed ones; an address is its own suffix."""
    name = bare_name(host)
    two = F.substring_index(name, ".", -2)
    return F.when(is_address(name), name).when(two.isin(TWO_LABEL_SUFFIXES), two) \
        .otherwise(F.substring_index(name, ".", -1))


def domain_of(host):
    """The suffix and one label before it; an address is its own domain."""
    name = bare_name(host)
    two = F.substring_index(name, ".", -2)
    return F.when(is_address(name), name) \
        .when(two.isin(TWO_LABEL_SUFFIXES), F.substring_index(name, ".", -3)).otherwise(two)


def matching_rule(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits: its host or a subdomain
    of it, and a path that starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):      # later, longer ones win
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _level(groups: DataFrame, parents: DataFrame, key: str, parent: str) -> DataFrame:
    """Shrink ``groups`` (key, parent, n, bad) towards ``parents`` (parent, mean,
    var); a prior mean is itself uncertain, so its variance is handed down.

    Strength m by moments: the variance of the groups' rates beyond binomial
    noise is p (1 - p) / (m + 1), weighted by pages; one value per level.
    A group without pages takes its prior.
    """
    g = groups.join(parents.select(parent, F.col("mean").alias("prior"), F.col("var").alias("prior_var")), parent)
    noise = F.sum(F.when(F.col("n") > 1, F.col("prior") * (1 - F.col("prior"))))
    spread = F.sum(F.when(F.col("n") > 1, F.pow(F.col("bad") / F.col("n") - F.col("prior"), F.lit(2.0))))
    within = F.sum(F.when(F.col("n") > 1, F.col("prior") * (1 - F.col("prior")) / F.col("n")))
    extra = F.greatest(F.coalesce(spread - within, F.lit(0.0)), F.lit(0.0))
    full = F.coalesce(noise - within, F.lit(0.0))
    # extra / full estimates 1 / (m + 1) for groups of many pages
    strength = F.when(extra * MOST_STRENGTH <= full, F.lit(MOST_STRENGTH)) \
        .otherwise(F.greatest(F.coalesce(full / F.nullif(extra, F.lit(0.0)) - 1, F.lit(MOST_STRENGTH)),
                              F.lit(LEAST_STRENGTH)))
    m = F.lit(float(g.agg(strength).first()[0]))        # one number per level
    mean = (F.col("bad") + m * F.col("prior")) / (F.col("n") + m)
    # the group's own variance, and its share of the parent's
    var = F.col("mean") * (1 - F.col("mean")) / (F.col("n") + m + 1) \
        + F.pow(m / (F.col("n") + m), F.lit(2.0)) * F.col("prior_var")
    return g.withColumn("mean", mean).withColumn("var", var)


def host_posteriors(hosts: DataFrame) -> DataFrame:
    """(host, n, mean, lower, root) of hosts (host, n labelled pages, bad ones
    among them); n may be 0.  ``root`` is the rate of all labelled pages."""
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    hosts = scratch_table(hosts, "hosts")        # read once for each level
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")) \
        .withColumn("root", F.lit(""))
    # one extra good and one extra bad page keep the rate of all pages off 0 and 1
    root = suffixes.groupBy("root").agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("mean"),
                                       F.sum("n").alias("n")) \
        .withColumn("var", F.col("mean") * (1 - F.col("mean")) / (F.col("n") + 3))
    s = _level(suffixes, root, "suffix", "root")
    d = _level(domains, s, "domain", "suffix")
    h = _level(hosts.select("host", "domain", "n", "bad"), d, "host", "domain")
    whole = root.first()                          # one row
    return h.select("host", "n", "mean", (F.col("mean") - BOUND_Z * F.sqrt("var")).alias("lower"),
                    F.lit(float(whole["mean"]) if whole else 0.5).alias("root"))


def url_filter(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
               label_id: str = "doc_id", rules=RULES, margin: float = MARGIN) -> DataFrame:
    """Per page: host, path, the hand rule that fits (else null) and the
    verdict, the rule's or else the host's reputation; ``n_labelled`` pages of
    the host and ``lower``, its bound.

    A page is bad if the label of its number (``label_id``; the numbers of
    labels are page numbers) says low quality or toxic.  A null url has an
    empty host, which is a host like any other; a null page id has no label.
    Repeated rows of a page are judged each; a page counts once for each of
    its label rows.  Without labels the rate of all pages is 1/2, and no host
    is above it.
    """
    host, path = url_parts(pages[url_col])
    base = pages.select(pages[id_col], host.alias("host"), path.alias("path"))
    marks = labels.select(labels[label_id].alias("__id"),
                          F.when((labels["quality"] == 0) | (labels["toxic"] == 1), 1).otherwise(0).alias("bad"))
    seen = base.join(marks, base[id_col] == marks["__id"]).groupBy("host") \
        .agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    every = base.select("host").distinct()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    known = host_posteriors(every.join(seen, "host", "left").select("host", zero("n"), zero("bad"))) \
        .select(F.col("host").alias("__host"), "lower", "root", F.col("n").alias("n_labelled"))
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    learnt = F.when(F.col("lower") > F.col("root") + margin * (1 - F.col("root")), "block").otherwise("allow")
    return base.join(known, base["host"] == known["__host"]).select(
        base[id_col], "host", "path", rule.alias("rule"), F.coalesce(says, learnt).alias("verdict"),
        "n_labelled", "lower")
