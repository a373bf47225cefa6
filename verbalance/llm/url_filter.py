"""URL filter by host reputation, shrunk from host to registered domain to suffix.

Labelled pages give each host a count of good and bad outcomes. A host's rate is drawn
towards its domain's, a domain's towards its suffix's, a suffix's towards the whole, each by a
beta-binomial prior whose strength is estimated from the spread at that level. A host is blocked
if even the lower bound of its posterior rate of bad pages is high.
"""

from pyspark.sql import functions as F

from verbalance import session

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rules of the query: verdict, host and path.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
BLOCK_ABOVE = 0.2
DEVIATIONS = 1.645
# Strength of a prior in pages: never less or more than this.
WEAKEST, STRONGEST = 1.0, 1000.0
# Second-level names under which country domains are registered.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


def host_of(url):
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, UPPER.lower())


def path_of(url):
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _labels(host):
    """The dotted parts of a host without user and port."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    return F.split(bare, r"\.", -1)


def _last_parts(parts, n):
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), n), ".")


def domain_and_suffix(host):
    """The registered domain of a host, and the suffix it is registered under."""
    parts = _labels(host)
    country = (
        (F.size(parts) > 2)
        & (F.length(F.element_at(parts, -1)) == 2)
        & F.get(parts, F.size(parts) - 2).isin(*SECOND_LEVEL)
    )
    suffix_size = F.when(country, 2).otherwise(1)
    return _last_parts(parts, suffix_size + 1), _last_parts(parts, suffix_size)


def matching_rule(host, path, rules=RULES):
    """The longest rule that fits, as ``struct<rule, verdict>``; null if none does."""
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(
            path, F.lit(slash + rest)
        )
        named = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, named).otherwise(fitting)
    return fitting


def _strength(children, mean):
    """Pages the prior counts for, by the method of moments over one level's children.

    ``children`` has ``n, bad`` and ``mean``, the rate of the parent. Outcomes vary by
    ``mean (1 - mean) (1 + (n - 1) r)`` around it; ``r`` is solved for over all children.
    """
    rate = F.col("bad") / F.col("n")
    spread = F.col("n") * F.pow(rate - mean, F.lit(2)) / (mean * (1 - mean))
    row = (
        children.where((F.col("n") > 0) & (mean > 0) & (mean < 1))
        .agg(F.sum(spread).alias("spread"), F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("n"))
        .first()
    )
    if not row["nodes"] or row["n"] <= row["nodes"]:
        return STRONGEST
    likeness = (row["spread"] - row["nodes"]) / (row["n"] - row["nodes"])
    if likeness <= 0:
        return STRONGEST
    return min(max(1 / likeness - 1, WEAKEST), STRONGEST)


def _shrunk(strength):
    return (F.col("bad") + strength * F.col("mean")) / (F.col("n") + strength)


def host_reputation(outcomes, block_above=BLOCK_ABOVE, deviations=DEVIATIONS):
    """``host, blocked, rate, bound`` from rows ``host, bad`` (null: no outcome known)."""
    spark = outcomes.sparkSession
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    hosts = session.written(
        hosts.select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix")),
        session.scratch_path(spark, "hosts"),
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = session.written(domains, session.scratch_path(spark, "domains"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = session.written(suffixes, session.scratch_path(spark, "suffixes"))
    whole = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    overall = whole[1] / whole[0] if whole[0] else 0.0

    suffixes = suffixes.withColumn("mean", F.lit(float(overall)))
    strength = _strength(suffixes, F.col("mean"))
    by_suffix = suffixes.select("suffix", _shrunk(strength).alias("mean"))
    domains = domains.join(by_suffix, "suffix")
    strength = _strength(domains, F.col("mean"))
    by_domain = domains.select("domain", "suffix", _shrunk(strength).alias("mean"))
    hosts = hosts.join(by_domain, ["domain", "suffix"])
    strength = _strength(hosts, F.col("mean"))
    rate = _shrunk(strength)
    error = F.sqrt(rate * (1 - rate) / (F.col("n") + strength + 1))
    bound = rate - F.lit(deviations) * error
    return hosts.select(
        "host", rate.alias("rate"), bound.alias("bound"), (bound > block_above).alias("blocked")
    )


def judge(pages, labels, rules=RULES, block_above=BLOCK_ABOVE, deviations=DEVIATIONS):
    """A verdict on the url of every page.

    ``pages`` needs ``page_id`` and ``url``, ``labels`` ``doc_id`` (the page's id) and ``quality``, of which 0
    is a bad outcome; other columns are ignored, the html among them. An id with several
    labels counts once, as bad if one says so. A url that is null or has no ``://`` has empty
    host and path; such pages are one host. Hosts without outcomes get their domain's
    rate; without any outcome nothing is blocked but by rule. Each row is judged by
    its url, so repeated rows agree.

    Returns ``page_id, host, path, rule, verdict`` and the host's ``rate`` and ``bound``.
    """
    outcome = (
        labels.select("doc_id", (F.col("quality") == 0).cast("int").alias("bad"))
        .where("doc_id is not null and bad is not null")
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max("bad").alias("bad"))
    )
    own = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    outcomes = own.join(outcome, F.col("page_id") == F.col("labelled"), "left").select("host", "bad")
    reputation = host_reputation(outcomes, block_above, deviations)
    fitting = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    return (
        own.join(reputation, "host")
        .withColumn("fitting", fitting)
        .select(
            "page_id",
            "host",
            "path",
            F.col("fitting.rule").alias("rule"),
            F.coalesce("fitting.verdict", method).alias("verdict"),
            "rate",
            "bound",
        )
    )
