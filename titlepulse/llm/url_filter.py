"""URL filter: rules first, then trust and distrust spread over the links between hosts.

A rule names a host and the beginning of a path; it fits the host and its subdomains, and the longest that fits
decides.  For every other url the method decides by its host.  Every host with pages that rules allow is a seed of trust, weighted by
their share of its pages, and every host with blocked pages one of distrust.  Personalised PageRank runs from the first
along links (who is linked from trusted hosts is trusted), and from the others against them (who links to blocked
hosts is distrusted), both on the scale of the weights.  A host is blocked where its distrust is at least ``MIN_DISTRUST`` of the
blocked seeds' mean and exceeds its trust ``RATIO`` times; otherwise it is allowed.  A seed's own blocked pages count
for its neighbours in any case, and for itself where they are more than half: one bad path condemns no host.

Links are grouped to weighted host edges before anything else, so a host's number of pages does not matter; ranks are
kept per host in written tables, one for each iteration.  A null url, or one without ``://``, has an empty host and
path, no rule, and is allowed.  Null pages hold no links; links inside a host do not count.  Repeated rows get equal
verdicts.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlepulse.llm.common import join_bounded, lower_ascii, once
from titlepulse.sources.shared import stage

# (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
ITERATIONS, DAMPING = 12, 0.85
MIN_DISTRUST, RATIO = 0.05, 2.0


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(rules) -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct of rule and verdict, else null."""
    chain = None
    for host, path, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        value = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return chain if chain is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst, n)``: links between different hosts, from the links of the pages with ``scheme://`` or ``//`` before a host."""
    linked = pages.select(
        host_of(F.col("url")).alias("src"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")), F.lit(r"(?i)href\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\s\"'>]+)"), 1)).alias("link"),
    )
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    ends = linked.select("src", host_of(full).alias("dst"))
    return ends.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def spread(seeds: DataFrame, edges: DataFrame, label: str, iterations: int = ITERATIONS) -> DataFrame:
    """``(host, score)``: personalised PageRank from ``seeds (host, weight)`` along ``edges (src, dst, share)``.

    Scores of the seeds' own restart sum to 1 - damping at each step; what hosts without links hold goes back nowhere,
    which lowers all scores alike and leaves their order.
    """
    total = seeds.agg(F.sum("weight").alias("total"))
    start = stage(seeds.join(F.broadcast(total), F.lit(True)).select("host", (F.col("weight") / F.col("total")).alias("score")), label)
    ranks = start
    for _ in range(iterations):
        moved = ranks.join(edges, ranks.host == edges.src).select(F.col("dst").alias("host"), (DAMPING * F.col("score") * F.col("share")).alias("score"))
        restart = start.select("host", ((1 - DAMPING) * F.col("score")).alias("score"))
        ranks = stage(moved.unionAll(restart).groupBy("host").agg(F.sum("score").alias("score")), label)
    return ranks


def host_verdicts(pages: DataFrame, judged: DataFrame) -> DataFrame:
    """``(host, blocked)`` for hosts that link-graph propagation has reached."""
    edges = stage(host_edges(pages), "host-edges")
    out = edges.groupBy("src").agg(F.sum("n").alias("all"))
    along = edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("share"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("all"))
    against = edges.join(into, "dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("n") / F.col("all")).alias("share"))
    # A host can be a seed of both.
    shares = stage(
        judged.where("host <> ''").groupBy("host").agg(
            F.avg(F.when(F.col("r.verdict") == "allow", 1.0).otherwise(0.0)).alias("good"),
            F.avg(F.when(F.col("r.verdict") == "block", 1.0).otherwise(0.0)).alias("bad"),
        ),
        "host-seeds",
    )
    if edges.isEmpty():
        # Nothing spreads: every seed keeps its own restart.
        steps = 0
    else:
        steps = ITERATIONS
    good = shares.where("good > 0").select("host", F.col("good").alias("weight"))
    bad = shares.where("bad > 0").select("host", F.col("bad").alias("weight"))
    all_good, all_bad, seeds = shares.agg(F.coalesce(F.sum("good"), F.lit(0.0)), F.coalesce(F.sum("bad"), F.lit(0.0)), F.count_if(F.col("bad") > 0)).first()
    # Scores sum to 1 on either side; times the sum of the weights they are comparable.
    trust = spread(good, along, "trust", steps).select("host", (F.col("score") * all_good).alias("trust"))
    distrust = spread(bad, against, "distrust", steps).select("host", (F.col("score") * all_bad).alias("distrust"))
    # Without links a seed's score is its weight, else its restart and what has come to it.
    own = bad.select("host", F.when(2 * F.col("weight") > 1, 0.0).otherwise(F.col("weight") * (1 - DAMPING if steps else 1.0)).alias("own"))
    both = distrust.join(trust, "host", "left").join(own, "host", "left").na.fill(0.0, ["trust", "own"])
    both = both.withColumn("distrust", F.col("distrust") - F.col("own"))
    enough = F.col("distrust") * seeds >= MIN_DISTRUST * all_bad
    return both.select("host", (enough & (F.col("distrust") > RATIO * F.col("trust"))).alias("blocked"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page."""
    bare = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").alias("html"))
    parts = once(bare.select("page_id", "url"), host=host_of(F.col("url")), path=path_of(F.col("url")))
    judged = once(parts, r=fitting_rule(rules))
    hosts = stage(host_verdicts(bare, judged), "host-verdicts").where("blocked")
    found = join_bounded(judged, hosts, "host", "left")
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow")))
    return found.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"))
