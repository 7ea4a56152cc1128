"""URL verdicts: path rules first, then trust and distrust spread over the graph of hosts.

Hosts are the nodes; a page's absolute links and its "(c) host" owner line are edges, counted once
per pair of hosts before anything else.  Trust starts at hosts by the share of their pages that a rule
allows and follows links; distrust starts by the share of pages a rule blocks and follows links
backwards, to those who link there.  Both are personalised PageRank in units of one full seed
(score = seed + damping * incoming share), iterated to a tolerance as one table keyed by (host, kind).
Mass at hosts without links ends there.  A host is blocked if distrust exceeds trust by the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import from_zero, lower_az
from tidemark.session import stored

#: (host, path prefix, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""
OWNER = r"(?:&copy;|©)\s*([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substr(rest, F.length(host) + 1)
    return lower_az(host), F.regexp_extract(tail, r"^[^?#]*", 0)


def with_rule(pages: DataFrame, rules: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` to rows with ``host`` and ``path``; the longest rule wins.

    Rules meet the distinct hosts through their suffixes, so any number of rules is one equi-join.
    """
    spark = pages.sparkSession
    listed = F.array(*[
        F.struct(F.lit(h).alias("rule_host"), F.lit(p).alias("prefix"), F.lit(v).alias("verdict")) for h, p, v in rules
    ])
    known = spark.range(1).select(F.inline(listed))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        from_zero(F.size(labels)), lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")
    )
    hosts = pages.select("host").distinct().withColumn("rule_host", F.explode(suffixes))
    fit = F.struct(
        F.length(F.concat("rule_host", "prefix")).alias("n"),
        F.concat("rule_host", "prefix").alias("rule"),
        "prefix",
        "verdict",
    )
    # at most one entry per rule
    per_host = hosts.join(known, "rule_host").groupBy("host").agg(F.collect_list(fit).alias("fits"))
    joined = pages.join(per_host, "host", "left")
    best = F.array_max(F.filter("fits", lambda x: F.startswith(F.col("path"), x["prefix"])))
    return joined.withColumn("best", best).select(
        *pages.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict")
    )


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts; rows need ``host`` and ``html``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    targets = F.array_union(
        F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), F.regexp_extract_all(html, F.lit(OWNER), F.lit(1))
    )
    links = pages.select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
    links = links.withColumn("dst", lower_az(F.col("dst"))).where("src <> dst and src <> ''")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, tolerance: float = 1e-6, damping: float = 0.85) -> DataFrame:
    """(host, kind, score) from edges (src, dst, n) and seeds (host, kind, seed).

    kind 0 follows edges, kind 1 runs against them.  A round moves only what arrived in the one before
    (``fresh``) and is written to the shared folder, so a plan never holds more than one.  What is still to
    arrive anywhere is at most the sum of ``fresh`` times damping / (1 - damping); rounds stop when that is
    at most ``tolerance``, so every score is that close to its limit, whatever the length of chains and
    cycles.  As each round leaves at most ``damping`` of that sum, the number of rounds grows with the
    logarithm of the number of hosts; without edges there is one.
    """
    ahead = edges.select(F.col("src").alias("host"), F.lit(0).alias("kind"), F.col("dst").alias("to"), "n")
    back = edges.select(F.col("dst").alias("host"), F.lit(1).alias("kind"), F.col("src").alias("to"), "n")
    flow = ahead.unionByName(back)
    totals = flow.groupBy("host", "kind").agg(F.sum("n").alias("total"))
    flow = stored(
        flow.join(totals, ["host", "kind"]).select("host", "kind", "to", (F.col("n") / F.col("total")).alias("share")),
        "host-flow",
    )
    scores = stored(seeds.select("host", "kind", F.col("seed").alias("score"), F.col("seed").alias("fresh")), "host-scores")
    nothing = F.lit(0.0)
    while True:
        moved = flow.join(scores.where("fresh > 0"), ["host", "kind"]).select(
            F.col("to").alias("host"), "kind", (damping * F.col("fresh") * F.col("share")).alias("fresh")
        )
        both = scores.withColumn("fresh", nothing).unionByName(moved.withColumn("score", F.col("fresh")))
        scores = stored(both.groupBy("host", "kind").agg(F.sum("score").alias("score"), F.sum("fresh").alias("fresh")), "host-scores")
        left = scores.agg(F.sum("fresh")).first()[0] or 0.0
        if left * damping / (1 - damping) <= tolerance:
            return scores.drop("fresh")


def judge(
    pages: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    tolerance: float = 1e-6,
    damping: float = 0.85,
    threshold: float = 0.5,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, trust, distrust.

    Null urls, urls without ``://`` and unlinked hosts have scores 0 and are allowed unless a rule
    blocks them; null html has no links.  Repeated rows stay; other columns are not read; an empty
    table gives an empty result.
    """
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    edges = host_edges(split)
    ruled = stored(with_rule(split.select("page_id", "host", "path"), rules), "url-rules")
    shares = ruled.groupBy("host").agg(
        F.avg((F.coalesce("rule_verdict", F.lit("")) == "allow").cast("double")).alias("allowed"),
        F.avg((F.coalesce("rule_verdict", F.lit("")) == "block").cast("double")).alias("blocked"),
    )
    seeds = shares.select(
        "host",
        F.inline(F.array(
            F.struct(F.lit(0).alias("kind"), F.col("allowed").alias("seed")),
            F.struct(F.lit(1).alias("kind"), F.col("blocked").alias("seed")),
        )),
    ).where("seed > 0")
    scores = propagate(edges, seeds, tolerance, damping)
    per_host = scores.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == 1, F.col("score")).otherwise(0.0)).alias("distrust"),
    )
    judged = ruled.join(per_host, "host", "left").fillna(0.0, ["trust", "distrust"])
    by_host = F.when(F.col("distrust") - F.col("trust") >= threshold, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_host).alias("verdict"), "trust", "distrust"
    )
