"""Operator 5: URL filters by explicit rules and link-graph propagation.

Pages that a rule fits take the rule's verdict.  For the others the host
decides: trust starts at hosts with allowed pages and follows links (a host
vouches for what it links to), distrust starts at hosts with blocked pages and
follows links backwards (a host answers for what it links to).  Both are
personalised PageRank vectors over host edges, iterated in Spark in units of
pages; a host is blocked when its distrust exceeds its trust and the stated
share of its pages.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from panelforge.llm.common import stage


class Rule(NamedTuple):
    """``action`` (allow or block) for a host with its subdomains, below a path."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Weight of the links against the seeds.
DAMPING = 0.85
#: A host is blocked from this much distrust per page of its own.
THRESHOLD = 0.5
#: Propagation ends when a round moves less than this share of all seed mass.
TOLERANCE = 1e-3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def ruled(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``pages`` (host, path) with ``rule`` and ``action`` of the longest fitting
    rule; of equally long ones the longer host, then blocking wins."""
    order = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.action != "block"))
    rule = action = None
    for r in order:
        hit = fits(r, F.col("host"), F.col("path"))
        rule = rule.when(hit, r.name) if rule is not None else F.when(hit, r.name)
        action = action.when(hit, r.action) if action is not None else F.when(hit, r.action)
    none = F.lit(None).cast("string")
    return pages.withColumns({"rule": none if rule is None else rule, "action": none if action is None else action})


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, n) among ``hosts`` (host): links between pages' hosts, and a
    subdomain's tie to its parent domain.  Links within a host are left out:
    they move nothing between hosts."""
    targets = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER)))
    links = pages.filter("host != '' and html is not null").select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
    parents = hosts.select(F.col("host").alias("src"), F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("dst")).filter("dst != ''")
    counted = links.filter("src != dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")).unionByName(parents.withColumn("n", F.lit(1).cast("long")))
    known = hosts.select(F.col("host").alias("dst"))
    return counted.join(known, "dst").groupBy("src", "dst").agg(F.sum("n").alias("n"))


def pagerank(hosts: DataFrame, edges: DataFrame, seed: str) -> DataFrame:
    """Personalised PageRank (host, rank) from column ``seed`` of ``hosts``;
    a host without edges keeps what it holds."""
    out = edges.groupBy("src").agg(F.sum("n").alias("_total"))
    flows = stage(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("_total")).alias("share")))
    fixed = hosts.join(out.select(F.col("src").alias("host"), F.lit(True).alias("linked")), "host", "left").select("host", F.col(seed).cast("double").alias("seed"), F.coalesce("linked", F.lit(False)).alias("linked"))
    fixed = stage(fixed)
    rank = fixed.select("host", "seed", "linked", F.col("seed").alias("rank"))
    mass = fixed.agg(F.sum("seed")).first()[0] or 0.0
    while True:  # each round shrinks the change by the damping at least
        moved = rank.filter("linked").join(flows, F.col("host") == F.col("src")).groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("into"))
        kept = F.when(F.col("linked"), 0.0).otherwise(F.col("rank"))
        new = (1 - DAMPING) * F.col("seed") + DAMPING * (F.coalesce("into", F.lit(0.0)) + kept)
        step = stage(rank.join(moved, "host", "left").select("host", "seed", "linked", new.alias("rank"), F.abs(new - F.col("rank")).alias("change")))
        rank = step.select("host", "seed", "linked", "rank")
        if (step.agg(F.sum("change")).first()[0] or 0.0) <= TOLERANCE * mass:
            return rank.select("host", "rank")


def judged(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict for rows (page_id, url, html).

    Null urls and urls without ``://`` have empty host and path; pages of the
    empty host without a rule are allowed.  Null html has no links.  Null ids
    and repeated rows are kept as they are (a repeated page counts twice).
    An empty table gives an empty result; further columns are ignored."""
    cut = pages.select("page_id", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = ruled(cut, rules)
    slim = stage(rows.drop("html"))
    seeds = slim.filter("host != ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("action") == "allow").alias("allowed"),
        F.count_if(F.col("action") == "block").alias("blocked"),
    )
    hosts = stage(seeds)
    edges = stage(host_edges(rows, hosts.select("host")))
    trust = pagerank(hosts, edges, "allowed").withColumnRenamed("rank", "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = pagerank(hosts, back, "blocked").withColumnRenamed("rank", "distrust")
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= THRESHOLD * F.col("pages"))
    scores = hosts.join(trust, "host").join(distrust, "host").filter(bad).select("host", F.lit("block").alias("host_verdict"))
    verdict = F.coalesce("action", "host_verdict", F.lit("allow"))
    return slim.join(scores, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
