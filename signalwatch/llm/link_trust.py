"""URL filters: rules by host and path, and trust and distrust that spread over links of hosts.

Rules decide where one fits. Other pages are judged by their host: trust spreads along links from
hosts most of whose pages rules allow, distrust against links from hosts most of whose pages they block
(who links to a blocked host is suspect), each by personalised PageRank over the host graph. All of it are joins
and sums in Spark: the graph is one row for each pair of linked hosts, added up map-side, and no
host's links are ever gathered.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.llm.common import picked, settle

DAMPING = 0.85
#: Propagation ends when all hosts together change by less.
SMALL_CHANGE = 1e-6
#: Rounds of propagation, each is written once: a round changes at most DAMPING of what the one before
#: did, and the first at most 2, so that the change is small by then.
MOST_ROUNDS = math.ceil(math.log(SMALL_CHANGE / 2) / math.log(DAMPING)) + 1
#: A host is blocked if its distrust is more than so many times its trust.
TIMES_TRUST = 1.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``pattern``: a host and a path; it fits the host, its subdomains, and paths that start so."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


#: The rules of the registered query.
RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"),
         Rule("allow", "org/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host lies after the first :// up to /, ?, # or the end, the path then up to ?, # or the
    end; both are empty for null and without ://."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls; of equally long ones the first."""
    pattern = verdict = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.pattern)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) \
            & F.startswith(path, F.lit(rule.path))
        pattern = F.when(fits, rule.pattern).otherwise(pattern)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return pattern, verdict


def link_hosts(html: Column) -> Column:
    """The hosts of a page's absolute links, one for each link."""
    found = F.regexp_extract_all(
        F.coalesce(html, F.lit("")),
        F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""), F.lit(1))
    return F.transform(found, lambda h: F.translate(h, _UPPER, _LOWER))


def host_graph(pages: DataFrame) -> DataFrame:
    """``source, target, n``: how many links lead from one host to another, on all pages."""
    return (
        picked(pages, page_id="long", url="string", html="string")
        .select(host_and_path(F.col("url"))[0].alias("source"), link_hosts(F.col("html")).alias("to"))
        .where("source <> '' AND size(to) > 0")
        .select("source", F.explode("to").alias("target"))
        .where("source <> target AND target <> ''")
        .groupBy("source", "target").agg(F.count("*").alias("n"))
    )


def personalised_pagerank(edges: DataFrame, seeds: DataFrame, name: str, damping: float = DAMPING,
                          most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """``host, rank`` of a walk that restarts at ``seeds`` (``host``), along ``source, target, n``.

    Ranks add up to 1; what hosts without links hold goes back to the seeds. Without seeds the
    result is empty. Hosts not listed have rank 0.

    The links of a host meet its rank in a plain join of stored tables, which adaptive execution
    splits where a host has very many; ranks are added up by target, first in each task.
    """
    out = edges.groupBy("source").agg(F.sum("n").alias("total"))
    shares = settle(edges.join(out, "source").select(
        "source", "target", (F.col("n") / F.col("total")).alias("share")), f"{name}-shares")
    n_seeds = seeds.count()
    restart = seeds.select("host", (F.lit(1.0) / max(n_seeds, 1)).alias("restart"))
    rank = settle(restart.withColumnRenamed("restart", "rank"), f"{name}-0")
    if shares.isEmpty():
        return rank
    for step in range(1, most_rounds + 1):
        moved = shares.join(rank.withColumnRenamed("host", "source"), "source") \
            .groupBy(F.col("target").alias("host")) \
            .agg(F.sum(F.col("rank") * F.col("share")).alias("moved"))
        kept = moved.agg(F.sum("moved")).first()[0] or 0.0
        back = 1 - damping + damping * max(0.0, 1 - kept)
        new = settle(
            moved.join(restart, "host", "full").select(
                "host", (damping * F.coalesce("moved", F.lit(0.0))
                         + back * F.coalesce("restart", F.lit(0.0))).alias("rank")),
            f"{name}-{step}")
        change = new.join(rank.withColumnRenamed("rank", "old"), "host", "full").agg(F.sum(F.abs(
            F.coalesce("rank", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0] or 0.0
        rank = new
        if change < SMALL_CHANGE:
            break
    return rank


def host_trust(pages: DataFrame, rules: tuple[Rule, ...] = RULES,
               graph: DataFrame | None = None) -> DataFrame:
    """``host, trust, distrust, blocked`` of all hosts of pages and links.

    A host is a seed of trust if rules allow more than half of its pages, of distrust if they block
    more than half. A host that is only linked to counts as one page with the path /.
    """
    edges = settle(host_graph(pages) if graph is None else graph, "host-graph")
    host, path = host_and_path(F.col("url"))
    verdict = rule_for(F.col("host"), F.col("path"), rules)[1]
    own = picked(pages, page_id="long", url="string") \
        .select(host.alias("host"), path.alias("path")).where("host <> ''")
    linked = edges.select(F.explode(F.array("source", "target")).alias("host")).distinct() \
        .join(own.select("host").distinct(), "host", "left_anti") \
        .select("host", F.lit("/").alias("path"))
    hosts = settle(
        own.union(linked).withColumn("verdict", verdict).groupBy("host").agg(
            F.count("*").alias("n"), F.count(F.when(F.col("verdict") == "allow", 1)).alias("allowed"),
            F.count(F.when(F.col("verdict") == "block", 1)).alias("ruled_out")), "hosts")
    turned = edges.select(F.col("target").alias("source"), F.col("source").alias("target"), "n")
    trust = personalised_pagerank(edges, hosts.where("2 * allowed > n"), "trust") \
        .withColumnRenamed("rank", "trust")
    distrust = personalised_pagerank(turned, hosts.where("2 * ruled_out > n"), "distrust") \
        .withColumnRenamed("rank", "distrust")
    return hosts.select("host").join(trust, "host", "left").join(distrust, "host", "left") \
        .fillna(0.0, ["trust", "distrust"]) \
        .withColumn("blocked", F.col("distrust") > TIMES_TRUST * F.col("trust"))


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Return ``page_id, host, path, rule, verdict, trust, distrust`` for each page.

    The longest rule that fits decides (of equally long ones the first); else the host is blocked
    if its distrust is above its trust, and allowed on a tie, as without a host or links. A null
    url or one without :// has empty host and path. Repeated rows give repeated results. Other
    columns are ignored; rows without a page_id are left out. An empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    placed = picked(pages, page_id="long", url="string").select(
        "page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    trust = host_trust(pages, rules)
    return placed.withColumns({"rule": rule, "by_rule": verdict}).join(trust, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
