"""URL filter by rules and by trust spread over the host graph (operator 6).

Rules decide the urls that they fit. Every other url gets the verdict of its host: personalised
PageRank spreads trust from hosts with allowed pages along links, and distrust from hosts with
blocked pages against them, since a host that links to blocked ones is suspect. A host is blocked
where its distrust exceeds its trust.

Edges and seeds are aggregated per host before any join; ranks of both kinds are one table, which is
written every few rounds. DataFrame operations only.

Special cases: a url without ``://``, or null, has an empty host and path, fits no rule and is no
node of the graph: it is allowed. A null html has no links. Links without a host stay inside their
own host and add no edge. Repeated pages are returned as often as they occur and count as often.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import ascii_lower
from wardlens.session import materialize


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (UrlRule("block", "net", "/"), UrlRule("allow", "example.net", "/en/"),
         UrlRule("block", "example.com", "/de/"), UrlRule("allow", "org", "/fr/"))
ROUNDS = 12
WRITE_EVERY = 4
DAMPING = 0.85
LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]*)"""


def _after(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    place = F.instr(url, "://")
    return F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def with_rules(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """page_id, host, path, the longest rule that fits, and its verdict; null where none fits."""
    parts = pages.withColumn("host", host_of(F.coalesce("url", F.lit("")))).withColumn(
        "path", path_of(F.coalesce("url", F.lit(""))))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return parts.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """(host, other, links): links between different hosts, counted."""
    links = pages.select(host_of("url").alias("host"), F.explode(
        F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("link"))
    target = host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit(":"), "link")).otherwise(F.col("link")))
    return (links.select("host", target.alias("other")).filter("host <> other AND host <> '' AND other <> ''")
            .groupBy("host", "other").agg(F.count("*").alias("links")))


def spread(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Personalised PageRank: seeds (kind, host, seed), edges (kind, host, other, share)."""
    ranks = seeds.select("kind", "host", F.col("seed").alias("rank"))
    for k in range(rounds):
        moved = ranks.join(edges, ["kind", "host"]).select(
            "kind", F.col("other").alias("host"), (DAMPING * F.col("rank") * F.col("share")).alias("rank"))
        restart = seeds.select("kind", "host", ((1 - DAMPING) * F.col("seed")).alias("rank"))
        ranks = moved.unionByName(restart).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if k % WRITE_EVERY == WRITE_EVERY - 1:
            ranks = materialize(ranks, "host-ranks")
    return ranks


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, rounds: int = ROUNDS) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    judged = with_rules(pages.select("page_id", "url"), rules)
    counts = materialize(judged.filter("host <> ''").groupBy("host").agg(
        F.count(F.when(F.col("rule_verdict") == "allow", 1)).alias("trust"),
        F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("distrust")), "host-seeds")
    seeds = counts.select("host", F.explode(F.create_map(
        F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "n")).filter("n > 0")
    sums = seeds.groupBy("kind").agg(F.sum("n").alias("all"))
    seeds = seeds.join(sums, "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("seed"))
    links = materialize(host_edges(pages.select("url", "html")), "host-edges")
    both = links.select(F.lit("trust").alias("kind"), "host", "other", "links").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("other").alias("host"), F.col("host").alias("other"), "links"))
    out = both.groupBy("kind", "host").agg(F.sum("links").alias("out"))
    edges = materialize(both.join(out, ["kind", "host"]).select(
        "kind", "host", "other", (F.col("links") / F.col("out")).alias("share")), "host-shares")
    ranks = spread(seeds, edges, rounds)
    hosts = ranks.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0.0)).alias("distrust"))
    bad = materialize(hosts.filter("distrust > trust").select("host", F.lit(True).alias("bad")), "bad-hosts")
    return judged.join(bad, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))
