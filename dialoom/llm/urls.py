"""URL filters: host and path rules first, then trust and distrust spread over the links between hosts.

Hosts with pages that a rule allows are trusted seeds, hosts with blocked pages distrusted ones, each by its number of
such pages. Personalised PageRank carries trust along the links from the trusted seeds, and distrust against them from
the blocked ones (who links to a bad host is suspect). A host whose distrust outweighs its trust is blocked.

Links are those in a page's html to other hosts. Sites whose pages link only within themselves are tied by their names:
a host and its parent domain link to each other as long as the parent has two labels.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule, and is allowed, as is any host that
neither trust nor distrust reaches, or that both reach alike; a null html has no links; pages and urls of any length are
read whole; repeated rows count as often as they occur; an empty table gives an empty one; an input
column named like an output is replaced, others are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, settle, small, table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, for paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)
#: Share of a rank that follows links, rounds, distrust that a unit of trust outweighs.
DAMPING, ROUNDS, TOLERANCE = 0.85, 12, 1.0


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def host_links(pages: DataFrame, html: str) -> DataFrame:
    """(src, dst, weight) between different hosts, from the absolute links of pages with their host."""
    found = F.regexp_extract_all(
        F.col(html), F.lit(r"""(?i)\b(?:href|src)\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), 1
    )
    target = F.col("link")
    target = F.when(target.startswith("//"), F.concat(F.lit("http:"), target)).otherwise(target)
    return (
        pages.filter("host <> ''").select(F.col("host").alias("src"), F.explode(F.array_distinct(found)).alias("link"))
        .select("src", host_of(target).alias("dst")).filter("dst <> '' and dst <> src")
        .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def family_links(hosts: DataFrame) -> DataFrame:
    """(src, dst, weight) between each host and its parent domain, both ways, up to parents of two labels."""
    labels = F.split("host", r"\.")
    chain = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    steps = (
        hosts.filter(F.size(labels) > 2)
        .select(F.explode(F.arrays_zip(F.slice(chain, 1, F.size(chain) - 1).alias("low"), F.slice(chain, 2, F.size(chain)).alias("high"))).alias("x"))
        .select(F.col("x.low").alias("low"), F.col("x.high").alias("high")).distinct()
    )
    up = steps.select(F.col("low").alias("src"), F.col("high").alias("dst"))
    down = steps.select(F.col("high").alias("src"), F.col("low").alias("dst"))
    return up.unionByName(down).withColumn("weight", F.lit(1.0))


def spread(edges: DataFrame, seeds: DataFrame, damping: float, rounds: int) -> DataFrame:
    """(kind, host, rank): PageRank that restarts at the seeds, for each kind of its own.

    ``edges`` has kind, src, dst, weight and ``seeds`` kind, host, share. What a host without links would pass on goes
    back to the seeds, so that the ranks of a kind always sum to one.
    """
    total = edges.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    shares = cut(edges.join(total, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("total")).alias("part")))
    linking = settle(shares.select("kind", "host").distinct())
    seeds, n = settle(seeds.select("kind", "host", "share"))
    ranks = seeds.select("kind", "host", F.col("share").alias("rank"))
    for _ in range(rounds):
        moved = shares.join(small(ranks, n), ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("part") * damping).alias("rank"))
        # what hosts with links pass on; the rest of each kind's mass, one row a kind, returns to the seeds
        kept = ranks.join(small(*linking), ["kind", "host"]).groupBy("kind").agg(F.sum(F.col("rank") * damping).alias("kept"))
        back = seeds.join(F.broadcast(kept), "kind", "left").select(
            "kind", "host", (F.col("share") * (1 - F.coalesce("kept", F.lit(0.0)))).alias("rank")
        )
        ranks, n = settle(moved.unionByName(back).groupBy("kind", "host").agg(F.sum("rank").alias("rank")))
    return ranks


def judge_hosts(pages: DataFrame, html: str = "html", damping: float = DAMPING, rounds: int = ROUNDS, ties: bool = True) -> DataFrame:
    """(host, trust, distrust) of every host that either reaches; ``pages`` has host, ruled (a verdict or null), html.

    ``ties`` links hosts to their parent domains besides the links in pages.
    """
    counted = cut(pages.filter("host <> ''").groupBy("host", "ruled").agg(F.count(F.lit(1)).alias("n")))
    links = host_links(pages, html)
    links = links.unionByName(family_links(counted.select("host").distinct())) if ties else links
    links = cut(links.groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    ahead = links.withColumn("kind", F.lit("trust"))
    against = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight").withColumn("kind", F.lit("distrust"))
    marked = counted.filter("ruled is not null").select(F.when(F.col("ruled") == "allow", "trust").otherwise("distrust").alias("kind"), "host", "n")
    sums = marked.groupBy("kind").agg(F.sum("n").alias("all"))
    seeds = marked.join(sums, "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("share"))
    ranks = spread(ahead.unionByName(against), seeds, damping, rounds)
    value = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    return ranks.groupBy("host").agg(value("trust"), value("distrust"))


def filter_urls(
    df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
    rules: tuple[Rule, ...] = RULES, tolerance: float = TOLERANCE, ties: bool = True,
) -> DataFrame:
    """(key, host, path, rule, verdict, trust, distrust) of every row; without ``ties``, hosts are linked by pages only."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    parsed = df.select(F.col(key), host.alias("host"), path.alias("path"), F.col(html).alias("_html"))
    name, verdict = first_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.select(key, "host", "path", "_html", name.alias("rule"), verdict.alias("ruled"))
    scores = judge_hosts(ruled.select("host", "ruled", F.col("_html").alias("html")), ties=ties)
    out = ruled.drop("_html").join(scores, "host", "left")
    method = F.when(F.coalesce(F.col("distrust") > tolerance * F.col("trust"), F.lit(False)), "block").otherwise("allow")
    return out.select(key, "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")


def op5_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"))
