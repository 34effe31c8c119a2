"""URL filters: allow and block rules, and for urls without a rule trust and distrust propagated over the graph of hosts.

All of it is DataFrame operations. Rules are host and path prefix. Hosts are linked where a page of one refers to the other, and with the
domain they are a part of. Trust is a personalised PageRank from the hosts of allowed pages along the links; distrust one from the hosts of blocked pages
against them. A host is blocked if its distrust is more than ``ratio`` times its trust.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import cut, only_columns

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
DAMPING, ROUNDS_A_CUT, TOLERANCE, RATIO = 0.85, 4, 1e-3, 3.0
ROUNDS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
#: Relative error that sums of scores in another order may have.
SLIGHT = 1e-9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null and for urls without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The place in ``rules`` of the longest that fits: the rule's host or a subdomain of it, and a path that starts with the rule's. Null if none fits."""
    out = F.lit(None).cast("int")
    for k in sorted(range(len(rules)), key=lambda k: len(rules[k][1])):
        name, slash, rest = rules[k][1].partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.lit(k)).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w): references from the pages of one host to another, and a host's with the domain above it, both ways; ``pages``: host, html."""
    named = pages.where("host <> ''")
    linked = named.select("host", F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("to"))
    linked = linked.select(F.col("host").alias("src"), F.translate("to", _UPPER, _LOWER).alias("dst")).groupBy("src", "dst").agg(F.count("*").cast("double").alias("w"))
    hosts = named.select("host").union(linked.select("dst")).distinct()
    above = hosts.select("host", F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1).alias("up")).where("up <> ''")
    tree = above.select(F.explode(F.array(F.struct(F.col("host").alias("src"), F.col("up").alias("dst")), F.struct(F.col("up").alias("src"), F.col("host").alias("dst")))).alias("e")).select("e.*", F.lit(1.0).alias("w"))
    return linked.union(tree).where("src <> dst").groupBy("src", "dst").agg(F.sum("w").alias("w"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None) -> DataFrame:
    """(host, trust, distrust) of each host that any score reaches, as shares of all. ``seeds``: host, allowed, blocked (numbers of pages).

    Unless their number is given there are ROUNDS rounds, after which TOLERANCE at most of the walk from any seed page is left, whatever the graph: a neighbourhood has the same
    scores in a table of any size. Within the rounds scores count seed pages, so they do not shrink with the table either.
    """
    ways = edges.select(F.lit("trust").alias("kind"), "src", "dst", "w").union(edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), F.col("w")))
    out = ways.groupBy("kind", "src").agg(F.sum("w").alias("all"))
    ways = cut(ways.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("w") / F.col("all")).alias("share")))
    start = seeds.select("host", F.explode(F.array(F.struct(F.lit("trust").alias("kind"), F.col("allowed").alias("n")), F.struct(F.lit("distrust").alias("kind"), F.col("blocked").alias("n")))).alias("s")).select("host", "s.*").where("n > 0")
    start = cut(start.select("kind", "host", "n", ((1 - DAMPING) * F.col("n")).alias("score")))
    all_ = {r.kind: r.n for r in start.groupBy("kind").agg(F.sum("n").alias("n")).collect()}  # two rows of totals
    start = start.drop("n")
    now = start
    for k in range(ROUNDS if rounds is None else rounds):
        moved = now.withColumnRenamed("host", "src").join(ways, ["kind", "src"]).select("kind", F.col("dst").alias("host"), (DAMPING * F.col("score") * F.col("share")).alias("score"))
        now = start.union(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if k % ROUNDS_A_CUT == ROUNDS_A_CUT - 1:
            now = cut(now)
    pick = lambda kind: (F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)) / all_.get(kind, 1)).alias(kind)
    return now.groupBy("host").agg(pick("trust"), pick("distrust"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, ratio: float = RATIO) -> DataFrame:
    """One row per page: page_id, host, path, rule (null if none fits), verdict (allow or block), trust and distrust of its host.

    The longest rule that fits decides; else the host's scores; hosts that no score reaches, and urls without host, are allowed. Null html has no
    links; of urls and html of any length the whole is read. Repeated pages are judged each. Without rules or links all is allowed. Scores are compared as they
    are, and given to ten significant digits, as their last ones depend on the order of sums.
    """
    host, path = url_parts(F.col("url"))
    parts = only_columns(pages, "page_id", "url", "html").select("page_id", host.alias("host"), path.alias("path"), "html").withColumn("k", longest_rule(F.col("host"), F.col("path"), rules))
    allows = F.array(*[F.lit(v == "allow") for v, _ in rules]) if rules else F.array().cast("array<boolean>")
    texts = F.array(*[F.lit(t) for _, t in rules]) if rules else F.array().cast("array<string>")
    ruled = parts.withColumn("ok", F.get(allows, F.col("k")))
    seeds = ruled.where("host <> '' and ok is not null").groupBy("host").agg(F.count_if("ok").alias("allowed"), F.count_if(~F.col("ok")).alias("blocked"))
    scores = propagate(host_edges(parts.select("host", "html")), seeds)
    joined = ruled.select("page_id", "host", "path", "k", "ok").join(scores, "host", "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    good = F.coalesce(F.col("ok"), distrust <= ratio * (1 + SLIGHT) * trust)
    shown = lambda c, name: F.format_string("%.9e", c).cast("double").alias(name)
    return joined.select("page_id", "host", "path", F.get(texts, F.col("k")).alias("rule"), F.when(good, "allow").otherwise("block").alias("verdict"), shown(trust, "trust"), shown(distrust, "distrust"))
