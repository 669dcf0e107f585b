"""URL verdicts: rules first, then trust and distrust spread over host links (native).

Host links come from ``href`` values of each page, counted per pair of hosts
(relative links point to the page's own host; fragments and other schemes such
as mailto are no links).  Trust starts at hosts whose
pages the allow rules cover and follows links (personalised PageRank); distrust
starts at hosts whose pages the block rules cover and follows links backwards.
A page no rule covers gets its host's verdict: block when the host's share of
all distrust exceeds its share of all trust, else allow.

Nulls and urls without ``://`` have empty host and path; the empty host takes
no part in the graph and is allowed.  Repeated pages count as often as they
occur.  Every step aggregates before it shuffles, so a host with a third of
all pages sends one row per task.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, only

#: (verdict, rule); a rule is a host, then a path prefix.
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
#: Propagation stops when a step moves neither vector by more than ``TOLERANCE`` in sum (looked at every ``CUT_EVERY`` steps).
DAMPING, TOLERANCE, CUT_EVERY = 0.85, 1e-9, 6
#: Every step shrinks the movement (2 at most) by ``DAMPING`` at least, so the tolerance is always reached within so many steps.
ITERATIONS = math.ceil(math.log(TOLERANCE / 2) / math.log(DAMPING))
HREF = r"""(?i)href\s*=\s*["']?([^"'\s>]+)"""


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct of the longest rule that fits, or null."""
    cases = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        cases = F.when(fits, found) if cases is None else cases.when(fits, found)
    return cases if cases is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: links between hosts."""
    src = host_of(F.col("url"))
    found = F.coalesce(F.regexp_extract_all("html", F.lit(HREF), F.lit(1)), F.array().cast("array<string>"))
    # A link's own start decides: scheme and host, host alone, another scheme or a fragment (no link), else the page's own host.
    link = F.col("link")
    dst = F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), host_of(link)).when(link.startswith("//"), host_of(F.concat(F.lit("http:"), link)))
    dst = dst.when(link.startswith("#") | link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit("")).otherwise(F.col("src"))
    rows = pages.select(src.alias("src"), F.explode(found).alias("link")).select("src", dst.alias("dst"))
    return rows.where("src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n"))


def host_scores(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``host, trust, distrust`` at the fixed point of the propagation; each sums to 1 over hosts where it has a seed."""
    urls = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where("host <> ''")
    urls = urls.withColumn("v", matched_rule(F.col("host"), F.col("path"), rules)["verdict"])
    seeds = urls.groupBy("host").agg(F.count_if(F.col("v") == "allow").cast("double").alias("t"), F.count_if(F.col("v") == "block").cast("double").alias("d"))
    edges = host_edges(pages)
    nodes = edges.select(F.col("dst").alias("host")).unionByName(seeds.select("host")).distinct()
    # A self link keeps the mass of a host without links.
    edges = edges.unionByName(nodes.select(F.col("host").alias("src"), F.col("host").alias("dst"), F.lit(1.0).alias("n"))).groupBy("src", "dst").agg(F.sum("n").alias("n"))
    edges = materialize(edges, "host-edges")
    total = seeds.agg(F.sum("t").alias("t"), F.sum("d").alias("d")).first()
    share = lambda c: F.col(c) / F.lit(float(total[c] or 0) or 1.0)
    seeds = materialize(seeds.select("host", share("t").alias("t"), share("d").alias("d")), "host-seeds")
    out_w = edges.groupBy(F.col("src").alias("host")).agg(F.sum("n").alias("w"))
    in_w = edges.groupBy(F.col("dst").alias("host")).agg(F.sum("n").alias("w"))
    forward = edges.join(out_w, edges["src"] == out_w["host"]).select(F.col("src").alias("a"), F.col("dst").alias("b"), (F.col("n") / F.col("w")).alias("wt"), F.lit(0.0).alias("wd"))
    backward = edges.join(in_w, edges["dst"] == in_w["host"]).select(F.col("dst").alias("a"), F.col("src").alias("b"), F.lit(0.0).alias("wt"), (F.col("n") / F.col("w")).alias("wd"))
    steps = materialize(forward.unionByName(backward).groupBy("a", "b").agg(F.sum("wt").alias("wt"), F.sum("wd").alias("wd")), "host-steps")
    ranks, i, moving = seeds, 0, True
    while moving and i < ITERATIONS + CUT_EVERY:
        i += 1
        moved = ranks.join(steps, ranks["host"] == steps["a"]).select(F.col("b").alias("host"), (F.lit(DAMPING) * F.col("t") * F.col("wt")).alias("t"), (F.lit(DAMPING) * F.col("d") * F.col("wd")).alias("d"))
        back = seeds.select("host", ((1 - DAMPING) * F.col("t")).alias("t"), ((1 - DAMPING) * F.col("d")).alias("d"))
        last = ranks.select("host", F.col("t").alias("t0"), F.col("d").alias("d0"))
        ranks = moved.unionByName(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        if i % CUT_EVERY == 0:
            gone = lambda x, y: F.sum(F.abs(F.coalesce(x, F.lit(0.0)) - F.coalesce(y, F.lit(0.0))))
            both = materialize(ranks.join(last, "host", "full"), "host-ranks")
            ranks = both.select("host", F.coalesce("t", F.lit(0.0)).alias("t"), F.coalesce("d", F.lit(0.0)).alias("d"))
            moving = max((v or 0.0) for v in both.agg(gone("t", "t0"), gone("d", "d0")).first()) > TOLERANCE
    return ranks.select("host", F.col("t").alias("trust"), F.col("d").alias("distrust"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the host's scores, one row per page."""
    rules = RULES if rules is None else rules
    pages = only(pages, "page_id", "url", "html")
    scores = host_scores(pages, rules)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("m", matched_rule(F.col("host"), F.col("path"), rules))
    rows = rows.join(scores, "host", "left")
    method = F.when(F.coalesce("distrust", F.lit(0.0)) > F.coalesce("trust", F.lit(0.0)), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        "page_id",
        "host",
        "path",
        F.col("m")["rule"].alias("rule"),
        F.coalesce(F.col("m")["verdict"], method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
