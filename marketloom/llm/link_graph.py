"""Operator 9: URL filters by rules and by trust that spreads over the host graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table, written

#: (verdict, host, path) in the order of the contract.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def host_of(url: str):
    rest = F.expr(f"substring({url}, locate('://', {url}) + 3)")
    return ascii_lower(F.when(F.col(url).contains("://"), F.regexp_extract(rest, r"^[^/?#]*", 0)).otherwise(""))


def path_of(url: str):
    rest = F.expr(f"substring({url}, locate('://', {url}) + 3)")
    return F.when(F.col(url).contains("://"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def match(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds rule and ruled (its verdict) to df (host, path): the longest rule (host, path, verdict) that fits.

    The rules are a list that someone keeps: they are folded into one expression.
    """
    best = F.lit(None).cast("struct<size:int,rule:string,ruled:string>")
    for r in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == r[1]) | F.endswith("host", F.lit("." + r[1]))) & F.startswith("path", F.lit(r[2]))
        best = F.when(fits, F.struct(F.lit(len(r[1] + r[2])).alias("size"), F.lit(r[1] + r[2]).alias("rule"), F.lit(r[0]).alias("ruled"))).otherwise(best)
    return df.withColumn("_best", best).withColumns({"rule": F.col("_best.rule"), "ruled": F.col("_best.ruled")}).drop("_best")


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between different hosts, from the absolute addresses in pages' html: src, dst, w (pages' links)."""
    found = F.regexp_extract_all("html", F.lit(r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^\s"'<>?#/]+)"""), F.lit(1))
    links = pages.select(F.col("host").alias("src"), F.explode(found).alias("to"))
    links = links.select("src", ascii_lower(F.regexp_extract("to", r"//(.*)$", 1)).alias("dst"))
    return links.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("w"))


def spread(edges: DataFrame, seeds: DataFrame, most: int = 40, close: float = 1e-3, damping: float = 0.85) -> DataFrame:
    """Personalised PageRank of hosts, for each side on its own: edges (side, src, dst, w), seeds (side, host, n); side, host, rank.

    Each round is a join on the edges' source and a grouped sum. Every fourth is written to the shared folder and compared
    with the one before it: the rounds end when ranks moved by less than `close` in all, or after `most` rounds. Mass that
    comes to a host without links goes back to the seeds: to scale the ranks of a side to a sum of 1 at the end comes to the same.
    """
    out = edges.groupBy("side", "src").agg(F.sum("w").alias("total"))
    shares = written(edges.join(out, ["side", "src"]).select("side", F.col("src").alias("host"), "dst", (F.col("w") / F.col("total")).alias("share")), "shares")
    masses = seeds.join(F.broadcast(seeds.groupBy("side").agg(F.sum("n").alias("all"))), "side")
    start = written(masses.select("side", "host", (F.col("n") / F.col("all")).alias("rank")), "start")
    again = start.select("side", "host", (F.col("rank") * (1 - damping)).alias("rank"))

    def step(rank):
        moved = rank.join(shares, ["side", "host"]).select("side", F.col("dst").alias("host"), (damping * F.col("rank") * F.col("share")).alias("rank"))
        return moved.union(again).groupBy("side", "host").agg(F.sum("rank").alias("rank"))

    rank = start
    for _ in range(0, most, 4):
        before = step(step(step(rank)))
        both = before.select("side", "host", F.col("rank").alias("last"), F.lit(0.0).alias("rank")).union(step(before).select("side", "host", F.lit(0.0), "rank"))
        rank = written(both.groupBy("side", "host").agg(F.sum("last").alias("last"), F.sum("rank").alias("rank")), "rank")
        moved = rank.agg(F.sum(F.abs(F.col("rank") - F.col("last")))).first()[0] or 0.0
        rank = rank.select("side", "host", "rank")
        if moved < close:
            break
    whole = rank.groupBy("side").agg(F.sum("rank").alias("whole"))
    return rank.join(F.broadcast(whole), "side").select("side", "host", (F.col("rank") / F.col("whole")).alias("rank"))


def judge(pages: DataFrame, rules=RULES, most: int = 40, close: float = 1e-3, bias: float = 1.0) -> DataFrame:
    """Judges pages (page_id, url, html): page_id, host, path, rule, verdict, trust, distrust.

    Pages that a rule fits get its verdict. Hosts of allowed pages are trusted seeds, of blocked ones
    blocked seeds, each with mass by its share of such pages. Trust follows links; distrust goes
    against them, from a blocked host to those that link to it. A host without a fitting rule is blocked
    if its distrust exceeds bias times its trust, else allowed, so hosts that neither reaches are
    allowed; so are all where no page is a seed. Null urls and urls without :// have an empty host and path, match no rule and are allowed.
    Rows alike are judged each; an empty table gives none. Urls and pages count whole, however long; other columns,
    of whatever names, are left out.
    """
    parsed = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), "html").withColumns({"host": host_of("url"), "path": path_of("url")})
    ruled = match(parsed, rules)
    edges = written(host_edges(parsed), "edges")
    seeds = ruled.where("ruled is not null").groupBy(F.col("ruled").alias("side"), "host").agg(F.count("*").alias("n"))
    # trust goes along the links, distrust against them
    sides = edges.select(F.lit("allow").alias("side"), "src", "dst", "w").union(edges.select(F.lit("block"), "dst", "src", "w"))
    ranks = spread(sides, seeds, most, close)
    hosts = ranks.groupBy("host").agg(F.sum(F.when(F.col("side") == "allow", F.col("rank"))).alias("trust"), F.sum(F.when(F.col("side") == "block", F.col("rank"))).alias("distrust"))
    zero = F.lit(0.0)
    out = ruled.select("page_id", "host", "path", "rule", "ruled").join(hosts, "host", "left").withColumns({"trust": F.coalesce("trust", zero), "distrust": F.coalesce("distrust", zero)})
    method = F.when(F.col("rule").isNull() & (F.col("host") != "") & (F.col("distrust") > bias * F.col("trust")), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).drop("trust", "distrust")
