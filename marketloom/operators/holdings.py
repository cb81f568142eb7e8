"""Day-over-day holdings differences, the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import arrow, percent_change
from .relational import outer_diff


def diff(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Both snapshots (key, holdings, weight) side by side, with differences and percent; missing counts as zero."""
    out = outer_diff(now, before, key, ["holdings", "weight"])
    zero = {f"{c}_{s}": F.coalesce(f"{c}_{s}", F.lit(0.0)) for c in ("holdings", "weight") for s in ("now", "prev")}
    out = out.withColumns(zero)
    return out.withColumns({"holdings_diff": F.col("holdings_now") - F.col("holdings_prev"), "weight_diff": F.col("weight_now") - F.col("weight_prev"), "change_pct": percent_change(F.col("holdings_now"), F.col("holdings_prev"))})


def top_changes(d: DataFrame, key: str, n: int = 15, least: float = 0.5) -> DataFrame:
    """The n largest changes among names held on both days."""
    both = d.where((F.col("status") == "both") & (F.abs("holdings_diff") > least)).withColumn("sign", arrow(F.col("holdings_diff")))
    return both.orderBy(F.abs("holdings_diff").desc(), F.asc(key)).limit(n)


def lines(d: DataFrame, key: str) -> DataFrame:
    """The report's lines (n, line): counts by status, then the top changes, numbers with thousands separators."""
    counts = d.groupBy("status").agg(F.count("*").alias("c")).select(F.lit(0).alias("part"), F.col("status").alias("at"), F.format_string("%s: %d", "status", "c").alias("line"))
    text = F.format_string("%s %s %,.0f (%+.2f%%)", F.col(key).cast("string"), "sign", "holdings_diff", "change_pct")
    # the largest first, ties by key: at most fifteen rows
    order = F.struct(-F.abs("holdings_diff"), F.col(key))
    top = top_changes(d, key).groupBy().agg(F.array_sort(F.collect_list(F.struct(order.alias("at"), text.alias("line")))).alias("x")).select(F.posexplode("x").alias("at", "x"))
    every = counts.unionByName(top.select(F.lit(1).alias("part"), F.format_string("%05d", "at").alias("at"), F.col("x.line").alias("line")))
    return every.select(F.row_number().over(Window.orderBy("part", "at")).alias("n"), "line")


def report(d: DataFrame, key: str) -> list[str]:
    """lines() for the console."""
    return [r.line for r in lines(d, key).orderBy("n").collect()]
