"""What has landed against what should have."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import human_bytes


def completeness(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """expected and landed (dataset, d): candidates, done (within the range), landed_all, pct, first, last."""
    e = expected.select("dataset", "d").distinct()
    have = landed.select("dataset", "d").distinct()
    done = e.join(have.withColumn("_h", F.lit(1)), ["dataset", "d"], "left").groupBy("dataset").agg(F.count("*").alias("candidates"), F.count("_h").alias("done"))
    span = have.groupBy("dataset").agg(F.count("*").alias("landed_all"), F.min("d").alias("first_day"), F.max("d").alias("last_day"))
    out = done.join(span, "dataset", "left").withColumn("landed_all", F.coalesce("landed_all", F.lit(0).cast("long")))
    return out.withColumn("pct", F.when(F.col("candidates") > 0, F.round(F.col("done") / F.col("candidates") * 100, 4)).otherwise(0.0))


def completeness_of_table(expected: DataFrame, table: DataFrame) -> DataFrame:
    """completeness of a landed table partitioned by (dataset, d), with the rows that have landed in all.

    table comes from readers.parquet_by_footers: partitions and their row counts are known from footers, so the only
    thing that grows with the rows is the number of files.
    """
    days = table.groupBy("dataset", "d").agg(F.count("*").alias("rows")).where("rows > 0")
    rows = days.groupBy("dataset").agg(F.sum("rows").alias("rows"))
    return completeness(expected, days).join(rows, "dataset", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))


def pending(expected: DataFrame, landed: DataFrame, refresh: bool = False) -> DataFrame:
    """What is still to load: all of expected on a refresh, else what has not landed."""
    return expected if refresh else expected.join(landed.select(*expected.columns).distinct(), expected.columns, "left_anti")


def status_histogram(log: DataFrame, key: str, status: str, values: list[str]) -> DataFrame:
    return log.groupBy(key).pivot(status, values).count().na.fill(0)


def sizes(files: DataFrame) -> DataFrame:
    """files (dataset, length) summed by dataset with a grand total (dataset null)."""
    return files.rollup("dataset").agg(F.sum("length").alias("bytes")).withColumn("size", human_bytes(F.col("bytes")))


def latest_before(asked: DataFrame, landed: DataFrame, most: int = 15) -> DataFrame:
    """For each asked (dataset, d) the last weekday up to d, d included, that has landed data, of at most `most` weekdays; null if none has."""
    have = landed.select("dataset", "d").where("weekday(d) < 5").distinct().withColumn("_h", F.col("d"))
    both = asked.select("dataset", "d").distinct().withColumn("_a", F.lit(True)).join(have, ["dataset", "d"], "full_outer")
    found = F.last("_h", ignorenulls=True).over(Window.partitionBy("dataset").orderBy("d"))
    weekdays = F.size(F.filter(F.sequence("latest", "d"), lambda x: F.weekday(x) < 5))
    out = both.withColumn("latest", found).where("_a")
    return out.select("dataset", "d", F.when(weekdays <= most, F.col("latest")).alias("latest"))
