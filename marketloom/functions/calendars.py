"""Date generators as one-column DataFrames (d), and the count of a rule's days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What each rule keeps of every day from start to end.
RULES = {
    "all": "true",
    "weekday": "weekday(d) < 5",
    "mon_sat": "weekday(d) <> 6",
    "monday": "weekday(d) = 0",
    "month_clamped": "day(d) = 1",
    "quarter_end": "d = last_day(d) and month(d) in (3, 6, 9, 12)",
}


def days(spark: SparkSession, start: str, end: str, rule: str = "all") -> DataFrame:
    """The rule's days from start to end. month_unclamped begins with the first of start's month."""
    if rule == "month_unclamped":
        return spark.sql(f"select explode(sequence(trunc(date'{start}', 'MM'), date'{end}', interval 1 month)) as d")
    return spark.sql(f"select explode(sequence(date'{start}', date'{end}', interval 1 day)) as d").where(RULES[rule])


def spans(df: DataFrame, start: str, end: str, rule: str = "all") -> DataFrame:
    """df with a row for each of the rule's days (d) from its start column to its end column, both included; none where
    either is null or the end lies before. month_unclamped begins with the first of start's month."""
    since = F.trunc(start, "MM") if rule == "month_unclamped" else F.col(start)
    step = F.expr("interval 1 month") if rule == "month_unclamped" else F.expr("interval 1 day")
    days = df.withColumn("d", F.explode(F.when(F.col(start) <= F.col(end), F.sequence(since, F.col(end), step))))
    return days if rule == "month_unclamped" else days.where(RULES[rule])


def day_count(start, end, rule: str = "weekday"):
    """How many days of a rule lie between two date columns, both included."""
    keep = {
        "all": lambda d: F.lit(True), "weekday": lambda d: F.weekday(d) < 5, "mon_sat": lambda d: F.weekday(d) != 6, "monday": lambda d: F.weekday(d) == 0,
        "month_clamped": lambda d: F.day(d) == 1, "quarter_end": lambda d: (d == F.last_day(d)) & F.month(d).isin(3, 6, 9, 12),
    }[rule]
    return F.when(start <= end, F.size(F.filter(F.sequence(start, end), keep))).otherwise(0)
