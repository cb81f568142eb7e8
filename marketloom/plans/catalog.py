"""The dataset catalogue and the request plan it gives."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendars import days

#: By mode of loading, the calendar that gives a dataset's dates (None: no dates).
CALENDARS = {"snapshot": None, "range_snapshot": None, "per_stock": None, "daily": "weekday", "daily_mon_sat": "mon_sat", "all_days": "all", "weekly": "monday", "monthly": "month_unclamped", "monthly_clamped": "month_clamped", "quarterly": "quarter_end"}


@dataclass(frozen=True)
class Dataset:
    name: str
    mode: str
    start: str
    key: tuple[str, ...] = field(default=())
    lookback_days: int = 0


def select(catalogue: list[Dataset], names: list[str] | None) -> list[Dataset]:
    """The named datasets; raises ValueError on unknown names."""
    known = {d.name: d for d in catalogue}
    if unknown := [n for n in names or () if n not in known]:
        raise ValueError(f"unknown datasets: {', '.join(unknown)}")
    return [known[n] for n in names] if names else list(catalogue)


def request_plan(spark: SparkSession, catalogue: list[Dataset], start: str, end: str, units: DataFrame | None = None, newest_first: bool = False) -> DataFrame:
    """dataset, mode, unit, d, from_date, to_date: a row a request. Range snapshots begin at their own start
    whatever the start asked for; per-stock datasets have a row for each of units (unit)."""
    out = None
    for d in catalogue:
        rule = CALENDARS[d.mode]
        since = max(start, d.start)
        if rule:
            rows = days(spark, since, end, rule).select(F.lit(None).cast("string").alias("unit"), "d", F.col("d").alias("from_date"), F.col("d").alias("to_date"))
        else:
            one = units.select("unit") if d.mode == "per_stock" else spark.range(1).select(F.lit(None).cast("string").alias("unit"))
            rows = one.select("unit", F.lit(None).cast("date").alias("d"), F.lit(d.start if d.mode == "range_snapshot" else since).cast("date").alias("from_date"), F.lit(end).cast("date").alias("to_date"))
        rows = rows.select(F.lit(d.name).alias("dataset"), F.lit(d.mode).alias("mode"), "unit", "d", "from_date", "to_date")
        out = rows if out is None else out.unionByName(rows)
    return out.orderBy("dataset", F.desc("d") if newest_first else F.asc("d")) if newest_first else out


def rolling_window(today, back: int, ahead: int = 0):
    return F.date_sub(today, back), F.date_add(today, ahead)
