"""Writers that leave either the old data or the new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def dated(df: DataFrame, path: str, by: list[str], order: list[str] = ()) -> None:
    """Replaces just the partitions that df has rows for."""
    rows = df.repartition(*by)
    rows = rows.sortWithinPartitions(*by, *order) if order else rows
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def snapshot(df: DataFrame, path: str) -> str:
    """Writes a new version beside the old ones and returns its folder: a reader of the old one isn't disturbed."""
    import uuid

    version = f"{path}/v-{uuid.uuid4().hex}"
    df.write.parquet(version)
    return version


def csv(df: DataFrame, path: str, fields: list[str], append: bool = False) -> None:
    df.select(*fields).write.mode("append" if append else "overwrite").option("header", True).csv(path)


def json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def lines(df: DataFrame, column: str, path: str) -> None:
    df.select(df[column].cast("string").alias("value")).write.mode("overwrite").text(path)


def counted(df: DataFrame, write, **counts: Column) -> dict:
    """Calls write(df) and returns the counts (aggregates by name) of the rows that it wrote, taken as they pass: df is not run again."""
    seen = Observation()
    write(df.observe(seen, *(c.alias(name) for name, c in counts.items())))
    return seen.get


def entities(df: DataFrame, path: str, entity: str, buckets: int = 64, changed: DataFrame | None = None) -> None:
    """A table of entities in hashed buckets. With changed (entity), only the buckets that hold one are written again; df then has all rows of these."""
    bucket = F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int")
    rows = df.withColumn("bucket", bucket)
    if changed is not None:
        rows = rows.join(F.broadcast(changed.select(bucket.alias("bucket")).distinct()), "bucket", "left_semi")
    dated(rows, path, ["bucket"], [entity])
