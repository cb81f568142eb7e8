"""Streaming forms of the incremental loads. Additions: the batch operators are the reference point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relational
from ..sources.versions import Table


def file_stream(spark: SparkSession, path: str, schema, time: str, pattern: str | None = None, files: int | None = None) -> DataFrame:
    """A file source whose time column is a timestamp, as watermarks ask for: of the folder's files those of a name
    pattern, and no more than `files` in a micro-batch."""
    options = {k: str(v) for k, v in (("pathGlobFilter", pattern), ("maxFilesPerTrigger", files)) if v}
    return spark.readStream.schema(schema).options(**options).parquet(path).withColumn(time, F.col(time).cast("timestamp"))


def dedup_stream(stream: DataFrame, key: list[str], time: str, late: str = "40 days") -> DataFrame:
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def tumbling(stream: DataFrame, time: str, width: str, key: list[str], late: str = "40 days") -> DataFrame:
    w = F.window(time, width)
    return stream.withWatermark(time, late).groupBy(w, *key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *key, "n")


def run_once(df: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Takes all that is there and stops."""
    q = df.writeStream.outputMode(mode).format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def upsert_stream(stream: DataFrame, apply, checkpoint: str, mode: str = "update") -> None:
    """Calls apply(batch, batch id) for each micro-batch: the batch upsert goes there. In update mode an aggregate's batch has the groups that changed."""
    stream.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def versioned_upserts(stream: DataFrame, target: Table, key: list[str], date: str, last: list[Column], checkpoint: str, name: str, window: tuple[str, str] | None = None) -> None:
    """Windowed upserts of a stream into a versioned table, each micro-batch once however often it is replayed.

    A batch has all its entities' rows (target.key) of its window: `window`, or the batch's own first to last date. Only
    buckets that hold an entity of the batch are read and written. The batch's id is committed with its rows under
    `name`, so a batch that comes again after a crash between commit and checkpoint changes nothing, and one that
    crashed before its commit left nothing that is read. Takes all that is there and stops.
    """

    def apply(rows: DataFrame, batch: int) -> None:
        head = target.head()
        if head and head.facts.get(name, -1) >= batch:
            return
        rows = rows.persist()
        try:
            start, end = window or rows.agg(F.min(date).cast("string"), F.max(date).cast("string")).first()
            touched = [r[0] for r in rows.select(target.bucket()).distinct().collect()]
            if touched:
                old = target.read(head, touched) if head else rows.limit(0)
                merged = relational.windowed_upsert(old, rows, target.key, key, date, start, end, last)
                target.commit(merged, head, touched, **{name: batch})
        finally:
            rows.unpersist()

    upsert_stream(stream, apply, checkpoint, "append")
