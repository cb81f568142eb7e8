"""What the training-data operators share: tables, shared storage, component labelling."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where none is configured a local master (tests) makes one; a cluster must name it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="marketloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def written_twice(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Like written; two readings of the one table, for joining it with itself."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it: cuts lineage, survives lost executors."""
    return written_twice(df, name)[0]


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like written, as a table dealt by key: grouping by it and joins on it don't shuffle its rows again."""
    spark = df.sparkSession
    own = f"{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(shuffle_partitions(spark), key).option("path", f"{shared_dir(spark)}/tables/{own}").saveAsTable(own)
    return spark.table(own)


def drop_written(df: DataFrame) -> None:
    """Deletes a table that written() made and that nothing will read again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Gives memory that is free, but kept by Arrow and by the allocator below NumPy, back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run, every: int = 16):
    """run, a mapInArrow function, that releases memory after so many results and at its end: Python workers outlive their tasks, and idle ones count."""

    def released(batches):
        k = 0
        for batch in run(batches):
            yield batch
            del batch
            k += 1
            if k % every == 0:
                release()
        release()

    return released


def ascii_lower(column):
    """Lower-cases A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected edges between long keys: node, component (its smallest node).

    Alternating large-star and small-star steps: every step is a grouped minimum (combined before the
    shuffle) and a join, so a node with many neighbours is never gathered in one task. The number of
    rounds grows with the logarithm of the longest path; each round is written to the shared folder.
    Self-loops keep a node; nulls are dropped.
    """
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null")
    nodes = written(e.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "nodes")
    cur = written(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        # large star: each larger neighbour of u is tied to the smallest of u's neighbourhood
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: each smaller neighbour of u, and u itself, is tied to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        last, cur = cur, written(small.where("u <> v").distinct(), "edges")
        drop_written(last)
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    low = cur.groupBy("u").agg(F.min("v").alias("m"))
    return nodes.join(low, nodes.node == low.u, "left").select("node", F.coalesce("m", "node").alias("component"))
