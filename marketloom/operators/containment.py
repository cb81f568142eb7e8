"""Which of many patterns texts hold: one pass of an Aho-Corasick automaton over each text, no candidate pairs."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Patterns in one automaton, and texts that one task goes through with it. Both bound a task's memory.
PATTERNS, TEXTS = 100_000, 50_000


def _blocks(df: DataFrame, column: str, size: int, spread: bool = False) -> tuple[DataFrame, int]:
    # smaller blocks where one would leave most tasks idle
    rows, tasks = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if spread else 1
    n = max(1, math.ceil(rows / size), min(tasks, rows // 2_000))
    return df.withColumn("own", F.pmod(F.xxhash64(column), F.lit(n)).cast("int")), n


def _spread(texts: DataFrame, patterns: DataFrame, run, schema: str, texts_per: int, patterns_per: int) -> DataFrame:
    """Each block of texts meets each block of patterns in one task; both are copied once for each block of the other."""
    t, blocks = _blocks(texts, "text", texts_per, True)
    p, shards = _blocks(patterns, "pattern", patterns_per)
    t = t.select(F.col("own").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), *texts.columns)
    p = p.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.col("own").alias("shard"), *patterns.columns)
    return t.groupBy("block", "shard").cogroup(p.groupBy("block", "shard")).applyInArrow(run, schema)


def _automaton(patterns: list[str], values: list):
    import ahocorasick

    a = ahocorasick.Automaton()
    for pattern, value in zip(patterns, values):
        a.add_word(pattern, value)
    a.make_automaton()
    return a


def first_held(texts: DataFrame, patterns: DataFrame, texts_per: int = TEXTS, patterns_per: int = PATTERNS) -> DataFrame:
    """texts (text) and patterns (pattern, ordinal long): each distinct text that holds a pattern, with the smallest ordinal of those it holds.

    Nulls and empty patterns hold nothing and are held by nothing.
    """

    def run(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"text": pa.array([], pa.string()), "ordinal": pa.array([], pa.int64())})
        a = _automaton(right["pattern"].to_pylist(), right["ordinal"].to_pylist())
        found = [(t, min((n for _, n in a.iter(t)), default=None)) for t in left["text"].to_pylist()]
        found = [x for x in found if x[1] is not None]
        return pa.table({"text": pa.array([t for t, _ in found], pa.string()), "ordinal": pa.array([n for _, n in found], pa.int64())})

    t = texts.where("text <> ''").select("text").distinct()
    p = patterns.where("pattern <> '' and ordinal is not null").groupBy("pattern").agg(F.min("ordinal").cast("long").alias("ordinal"))
    found = _spread(t, p, run, "text string, ordinal long", texts_per, patterns_per)
    return found.groupBy("text").agg(F.min("ordinal").alias("ordinal"))


def first_holder(patterns: DataFrame, texts: DataFrame, texts_per: int = TEXTS, patterns_per: int = PATTERNS) -> DataFrame:
    """patterns (pattern) and texts (text, ordinal long): each distinct pattern that a text holds, with the smallest ordinal of those texts."""

    def run(left, right):
        best = {}
        if left.num_rows and right.num_rows:
            names = right["pattern"].to_pylist()
            a = _automaton(names, names)
            for text, ordinal in zip(left["text"].to_pylist(), left["ordinal"].to_pylist()):
                for _, name in a.iter(text):
                    if ordinal < best.get(name, ordinal + 1):
                        best[name] = ordinal
        return pa.table({"pattern": pa.array(list(best), pa.string()), "ordinal": pa.array(list(best.values()), pa.int64())})

    p = patterns.where("pattern <> ''").select("pattern").distinct()
    t = texts.where("text <> '' and ordinal is not null").groupBy("text").agg(F.min("ordinal").cast("long").alias("ordinal"))
    found = _spread(t, p, run, "pattern string, ordinal long", texts_per, patterns_per)
    return found.groupBy("pattern").agg(F.min("ordinal").alias("ordinal"))
