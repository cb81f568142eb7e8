"""Set-based forms of the incremental and lookup idioms: each is a plain DataFrame transformation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in the order (descending orders keep the last)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def lookup_default(df: DataFrame, right: DataFrame, key: str, columns: list[str], default: str = "") -> DataFrame:
    """Left lookup in a table with one row a key, or more (one-to-many); what is missing gets the default."""
    out = df.join(right.select(key, *columns), key, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(default)) for c in columns})


def mark_join(df: DataFrame, key: str, **sides: DataFrame) -> DataFrame:
    """Adds a flag for each named side: whether key is among its ids."""
    for name, ids in sides.items():
        ids = ids.select(F.col(ids.columns[0]).alias(key)).distinct().withColumn(name, F.lit(True))
        df = df.join(ids, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return df


def outer_diff(now: DataFrame, before: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Full outer, null-safe: key, each value with _now and _prev, and status both, left_only or right_only."""
    n = now.select(F.col(key).alias("_k"), *(F.col(v).alias(f"{v}_now") for v in values), F.lit(True).alias("_n"))
    b = before.select(F.col(key).alias("_j"), *(F.col(v).alias(f"{v}_prev") for v in values), F.lit(True).alias("_b"))
    out = n.join(b, n._k.eqNullSafe(b._j), "full_outer")
    status = F.when(F.col("_b").isNull(), "left_only").when(F.col("_n").isNull(), "right_only").otherwise("both")
    pairs = [F.col(f"{v}{s}") for v in values for s in ("_now", "_prev")]
    return out.select(F.coalesce("_k", "_j").alias(key), *pairs, status.alias("status"))


def latest_n(df: DataFrame, key: list[str], by: str, n: int) -> DataFrame:
    """Rows of each key's n latest distinct values of by; with no key, of the table's (a small lookup)."""
    if key:
        top = df.select(*key, by).distinct().withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(by)))).where(f"_r <= {n}").drop("_r")
        return df.join(top, [*key, by], "left_semi")
    top = df.select(by).distinct().orderBy(F.desc(by)).limit(n)
    return df.join(F.broadcast(top), by, "left_semi")


def windowed_upsert(old: DataFrame, new: DataFrame, entity: str, key: list[str], date: str, start: str, end: str, last: list[Column]) -> DataFrame:
    """Replaces the window [start, end] of the entities that are in new; others stay as they are.

    Old rows of a touched entity stay if their date is outside the window or null; new rows are added
    and for each key the last one stays, by `last` (new beats old).
    """
    touched = new.select(entity).distinct()
    keep = old.join(touched, entity, "left_semi").where(F.col(date).isNull() | ~F.col(date).between(F.lit(start), F.lit(end)))
    merged = keep.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    merged = dedup(merged, key, [F.desc("_new"), *last]).drop("_new")
    return merged.unionByName(old.join(touched, entity, "left_anti"), allowMissingColumns=True)


def change_types(old: DataFrame, new: DataFrame, entity: str) -> DataFrame:
    """Each entity of either table with created, removed, updated or unchanged, by a digest of its rows."""
    def digest(df, name):
        columns = sorted(df.columns)
        return df.groupBy(entity).agg(F.struct(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.sum(F.xxhash64(F.lit(7), *columns).cast("decimal(38,0)"))).alias(name))

    both = digest(old, "o").join(digest(new, "n"), entity, "full_outer")
    kind = F.when(F.col("o").isNull(), "created").when(F.col("n").isNull(), "removed").when(F.col("o") == F.col("n"), "unchanged").otherwise("updated")
    return both.select(entity, kind.alias("change_type"))


def corrections(df: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """Overwrites the patch's columns where its key is known and appends its other rows."""
    columns = [c for c in patch.columns if c != key]
    p = patch.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_p"))
    out = df.join(p, df[key] == p._k, "full_outer")
    pick = {c: (F.when(F.col("_p"), F.col(f"_{c}")).otherwise(F.col(c)) if c in columns else F.coalesce(c, "_k") if c == key else F.col(c)) for c in df.columns}
    return out.select(*(v.alias(c) for c, v in pick.items()))


def overlay(base: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """base, and those rows of more whose key base hasn't."""
    return base.unionByName(more.join(base, key, "left_anti"), allowMissingColumns=True)


def flag_dedup(df: DataFrame, key: list[str], order: list[str], flag: str, columns: list[str]) -> DataFrame:
    """One row a key: the columns of its first row by order, flag true if any row's is."""
    first = F.min_by(F.struct(*columns), F.struct(*order)).alias("_first")
    return df.groupBy(*key).agg(first, F.bool_or(flag).alias(flag)).select(*key, "_first.*", flag)


def run_lengths(df: DataFrame, key: list[str], order: list[str], fails: Column) -> DataFrame:
    """Runs of consecutive failures: key, island, run_length."""
    w = Window.partitionBy(*key).orderBy(*order)
    marked = df.withColumn("_f", fails).withColumn("island", F.sum((~F.col("_f")).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.where("_f").groupBy(*key, "island").agg(F.count("*").alias("run_length"))


def align(df: DataFrame, columns: list[str], extras: bool = False) -> DataFrame:
    """The known columns in order, as far as there; others dropped, or kept last."""
    known = [c for c in columns if c in df.columns]
    return df.select(*known, *(c for c in df.columns if extras and c not in known))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def expected_date_gate(df: DataFrame, batch: str, ordinal: list[str], date: Column, expected) -> DataFrame:
    """Drops batches whose first row has another date than expected."""
    good = df.groupBy(batch).agg(F.min_by(date, F.struct(*ordinal)).alias("_d")).where(F.col("_d") == expected).select(batch)
    return df.join(good, batch, "left_semi")


def multiset_equal(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def ordered_list(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Each key's values as a list in the given order, as a lookup table with several values a key holds them."""
    return df.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias(f"{value}s"))


def first_n(df: DataFrame, key: str, by: str, n: int, separator: str = ", ") -> DataFrame:
    """Each key's n smallest values joined as text: ranked first, so that no more than n are collected."""
    top = df.select(key, by).withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(by))).where(f"_r <= {n}")
    return top.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", by))), lambda x: x[by].cast("string")), separator).alias(by))


def until_older(df: DataFrame, page: str, date: str, least: Column) -> DataFrame:
    """Rows of pages, newest first, up to the first page whose rows are all older than `least`: paging that stops early."""
    stop = df.groupBy(page).agg(F.max(date).alias("_d")).where(F.col("_d") < least).agg(F.min(page).alias("_stop"))
    return df.join(F.broadcast(stop), F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))).drop("_stop")
