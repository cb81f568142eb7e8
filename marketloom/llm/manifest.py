"""Operator 13: Merkle manifests of a dataset by nested-struct rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, shuffle_partitions, table, written

#: Nodes under one node; a power of two.
FAN = 16
#: Levels that one block nests: it holds at most FAN ** LEVELS nodes, whatever the size of the table.
LEVELS = 3
BITS = FAN.bit_length() - 1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def leaf(values: dict[str, Column]) -> Column:
    """A row's digest: of each field `-` where it is null, else its UTF-8 bytes' count, a colon and the bytes."""
    texts = [values[f].cast("string") for f in FIELDS]
    return digest(F.concat(*(F.when(x.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x)) for x in texts)))


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """rows with rank (a long, from 0 within `key`, by `order`) and n (rows of the key).

    Rows are laid out in sorted ranges, so no key is gathered in one task; a key's ranges are numbered on from each other
    by counts, of which there are no more than ranges and keys together.
    """
    by = ("key", *order)
    laid = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    laid = written(laid.withColumn("_at", F.monotonically_increasing_id()), "ranges").withColumn("_range", F.shiftright("_at", 33))
    own = Window.partitionBy("key")
    runs = laid.groupBy("key", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = F.sum("_rows").over(own.orderBy("_range")) - F.col("_rows") - F.col("_first")
    runs = runs.select("key", "_range", before.alias("_shift"), F.sum("_rows").over(own).alias("n"))
    return laid.join(runs, ["key", "_range"]).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def height() -> Column:
    """Levels above the leaves of a tree of n leaves: the smallest h with FAN ** h >= n."""
    return sum(((F.col("n") > FAN**k).cast("int") for k in range(15)), F.lit(0))


def nested(nodes: DataFrame) -> DataFrame:
    """Blocks of up to FAN ** LEVELS nodes: key, rank, height, digest and the nodes as nested kids.

    nodes: key, rank, height (levels still above it), digest, item. A node's rank is cut into digits; grouping takes the
    last digit away and nests what differs in it, level by level, all within the one partitioning by block.
    """
    cut = [F.shiftright("rank", BITS * k).bitwiseAND(FAN - 1).cast("int").alias(f"d{k}") for k in range(LEVELS)]
    rows = nodes.select("key", F.shiftright("rank", BITS * LEVELS).alias("block"), *cut, "height", "digest", "item")
    rows = rows.repartition(shuffle_partitions(nodes.sparkSession), "key", "block")
    for k in range(LEVELS):
        inner = F.struct(F.col(f"d{k}").alias("at"), "digest", *(["kids"] if k else ["item"]))
        rows = rows.groupBy("key", "block", "height", *(f"d{j}" for j in range(k + 1, LEVELS))).agg(F.array_sort(F.collect_list(inner)).alias("kids"))
        joined = digest(F.array_join(F.col("kids")["digest"], ""))
        rows = rows.withColumn("digest", F.when(F.col("height") > k, joined).otherwise(F.col("kids")[0]["digest"]))
    return rows.select("key", F.col("block").alias("rank"), "height", "digest", "kids")


def grown(nodes: DataFrame) -> list[DataFrame]:
    """Written blocks of each round, the last with one block a key; a round leaves one node of FAN ** LEVELS."""
    rounds = []
    while True:
        rounds.append(written(nested(nodes), "blocks"))
        if not rounds[-1].agg(F.max("rank")).first()[0]:
            return rounds
        left = F.greatest(F.col("height") - LEVELS, F.lit(0))
        nodes = rounds[-1].select("key", "rank", left.alias("height"), "digest", F.struct("rank").alias("item"))


def unfolded(blocks: DataFrame, kept: list[str]) -> DataFrame:
    """A row for each node of the blocks: key, digest, item, kept columns, and its path.

    A path lists a node's siblings from its own level to the root: left and right, joined digests. blocks have their own
    path; the nodes' paths are made inside the row and exploded, without a join.
    """

    def grow(kids: Column, above: Column, level: int) -> Column:
        def each(kid, at):
            digests = kids["digest"]
            side = F.struct(F.array_join(F.slice(digests, F.lit(1), at), "").alias("left"), F.array_join(F.slice(digests, at + 2, F.lit(FAN)), "").alias("right"))
            path = F.when(F.col("height") > level, F.concat(F.array(side), above)).otherwise(above)
            return F.struct(*([kid["kids"].alias("kids")] if level else [kid["digest"].alias("digest"), kid["item"].alias("item")]), path.alias("path"))

        return F.transform(kids, each)

    nodes = grow(F.col("kids"), F.col("path"), LEVELS - 1)
    below = lambda level: lambda node: grow(node["kids"], node["path"], level)
    for level in reversed(range(LEVELS - 1)):
        nodes = F.flatten(F.transform(nodes, below(level)))
    return blocks.select("key", *kept, F.inline(nodes))


def paths(rounds: list[DataFrame], above: DataFrame, kept: list[str]) -> DataFrame:
    """The leaves of all rounds with their paths. above: key, the path of the key's last node and the kept columns.

    A round's blocks meet their paths by a join of a row a block, one for FAN ** LEVELS nodes.
    """
    found = rounds[-1].join(above, "key")
    for lower in reversed(rounds[:-1]):
        upper = unfolded(found, kept).select("key", F.col("item.rank").alias("rank"), "path", *kept)
        found = lower.join(upper, ["key", "rank"])
    return unfolded(found, kept)


def manifest(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """A Merkle tree of the rows of docs: doc_id, leaf, claimed, subroot, root, path.

    The leaves of a source ascend by doc_id (null first, ties by their digests) and are hashed in runs of FAN until one
    node, the source's subroot, is left; subroots, by source (null first, UTF-8 bytes), are hashed likewise to the root.
    claimed is a leaf digest to verify, the row's own unless given; as the digests of equal rows are equal, so are their
    claims. path goes into folded() and proof(). Columns beyond FIELDS don't count; an empty table gives no rows; texts
    count whole, empty ones as empty, not as null.
    """
    own = leaf({f: F.col(f) for f in FIELDS})
    source = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    claim = own if claimed is None else F.coalesce(claimed, own)
    leaves = written(docs.select(source.alias("key"), "doc_id", own.alias("digest"), claim.alias("claimed")), "leaves")
    order = ranked(leaves, "doc_id", "digest", "claimed").withColumn("height", height())
    rounds = grown(order.select("key", "rank", "height", "digest", F.struct("doc_id", "claimed").alias("item")))
    tops = rounds[-1].select(F.lit("").alias("key"), F.col("key").alias("source"), "digest")
    sources = ranked(tops, "source").withColumn("height", height())
    over = grown(sources.select("key", "rank", "height", "digest", F.struct("source").alias("item")))
    none = F.array().cast("array<struct<left: string, right: string>>")
    root = over[-1].select("key", none.alias("path"), F.col("digest").alias("root"))
    above = paths(over, root, ["root"]).select(F.col("item.source").alias("key"), "root", F.col("digest").alias("subroot"), "path")
    found = paths(rounds, above, ["root", "subroot"])
    return found.select("item.doc_id", F.col("digest").alias("leaf"), "item.claimed", "subroot", "root", "path")


def proof() -> Column:
    """The digest of all siblings of a path."""
    return digest(F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), ""))


def folded(start: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate("path", start, lambda x, step: digest(F.concat(step["left"], x, step["right"])))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = leaf({f: F.col(f) for f in FIELDS} | {"text": ascii_lower(F.col("text"))})
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = manifest(docs, F.when(tampered, changed))
    root = folded(F.col("claimed"))
    return rows.select("doc_id", "leaf", "subroot", "root", proof().alias("proof_sha256"), root.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def sql(leaf_levels: int = 7, source_levels: int = 5) -> str:
    """DuckDB's version of op13 for up to FAN ** leaf_levels rows a source and FAN ** source_levels sources."""
    fields = lambda text: " || ".join(f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c} end" for c in ("doc_id", "source", "lang", "n_chars", text))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: list_transform(range(8), lambda b: (ascii(c) >> b) & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, {bits}), lambda c, b: case when xor(c, b) & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end), 4294967295)"
    out = f"""with leaves as (
  select doc_id, source, sha256({fields("text")}) as leaf, case when ({crc}) % 5 = 0 then sha256({fields(lower)}) end as changed from documents),
a as (select doc_id, source as k, leaf, coalesce(changed, leaf) as claimed, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by source) as n from leaves),
s0 as (select k, i, n, leaf as d from a)"""

    def levels(name: str, count: int) -> str:
        made = ""
        for j in range(count):
            part = "partition by k, i // 16 order by i rows between"
            made += f""",
{name}{j}w as (select k, i, n, coalesce(string_agg(d, '') over ({part} unbounded preceding and 1 preceding), '') as l, coalesce(string_agg(d, '') over ({part} 1 following and unbounded following), '') as r from {name}{j}),
{name}{j + 1} as (select k, i // 16 as i, (n + 15) // 16 as n, case when n > 1 then sha256(string_agg(d, '' order by i)) else min(d) end as d from {name}{j} group by k, i // 16, n)"""
        return made

    out += levels("s", leaf_levels)
    out += f""",
tops as (select k as source, d as subroot, row_number() over (order by k nulls first) - 1 as i, count(*) over () as n from s{leaf_levels}),
u0 as (select 0 as k, i, n, subroot as d from tops)"""
    out += levels("u", source_levels)
    out += f""",
f0 as (select a.doc_id, a.leaf, a.k, a.i, t.i as ti, t.subroot, (select d from u{source_levels}) as root, '' as proof, a.claimed as f from a join tops t on a.k is not distinct from t.source)"""
    steps = [("s", j, "f.i", "f.k is not distinct from w.k") for j in range(leaf_levels)] + [("u", j, "f.ti", "w.k = 0") for j in range(source_levels)]
    for at, (name, j, i, same) in enumerate(steps):
        out += f""",
f{at + 1} as (select f.doc_id, f.leaf, f.k, f.i, f.ti, f.subroot, f.root, case when w.n > 1 then f.proof || w.l || w.r else f.proof end as proof, case when w.n > 1 then sha256(w.l || f.f || w.r) else f.f end as f
  from f{at} f join {name}{j}w w on {same} and w.i = {i} >> {4 * j})"""
    return out + f"\nselect doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, f as folded_root, f = root as verified from f{len(steps)}"


SQL = sql()
