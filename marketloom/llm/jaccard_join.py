"""Operator 7: n-gram Jaccard join through count-vector R-trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, drop_written, releasing, table, written
from .vectors import forest

#: Percent of the union that the intersection must have at least.
LEAST = 80
SHINGLE = 5
#: Coordinates of a count vector by set size: sets below the size have so many.
DIMENSIONS = ((512, 64), (4096, 256), (1 << 62, 1024))
PAGE = 32


class Shingles:
    """Sets of a text's distinct shingles as sorted 64-bit hashes; words' hashes are kept between texts."""

    def __init__(self, keep: int = 300_000):
        self.words: dict[bytes, int] = {}
        self.keep = keep

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.words
        if len(known) > self.keep:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(SHINGLE, len(h))
        out = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            out = (out ^ h[k : len(h) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        return np.unique(out)


def dimensions(n: int) -> int:
    return next(d for most, d in DIMENSIONS if n < most)


def count_vector(shingles: np.ndarray) -> np.ndarray:
    """Counts by group of the hashes' low bits; 255 stands for that or more."""
    d = dimensions(len(shingles))
    return np.minimum(np.bincount((shingles & np.uint64(d - 1)).astype(np.int64), minlength=d), 255).astype(np.uint8)


def counts_of(vector: bytes | np.ndarray) -> np.ndarray:
    """A stored vector's counts; where it is full, one that no minimum comes below."""
    v = np.frombuffer(vector, np.uint8).astype(np.int32)
    return np.where(v == 255, 1 << 24, v)


def sketch(docs: DataFrame) -> DataFrame:
    """A row per row: doc_id, hash (the text's), node (the set's hash; 0 for an empty set), n, prefix, vector.

    Sets of Jaccard at least LEAST % share at least LEAST % of either, so the least hashes, one more than
    either may lack, have one in common: the prefix.
    """

    def run(batches):
        shingles = Shingles()
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for lo in range(0, len(t), 256):
                part = t.slice(lo, 256)
                sets = [shingles.of(x.as_py()) for x in part["text"]]
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"].combine_chunks(),
                    part["hash"].combine_chunks(),
                    pa.array([node_of(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[: len(s) - -(-len(s) * LEAST // 100) + 1 if len(s) else 0].view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([count_vector(s).tobytes() for s in sets], pa.binary()),
                ], ["doc_id", "hash", "node", "n", "prefix", "vector"])

    return docs.select("doc_id", F.xxhash64("text").alias("hash"), "text").mapInArrow(releasing(run), "doc_id long, hash long, node long, n long, prefix array<long>, vector binary")


def node_of(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()) | 1).astype(np.int64)) if len(shingles) else 0


def enough(overlap, n, m):
    """Whether sets of n and m with this overlap (or a bound on it) link."""
    return 100 * overlap >= LEAST * (n + m - overlap)


class Tree:
    """A packed R-tree of count vectors: leaf pages of points in the order of set sizes, with their bounds.

    Of two sets the overlap is at most the sum of their vectors' coordinate minima; of two pages, at
    most that of their upper corners. So pages, then points, that can't reach the threshold are skipped.
    """

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((vectors[:, 0], sizes))
        self.points, self.sizes = vectors[self.order].astype(np.int32), sizes[self.order]
        cuts = np.arange(0, len(sizes), PAGE)
        self.cuts = np.append(cuts, len(sizes))
        self.high = np.maximum.reduceat(self.points, cuts, axis=0)
        self.least, self.most = self.sizes[cuts], self.sizes[self.cuts[1:] - 1]

    def neighbours(self, other: Tree):
        """Pairs that may link: row numbers of this tree's and of the other's points, page by page."""
        for p in range(len(self.high)):
            bound = np.minimum(self.high[p], other.high).sum(1)
            near = (100 * self.most[p] >= LEAST * other.least) & (100 * other.most >= LEAST * self.least[p])
            near &= enough(bound, self.least[p], other.least)
            pages = np.flatnonzero(near)
            mine = slice(self.cuts[p], self.cuts[p + 1])
            for lo in range(0, len(pages), 32):
                rows = np.concatenate([np.arange(other.cuts[q], other.cuts[q + 1]) for q in pages[lo : lo + 32]])
                n, m = self.sizes[mine][:, None], other.sizes[rows][None]
                a, b = np.nonzero((100 * n >= LEAST * m) & (100 * m >= LEAST * n))
                for s in range(0, len(a), 4096):
                    i, j = a[s : s + 4096], b[s : s + 4096]
                    least = np.minimum(self.points[mine][i], other.points[rows[j]]).sum(1)
                    good = enough(least, self.sizes[mine][i], other.sizes[rows[j]])
                    yield self.order[self.cuts[p] + i[good]], other.order[rows[j[good]]]


def folded(vector: np.ndarray, d: int) -> np.ndarray:
    return np.minimum(vector.reshape(-1, d).astype(np.int64).sum(0), 1 << 24)


def may_link(nodes, sizes, vectors, left=None, right=None):
    """Pairs of rows of a group that may link (of left against right, if given), from the R-trees by dimension."""
    left = np.ones(len(nodes), bool) if left is None else left
    right = left if right is None else right
    dims = np.array([dimensions(n) for n in sizes])
    for _, d in DIMENSIONS:
        coarse, finer = dims == d, (dims > d) & (100 * sizes < (100 + LEAST) * np.max(sizes[dims == d], initial=0))
        trees = []
        for own in (left & coarse, right & (coarse | finer), left & finer, right & coarse):
            rows = np.flatnonzero(own)
            trees.append((rows, Tree(np.stack([folded(vectors[i], d) for i in rows]), sizes[rows]) if len(rows) else None))
        for (a, x), (b, y) in ((trees[0], trees[1]), (trees[2], trees[3])):
            if x and y:
                for i, j in x.neighbours(y):
                    i, j = a[i], b[j]
                    other = nodes[i] != nodes[j]
                    yield i[other], j[other]


def candidate_edges(groups: DataFrame, block: int) -> DataFrame:
    """A spanning forest of each group's pairs that may link: a, b. groups: gid, size, node, n, vector.

    Groups of more than block rows are cut into hashed parts, and each two parts meet in one task.
    """
    k = F.ceil(F.col("size") / block).cast("int")
    rows = groups.withColumn("own", F.pmod(F.xxhash64("node"), k).cast("int"))
    low = rows.withColumn("other", F.explode(F.sequence("own", k - 1))).withColumn("i", F.col("own")).withColumn("j", F.col("other"))
    high = rows.where("own > 0").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("own") - 1))).withColumn("i", F.col("other")).withColumn("j", F.col("own"))

    def run(t: pa.Table) -> pa.Table:
        nodes, sizes, own = (t[c].to_numpy() for c in ("node", "n", "own"))
        vectors = [counts_of(v.as_py()) for v in t["vector"]]
        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        a, b = [], []
        for x, y in may_link(nodes, sizes, vectors, own == i, own == j):
            keep = forest(nodes[x], nodes[y])
            a.append(nodes[x[keep]])
            b.append(nodes[y[keep]])
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        keep = forest(a, b)
        return pa.table({"a": pa.array(a[keep], pa.int64()), "b": pa.array(b[keep], pa.int64())})

    columns = ["gid", "i", "j", "own", "node", "n", "vector"]
    return low.select(columns).union(high.select(columns)).groupBy("gid", "i", "j").applyInArrow(run, "a long, b long")


def linked(sets: DataFrame, most: int) -> DataFrame:
    """Verified links inside clusters, as spanning forests: a, b. sets: cluster, weight, node, shingles.

    Clusters of more than `most` shingles are cut into hashed parts, and each two parts meet in one task.
    """
    k = F.ceil(F.col("weight") / most).cast("int")
    rows = sets.withColumn("own", F.pmod(F.xxhash64("node"), k).cast("int"))
    low = rows.withColumn("j", F.explode(F.sequence("own", k - 1))).withColumn("i", F.col("own"))
    high = rows.where("own > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("own") - 1))).withColumn("j", F.col("own"))

    def run(t: pa.Table) -> pa.Table:
        nodes, own = t["node"].to_numpy(), t["own"].to_numpy()
        shingles = [s.values.to_numpy().view(np.uint64) for s in t["shingles"]]
        sizes = np.array([len(s) for s in shingles])
        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        near: list[list[np.ndarray]] = [[] for _ in nodes]
        for x, y in may_link(nodes, sizes, [counts_of(count_vector(s)) for s in shingles], own == i, own == j):
            for u, v in ((x, y), (y, x)):
                order = np.argsort(u, kind="stable")
                u, v = u[order], v[order]
                cuts = np.flatnonzero(np.diff(u)) + 1
                for part, head in zip(np.split(v, cuts), u[np.concatenate(([0], cuts))] if len(u) else ()):
                    near[head].append(part)
        near = [np.unique(np.concatenate(v)) if v else np.zeros(0, int) for v in near]
        label, a, b = np.arange(len(nodes)), [], []
        done = np.zeros(len(nodes), bool)
        for u in sorted(range(len(nodes)), key=lambda u: -len(near[u])):
            # what is tied already needs no check, and a pair is checked from the side with more neighbours
            rest = near[u][(label[near[u]] != label[u]) & ~done[near[u]]]
            done[u] = True
            if not len(rest):
                continue
            ends = np.cumsum(sizes[rest])
            every = np.concatenate([shingles[v] for v in rest])
            at = np.minimum(np.searchsorted(shingles[u], every), sizes[u] - 1)
            overlap = np.add.reduceat((shingles[u][at] == every).astype(np.int64), ends - sizes[rest])
            for v in rest[enough(overlap, sizes[u], sizes[rest])]:
                if label[v] != label[u]:
                    label[label == label[v]] = label[u]
                    a.append(nodes[u])
                    b.append(nodes[v])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    columns = ["cluster", "i", "j", "own", "node", "shingles"]
    return low.select(columns).union(high.select(columns)).groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long")


#: Bits by which documents are sorted out before their sets are made: 256 bitmaps of 32768 bits, 1 MB at any scale.
BITMAPS, BITS = 256, 32768


def bit_of(column: str):
    return F.pmod(F.xxhash64(column), F.lit(BITMAPS * BITS))


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingles of wanted (rep: a doc_id, node, cluster, weight), from docs' whole texts.

    A bitmap of the wanted doc_ids' hashes, of fixed size, spares most of the other texts the work; the
    join then decides. With many documents wanted it spares fewer, and the result is the same.
    """
    bit = bit_of("rep")
    maps = wanted.groupBy(F.floor(bit / BITS).alias("map")).agg(F.bitmap_construct_agg((bit % BITS)).alias("bits")).collect()
    bitmap = np.zeros(BITMAPS * BITS // 8, np.uint8)
    for r in maps:
        bitmap[r["map"] * BITS // 8 : (r["map"] + 1) * BITS // 8] = np.frombuffer(r["bits"], np.uint8)

    def run(batches):
        shingles = Shingles()
        for batch in batches:
            t = pa.Table.from_batches([batch])
            bit = t["bit"].to_numpy()
            t = t.filter(pa.array((bitmap[bit >> 3] >> (bit & 7) & 1).astype(bool)))
            for lo in range(0, len(t), 256):
                part = t.slice(lo, 256)
                sets = [shingles.of(x.as_py()) for x in part["text"]]
                yield pa.RecordBatch.from_arrays([part["doc_id"].combine_chunks(), pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc_id", "of", "shingles"])

    made = docs.select("doc_id", "text", bit_of("doc_id").alias("bit")).mapInArrow(releasing(run), "doc_id long, of long, shingles array<long>")
    met = made.join(wanted, made.doc_id.eqNullSafe(wanted.rep) & (F.col("of") == F.col("node")))
    return met.select("node", "cluster", "weight", "shingles").dropDuplicates(["node"])


def join(docs: DataFrame, small: int = 8, listed: int = 64, block: int = 2048, most: int = 2_000_000) -> DataFrame:
    """See labelled; without hash and component."""
    return labelled(docs, small, listed, block, most).select("doc_id", "n_shingles", "component_id")


def labelled(docs: DataFrame, small: int = 8, listed: int = 64, block: int = 2048, most: int = 2_000_000) -> DataFrame:
    """Links docs (doc_id, text) whose sets of distinct five-word shingles have Jaccard of at least 0.8.

    Returns a row per row: doc_id, n_shingles, component_id (the smallest doc_id reachable), hash (the text's
    xxhash64) and component (the smallest hash of a set reachable; null for an empty set). Texts of
    fewer than five words are one shingle; null texts and texts without words have none and link with
    nothing. Rows alike, or with the same set, are one class. Rows without doc_id take part; where no
    row of a component has one, component_id is null. Empty tables give no rows. Texts count whole, however long; columns
    but doc_id and text are left out, so names can't clash.

    1. Classes with a common prefix shingle meet. 2. In every such group R-trees of count vectors bound
    the overlap by summed coordinate minima; what may link is tied to clusters by spanning forests, so
    pairs are never listed. 3. Inside each cluster R-trees pick the pairs again and the sets verify
    them, skipping what is tied already. Nothing that links is lost. Groups and clusters too large for
    a task are cut into parts that meet two by two.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = written(sketch(docs), "sketch")
    rows = written(sketches.select("doc_id", "hash", "n", "node"), "rows")
    classes = written(sketches.where("n > 0").drop("hash").dropDuplicates(["node"]), "classes")
    drop_written(sketches)
    tokens = classes.select("node", F.explode("prefix").alias("token"))
    # grouped counts are combined before the shuffle, and the join back may split a frequent token's rows
    sizes = tokens.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(tokens.join(sizes, "token"), "shared")
    points = classes.select("node", "n", "vector")
    lists = shared.where(F.col("size") <= listed).groupBy("token").agg(F.sort_array(F.collect_list("node")).alias("nodes")).select("nodes").distinct()
    lists = written(lists, "lists")
    few = lists.where(F.size("nodes") <= small).select("nodes", F.posexplode("nodes").alias("k", "a"))
    few = few.select("a", F.explode(F.expr("slice(nodes, k + 2, size(nodes))")).alias("b")).distinct()
    few = few.join(points.select(F.col("node").alias("a"), F.col("n").alias("n"), F.col("vector").alias("v")), "a")
    few = few.where("a <> b").join(points.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("vector").alias("w")), "b")

    def bound(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            n, m = t["n"].to_numpy(), t["m"].to_numpy()
            good = []
            for k, (v, w) in enumerate(zip(t["v"].to_pylist(), t["w"].to_pylist())):
                v, w = counts_of(v), counts_of(w)
                d = min(len(v), len(w))
                good.append(bool(enough(int(np.minimum(folded(v, d), folded(w, d)).sum()), n[k], m[k])))
            yield from t.select(["a", "b"]).filter(pa.array(good, pa.bool_())).to_batches()

    few = few.where(f"100 * n >= {LEAST} * m and 100 * m >= {LEAST} * n").mapInArrow(releasing(bound), "a long, b long")
    mid = lists.where(F.size("nodes") > small).select(F.xxhash64("nodes").alias("gid"), F.size("nodes").alias("size"), F.explode("nodes").alias("node"))
    big = shared.where(F.col("size") > listed).select(F.col("token").alias("gid"), F.col("size").cast("int").alias("size"), "node")
    many = candidate_edges(mid.union(big).join(points, "node"), block)
    candidates = written(few.union(many).distinct(), "candidates")
    drop_written(shared)
    drop_written(lists)
    clusters = components(candidates)
    members = clusters.withColumnRenamed("component", "cluster").join(classes.select("node", F.col("doc_id").alias("rep"), "n"), "node")
    members = written(members, "members")
    members = written(members.join(members.groupBy("cluster").agg(F.sum("n").alias("weight")), "cluster").select("node", "cluster", "rep", "weight"), "clusters")
    drop_written(classes)
    sets = written(shingle_sets(docs, members), "sets")
    links = written(linked(sets, most), "links")
    drop_written(sets)
    labels = written(components(links), "labels")
    low = rows.groupBy("node").agg(F.min("doc_id").alias("low")).where("node <> 0")
    own = low.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    own = written(own, "own")
    own = own.join(own.groupBy("component").agg(F.min("low").alias("component_id")), "component").select("node", "component", "component_id")
    out = rows.join(own, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "hash", "component")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


#: The join in DuckDB's SQL: all pairs with a common shingle, counted, and what they reach.
SQL = r"""
with recursive docs as (select row_number() over () as id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
words as (select id, len(w) as k, unnest(w) as x, generate_subscripts(w, 1) as pos from docs),
runs as (select id, k, pos, concat_ws(' ', x, lead(x, 1) over i, lead(x, 2) over i, lead(x, 3) over i, lead(x, 4) over i) as t from words window i as (partition by id order by pos)),
shingles as (select distinct id, t from runs where pos = 1 or pos <= k - 4),
sizes as (select id, count(*) as n from shingles group by id),
one as (select s.id, z.n, s.t from shingles s join sizes z on s.id = z.id),
links as (select a.id as a, b.id as b from one a join one b on a.t = b.t and a.id <> b.id group by a.id, b.id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) as (select id, id from docs union select r.a, l.b from reach r join links l on r.b = l.a)
select d.doc_id, coalesce(z.n, 0) as n_shingles, min(o.doc_id) as component_id from docs d left join sizes z on z.id = d.id join reach r on r.a = d.id join docs o on o.id = r.b group by d.id, d.doc_id, z.n
"""
