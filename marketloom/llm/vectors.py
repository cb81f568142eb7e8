"""Operators 3 and 10: approximate nearest neighbours and near-duplicate vectors."""

from __future__ import annotations

import math
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, shuffle_partitions, table, written, written_twice


def sound(name: str):
    """Whether a vector is neither null, empty nor zero and holds finite numbers only."""
    finite = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(name).isNotNull() & (F.size(name) > 0) & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(name, lambda x: x != 0), F.lit(False))


def usable(df: DataFrame) -> DataFrame:
    return df.where(sound("embedding"))


def matrix(column) -> np.ndarray:
    """Arrow lists of one length as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


# --- nearest neighbours ------------------------------------------------------------------------


class Codebook:
    """Four-bit codes of vectors, two components to a code, whose error is least along the vector itself.

    Distances don't change with the origin and only scale with the unit, so vectors are taken from the sample's mean and
    in its spread. Nearest by Euclidean distance is largest by inner product with the query less |x|^2 / 2: the product
    is approximated by codes, the norm is not coded but exact. The loss of a code is the squared error plus
    (eta - 1) times its part parallel to the vector; codes are set by coordinate descent, centroids by
    the weighted least squares that follow from it.
    """

    def __init__(self, x: np.ndarray, eta: float = 4.0, rounds: int = 6, seed: int = 5):
        self.eta = eta
        self.mean = x.mean(0)
        self.spread = max(float(np.sqrt(((x - self.mean) ** 2).mean())), 1e-30)
        x = self.framed(x)
        rng = np.random.default_rng(seed)
        parts = self.parts(x)
        self.centroids = np.stack([p[rng.choice(len(p), 16, replace=len(p) < 16)] for p in parts])
        codes = None
        for _ in range(rounds):
            codes = self.encode(x, codes, framed=True)
            self.update(x, codes)

    def framed(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.spread
        return np.column_stack((x, np.zeros(len(x)))) if x.shape[1] % 2 else x

    @staticmethod
    def parts(x: np.ndarray) -> np.ndarray:
        return x.reshape(len(x), -1, 2).transpose(1, 0, 2)

    def encode(self, x: np.ndarray, codes: np.ndarray | None = None, framed: bool = False, rounds: int = 2) -> np.ndarray:
        x = x if framed else self.framed(x)
        parts, norm = self.parts(x), np.maximum((x * x).sum(1), 1e-12)
        if codes is None:
            codes = np.stack([((p[:, None] - c) ** 2).sum(2).argmin(1) for p, c in zip(parts, self.centroids)]).astype(np.uint8)
        parallel = np.stack([((p - c[k]) * p).sum(1) for p, c, k in zip(parts, self.centroids, codes)])
        total = parallel.sum(0)
        for _ in range(rounds):
            for m, (p, c) in enumerate(zip(parts, self.centroids)):
                error = p[:, None] - c
                along = (error * p[:, None]).sum(2)
                loss = (error**2).sum(2) + (self.eta - 1) * ((total - parallel[m])[:, None] + along) ** 2 / norm[:, None]
                codes[m] = loss.argmin(1)
                now = along[np.arange(len(x)), codes[m]]
                total += now - parallel[m]
                parallel[m] = now
        return codes

    def update(self, x: np.ndarray, codes: np.ndarray) -> None:
        parts, norm = self.parts(x), np.maximum((x * x).sum(1), 1e-12)
        along = np.stack([((p - c[k]) * p).sum(1) for p, c, k in zip(parts, self.centroids, codes)])
        total, g = along.sum(0), self.eta - 1
        for m, p in enumerate(parts):
            for k in range(16):
                own = codes[m] == k
                if own.any():
                    q, w = p[own], g / norm[own]
                    a = own.sum() * np.eye(2) + (q * w[:, None]).T @ q
                    b = q.sum(0) + (q * (w * ((total - along[m])[own] + (q * q).sum(1)))[:, None]).sum(0)
                    self.centroids[m, k] = np.linalg.solve(a, b)
            new = ((p - self.centroids[m][codes[m]]) * p).sum(1)
            total += new - along[m]
            along[m] = new

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for, framed."""
        return np.concatenate([c[k] for c, k in zip(self.centroids, codes)], axis=1)

    def scan(self, queries: np.ndarray, codes: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squared distances of coded vectors to queries by 16-entry tables of the query, added up; and how wrong they may be.

        With r what a vector's code leaves over, its product with the vector itself is added exactly. So of a vector at distance d the
        squared distance is wrong by 2 (x - q) r, that is by 2 d |r| at most, and by the rounding of the sums. Returns the squares, |r|,
        and bounds on the rounding. All is framed: distances are in units of the spread.
        """
        q, x, y = self.framed(queries), self.framed(vectors), self.decoded(codes)
        rest = x - y
        tables = np.einsum("qmd,mkd->qmk", q.reshape(len(q), -1, 2), self.centroids).astype(np.float32)
        norm, norms = (q * q).sum(1), (x * x).sum(1)
        out = np.tile((-0.5 * norms + (x * rest).sum(1)).astype(np.float32), (len(q), 1))
        for m in range(len(codes)):
            out += tables[:, m][:, codes[m]]
        sizes = norms + np.sqrt(norms * (rest * rest).sum(1))
        rounding = 4e-7 * (len(codes) + 8) * (np.sqrt(norm)[:, None] * np.sqrt((y * y).sum(1)) + sizes + norm[:, None])
        return norm[:, None] - 2.0 * out, np.sqrt((rest * rest).sum(1)), rounding


def packed(codes: np.ndarray) -> np.ndarray:
    """Codes (parts x vectors) as rows of bytes, two codes to a byte."""
    codes = np.concatenate((codes, np.zeros((len(codes) % 2, codes.shape[1]), np.uint8)))
    return np.ascontiguousarray((codes[::2] | codes[1::2] << 4).T)


def unpacked(rows: np.ndarray, parts: int) -> np.ndarray:
    codes = np.empty((2 * rows.shape[1], len(rows)), np.uint8)
    codes[::2], codes[1::2] = (rows & 15).T, (rows >> 4).T
    return codes[:parts]


class Index(NamedTuple):
    """What is fitted for vectors of one length: a codebook, and the centroids of cells, from the sample's mean, to the nearest of which a vector belongs."""

    book: Codebook
    cells: np.ndarray

    def order(self, x: np.ndarray) -> np.ndarray:
        """Cells by their distance to each of x, nearest first."""
        return np.argsort((self.cells**2).sum(1)[None] - 2 * (x - self.book.mean) @ self.cells.T, axis=1, kind="stable")


def fit_index(vectors: DataFrame, part: int, bound: int, seed: int = 3) -> dict[int, Index]:
    """An Index for each length of vectors, fitted on about `bound` of them at most, the first by hashed vec_id. A cell for each `part` vectors, but not more than one for 8 of the sample."""
    sizes = {r["dim"]: r["count"] for r in vectors.groupBy(F.size("embedding").alias("dim")).count().collect()}
    n = sum(sizes.values())
    mark = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "vec_id"), 1).cast("double") / float(1 << 63)
    sample = vectors.where(mark < bound / n) if n > bound else vectors
    by: dict[int, list] = defaultdict(list)
    for row in sorted(sample.select("vec_id", "embedding").collect(), key=lambda r: (r.vec_id, r.embedding)):
        by[len(row.embedding)].append(row.embedding)
    found = {}
    for d, rows in by.items():
        x = np.asarray(rows, dtype=np.float64)
        n_cells = max(1, min(-(-sizes[d] // part), len(x) // 8))
        book = Codebook(x)
        x = x - book.mean
        cells = x[np.random.default_rng(seed).choice(len(x), n_cells, replace=False)]
        for _ in range(8):
            near = ((cells**2).sum(1)[None] - 2 * x @ cells.T).argmin(1)
            cells = np.stack([x[near == j].mean(0) if (near == j).any() else cells[j] for j in range(n_cells)])
        found[d] = Index(book, cells)
    return found


def coded(vectors: DataFrame, index: dict[int, Index]) -> DataFrame:
    """All vectors with dim, cell and their packed codes. Lengths that the sample doesn't hold have one cell and no codes."""

    def run(batches):
        for batch in batches:
            for t in by_length(pa.Table.from_batches([batch])):
                x = matrix(t["embedding"])
                own = index.get(x.shape[1])
                cell = own.order(x)[:, 0] if own else np.zeros(len(x), np.int64)
                codes = [r.tobytes() for r in packed(own.book.encode(x))] if own else [b""] * len(x)
                dims = np.full(len(x), x.shape[1])
                yield from t.append_column("dim", pa.array(dims, pa.int32())).append_column("cell", pa.array(cell, pa.int32())).append_column("codes", pa.array(codes, pa.binary())).to_batches()

    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id long, embedding {vectors.schema['embedding'].dataType.simpleString()}, dim int, cell int, codes binary")


def by_length(t: pa.Table, most: int = 1024):
    """A table's rows with embedding by its length, at most so many at a time."""
    lengths = pa.compute.list_value_length(t["embedding"]).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths):
        own = t.filter(pa.array(lengths == d))
        for lo in range(0, len(own), most):
            yield own.slice(lo, most).combine_chunks()


def probes_for(asked: DataFrame, ready: DataFrame, index: dict[int, Index], k: int, queries: int, coverage: float, seed: int = 9) -> dict[int, int]:
    """How many cells a query must look into, by length: so many that of about `queries` sampled queries' true k nearest a share of `coverage` lies in them.

    The sample is compared with all vectors: one pass, of which k + 1 rows a query leave each batch.
    """
    n = asked.count()
    mark = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "query_id"), 1).cast("double") / float(1 << 63)
    rows = asked.where(mark < queries / max(n, 1)).select("embedding").collect() if n else []
    own: dict[int, np.ndarray] = {d: np.array([r.embedding for r in rows if len(r.embedding) == d], dtype=np.float64) for d in index}

    def run(batches):
        for batch in batches:
            for t in by_length(pa.Table.from_batches([batch])):
                x, cell = matrix(t["embedding"]), t["cell"].to_numpy()
                q = own.get(x.shape[1], np.zeros((0, x.shape[1])))
                if len(q):
                    mean = index[x.shape[1]].book.mean
                    q, x = q - mean, x - mean
                    d = (q**2).sum(1)[:, None] - 2 * q @ x.T + (x**2).sum(1)
                    near = np.argsort(d, axis=1, kind="stable")[:, : k + 1]
                    m = near.shape[1]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(q) * m, x.shape[1]), pa.int32()), pa.array(np.repeat(np.arange(len(q)), m), pa.int32()),
                        pa.array(np.take_along_axis(d, near, 1).ravel()), pa.array(cell[near.ravel()], pa.int32()),
                    ], ["dim", "q", "d", "cell"])

    found = ready.mapInArrow(run, "dim int, q int, d double, cell int")
    found = found.withColumn("r", F.row_number().over(Window.partitionBy("dim", "q").orderBy("d", "cell"))).where(F.col("r") <= k + 1)
    ranks: dict[int, list] = defaultdict(list)
    places = {d: np.argsort(index[d].order(q), axis=1) for d, q in own.items() if len(q)}
    for r in found.collect():
        ranks[r.dim].append(int(places[r.dim][r.q, r.cell]) + 1)
    return {d: int(np.quantile(ranks[d], coverage, method="higher")) if ranks[d] else len(index[d].cells) for d in index}


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 10, rerank: int = 150, part: int = 4096, block: int = 2048, fit_bound: int = 8192, sampled: int = 64, coverage: float = 0.98) -> DataFrame:
    """The k nearest of vectors to each of queries (both vec_id, embedding) by Euclidean distance, approximately.

    All vectors are coded, in four bits for two components, and belong to the nearest of the cells; a cell's vectors are
    dealt to parts of about `part`. A query looks into as many cells as a sample of queries shows to hold `coverage` of true neighbours
    (see probes_for): few where the vectors lie in clusters, nearly all where they don't. In each part the queries that look into it, in
    blocks of about `block`, scan the four-bit tables. Exact distances, in double precision on the original vectors, of the `rerank` distinct
    vectors that look best bound the distance of the k-th; every vector of the part that is not shown to lie beyond it (see Codebook.scan)
    is then compared exactly too. So no part loses a neighbour, however alike its vectors are, and only cells that aren't looked into do. A task holds about
    `part` vectors and `block` queries at any size of the tables.

    Returns query_id, rank (from 1), vec_id, score; nearest first, ties to the smaller vec_id; fewer than k where fewer are
    found. Each query row is answered on its own: of the vectors with its vec_id and its very numbers one, itself, is left out, others with its
    vec_id are candidates. Unusable vectors (see sound) and rows without vec_id take no part, and
    vectors of different length are never compared; an empty side gives no rows.
    """
    ready = usable(vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"))
    asked = usable(queries.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("query_id"), "embedding"))
    asked = written(asked.withColumn("query", F.monotonically_increasing_id()), "asked")
    index = fit_index(ready, part, fit_bound)
    ready = written(coded(ready, index), "coded")
    looks = probes_for(asked, ready, index, k, sampled, coverage)

    def probe(batches):
        for batch in batches:
            for t in by_length(pa.Table.from_batches([batch])):
                x = matrix(t["embedding"])
                own = index.get(x.shape[1])
                cells = own.order(x)[:, : looks[x.shape[1]]] if own else np.zeros((len(x), 1), np.int64)
                rows = t.take(pa.array(np.repeat(np.arange(len(x)), cells.shape[1])))
                yield from rows.append_column("dim", pa.array(np.full(len(rows), x.shape[1]), pa.int32())).append_column("cell", pa.array(cells.ravel(), pa.int32())).to_batches()

    probing = written(asked.mapInArrow(probe, f"query_id long, embedding {asked.schema['embedding'].dataType.simpleString()}, query long, dim int, cell int"), "probing")
    place = ["dim", "cell"]
    sizes = ready.groupBy(*place).agg(F.ceil(F.count("*") / part).cast("int").alias("parts")).join(probing.groupBy(*place).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), place)
    sizes = written(sizes, "cells")
    left = ready.join(sizes, place).withColumns({"part": F.pmod(F.xxhash64("vec_id", "embedding"), "parts").cast("int"), "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    right = probing.join(sizes, place).withColumns({"block": F.pmod(F.xxhash64("query"), "blocks").cast("int"), "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})

    def run(own: pa.Table, wanted: pa.Table) -> pa.Table:
        out_id, out_near = [], []
        if len(own) and len(wanted):
            ids, x = own["vec_id"].to_numpy(), matrix(own["embedding"])
            # like vectors count as one; their smallest k + 1 ids are enough, one may be the query itself
            rows = np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.shape[1] * 8))).ravel()
            _, first, member = np.unique(rows, return_index=True, return_inverse=True)
            by_class = np.lexsort((ids, member))
            lows = np.searchsorted(member[by_class], np.arange(len(first) + 1))
            u, index_ = x[first], index.get(x.shape[1])
            codes = unpacked(np.stack([np.frombuffer(own["codes"][int(i)].as_py(), np.uint8) for i in first]), len(index_.book.centroids)) if index_ else None
            keys, qids, qx = wanted["query"].to_numpy(), wanted["query_id"].to_numpy(), matrix(wanted["embedding"])
            m = min(max(rerank, k + 1), len(u))
            for lo in range(0, len(qids), 256):
                q = qx[lo : lo + 256]
                if index_ and m < len(u):
                    square, rest, rounding = index_.book.scan(q, codes, u)
                    best = np.argpartition(square, m - 1, axis=1)[:, :m]
                    edges = [np.partition(np.sqrt(((u[c] - y) ** 2).sum(1)), k)[k] / index_.book.spread for c, y in zip(best, q)]
                    edges = np.array(edges)[:, None]
                    near = ~(square > edges**2 + 2 * edges * rest + rounding)
                    np.put_along_axis(near, best, True, 1)
                else:
                    near = np.ones((len(q), len(u)), bool)
                for j, cand in enumerate(map(np.flatnonzero, near)):
                    dist = np.sqrt(((u[cand] - q[j]) ** 2).sum(1))
                    edge = np.partition(dist, min(k, len(dist) - 1))[min(k, len(dist) - 1)]
                    found = []
                    for c in np.flatnonzero(dist <= edge):
                        mine = ids[by_class[lows[cand[c]] : lows[cand[c] + 1]]]
                        at = np.searchsorted(mine, qids[lo + j]) if dist[c] == 0 else len(mine)
                        if at < len(mine) and mine[at] == qids[lo + j]:
                            mine = np.delete(mine, at)
                        found += [(float(dist[c]), int(i)) for i in mine[:k]]
                    out_id.append(int(keys[lo + j]))
                    out_near.append([{"score": s, "vec_id": i} for s, i in sorted(found)[:k]])
        return pa.table({"query": pa.array(out_id, pa.int64()), "near": pa.array(out_near, pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())])))})

    keys = [*place, "part", "block"]
    left, right = left.select(*keys, "vec_id", "embedding", "codes"), right.select(*keys, "query", "query_id", "embedding")
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query long, near array<struct<score:double,vec_id:bigint>>")
    ranked = met.select("query", F.inline("near")).withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", "query_id"), "query").select("query_id", "rank", "vec_id", "score")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors.where("vec_id % 100 = 0"), vectors)


# --- near duplicates ---------------------------------------------------------------------------


def directions(dim: int, passes: int, hashes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((seed, dim))
    return rng.standard_normal((passes * hashes, dim)), rng.random(passes * hashes)


def forest(a: np.ndarray, b: np.ndarray, sure: int | None = None) -> np.ndarray:
    """Which of the pairs tie together what earlier ones have not: a spanning forest. Pairs from the place `sure` on tie nothing, but are kept where the others don't tie them."""
    sure = len(a) if sure is None else sure
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = np.zeros(len(a), dtype=bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            keep[k] = True
            if k < sure:
                parent[x] = y
    return keep


def rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors in a byte a component: numbers, their scale, and how far the vector is from what they stand for."""
    scale = np.maximum(np.abs(x).max(1), 1e-30) / 127
    small = np.rint(x / scale[:, None]).astype(np.int8)
    return small, scale.astype(np.float32), np.linalg.norm(x - small * scale.astype(np.float32)[:, None].astype(np.float64), axis=1).astype(np.float32) + np.float32(1e-5)


def matches(kinds, small, scale, error, window: int, least: float):
    """Pairs of rows at most window apart, of one pass: places i < j that link for sure, and those too near `least` to tell from rounded vectors."""
    close, sure, maybe = small.astype(np.float32), [], []
    for step in range(1, min(window, len(kinds) - 1) + 1):
        cosine = np.einsum("ij,ij->i", close[:-step], close[step:]) * scale[:-step] * scale[step:]
        # |x.y - x'.y'| is at most |y - y'| + |x - x'| (1 + |y - y'|)
        off = error[step:] + error[:-step] * (1 + error[step:])
        same = kinds[:-step] == kinds[step:]
        for out, hit in ((sure, cosine - off >= least), (maybe, (cosine - off < least) & (cosine + off >= least))):
            i = np.flatnonzero(same & hit)
            out.append(np.stack((i, i + step)))
    none = np.zeros((2, 0), np.int64)
    return (np.concatenate(v, axis=1) if v else none for v in (sure, maybe))


class Frame(NamedTuple):
    """Where unit vectors of one length lie, and the passes that they ask for: keys are made of (x - mean) / spread, of length 1 on average."""

    mean: np.ndarray | float = 0.0
    spread: float = 1.0
    passes: int = 12


def pass_keys(x: np.ndarray, axes: np.ndarray, shift: np.ndarray, passes: int, width: float) -> np.ndarray:
    """Sort keys of framed vectors for each pass: projections cut to steps of `width`, a byte each, then one projection's value, big-endian bytes."""
    at = (x @ axes.T).reshape(len(x), passes, -1)
    cut = np.clip(np.floor(at[..., :-1] / width + shift.reshape(passes, -1)[:, :-1]) + 128, 0, 255).astype(np.uint8)
    value = np.clip(np.floor(at[..., -1:] * (1 << 22)) + (1 << 31), 0, (1 << 32) - 1).astype(">u4")
    return np.concatenate((cut, np.ascontiguousarray(value).view(np.uint8)), axis=2)


def met_in(x: np.ndarray, pairs: int, hashes: int, passes: int, windows: tuple[int, ...], width: float, seed: int) -> np.ndarray:
    """The share of the pairs (k, pairs + k), by window, that one pass brings within it."""
    axes, shift = directions(x.shape[1], passes, hashes + 1, seed)
    place, met = np.empty(len(x), np.int64), np.zeros(len(windows))
    for p in range(passes):
        own = slice(p * (hashes + 1), (p + 1) * (hashes + 1))
        keys = pass_keys(x, axes[own], shift[own], 1, width)[:, 0]
        place[np.lexsort(keys.T[::-1])] = np.arange(len(x))
        met += [(abs(place[:pairs] - place[pairs : 2 * pairs]) <= w).mean() for w in windows]
    return met / passes


def fit_frame(x: np.ndarray, n: int, least: float, window: int, hashes: int, width: float, target: float, seed: int) -> Frame:
    """Mean, spread and passes for n vectors of which the unit vectors x are a sample.

    Partners of cosine `least` are planted beside vectors of the sample. How often a pass brings a pair together falls with
    a power of the table's size, which the sample shows by a window an eighth as wide; carried on to n it gives the
    passes after which a share of `target` has met, and half as many again, as some pairs meet less often than most.
    """
    mean = x.mean(0)
    spread = max(float(np.sqrt(((x - mean) ** 2).sum(1).mean())), 1e-9)
    pairs = min(len(x) // 2, 1000)
    if pairs < 32 or spread < 1e-6:
        return Frame(mean, spread)
    rng = np.random.default_rng(seed)
    side = rng.standard_normal((pairs, x.shape[1]))
    side -= (side * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    planted = least * x[:pairs] + math.sqrt(1 - least**2) * side / np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
    framed = (np.concatenate((x[:pairs], planted, x[pairs:])) - mean) / spread
    wide, narrow = np.maximum(met_in(framed, pairs, hashes, 16, (window, max(1, window // 8)), width, seed), 1e-4)
    power = min(1.0, max(0.0, math.log(wide / narrow) / math.log(window / max(1, window // 8))))
    share = min(0.9, wide * (len(framed) / max(n, len(framed))) ** power)
    return Frame(mean, spread, max(Frame().passes, math.ceil(1.5 * math.log(1 - target) / math.log(1 - share))))


def fit_frames(classes: DataFrame, least: float, window: int, hashes: int, width: float, bound: int, target: float, seed: int) -> dict[int, Frame]:
    """A Frame for each length of vectors, from about `bound` of them, the first by their hashes."""
    sizes = {r["dim"]: r["count"] for r in classes.groupBy(F.size("embedding").alias("dim")).count().collect()}
    n = sum(sizes.values())
    mark = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "a"), 1).cast("double") / float(1 << 63)
    by: dict[int, list] = defaultdict(list)
    for r in sorted(classes.where(mark < bound / max(n, 1)).select("a", "b", "embedding").collect(), key=lambda r: (r.a, r.b)):
        by[len(r.embedding)].append(r.embedding)
    out = {}
    for d, rows in by.items():
        x = np.asarray(rows, dtype=np.float64)
        out[d] = fit_frame(x / np.linalg.norm(x, axis=1, keepdims=True), sizes[d], least, window, hashes, width, target, seed)
    return out


def link_vectors(vectors: DataFrame, least: float = 0.9, window: int = 48, width: float = 2.6, block: int = 512, fit_bound: int = 8192, target: float = 0.985, seed: int = 23) -> DataFrame:
    """Near-duplicate vectors (vec_id, embedding) by sorted projection passes.

    Vectors alike are one class. In each pass the classes are ordered by concatenated random hashes: projections of the unit vectors,
    taken from the mean of a sample of about `fit_bound` and in its spread, cut to steps of `width`, as many as tell the classes apart, then
    a projection's value. There are as many passes as pairs planted into the sample ask for to meet with a share of `target` (see fit_frame). Only sort keys and vectors rounded to
    a byte a component are sorted; each is compared with the `window` after it. What links whatever the rounding ties components
    together; pairs that the rounding leaves open, and that aren't tied by then, are checked on the original vectors. The pairs of all passes are united. Then the members of each
    component are compared in blocks for their exact numbers of links, of which only counts leave a task.

    Returns a row per row: vec_id, n_links, component_id (smallest vec_id), kept. Unusable vectors (see
    usable) and rows without vec_id link with nothing: n_links 0, themselves as component. Rows with the
    same vec_id are each a row of their own, linked only if their vectors are. Vectors of different length are never linked. An empty table
    gives no rows; columns but vec_id and embedding, of whatever names, are left out.
    """
    spark = vectors.sparkSession
    keyed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    ready = usable(keyed.where("vec_id is not null")).withColumn("a", F.xxhash64("embedding")).withColumn("b", F.xxhash64("embedding", F.lit(1)))
    classes = ready.groupBy("a", "b").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"), F.min("embedding").alias("embedding"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    n_classes = classes.count()
    hashes = math.ceil(math.log2(n_classes + 2))
    frames = fit_frames(classes, least, window, hashes, width, fit_bound, target, seed)
    passes = max((f.passes for f in frames.values()), default=Frame().passes)

    def deal(batches):
        for batch in batches:
            for part in by_length(pa.Table.from_batches([batch])):
                x = matrix(part["embedding"])
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                dim = x.shape[1]
                small, scale, error = rounded(x)
                values = pa.array([r.tobytes() for r in small], pa.binary())
                frame = frames.get(dim, Frame())
                axes, shift = directions(dim, frame.passes, hashes + 1, seed)
                order = pass_keys((x - frame.mean) / frame.spread, axes, shift, frame.passes, width)
                for p in range(frame.passes):
                    keys = [dim.to_bytes(4, "big") + p.to_bytes(2, "big") + r.tobytes() for r in order[:, p]]
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), part["node"].combine_chunks() if isinstance(part["node"], pa.ChunkedArray) else part["node"], values, pa.array(scale), pa.array(error)], ["key", "node", "x", "scale", "error"])

    row = "key binary, node long, x binary, scale float, error float"
    edge = f"a long, b long, sure boolean, part int, side int, {row}"
    rows = classes.select("node", "embedding").mapInArrow(deal, row)
    parts = max(1, min(shuffle_partitions(spark), n_classes * passes // (8 * window)))
    ordered = rows.repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node")

    def pairs_of(t: pa.Table):
        """Links for sure, as a spanning forest, and pairs to be checked that it doesn't tie: a, b, sure."""
        keys, nodes, scale, error = t["key"].to_pylist(), t["node"].to_numpy(), t["scale"].to_numpy(), t["error"].to_numpy()
        sizes = np.array([int.from_bytes(k[:4], "big") for k in keys])
        for dim in np.unique(sizes):
            own = np.flatnonzero(sizes == dim)
            kinds = np.array([int.from_bytes(keys[k][4:6], "big") for k in own])
            small = np.frombuffer(b"".join(t["x"][int(k)].as_py() for k in own), np.int8).reshape(len(own), -1)
            sure, maybe = matches(kinds, small, scale[own], error[own], window, least)
            (a, b), (c, d) = nodes[own[sure]], nodes[own[maybe]]
            kept = forest(np.concatenate((a, c)), np.concatenate((b, d)), len(a))
            yield np.concatenate((a, c))[kept], np.concatenate((b, d))[kept], (np.arange(len(kept)) < len(a))[kept]

    names = ["a", "b", "sure", "part", "side", "key", "node", "x", "scale", "error"]

    def links(a, b, sure):
        n = len(a)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sure, pa.bool_()), *(pa.nulls(n, x) for x in (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.float32(), pa.float32()))], names)

    def border(t: pa.Table, part: int, side: int):
        n, t = len(t), t.combine_chunks()
        columns = [t[c].combine_chunks() if isinstance(t[c], pa.ChunkedArray) else t[c] for c in names[5:]]
        return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), pa.array([part] * n, pa.int32()), pa.array([side] * n, pa.int32()), *columns], names)

    def compare(batches):
        from pyspark import TaskContext

        part, held, first = TaskContext.get().partitionId(), None, True
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                t = pa.Table.from_batches([batch.slice(lo, 4096)])
                held = t if held is None else pa.concat_tables([held, t])
                if first and len(held) >= window:
                    yield border(held.slice(0, window), part, 0)
                    first = False
                for found in pairs_of(held):
                    yield links(*found)
                held = held.slice(max(0, len(held) - window))
        if held is not None:
            if first:
                yield border(held, part, 0)
            yield border(held, part + 1, -1)

    found = written(ordered.mapInArrow(compare, edge), "windows")

    def across(t: pa.Table) -> pa.Table:
        t = t.take(pa.array(np.lexsort((np.arange(len(t)), t["side"].to_numpy()))))
        return pa.concat_tables([pa.Table.from_batches([links(*x)]).select(["a", "b", "sure"]) for x in pairs_of(t)])

    borders = found.where("part is not null").select("part", "side", *(c.split()[0] for c in row.split(", "))).groupBy("part").applyInArrow(across, "a long, b long, sure boolean")
    pairs = found.where("a is not null").select("a", "b", "sure").union(borders)
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sure").groupBy("a", "b").agg(F.max("sure").alias("sure")), "pairs")
    open_ = pairs.where("not sure").join(classes.select(F.col("node").alias("a"), F.col("embedding").alias("x")), "a").join(classes.select(F.col("node").alias("b"), F.col("embedding").alias("y")), "b")

    def check(batches):
        for batch in batches:
            for t in by_length(pa.Table.from_batches([batch]).rename_columns(["a", "b", "embedding", "y"])):
                x, y = matrix(t["embedding"]), matrix(t["y"])
                x, y = x / np.linalg.norm(x, axis=1, keepdims=True), y / np.linalg.norm(y, axis=1, keepdims=True)
                yield from t.select(["a", "b"]).filter(pa.array((x * y).sum(1) >= least)).to_batches()

    checked = open_.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")
    label = written(components(pairs.where("sure").select("a", "b").union(checked)), "labels")
    sizes = label.groupBy("component").agg(F.count("*").alias("size"))
    # the members of each component, in blocks: every block is compared with every block of its component
    blocks = F.ceil(F.col("size") / block).cast("int")
    member, again = written_twice(label.join(sizes, "component").join(classes, "node").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")), "members")
    one = member.select("component", F.col("block").alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"), "node", "n", "embedding")
    two = again.select("component", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("own"), F.col("block").alias("other"), "node", "n", "embedding")

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, links = [], []
        if len(left) and len(right):
            y, other, weight = matrix(right["embedding"]), right["node"].to_numpy(), right["n"].to_numpy()
            y /= np.linalg.norm(y, axis=1, keepdims=True)
            x = matrix(left["embedding"])
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            near = (x @ y.T >= least) & (left["node"].to_numpy()[:, None] != other)
            ids, links = left["node"].to_numpy(), near @ weight
        return pa.table({"node": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64())})

    keys = ["component", "own", "other"]
    counted = written(one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInArrow(count, "node long, links long"), "links")
    counted = counted.groupBy("node").agg(F.sum("links").alias("links"))
    lows = member.groupBy("component").agg(F.min("low").alias("component_id"))
    info = classes.select("a", "b", "node", "n", "low").join(label.join(lows, "component").select("node", "component_id"), "node", "left").join(counted, "node", "left")
    info = info.select("a", "b", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "low").alias("component_id"))
    done = ready.select("vec_id", "a", "b").join(info, ["a", "b"]).select("vec_id", "n_links", "component_id")
    rest = keyed.where(F.col("vec_id").isNull() | ~F.coalesce(sound("embedding"), F.lit(False)))
    out = done.union(rest.select("vec_id", F.lit(0).cast("long"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


#: The links in DuckDB's SQL: every pair's cosine, and what they reach.
LINKS_SQL = """
with recursive v as (select row_number() over () as id, vec_id, list_transform(embedding, lambda x: x::double) as x from embeddings),
good as (select * from v where vec_id is not null and x is not null and len(x) > 0 and len(list_filter(x, lambda y: y is null or not isfinite(y))) = 0 and len(list_filter(x, lambda y: y <> 0)) > 0),
links as (select a.id as a, b.id as b from good a join good b on a.id <> b.id and len(a.x) = len(b.x) where list_cosine_similarity(a.x, b.x) >= 0.9),
reach(a, b) as (select id, id from v union select r.a, l.b from reach r join links l on r.b = l.a),
low as (select r.a, min(o.vec_id) as component_id from reach r join v o on o.id = r.b group by r.a)
select vec_id, (select count(*) from links where a = v.id) as n_links, component_id, coalesce(vec_id = component_id, true) as kept from v join low on low.a = v.id
"""
