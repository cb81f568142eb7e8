import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketloom.llm import link_graph, vectors


@pytest.fixture(scope="session")
def points(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 16))
    x[100:160] = x[100] + 0.05 * rng.standard_normal((60, 16))
    x[200:230] = x[200]
    rows = [(i, [float(v) for v in r], i % 3) for i, r in enumerate(x)]
    rows += [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [1.0, None] * 8, 0), (504, [1.0, 2.0], 0), (504, [1.0, 2.0], 0), (None, [1.0] * 16, 0), (505, [], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), x


def test_nearest_recall(points):
    df, x = points
    got = {}
    for r in vectors.nearest(df.where("vec_id % 20 = 0"), df, fit_bound=200, rerank=20, part=100, block=8).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 400, 20))
    hits = 0
    for q, rows in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        rows.sort()
        assert [k for k, _, _ in rows] == list(range(1, 11)) and np.allclose([s for _, _, s in rows], d[[i for _, i, _ in rows]])
        hits += len({i for _, i, _ in rows} & set(np.lexsort((np.arange(400), d))[:10].tolist()))
    assert hits / (10 * len(got)) >= 0.9


def test_vector_links(points):
    df, x = points
    rows = {}
    for r in vectors.link_vectors(df).collect():
        rows.setdefault(r.vec_id, []).append(r)
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (y @ y.T >= 0.9).sum(1) - 1
    assert [rows[i][0].n_links for i in range(400)] == links.tolist()
    assert all(rows[i][0].component_id == 100 for i in range(100, 160)) and all(rows[i][0].component_id == 200 for i in range(200, 230))
    assert all(rows[i][0].n_links == 0 and rows[i][0].kept for i in (500, 501, 502, 503, 505))
    assert len(rows[504]) == 2 and rows[504][0].n_links == 1


def cone(rng, n, dim, cosine):
    """Unit vectors whose mean cosine with each other is `cosine`."""
    x = rng.standard_normal((n, dim))
    x[:, 0] = 0
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= math.sqrt(1 - cosine)
    x[:, 0] = math.sqrt(cosine)
    return x


def partners(rng, x, cosine):
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    return cosine * x + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side, axis=1, keepdims=True)


def planted_recall(n, cosine, mean=0.0, pairs=500, window=48, seed=11):
    """The share of planted pairs that some pass brings within the window, among n unit vectors of 64 dimensions, and the passes."""
    rng = np.random.default_rng(seed)
    x = cone(rng, n, 64, mean) if mean else rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[pairs : 2 * pairs] = partners(rng, x[:pairs], cosine)
    hashes = math.ceil(math.log2(n + 2))
    frame = vectors.fit_frame(x[rng.choice(n, 8192, replace=False)], n, 0.9, window, hashes, 2.6, 0.985, 23)
    axes, shift = vectors.directions(64, frame.passes, hashes + 1, 23)
    met, y = np.zeros(pairs, bool), (x - frame.mean) / frame.spread
    for p in range(frame.passes):
        own = slice(p * (hashes + 1), (p + 1) * (hashes + 1))
        keys = np.ascontiguousarray(vectors.pass_keys(y, axes[own], shift[own], 1, 2.6)[:, 0])
        place = np.empty(n, int)
        place[np.lexsort(keys.T[::-1])] = np.arange(n)
        met |= abs(place[:pairs] - place[pairs : 2 * pairs]) <= window
    return met.mean(), frame.passes


@pytest.mark.parametrize("n", [20_000, 80_000])
def test_planted_pairs_meet(n):
    found = {c: planted_recall(n, *c) for c in ((0.905, 0.0), (0.95, 0.0), (0.92, 0.5), (0.92, 0.8))}
    assert all(recall >= (0.995 if c[0] == 0.95 else 0.98) for c, (recall, _) in found.items()), found


def test_planted_links_in_a_cone(spark):
    """20,000 vectors of mean cosine 0.8: planted pairs of cosine 0.92 and all links there are, by component or directly."""
    rng = np.random.default_rng(13)
    x = cone(rng, 20_000, 64, 0.8)
    x[500:1000] = partners(rng, x[:500], 0.92)
    near = np.concatenate([(x[lo : lo + 2000] @ x.T >= 0.9).sum(1) - 1 for lo in range(0, 20_000, 2000)])
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(20_000), "embedding": pa.array(list(3 * x), pa.list_(pa.float64()))}))
    got = vectors.link_vectors(df).toPandas().set_index("vec_id").sort_index()
    assert (got.n_links.to_numpy() <= near).all() and got.n_links.sum() >= 0.98 * near.sum() and near.sum() > 5000
    assert (got.component_id.to_numpy()[:500] == got.component_id.to_numpy()[500:1000]).mean() >= 0.98


@pytest.mark.parametrize("shape", ["shifted", "norms of 20", "log-normal norms", "cone 0.8", "cone 0.95"])
def test_recall_wherever_vectors_lie(spark, shape):
    """50,000 vectors in several parts, of which distances don't change with the origin."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((50_000, 64))
    if shape == "shifted":
        x += 10
    elif shape.startswith("cone"):
        x = cone(rng, 50_000, 64, float(shape.split()[1]))
    else:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        x *= (rng.normal(20, 2, 50_000) if shape == "norms of 20" else rng.lognormal(0, 0.5, 50_000))[:, None]
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(50_000), "embedding": pa.array(list(x), pa.list_(pa.float64()))}))
    got = vectors.nearest(df.where("vec_id % 2000 = 0"), df).toPandas().groupby("query_id").vec_id.agg(set)
    hits = 0
    for q in range(0, 50_000, 2000):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert hits / 250 >= 0.95


@pytest.mark.parametrize("shape", ["tight clusters", "dense behind the first ids", "outliers", "far off"])
def test_recall_where_codes_tell_little(spark, shape):
    """20,000 vectors much nearer to each other than codes tell apart, or ids that say something of the place."""
    rng = np.random.default_rng(21)
    n, dim = 20_000, 32
    x = rng.standard_normal((n, dim))
    if shape == "tight clusters":
        x = 5 * x[rng.integers(0, 16, n)] + 0.001 * rng.standard_normal((n, dim))
    elif shape == "dense behind the first ids":
        x[9_000:] = x[9_000] + 0.01 * x[9_000:]
    elif shape == "outliers":
        x[::97] *= 1e6
    else:
        x += 1e7
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": pa.array(list(x), pa.list_(pa.float64()))}))
    got = vectors.nearest(df.where("vec_id % 500 = 0"), df).toPandas().groupby("query_id").vec_id.agg(set)
    hits = 0
    for q in range(0, n, 500):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert hits / (10 * len(got)) >= 0.95, hits / (10 * len(got))


def test_nearest_answers_every_query_row(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.0, 0.9]), (3, [1.0, 0.0]), (None, [1.0, 0.0]), (4, [1.0]), (200, [5.0]), (300, None)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, query string").withColumn("rank", F.lit(1)).withColumn("cell", F.lit("c"))
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in vectors.nearest(df.where("vec_id % 100 = 0"), df, k=3).collect())
    d = lambda a, b: round(float(np.linalg.norm(np.subtract(a, b))), 6)
    want = []
    for k, (i, v) in enumerate(rows):
        if i is not None and i % 100 == 0 and v:
            near = sorted((d(v, w), j) for m, (j, w) in enumerate(rows) if m != k and j is not None and w and len(w) == len(v))
            want += [(i, r + 1, j, s) for r, (s, j) in enumerate(near[:3])]
    assert got == sorted(want)


def test_recall_on_many_vectors(spark):
    """50,000 vectors of 32 dimensions, without clusters and with them."""
    rng = np.random.default_rng(6)
    for centres in (0, 300):
        x = rng.standard_normal((50_000, 32)) + (4 * rng.standard_normal((centres, 32))[rng.integers(centres, size=50_000)] if centres else 0)
        df = spark.createDataFrame(pa.table({"vec_id": np.arange(50_000), "embedding": pa.array(list(x), pa.list_(pa.float64()))}))
        hits = 0
        got = vectors.nearest(df.where("vec_id % 1000 = 0"), df).toPandas().groupby("query_id").vec_id.agg(set)
        for q in range(0, 50_000, 1000):
            d = ((x - x[q]) ** 2).sum(1)
            d[q] = np.inf
            hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
        assert hits / 500 >= 0.95


def test_links_of_rows_with_one_id(spark):
    rows = [(7, [1.0, 0.0, 0.0]), (7, [0.0, 1.0, 0.0]), (1, [1.0, 0.05, 0.0]), (2, [0.0, 1.0, 0.02]), (9, [0.0, 0.0, 1.0]), (9, [0.0, 0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], "vec_id long, embedding array<float>, n int, component string")
    got = sorted(tuple(r) for r in vectors.link_vectors(df).collect())
    assert got == [(1, 1, 1, True), (2, 1, 2, True), (7, 1, 1, False), (7, 1, 2, False), (9, 1, 9, True), (9, 1, 9, True)]


def test_planted_links_among_many(spark):
    """Pairs and a group near the threshold among 20,000 vectors: all links against brute force."""
    rng = np.random.default_rng(12)
    x = rng.standard_normal((20_000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 1600, 2):
        side = rng.standard_normal(48)
        side -= side @ x[i] * x[i]
        c = rng.uniform(0.88, 0.99)
        x[i + 1] = c * x[i] + math.sqrt(1 - c * c) * side / np.linalg.norm(side)
    x[5000:5300] = x[5000] + 0.33 * rng.standard_normal((300, 48)) / math.sqrt(48)
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(y[lo : lo + 2000] @ y.T >= 0.9).sum(1) - 1 for lo in range(0, 20_000, 2000)])
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(20_000), "embedding": pa.array(list(x), pa.list_(pa.float64()))}))
    got = vectors.link_vectors(df).toPandas().set_index("vec_id").n_links.sort_index().to_numpy()
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum() and want.sum() > 20_000


def test_vectors_of_empty_tables(points):
    df, _ = points
    assert vectors.link_vectors(df.limit(0)).count() == 0 and vectors.nearest(df.limit(0), df.limit(0)).count() == 0


def test_rules_and_spread(spark):
    rows = [
        (1, "http://a.net/x", '<a href="http://b.com/">b</a>'), (2, "HTTPS://WWW.Example.NET/en/1?q#f", ""), (3, "https://sub.example.com/de/2", ""), (4, "http://x.org/fr/3", '<a href="//good.com/a">g</a>'),
        (5, None, None), (6, "no scheme", "<a href='http://x'>"), (7, "http://linker.com/p", '<a href="https://a.net/y">bad</a>'), (8, "http://good.com", ""), (9, "http://lonely.com#x", None), (9, "http://lonely.com#x", None),
    ]
    got = [tuple(r)[:5] for r in link_graph.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    want = [
        (1, "a.net", "/x", "net/", "block"), (2, "www.example.net", "/en/1", "example.net/en/", "allow"), (3, "sub.example.com", "/de/2", "example.com/de/", "block"), (4, "x.org", "/fr/3", "org/fr/", "allow"),
        (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "linker.com", "/p", None, "block"), (8, "good.com", "", None, "allow"), (9, "lonely.com", "", None, "allow"), (9, "lonely.com", "", None, "allow"),
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_parsing_matches_plain_python(spark):
    urls = ["http://A.b/C?d#e", "x://", "://h?x", "a://b://c/d", "", "http:/x", "http://h#f/p"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", link_graph.host_of("url").alias("h"), link_graph.path_of("url").alias("p")).collect()
    for r in rows:
        rest = r.url.split("://", 1)[1] if "://" in r.url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        assert (r.h, r.p) == (host.lower(), re.match(r"[^?#]*", rest[len(host) :])[0])


def test_ranks_match_brute_force(spark):
    rng = np.random.default_rng(5)
    hosts = ["s0.net", "s1.net", "example.net", "s2.org"] + [f"h{k}.com" for k in range(36)]
    rows, links = [], np.zeros((40, 40))
    for i, h in enumerate(hosts):
        for k in range(3):
            to = [] if i % 9 == 5 else [int(t) for t in rng.integers(40, size=rng.integers(0, 5))]
            for t in to:
                links[i, t] += t != i
            path = {"example.net": "/en/", "s2.org": "/fr/"}.get(h, "/") + str(k)
            rows.append((3 * i + k, f"http://{h}{path}", "".join(f'<a href="http://{hosts[t]}/x">.</a>' for t in to), "clash"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, side string")

    def rank(w, seed):
        seed = seed / seed.sum()
        total, r = w.sum(1), seed.copy()
        for _ in range(400):
            flow = (r / np.where(total > 0, total, 1) * (total > 0)) @ w + r[total == 0].sum() * seed
            r = 0.85 * flow + 0.15 * seed
        return r

    trust = rank(links, np.array([3.0 * (h in ("example.net", "s2.org")) for h in hosts]))
    distrust = rank(links.T, np.array([3.0 * (h in ("s0.net", "s1.net")) for h in hosts]))
    got = link_graph.judge(df, most=200, close=1e-9).collect()
    assert len(got) == len(rows)
    for r in got:
        k = hosts.index(r.host)
        assert abs(r.trust - trust[k]) < 1e-6 and abs(r.distrust - distrust[k]) < 1e-6
        if r.rule is None:
            assert r.verdict == ("block" if distrust[k] > trust[k] else "allow")
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}
    # without rules, links or rows
    assert {r.verdict for r in link_graph.judge(df, rules=()).collect()} == {"allow"} and link_graph.judge(df.limit(0)).count() == 0
    assert {r.verdict for r in link_graph.judge(df.withColumn("html", F.lit(None).cast("string")).where("page_id > 20")).collect()} == {"allow"}
