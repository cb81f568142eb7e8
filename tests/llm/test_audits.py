"""Divergence audit, quality classifier and Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from marketloom.llm import divergence, manifest, quality
from pyspark.sql import functions as F


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Root and each leaf's siblings by level, (left, right)."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, a in enumerate(at):
            lo = a // 16 * 16
            paths[k].append(("".join(level[lo:a]), "".join(level[a + 1 : lo + 16])))
        level = [sha(*level[lo : lo + 16]) for lo in range(0, len(level), 16)]
        at = [a // 16 for a in at]
    return level[0], paths


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_matches_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    rng = random.Random(levels)
    rows = [(k, rng.choice("abc") * rng.randint(0, 30), "en", "hot", k) for k in range(400)]
    rows += [(k, None, None, None, None) for k in range(16)] + [(None, "x", "en", "hot", 1), (None, None, "en", "hot", 1), (7, "again", "en", "hot", 5)]
    rows += [(1, "ü", "de", "one", 1), (2, "", "de", "", 0)] + [(k, "same", "de", f"s{k:02}", 4) for k in range(40)] + [(9, "twice", "en", "t", 5)] * 2
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda r, text: sha(*map(field, (r[0], r[3], r[2], r[4], text)))
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), leaf(r, (r[1] or "").upper()) if r[1] is not None else leaf(r, None)))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops = [tree([x[2] for x in sorted(by[s])]) for s in order]
    root, above = tree([t[0] for t in tops])
    want = Counter()
    for s, (subroot, paths), up in zip(order, tops, above):
        for (has, i, own, claim), path in zip(sorted(by[s]), paths):
            whole, at = path + up, claim
            for left, right in whole:
                at = sha(left, at, right)
            want[(i if has else None, own, subroot, root, sha("".join(a + b for a, b in whole)), at)] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"rank": F.lit(1), "key": F.lit("clash"), "digest": F.lit(0)})
    changed = manifest.leaf({f: F.col(f) for f in manifest.FIELDS} | {"text": F.upper("text")})
    got = manifest.manifest(df, changed).select("doc_id", "leaf", "subroot", "root", manifest.proof(), manifest.folded(F.col("claimed")))
    assert Counter(map(tuple, got.collect())) == want
    own = manifest.manifest(df)
    assert own.where(manifest.folded(F.col("leaf")) != F.col("root")).count() == 0 and own.count() == len(rows)
    assert manifest.manifest(df.limit(0)).count() == 0
    one = manifest.manifest(df.limit(1)).first()
    assert one.leaf == one.root and one.path == []


def test_skyband_matches_brute_force(monkeypatch):
    rng = np.random.default_rng(3)
    for n, k, span in ((0, 3, 9), (1, 1, 9), (700, 3, 12), (900, 50, 10_000), (600, 1, 2)):
        c, g = rng.integers(1, span + 1, n), rng.integers(1, span + 1, n)
        t = rng.permutation(n)
        over = ((c[None] >= c[:, None]) & (g[None] <= g[:, None]) & (t[None] < t[:, None])).sum(1)
        assert sorted(divergence.skyband(c, g, t, k)) == list(np.flatnonzero(over < k))
    # in batches and with little room: never less than the skyband, and it is left once all is merged
    terms = [f"t{x:03}" for x in t]
    rows = pa.table({"lang": ["en"] * n, "source": ["a", "b"] * (n // 2), "term": terms, "count": c, "lang_count": g, "value": c})
    for group_rows, all_rows in ((8, 10**6), (8, 40), (10**6, 10**6)):
        monkeypatch.setattr(divergence, "GROUP_ROWS", group_rows)
        monkeypatch.setattr(divergence, "ALL_ROWS", all_rows)
        run = divergence.skybands(2)
        part = pa.Table.from_batches(list(run(rows.to_batches(max_chunksize=32))), rows.schema)
        monkeypatch.setattr(divergence, "ALL_ROWS", 10**6)
        monkeypatch.setattr(divergence, "GROUP_ROWS", 1)
        last = pa.Table.from_batches(list(run(part.to_batches())), rows.schema)
        for s in (0, 1):
            own = np.arange(n)[s::2]
            want = own[divergence.skyband(c[own], g[own], t[own], 2)]
            assert sorted(last.filter(pa.compute.equal(last["source"], "ab"[s]))["term"].to_pylist()) == sorted(terms[i] for i in want)


def test_term_counts_in_little_room(monkeypatch):
    texts = ["Eins zwei-EINS ünf\x00x ÄÖ 3vier\n_fünf" * 50, "", "a b A", "z" * 300]
    want, docs = Counter(), Counter()
    for text in texts:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        want.update(found)
        docs.update(set(found))
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 4), pa.array(["s"] * 4), pa.array(texts)], ["lang", "source", "text"])
    for chunk, held in ((1 << 20, 10**6), (5, 10**6), (7, 1)):
        monkeypatch.setattr(divergence, "CHUNK", chunk)
        monkeypatch.setattr(divergence, "HELD", held)
        count, own = Counter(), Counter()
        for b in divergence.term_counts([batch]):
            for r in b.to_pylist():
                count[r["term"]] += r["count"]
                own[r["term"]] += r["docs"]
        assert count == want and own == docs


def test_audit_in_small_parts(spark, monkeypatch):
    """Many parts of the terms give the same sums; a language without kept terms still has its groups' pairs."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df = df.unionByName(spark.createDataFrame([(1, "one two", "xx", "a", 7), (2, None, "xx", "b", 0), (3, "", None, None, 0)], df.schema)).withColumns({"term": F.lit(1), "count": F.lit(2), "v": F.lit(3)})
    whole = Counter(map(tuple, divergence.audit(df).collect()))
    monkeypatch.setattr(divergence, "CELLS", 500)
    assert Counter(map(tuple, divergence.audit(df).collect())) == whole
    assert {k for k in whole if k[0] in ("xx", "")} == {("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)}


def test_distances_by_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    names, zero = [f"s{k}" for k in range(7)], rng.integers(1, 9, 7)
    p = {(s, t): int(rng.integers(1, 100)) for s in names for t in "uvwxyz" if rng.random() < 0.5}
    rows = [(s, None, int(z)) for s, z in zip(names, zero)] + [(s, t, v) for (s, t), v in p.items()]
    rng.shuffle(rows)
    rows = pa.table({"source": [r[0] for r in rows], "term": pa.array([None if r[1] is None else str(r[1]) for r in rows], pa.string()), "p": [int(r[2]) for r in rows]})
    seen = {t for _, t in p}
    value = lambda s, t: p.get((s, t), int(zero[names.index(s)]))
    want = {(a, b): sum(abs(value(a, t) - value(b, t)) for t in seen) for a in names for b in names if a != b}
    monkeypatch.setattr(divergence, "SOURCES", 3)
    got = [r for k in range(3) for r in divergence.distances((pa.scalar("en"), pa.scalar(0), pa.scalar(k)), rows).to_pylist()]
    assert {(r["source"], r["item"]): r["value"] for r in got} == want and len(got) == len(want)


def test_machine_scores_are_the_pairs_sum():
    rng = np.random.default_rng(2)
    size = quality.WORDS + len(quality.STATISTICS) * quality.BINS
    m = quality.Machine(0.3, rng.normal(0, 1, size), rng.normal(0, 1, (size, 3)), np.sort(rng.normal(0, 1, (len(quality.STATISTICS), quality.BINS - 1)), axis=1))
    found = [quality.features(t, n) for t, n in ((b"", None), (b"a few words, a few", 5), ("Ünd Über\nmehr".encode(), 0))]
    for one, score in zip(found, m.score(found)):
        idx, val = m.row(*one)
        margin = 0.3 + sum(m.w[i] * x for i, x in zip(idx, val))
        margin += sum(float(m.v[idx[a]] @ m.v[idx[b]]) * val[a] * val[b] for a in range(len(idx)) for b in range(a))
        assert abs(score - 1 / (1 + np.exp(-margin))) < 1e-9


def test_features_take_whole_texts(monkeypatch):
    text = b"\n".join(b"Line %d of MANY, many!! words" % k for k in range(300))
    whole = quality.features(text, 3)
    monkeypatch.setattr(quality, "CHUNK", 50)
    parts = quality.features(text, 3)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts)) and b"".join(quality.pieces(text)) == text
    assert b"".join(quality.pieces(b"x" * 400 + b" y")) == b"x" * 400 + b" y"


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = quality.op12_quality_scores(spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    out = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for y, s, _ in out if y == 1], [s for y, s, _ in out if y == 0]
    assert len(bad) > 5 and np.mean([[a > b for b in bad] for a in good]) > 0.98 and np.mean([y == p for y, _, p in out]) > 0.95


def test_quality_without_labels_or_with_one(spark, odd):
    none = spark.createDataFrame([], "doc_id long, label int")
    one = spark.createDataFrame([(1, 1), (2, 1), (4, 1), (4, 0), (None, 0), (5, None), (6, 7)], "doc_id long, label int")
    for labels, share in ((none, 0.5), (one, 0.75)):
        got = quality.classify(odd.withColumn("score", F.lit("clash")), quality.fit(odd, labels)).collect()
        assert len(got) == odd.count() and all(abs(r.score - share) < 1e-9 for r in got)
    assert quality.classify(odd.drop("n_chars"), quality.fit(odd, one)).count() == odd.count()
    # repeated runs agree
    fit = lambda: quality.fit(odd, spark.createDataFrame([(1, 1), (2, 0), (4, 1), (5, 0)], "doc_id long, label int"), steps=20)
    assert np.array_equal(fit().v, fit().v)
