"""Operator 8: language identification by nearest centroids of TF-IDF n-gram vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import releasing, table

LETTER = regex.compile(r"\p{L}")
#: Bytes that aren't part of letters (ASCII but for a-z) count as a word's border.
BORDER = bytes(c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))
#: Coordinates of a vector.
DIM = 4096
#: Documents after which a batch of vectors is scored.
BLOCK = 512


def grams(text: str, dim: int) -> np.ndarray:
    """Hashed counts of a text's byte bigrams and trigrams, lower-cased."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(BORDER) + b" ", dtype=np.uint8)
    b = b[(b != 32) | np.concatenate(([True], b[:-1] != 32))].astype(np.uint32)
    two = (b[:-1] << 8) + b[1:]
    three = (two[:-1] << 8) + b[2:] if len(b) > 2 else two[:0]
    mixed = np.concatenate((two, three)) * np.uint32(2654435761) >> np.uint32(16)
    return np.bincount(mixed % dim, minlength=dim).astype(np.float32)


def normalised(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def clustered(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of spherical k-means."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        c = np.stack([x[near == j].sum(0) if (near == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


class Model:
    """langs[j]: the language of centroid j; floor: by language, the cosine below which a text is rejected. Without centroids all is rejected as und."""

    def __init__(self, idf, centroids, langs, floor):
        self.idf, self.centroids, self.langs, self.floor = idf, centroids, langs, floor

    def predict(self, counts: np.ndarray):
        if not self.langs:
            return ["und"] * len(counts), np.zeros(len(counts)), [True] * len(counts)
        near = normalised(counts, self.idf) @ self.centroids.T
        best = near.argmax(1)
        score = np.clip(near[np.arange(len(best)), best].astype(float), 0, 1)
        langs = [self.langs[j] for j in best]
        return langs, score, [bool(s < self.floor[x]) for s, x in zip(score, langs)]


def fit(labelled: DataFrame, bound: int = 1200, clusters: int = 3, dim: int = DIM, seed: int = 11, slack: float = 0.5) -> Model:
    """Fits centroids on labelled (doc_id, text, lang): at most about `bound` rows, from each language alike as far as it has them, the first by hashed doc_id.

    Rows without text, letter or lang teach nothing. Each language has up to `clusters` centroids.
    Its rejection floor is `slack` times the smallest cosine of its training texts. With nothing to learn from,
    the model tells no language (see Model).
    """
    rows = labelled.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model(None, None, [], {})
    # languages with less than an even share leave the rest to the others
    share, left = {}, bound
    for k, lang in enumerate(sorted(sizes, key=lambda x: (sizes[x], x))):
        share[lang] = min(sizes[lang], left / (len(sizes) - k))
        left -= share[lang]
    rate = F.create_map(*(F.lit(x) for lang in sorted(sizes) for x in (lang, share[lang] / sizes[lang])))
    mark = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 1).cast("double") / float(1 << 63)

    def count(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            keep = [(x, g) for x, g in zip(t["lang"].to_pylist(), t["text"].to_pylist()) if LETTER.search(g)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in keep], pa.string()), pa.array([grams(g, dim).astype("<u4").tobytes() for _, g in keep], pa.binary())], ["lang", "counts"])

    sample = rows.where(mark < rate[F.col("lang")])
    got = sorted(sample.select("lang", "text").mapInArrow(count, "lang string, counts binary").toPandas().itertuples(index=False), key=lambda r: (r.lang, r.counts))
    if not got:
        return Model(None, None, [], {})
    counts = np.stack([np.frombuffer(r.counts, "<u4") for r in got]).astype(np.float32)
    langs = np.array([r.lang for r in got])
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
    x = normalised(counts, idf)
    centroids, names, floor = [], [], {}
    for lang in sorted(set(langs)):
        own = x[langs == lang]
        c = clustered(own, clusters, seed)
        centroids.append(c)
        names += [lang] * len(c)
        floor[lang] = slack * float((own @ c.T).max(1).min())
    return Model(idf, np.concatenate(centroids).astype(np.float32), names, floor)


def identify(docs: DataFrame, model: Model, dim: int = DIM) -> DataFrame:
    """Predicts each row's language from its whole text: docs' columns, lang_pred, score, rejected.

    Null texts and texts without a letter get und, score 0 and are rejected; a text whose best cosine
    is under its language's floor is rejected and keeps its best language. Of centroids equally near the first counts, in the order
    of their languages' names. One row per row, an empty table gives none; columns named like the results or _text are left out.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected", "_text")]

    def predict(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            texts = t["_text"]
            for lo in range(0, len(t), BLOCK):
                part = texts.slice(lo, BLOCK).to_pylist()
                has = [bool(x and LETTER.search(x)) for x in part]
                lang, score, rejected = ["und"] * len(part), [0.0] * len(part), [True] * len(part)
                if any(has):
                    found = zip(*model.predict(np.stack([grams(x, dim) for x, ok in zip(part, has) if ok])))
                    for k in (k for k, ok in enumerate(has) if ok):
                        lang[k], score[k], rejected[k] = next(found)
                out = t.slice(lo, BLOCK).drop_columns(["_text"])
                out = out.append_column("lang_pred", pa.array(lang, pa.string())).append_column("score", pa.array(score, pa.float64())).append_column("rejected", pa.array(rejected, pa.bool_()))
                yield from out.to_batches()

    rows = docs.select(*kept, F.col("text").cast("string").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return rows.mapInArrow(releasing(predict), f"{fields}, lang_pred string, score double, rejected boolean")


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(held_out(), F.lit(False))
    model = fit(docs.where(~out))
    return identify(docs.select("doc_id", out.alias("held_out"), "text"), model).drop("text")
