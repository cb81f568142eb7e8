"""Operator 12: quality scores by a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Buckets of hashed words; a document has at most so many word features, however long it is.
WORDS = 1 << 14
#: Bins of a statistic: each is one feature of its own.
BINS = 12
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes of a text that are taken apart at a time, up to the next space or line's end.
CHUNK = 1 << 20
#: Word features that are scored at a time, but for a longer document's own.
HELD = 1 << 17
STATISTICS = ("n_chars", "bytes", "words", "word_length", "distinct", "top_word", "upper", "digit", "mark", "symbol", "beyond_ascii", "lines", "line_words", "distinct_lines", "marked_words", "caps_words", "twice_marked")


def pieces(text: bytes):
    """The text in parts of about CHUNK bytes that end at a line's end or, within long lines, at a space."""
    at = 0
    while at < len(text):
        end = -1
        if len(text) - at > CHUNK:
            end = text.rfind(b"\n", at, at + CHUNK) + 1 or text.rfind(b" ", at, at + CHUNK) + 1 or text.find(b" ", at + CHUNK) + 1
        end = end if end > at else len(text)
        yield text[at:end]
        at = end


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A whole text's word buckets, their weights (of length 1 in all) and its statistics."""
    counts, lines, marked, caps, twice = Counter(), Counter(), 0, 0, 0
    for part in pieces(text):
        words = part.split()
        marked += sum(w[-1] < 48 for w in words)
        caps += sum(w.isupper() for w in words)
        twice += sum(w[-2:].translate(None, b"!#$%&*+=^~|<>@\\/_") == b"" for w in words)
        counts.update(part.translate(LOWER).split())
        lines.update(x for x in part.split(b"\n") if x)
    kind = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    seen = max(1, len(text))
    n, n_lines = sum(counts.values()), sum(lines.values())
    stats = [
        -1.0 if n_chars is None else np.log1p(max(0, n_chars)), np.log1p(len(text)), np.log1p(n), (len(text) - n) / max(1, n),
        len(counts) / max(1, n), max(counts.values(), default=0) / max(1, n),
        kind[65:91].sum() / seen, kind[48:58].sum() / seen, kind[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum() / seen,
        kind[[35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 92, 94, 95, 124, 126]].sum() / seen, kind[128:].sum() / seen,
        np.log1p(n_lines), n / max(1, n_lines), len(lines) / max(1, n_lines), marked / max(1, n), caps / max(1, n), twice / max(1, n),
    ]
    if not counts:
        return np.zeros(0, np.uint16), np.zeros(0, np.float32), np.array(stats, np.float32)
    buckets = np.fromiter((zlib.crc32(w) for w in counts), np.uint32, len(counts)) % WORDS
    weight = np.bincount(buckets, np.log1p(np.fromiter(counts.values(), np.float64, len(counts))), minlength=WORDS)
    at = np.flatnonzero(weight)
    weight = weight[at]
    return at.astype(np.uint16), (weight / np.linalg.norm(weight)).astype(np.float32), np.array(stats, np.float32)


class Machine:
    """score = sigmoid(bias + sum of w_i x_i + sum over pairs i < j of <v_i, v_j> x_i x_j).

    Features are the word buckets and, after them, BINS for each statistic; edges are the statistics' bins.
    """

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray, edges: np.ndarray):
        self.bias, self.w, self.v, self.edges = bias, w, v, edges

    def row(self, words, weights, stats):
        """(features, values) of a document: its words and the bin of each statistic."""
        bins = WORDS + np.arange(len(stats)) * BINS + (self.edges <= stats[:, None]).sum(1)
        return np.concatenate((words.astype(np.int64), bins)), np.concatenate((weights, np.full(len(bins), 1 / np.sqrt(len(bins)))))

    @staticmethod
    def joined(rows):
        """(features, values, first) of several documents one after the other; every document has its bins at least."""
        first = np.cumsum([0, *(len(x) for x, _ in rows[:-1])])
        return np.concatenate([x for x, _ in rows]), np.concatenate([y for _, y in rows]), first

    def margin(self, idx, val, first):
        """Before the sigmoid, in time linear in the features: the pairs' sum is half of (sum of v x)^2 - sum of (v x)^2."""
        vx = self.v[idx] * val[:, None]
        total = np.add.reduceat(vx, first, axis=0)
        return self.bias + np.add.reduceat(self.w[idx] * val, first) + 0.5 * (total**2 - np.add.reduceat(vx**2, first, axis=0)).sum(1), total

    def score(self, found) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(*self.joined([self.row(*x) for x in found]))[0], -30, 30)))


def train(found: list, labels: np.ndarray, rank: int = 8, steps: int = 900, rate: float = 0.05, decay: float = 1e-4, batch: int = 64, seed: int = 7) -> Machine:
    """Fits by AdaGrad on the logistic loss, both labels weighing alike. Without rows, or with one label only, the score is the labels' smoothed share."""
    rng = np.random.default_rng(seed)
    size = WORDS + len(STATISTICS) * BINS
    share = (labels.sum() + 1) / (len(labels) + 2)
    edges = np.zeros((len(STATISTICS), BINS - 1))
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, rank)), edges)
    if not 0 < labels.sum() < len(labels):
        return machine
    stats = np.stack([s for _, _, s in found])
    machine.edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.copy()
    machine.v = rng.normal(0, 0.05, (size, rank))
    squares_w, squares_v = np.full(size, 1e-6), np.full((size, rank), 1e-6)
    rows = [machine.row(*x) for x in found]
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    machine.bias = 0.0
    for _ in range(-(-steps * batch // len(found))):
        order = rng.permutation(len(found))
        for lo in range(0, len(order), batch):
            own = order[lo : lo + batch]
            idx, val, first = machine.joined([rows[i] for i in own])
            margin, total = machine.margin(idx, val, first)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[own]) * weight[own] / len(own)
            each = np.repeat(np.arange(len(own)), np.diff(np.append(first, len(idx))))
            push = slope[each] * val
            at, place = np.unique(idx, return_inverse=True)
            pull = push[:, None] * (total[each] - machine.v[idx] * val[:, None])
            dw = np.bincount(place, push) + decay * machine.w[at]
            dv = np.stack([np.bincount(place, pull[:, r]) for r in range(rank)], axis=1) + decay * machine.v[at]
            squares_w[at] += dw**2
            squares_v[at] += dv**2
            machine.w[at] -= rate * dw / np.sqrt(squares_w[at])
            machine.v[at] -= rate * dv / np.sqrt(squares_v[at])
            machine.bias -= rate * slope.sum()
    return machine


def extracted(batches):
    """(id, label, words, weights, stats) from batches of (id, label, text, n_chars)."""
    for batch in batches:
        rows = [features(t.as_py() or b"", n.as_py()) for t, n in zip(batch.column(2).cast(pa.binary()), batch.column(3))]
        columns = [pa.array([r[k].astype(kind).tobytes() for r in rows], pa.binary()) for k, kind in enumerate(("<u2", "<f4", "<f4"))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "label", "words", "weights", "stats"])


def fit(docs: DataFrame, labels: DataFrame, bound: int = 3000, seed: int = 7, **options) -> Machine:
    """Fits on docs (doc_id, text, n_chars) that labels (doc_id, label 0 or 1) mark: a sample of about `bound` ids.

    The sample is drawn by hashed doc_id, so reruns agree. Ids whose labels disagree, null ids and labels other than 0
    and 1 teach nothing; of rows with one id, one teaches. Null texts teach as empty ones.
    """
    marked = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"), F.max("label").alias("other")).where("label = other")
    n = marked.count()
    mark = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 1).cast("double") / float(1 << 63)
    drawn = marked.where(mark < bound / max(1, n)).select(F.col("doc_id").alias("_id"), "label")
    # about `bound` rows of two numbers, whatever the tables' size
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("n_chars").cast("long").alias("n_chars")).join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    seen = rows.select("doc_id", "label", "text", "n_chars").mapInArrow(extracted, f"doc_id {kind}, label int, words binary, weights binary, stats binary")
    one = seen.groupBy("doc_id").agg(F.min(F.struct("words", "weights", "stats", "label")).alias("r")).select("r.*").collect()
    one = sorted(one, key=lambda r: (bytes(r.words), bytes(r.weights), bytes(r.stats), r.label))
    found = [(np.frombuffer(r.words, "<u2"), np.frombuffer(r.weights, "<f4"), np.frombuffer(r.stats, "<f4")) for r in one]
    return train(found, np.array([r.label for r in one], dtype=float), seed=seed, **options)


def classify(docs: DataFrame, machine: Machine) -> DataFrame:
    """Scores each row's whole text: docs' columns and score (0 to 1, null texts as empty ones).

    Only text and n_chars (null where docs has none) are read. Columns named score, _text or _n_chars are left out; one row per row.
    """
    kept = [c for c in docs.columns if c not in ("score", "_text", "_n_chars")]

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            found, scores, held = [], [], 0
            for text, n in zip(t["_text"].cast(pa.binary()), t["_n_chars"]):
                found.append(features(text.as_py() or b"", n.as_py()))
                held += len(found[-1][0])
                if held > HELD:
                    scores.append(machine.score(found))
                    found, held = [], 0
            if found:
                scores.append(machine.score(found))
            out = t.drop_columns(["_text", "_n_chars"])
            yield from out.append_column("score", pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())).to_batches()

    n_chars = F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)
    rows = docs.select(*kept, F.col("text").cast("string").alias("_text"), n_chars.cast("long").alias("_n_chars"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return rows.mapInArrow(run, f"{fields}, score double")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op12_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars", held_out().alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("quality").alias("label"))
    scored = classify(docs, fit(docs.where("not held_out"), labels))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
