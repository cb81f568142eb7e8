"""Operator 4: language-model scores from a probabilistic suffix tree over words."""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucketed, table, written

#: What stands for the end of a text among the words: no word holds white space.
END = b"\n"
#: Words of a piece (a row of whole texts) and, about, of a bucket (a group of counts): bounds on a task's memory.
PIECE = 1_500_000
#: The followers of a context seen oftener spread over buckets, about so many to each.
HEAP = 1_000_000
#: Stands among a spread context's followers in each of its buckets, and brings its whole count there.
WHOLE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Steps of a gain for a nat: whole numbers, whose sum doesn't depend on how followers are spread.
UNIT = 1 << 20
HIGH = np.uint64(32)
#: Steps of a parent's log probability, for a nat, as it goes to the test.
STEPS = 1024.0
#: Bytes of texts whose words are cut at once.
SLICE = 1 << 22

PIECES = "piece long, doc_id array<long>, train array<boolean>, sizes array<int>, keys binary, words binary, learnt long, total long"
ASKS = "level int, bucket int, piece long, states binary, fans binary, words binary, parents binary, own binary"
ANSWERS = "level int, bucket int, piece long, counts binary, stays binary, known long, top long"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts with A-Z lower-cased, and how many each text has. bytes.lower and Arrow's ascii_split_whitespace know ASCII only, as wanted."""
    # not by ascii_lower, which gives zero bytes where an array's first offset isn't 0, as after a slice's cast
    lower = pa.array([(t or b"").lower() for t in texts.cast(pa.large_binary()).to_pylist()], pa.large_binary())
    lists = pc.ascii_split_whitespace(lower.view(pa.large_string()))
    words, cuts = lists.flatten(), np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
    # white space at a text's ends leaves empty words
    real = pc.greater(pc.binary_length(words), 0)
    before = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    return words.filter(real), np.diff(before[cuts])


def slices(texts: pa.Array):
    """Where slices of about SLICE bytes begin and end."""
    at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // SLICE
    cuts = firsts(at)
    return zip(cuts.tolist(), np.append(cuts[1:], len(at)).tolist())


def shut(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, 1, 2, 4 or 8 for each as the largest asks: all lowest bytes first, then all second ones and so on, compressed."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    width = next(w for w in (1, 2, 4, 8) if not len(values) or int(values.max()) >> 8 * w == 0)
    flat = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    flat = np.stack([flat[:, k] for k in range(width)]).tobytes()
    return (len(values) << 4 | width).to_bytes(8, "little") + pa.compress(flat, "zstd", asbytes=True)


def opened(data: bytes) -> np.ndarray:
    head = int.from_bytes(data[:8], "little")
    n, width = head >> 4, head & 15
    flat = pa.decompress(data[8:], width * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(width, n).T).reshape(-1).view(f"<u{width}").astype(np.uint64)


def order_of(*columns: np.ndarray) -> np.ndarray:
    """Places of the rows in the columns' order, the first column foremost, equal rows as they come.

    What np.lexsort gives of the columns turned round, but by sorting whole numbers that carry their place in the
    lowest bits: plain sorts of 64-bit numbers take a fraction of the time. Columns are joined where their bits fit.
    """
    n = len(columns[0])
    place, bits = np.arange(n, dtype=np.uint64), n.bit_length()
    parts: list[tuple[np.ndarray, int]] = []
    for c in reversed(columns):
        top = int(c.max()).bit_length() if n else 0
        if parts and top + parts[-1][1] <= 64 - bits:
            low, size = parts.pop()
            parts.append((c.astype(np.uint64) << np.uint64(size) | low, top + size))
        elif top:
            parts.append((c.astype(np.uint64), top))
    order = place
    for c, top in parts:  # the hindmost first
        for low in range(0, top, 64 - bits):
            # a shift to the left drops what is above this pass's bits
            keyed = ((c if order is place else c[order]) >> np.uint64(low)) << np.uint64(bits) | place
            keyed.sort()
            keyed &= np.uint64((1 << bits) - 1)
            order = keyed if order is place else order[keyed]
    return order.view(np.int64)


def grouped(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """order_of, and where in it runs of equal rows begin."""
    order = order_of(*columns)
    return order, firsts(*(c[order] for c in columns))


def spread_out(values: np.ndarray, order: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each row, the value of its run."""
    out = np.empty(len(order), values.dtype)
    out[order] = np.repeat(values, np.diff(np.append(begin, len(order))))
    return out


def firsts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    n = len(columns[0])
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])) if n else np.zeros(0, np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(27)


def bucket_of(state: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(state) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def strength(n: np.ndarray, spread: float) -> np.ndarray:
    """How many draws the parent's prediction counts for in a state seen n times: about as many as it has distinct followers."""
    return np.maximum(n, 1.0) ** spread


def in_pieces(docs: DataFrame, most: int) -> DataFrame:
    """Rows of whole texts, about `most` words each: doc_ids, hashes of their distinct words and, for each place, the word's number."""

    def deal(batches):
        ids, train, sizes, taken = [], [], [], []

        def row():
            words = pa.chunked_array(taken, pa.large_string()).combine_chunks().dictionary_encode()
            # the bytes of all distinct words, cut here: a Python value for each by Arrow takes longer than numbering them
            _, cuts, data = words.dictionary.buffers()
            cuts = np.frombuffer(cuts, np.int64)[: len(words.dictionary) + 1].tolist() if len(words.dictionary) else []
            data = data.to_pybytes() if cuts else b""
            number = [*(data[a:b] for a, b in zip(cuts, cuts[1:])), END]
            # each text's words, then the end
            at = np.ones(sum(sizes), bool)
            at[np.cumsum(sizes) - 1] = False
            flat = np.full(len(at), len(number) - 1, np.int64)
            flat[at], words = words.indices.to_numpy(), flat
            often = np.argsort(-np.bincount(words, minlength=len(number)), kind="stable")
            place = np.empty(len(often), np.int64)
            place[often] = np.arange(len(often))
            keys = np.fromiter(map(xxhash.xxh3_64_intdigest, number), dtype=np.uint64, count=len(number))[often]
            learnt = sum(n for n, t in zip(sizes, train) if t)
            values = [uuid.uuid4().int >> 65, ids, train, sizes, shut(keys), shut(place[words]), learnt, len(words)]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            names = ["piece", "doc_id", "train", "sizes", "keys", "words", "learnt", "total"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        total = 0
        for batch in batches:
            for lo, hi in slices(batch["text"]):
                words, counts = words_of(batch["text"][lo:hi])
                begin = end = 0
                for doc_id, own, n in zip(batch["doc_id"][lo:hi].to_pylist(), batch["train"][lo:hi].to_pylist(), counts.tolist()):
                    ids.append(doc_id), train.append(own), sizes.append(n + 1)
                    total, end = total + n + 1, end + n
                    if total >= most:
                        taken.append(words[begin:end])
                        yield row()
                        total, ids, train, sizes, taken, begin = 0, [], [], [], [], end
                taken.append(words[begin:])
        if sizes:
            yield row()

    return docs.select("doc_id", "train", "text").mapInArrow(deal, PIECES)


class Model(NamedTuple):
    """What all tasks share: buckets, training tokens, distinct ones, score's parameters (sure: infinite for none), and whether two words' numbers fit one of 64 bits."""

    buckets: int
    n: int = 0
    v: int = 0
    least: float = 3.0
    spread: float = 0.85
    sure: float = np.inf
    heap: int = HEAP
    paired: bool = True


class Piece:
    """A piece, and what the answers known so far say of it.

    For each place there are the probability p of its word after the longest state known by then, and the number
    of the longest context that ends with it and is still asked for: first a word, then a pair and so on.
    Contexts are numbered by the piece, as their keys ascend: what is small sorts fast. Each number has a key and a count.
    """

    def __init__(self, row: pa.Table, answers: pa.Table | None, model: Model):
        self.model, self.number = model, row["piece"][0].as_py()
        self.doc_id, self.train = row["doc_id"][0].values, np.asarray(row["train"][0].as_py(), dtype=bool)
        self.sizes = np.array(row["sizes"][0].as_py(), dtype=np.int64)
        self.keys, self.words = opened(row["keys"][0].as_py()), opened(row["words"][0].as_py()).astype(np.int64)
        self.learnt = np.repeat(self.train, self.sizes)
        self.within = np.arange(len(self.words)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.answers = {}
        for a in answers.to_pylist() if answers is not None else []:
            self.answers[a["level"], a["bucket"]] = opened(a["counts"]), opened(a["stays"])

    @staticmethod
    def dealt(bucket: np.ndarray):
        """Buckets and the places of the entries that each gets."""
        order, cuts = grouped(bucket)
        for lo, hi in zip(cuts, np.append(cuts[1:], len(order))):
            yield int(bucket[order[lo]]), order[lo:hi]

    def start(self) -> None:
        """The words' numbers, that all pieces share, and counts, from the answers of level 0."""
        ids, seen = np.zeros(len(self.keys), np.uint64), np.zeros(len(self.keys), np.int64)
        order = order_of(self.keys)
        for bucket, own in self.dealt(bucket_of(self.keys[order], self.model.buckets)):
            seen[order[own]], ids[order[own]] = self.answers[0, bucket]
        order, number = order_of(ids), np.empty(len(ids), np.int64)
        number[order] = np.arange(len(ids))
        self.words = self.own = number[self.words]
        self.ids = self.key = ids[order]
        self.seen = self.count = seen[order]
        self.root = (self.seen + 0.5) / (self.model.n + 0.5 * (self.model.v + 1))
        self.p, self.bits = self.root[self.words], np.uint64(len(ids).bit_length())

    def extend(self, level: int) -> None:
        """The distinct entries of a level: a context of so many words, seen twice at least (no other passes the test), and the word after it."""
        real = (self.count >= 2)[self.own[:-1]] & (self.within[1:] >= level)
        self.at = at = np.flatnonzero(real) + 1
        entries = self.own[:-1][real].astype(np.uint64) << self.bits | self.words[1:][real].astype(np.uint64)
        order, begin = grouped(entries)
        self.inverse = spread_out(np.arange(len(begin)), order, begin)
        first = at[order[begin]]
        context, self.parent = self.own[first - 1], self.p[first]
        self.state, self.total, self.word = self.key[context], self.count[context], self.ids[self.words[first]]
        subs = (self.total // self.model.heap + 1).astype(np.uint64)
        spot = np.where(subs > 1, self.state ^ mix(mix(self.word) % subs + np.uint64(1)), self.state)
        self.bucket = bucket_of(spot, self.model.buckets)
        # a spread context asks each of its buckets, as its test is on all followers
        at = firsts(self.state)
        at = at[subs[at] > 1]
        spots = [np.unique(bucket_of(self.state[k] ^ mix(np.arange(1, int(subs[k]) + 1, dtype=np.uint64)), self.model.buckets)) for k in at]
        self.real, self.of = len(self.word), np.repeat(at, [len(b) for b in spots])
        self.bucket = np.concatenate([self.bucket, *spots])
        self.state, self.total = np.append(self.state, self.state[self.of]), np.append(self.total, self.total[self.of])
        self.word = np.append(self.word, np.full(len(self.of), WHOLE))

    def ask(self, level: int) -> pa.Table:
        own = np.bincount(self.inverse[self.learnt[self.at]], minlength=len(self.word))
        parents = np.append(np.rint(-np.log(self.parent) * STEPS), self.total[self.real :]).astype(np.uint64)
        return self.rows(level, self.bucket, self.state, self.word, parents, own)

    def rows(self, level: int, bucket, state, word, parents, own) -> pa.Table:
        rows, (order, cuts) = [], grouped(bucket)
        bucket, state, *columns = (c[order] for c in (bucket, state, word, parents, own))
        for lo, hi in zip(cuts, np.append(cuts[1:], len(order))):
            at = firsts(state[lo:hi])
            rows.append((level, int(bucket[lo]), self.number, shut(np.diff(state[lo:hi][at], prepend=np.uint64(0))), shut(np.diff(np.append(at, hi - lo))), *(shut(c[lo:hi]) for c in columns)))
        types = [pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * 5
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["level", "bucket", "piece", "states", "fans", "words", "parents", "own"])

    def hear(self, level: int, last: int | None = None) -> None:
        """Takes a level's answers: p where a state stays, key and count of the contexts one word longer, unless it is the last level."""
        counts, stays = np.zeros(len(self.word), np.int64), np.zeros(len(self.word), np.uint64)
        for bucket, own in self.dealt(self.bucket):
            c, kept = self.answers[level, bucket]
            fans = np.diff(np.append(firsts(self.state[own]), len(own)))
            counts[own], stays[own] = c, np.repeat(kept, fans)
        parts, stays = stays[self.real :], stays > 0
        if len(parts):
            begin = firsts(self.of)
            gains = np.add.reduceat((parts >> np.uint64(2)).astype(np.int64) * np.where(parts & np.uint64(2), -1, 1), begin)
            kept = (gains >= self.model.least * UNIT) & (np.bitwise_or.reduceat(parts & np.uint64(1), begin) > 0)
            spread = self.of[begin]
            place = np.searchsorted(spread, firsts(self.state[: self.real]))
            runs = np.diff(np.append(firsts(self.state[: self.real]), self.real))
            hit = np.isin(firsts(self.state[: self.real]), spread)
            whole = np.where(hit, kept[np.minimum(place, len(spread) - 1)], stays[firsts(self.state[: self.real])])
            stays[: self.real] = np.repeat(whole, runs)
        stays |= self.total >= self.model.sure
        p, e = self.parent, np.flatnonzero(stays[: self.real])
        weight = strength(self.total[e], self.model.spread)
        p[e] = (counts[e] + weight * p[e]) / (self.total[e] + weight)
        here = stays[self.inverse]
        self.p[self.at[here]] = p[self.inverse[here]]
        if level == last:
            return
        # a pair's key is its two numbers where they fit, other contexts' keys are hashes of 64 bits
        state, word, counts, number = self.state[: self.real], self.word[: self.real], counts[: self.real], self.inverse
        if level == 1 and self.model.paired:
            key = state << HIGH | word  # ascends as the entries do
        else:
            key = mix(mix(state) + word)
            order, rank = order_of(key), np.empty(len(key), np.int64)
            rank[order] = np.arange(len(key))
            key, counts, number = key[order], counts[order], rank[number]
        # the last number is that of places without such a context
        self.key, self.count = np.append(key, np.uint64(0)), np.append(counts, 0)
        self.own = np.full(len(self.words), len(key))
        self.own[self.at] = number


def reply(model: Model):
    """The task that counts a bucket: sums what pieces ask of, and says which states the tree keeps.

    At level 0 it numbers the words instead, frequent ones low, so that all pieces call a word alike.
    A state stays if its next-word distribution diverges from its parent's, that of the longest state among its suffixes: the gain in log likelihood
    of its own followers, each predicted without itself, is at least `least` nats, and one came twice. Of a spread context the bucket
    answers its followers' part of the gain instead, which the pieces sum: four times its size, plus 2 if it is below zero, plus 1 if a follower came twice.
    """

    def answer(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        level, bucket = rows[0]["level"], rows[0]["bucket"]
        states, fans = [np.cumsum(opened(r["states"])) for r in rows], [opened(r["fans"]).astype(np.int64) for r in rows]
        distinct = np.concatenate(states)
        order, begin = grouped(distinct)
        state = np.repeat(spread_out(np.arange(len(begin)), order, begin), np.concatenate(fans))
        word, parent, own = (np.concatenate([opened(r[k]) for r in rows]) for k in ("words", "parents", "own"))
        order, first = grouped(state, word)
        c = np.add.reduceat(own[order].astype(np.int64), first)
        pair = spread_out(np.arange(len(first)), order, first)
        by = firsts(state[order][first])
        at = np.repeat(np.arange(len(by)), np.diff(np.append(by, len(first))))
        known = top = 0
        if level == 0:
            rank = np.empty(len(c), np.int64)
            rank[np.argsort(-c, kind="stable")] = np.arange(len(c))
            stays, known = rank * model.buckets + bucket, int((c > 0).sum())
            top = int(stays.max())
        else:
            whole, brought = word[order][first] == WHOLE, parent[order][first]
            p = np.where(whole, 1.0, np.exp(-brought.astype(np.float64) / STEPS))
            n = np.add.reduceat(c, by)
            n[at[whole]] = brought[whole].astype(np.int64)
            weight = strength(n, model.spread)
            without = np.where(c > 0, (c - 1 + weight[at] * p) / (n[at] - 1 + weight[at]), p)
            gain = np.add.reduceat(np.rint(c * np.log(without / p) * UNIT).astype(np.int64), by)
            twice = np.maximum.reduceat(c, by) >= 2
            stays = ((gain >= model.least * UNIT) & twice).astype(np.int64)
            spread = at[whole]
            stays[spread] = np.abs(gain[spread]) * 4 + (gain[spread] < 0) * 2 + twice[spread]
        out, lo = [], 0
        for k, r in enumerate(rows):
            hi = lo + int(fans[k].sum())
            mine = at[pair[lo:hi][np.cumsum(fans[k]) - fans[k]]]
            out.append((level, bucket, r["piece"], shut(c[pair[lo:hi]]), shut(stays[mine]), 0 if k else known, top))
            lo = hi
        types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.table([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], ["level", "bucket", "piece", "counts", "stays", "known", "top"])

    return answer


def score(docs: DataFrame, train, depth: int = 2, least: float = 3.0, spread: float = 0.85, sure: int | None = None, piece_words: int = PIECE, numbers: int = 1 << 32, heap: int = HEAP) -> DataFrame:
    """Scores docs (doc_id, text) by what the rows where `train` holds teach.

    Symbols are words and the end. The root predicts by add-half counts, with one class for words not
    seen. Every context of 1 to `depth` words may be a state; whether it is, the divergence test says
    (reply), at any size; only a caller that gives `sure` takes contexts seen so many times for states untested. A state seen n times predicts (c + a * p) / (n + a): p is its parent's prediction, that of the longest state among
    its suffixes, and a = n ** spread; the longest state that fits speaks, so each distribution sums to one.

    Returns doc_id, held_out (not train), n_tokens, n_known, train_tokens, base_score, score. Null
    texts are empty: the end alone. A null train is held out. Rows alike are scored each. Without
    training rows the counts are 0; an empty table gives no rows. Other columns are left out.

    Texts are written once as pieces of about `piece_words` words. For each level pieces ask buckets, of about as
    many words, for counts: of their distinct words, then of the words after their contexts of one word and so on. Both sides pre-aggregate;
    the followers of contexts seen `heap` times or more spread over buckets by word, so no bucket grows with
    a frequent word; their parts of the gain are whole numbers, whose sum is the same however they are spread. Pieces stay where
    they are, dealt by number when written; only asks and answers are shuffled. A piece has a row for a bucket only where it asks, so there are never more rows than distinct n-grams in the pieces. Pairs of words go by their two numbers while these
    stay below `numbers`, beyond it by hashes of 64 bits, as longer contexts do at any size.
    """
    own = F.coalesce(train, F.lit(False)).alias("train")
    pieces = bucketed(in_pieces(docs.select(F.col("doc_id").cast("long").alias("doc_id"), own, F.col("text").cast("string").alias("text")), piece_words), "pieces", "piece")
    n, total = (int(x or 0) for x in pieces.agg(F.sum("learnt"), F.sum("total")).first())
    model = Model(total // piece_words + 1, n, 0, least, spread, np.inf if sure is None else sure, heap)

    def ask_words(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                p = Piece(pa.Table.from_batches([batch.slice(k, 1)]), None, model)
                number, order = np.empty(len(p.keys), np.int64), order_of(p.keys)
                number[order] = np.arange(len(order))
                keys, none = p.keys[order], np.zeros(len(order), np.uint64)
                own = np.bincount(number[p.words][p.learnt], minlength=len(keys))
                yield from p.rows(0, bucket_of(keys, model.buckets), keys, none, none, own).to_batches()

    def counted(asks: DataFrame) -> DataFrame:
        return written(asks.groupBy("bucket").applyInArrow(reply(model), ANSWERS), "answers")

    def told(answers: DataFrame, ask, schema: str) -> DataFrame:
        return pieces.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(ask, schema)

    answers = counted(pieces.mapInArrow(ask_words, ASKS))
    known, top = answers.agg(F.sum("known"), F.max("top")).first()
    model = model._replace(v=int(known or 0), paired=(top or 0) < min(numbers, 1 << 32))

    def heard(left: pa.Table, right: pa.Table, levels: int, model: Model) -> Piece:
        p = Piece(left, right, model)
        p.start()
        for k in range(1, levels + 1):
            p.extend(k)
            p.hear(k, last=depth)
        return p

    def asker(level: int, model: Model):
        def ask(left: pa.Table, right: pa.Table) -> pa.Table:
            p = heard(left, right, level - 1, model)
            p.extend(level)
            return p.ask(level)

        return ask

    for level in range(1, depth + 1):
        answers = answers.union(counted(told(answers, asker(level, model), ASKS)))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        p = heard(left, right, depth, model)
        start = np.cumsum(p.sizes) - p.sizes
        whole = lambda x: np.add.reduceat(x, start)
        out = {
            "doc_id": p.doc_id,
            "held_out": pa.array(~p.train),
            "n_tokens": pa.array(p.sizes),
            "n_known": pa.array(whole((p.seen > 0).astype(np.int64)[p.words])),
            "train_tokens": pa.array(np.full(len(start), n, np.int64)),
            "base_score": pa.array(whole(np.log10(p.root)[p.words])),
            "score": pa.array(whole(np.log10(p.p))),
        }
        return pa.table(out)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return told(answers, run, schema)


def op4_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1)
