"""Operator 1: best-fit packing of token sequences through a configuration linear program."""

from __future__ import annotations

import bisect
import math
import os
import zlib
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import releasing, shuffle_partitions, table, written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Bytes of text whose words are encoded together: a bound on memory, not on results.
SLICE = 8 << 20
#: Cuts that the tokeniser gets as one text, and texts that it gets at once.
JOINED = 128
ENDS = ",.;:!?"
#: A cut that ends in a punctuation mark after a letter or digit (of the alphabets named).
ENDED = r"[0-9A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԯ][,.;:!?]\z"
#: A cut that is empty, ends with white space, or begins with it but for one space.
SPACES = r"\x09-\x0d\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BLANK = rf"^\z|^ ?[{SPACES}]|^  |[ {SPACES}]\z"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def gathered(store: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of store that begin at starts, one after the other."""
    return store[np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)]


def led(mark: str, texts: pa.Array) -> pa.Array:
    """texts, each after a mark."""
    return pc.binary_join_element_wise(pa.scalar(mark, texts.type), texts, pa.scalar("", texts.type))


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    A byte-level BPE never merges across a pre-token border, and there always is one before a lone
    space and around a lone line end between two other characters. So the texts are cut there, and each distinct cut is
    encoded once: cuts are joined by line ends, whose id then parts the ids. Texts with other white space beside a
    space or a line end or with special tokens are encoded whole; with line ends in a row, cut at spaces only.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line, *self.ends = self.whole(["\n", *ENDS])

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        batches = (texts[k : k + JOINED] for k in range(0, len(texts), JOINED))
        return [np.array(e.ids, dtype="<u4") for own in batches for e in self.tokenizer.encode_batch_fast(own, add_special_tokens=False)]

    def runs(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct cuts, which neither begin (but for one space) nor end with white space: store, starts and lengths of each in it."""
        apart = pc.match_substring(cuts, "\n").to_numpy(zero_copy_only=False) | (len(self.line) > 1)
        own = cuts.filter(pa.array(~apart))
        lists = pa.LargeListArray.from_arrays(pa.array([*range(0, len(own), JOINED), len(own)], pa.int64()), own)
        found = self.whole(pc.binary_join(lists, pa.scalar("\n", cuts.type)).to_pylist())
        store = np.concatenate([x for ids in found for x in (ids, self.line)]) if found else np.zeros(0, "<u4")
        ends = np.flatnonzero(store == self.line[0])
        rest = self.whole(cuts.filter(pa.array(apart)).to_pylist())
        starts, lengths = np.zeros(len(cuts), np.int64), np.zeros(len(cuts), np.int64)
        starts[~apart] = np.concatenate([[0], ends[:-1] + 1])[: len(own)]
        lengths[~apart] = ends - starts[~apart]
        lengths[apart] = [len(x) for x in rest]
        starts[apart] = len(store) + np.cumsum(lengths[apart]) - lengths[apart]
        return np.concatenate([store, *rest]), starts, lengths

    def words(self, marked: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct cuts, of which those that don't follow a space are marked by \\0: store, starts, lengths, and which can't be cut so."""
        cuts = pc.replace_substring(led(" ", marked), " \0", "")
        line = pc.equal(cuts, "\n")
        uncut = pc.and_not(pc.match_substring_regex(cuts, BLANK), line)
        # a letter or number and a punctuation mark never share a pre-token
        ended = pc.match_substring_regex(cuts, ENDED)
        mark = pc.index_in(pc.utf8_slice_codeunits(cuts, -1), pa.array([*ENDS], cuts.type)).to_numpy(zero_copy_only=False)
        stems = pc.if_else(pc.or_(uncut, line), pa.scalar(None, cuts.type), pc.if_else(ended, pc.utf8_slice_codeunits(cuts, 0, -1), cuts)).dictionary_encode()
        store, starts, lengths = self.runs(stems.dictionary)
        # after the stems' ids: none, a line end's and the marks'
        more = [self.line[:0], self.line, *self.ends]
        size = np.array([len(x) for x in more])
        starts, lengths = np.concatenate([starts, len(store) + np.cumsum(size) - size]), np.concatenate([lengths, size])
        n = len(stems.dictionary)
        line, ended = (x.to_numpy(zero_copy_only=False) for x in (line, ended))
        first = np.where(line, n + 1, pc.fill_null(stems.indices, n).to_numpy(zero_copy_only=False))
        both = np.stack([first, np.where(ended, n + 2 + np.nan_to_num(mark), n).astype(np.int64)], axis=1)
        store = gathered(np.concatenate([store, *more]), starts[both.ravel()], lengths[both.ravel()])
        lengths = lengths[both].sum(axis=1)
        return store, np.cumsum(lengths) - lengths, lengths, uncut.to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array):
        """Yields each text's ids."""
        texts = pc.fill_null(texts.cast(pa.large_string()), pa.scalar("", pa.large_string()))
        plain = pc.invert(pc.match_substring(texts, "\0"))
        for s in self.special:
            plain = pc.and_not(plain, pc.match_substring(texts, s))
        apart = texts if len(self.line) > 1 else pc.if_else(pc.match_substring(texts, "\n\n"), texts, pc.replace_substring(texts, "\n", " \0\n \0"))
        cuts = pc.split_pattern(led("\0", pc.if_else(plain, apart, pa.scalar("", apart.type))), " ")
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(cuts).to_numpy())])
        found = pc.list_flatten(cuts).dictionary_encode()
        del apart, cuts
        store, starts, lengths, uncut = self.words(found.dictionary)
        place = found.indices.to_numpy()
        whole = np.logical_or.reduceat(uncut[place], at[:-1])
        for k in range(0, len(texts), 256):
            own = at[k : k + 257]
            some = place[own[0] : own[-1]]
            ids = gathered(store, starts[some], lengths[some])
            ends = np.concatenate([[0], np.cumsum(lengths[some])])[own - own[0]]
            for i, (s, e) in enumerate(zip(ends, ends[1:]), k):
                yield ids[s:e].tobytes() if not whole[i] else self.whole([texts[i].as_py()])[0].tobytes()


def slices(texts: pa.Array):
    """Slices of at most SLICE bytes, or of one text."""
    share = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy()) // SLICE
    at = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(texts)]
    return [texts.slice(s, e - s) for s, e in zip(at, at[1:]) if e > s]


def pieces(docs: DataFrame, path: str | None = None, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Tokenises docs (doc_id, text; null text: empty) and cuts what is longer than capacity.

    Every text gives at least the end id. A text of more than capacity ids is cut into pieces of
    capacity ids; the first piece takes the remainder. With with_ids the ids come as an array.
    """
    path = path or tokenizer_path()

    def cut(batches):
        encoder, end = Encoder(path), np.uint32(end_id).astype("<u4").tobytes()
        for batch in batches:
            keys = iter(batch.column(0).to_pylist())
            for part in slices(batch.column(1)):
                rows = []
                for ids, key in zip(encoder.encode(part), keys):
                    ids += end
                    n = len(ids) // 4
                    at = [0, *range(n % capacity or capacity, n, capacity), n] if n > capacity else [0, n]
                    for k, (s, e) in enumerate(zip(at, at[1:])):
                        own = ids[4 * s : 4 * e]
                        rows.append((key, k, s, e - s, zlib.crc32(own), np.frombuffer(own, "<u4").astype(np.int64) if with_ids else None))
                cols = list(zip(*rows))
                arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:5])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(cols[5], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(releasing(cut, every=1), PIECES + ", ids array<long>" * with_ids)


def knapsack(weight: np.ndarray, capacity: int, slack: float = 0.01, most: int = 64) -> tuple[float, list[tuple[int, ...]]]:
    """Prices configurations, the multisets of lengths that fit capacity, by dynamic programming.

    weight[l]: what length l is worth, -inf where there is none. Returns the largest worth of a configuration, and
    of each length's best configuration those within `slack` of that worth, the best `most` of them.
    """
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    back = weight[1:]
    for c in range(1, capacity + 1):
        v = back[:c] + best[c - 1 :: -1][:c]
        k = int(v.argmax())
        if v[k] > best[c - 1]:
            best[c], choice[c] = v[k], k + 1
        else:
            best[c] = best[c - 1]

    def trace(c):
        while c > 0:
            if choice[c]:
                yield int(choice[c])
                c -= int(choice[c])
            else:
                c -= 1

    worth = np.where(np.isfinite(weight), weight + best[capacity - np.arange(capacity + 1)], -np.inf)
    near = [int(k) for k in np.argsort(-worth, kind="stable")[:most] if worth[k] >= (1 - slack) * best[capacity]]
    return float(best[capacity]), sorted({tuple(sorted((k, *trace(capacity - k)), reverse=True)) for k in near})


def best_fit(left: dict[int, int], capacity: int) -> dict[tuple[int, ...], int]:
    """Best-fit decreasing on counts: whole groups of like sequences take a piece each at a time."""
    spaces: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    order: list[int] = []
    done: dict[tuple[int, ...], int] = defaultdict(int)

    def put(items, n):
        space = capacity - sum(items)
        if not space:
            done[items] += n
            return
        if not spaces[space]:
            bisect.insort(order, space)
        spaces[space][items] = spaces[space].get(items, 0) + n

    for length in sorted(left, reverse=True):
        need = left[length]
        while need:
            k = bisect.bisect_left(order, length)
            if k == len(order):
                fit = capacity // length
                whole, rest = divmod(need, fit)
                if whole:
                    put((length,) * fit, whole)
                if rest:
                    put((length,) * rest, 1)
                break
            space = order[k]
            items, n = spaces[space].popitem()
            if not spaces[space]:
                order.pop(k)
            take = min(n, need)
            put((*items, length), take)
            if n > take:
                put(items, n - take)
            need -= take
    for group in spaces.values():
        for items, n in group.items():
            done[items] += n
    return dict(done)


class Program:
    """The configuration linear program: the fewest sequences (x, fractions allowed) whose configurations hold each length as often as it comes.

    Multiplicative weights on both sides: a length's price y grows by exp(rate * its lack), a configuration's share x by
    exp(rate * (its worth at the prices - 1)), each with the last step's gradient once more against the one before
    (optimistic steps). Lacks are shares of the lengths' counts, so rare and frequent lengths move alike. Both sides are
    averaged over a round; then the knapsack prices all configurations at the averaged prices, and those worth
    most join the program. Prices divided by the best worth are a dual solution, so they bound the fewest sequences from below.
    """

    def __init__(self, histogram: dict[int, int], capacity: int, start: dict[tuple[int, ...], int]):
        self.capacity = capacity
        self.lengths = np.array(sorted(histogram), dtype=np.int64)
        self.counts = np.array([histogram[k] for k in self.lengths.tolist()], dtype=np.float64)
        self.place = {k: i for i, k in enumerate(self.lengths.tolist())}
        self.columns: list[tuple[int, ...]] = []
        self.x, self.y, self.low = np.zeros(0), self.lengths / capacity, 0.0
        self.add(list(start), np.array([float(n) for n in start.values()]))

    def add(self, columns: list[tuple[int, ...]], x: np.ndarray) -> None:
        self.columns += columns
        self.x = np.concatenate((self.x, x))
        parts = [np.unique([self.place[k] for k in c], return_counts=True) for c in self.columns]
        sizes = np.array([len(p) for p, _ in parts])
        self.row, self.many = np.concatenate([p for p, _ in parts]), np.concatenate([n for _, n in parts]).astype(np.float64)
        self.first, self.column = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(parts)), sizes)

    def worth(self, y: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.many * y[self.row], self.first)

    def held(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.many * x[self.column], minlength=len(self.lengths))

    def step(self, steps: int, rate: float) -> None:
        x, y, sum_x, sum_y = self.x, self.y, np.zeros_like(self.x), np.zeros_like(self.y)
        last_x = last_y = None
        for _ in range(steps):
            gx, gy = self.worth(y) - 1, 1 - self.held(x) / self.counts
            ox, oy = (gx, gy) if last_x is None else (2 * gx - last_x, 2 * gy - last_y)
            x, y = x * np.exp(np.clip(rate * ox, -1, 1)), y * np.exp(np.clip(rate * oy, -1, 1))
            last_x, last_y = gx, gy
            sum_x += x
            sum_y += y
        self.x, self.y = sum_x / steps, sum_y / steps

    def solve(self, rounds: int, steps: int, rate: float, gap: float, keep: int) -> None:
        """At most `rounds` rounds; earlier where no configuration's worth exceeds 1 by more than gap and the sequences are within gap of the bound."""
        known = set(self.columns)
        for _ in range(rounds):
            self.step(steps, rate)
            weight = np.full(self.capacity + 1, -np.inf)
            weight[self.lengths] = self.y
            top, found = knapsack(weight, self.capacity)
            self.low = max(self.low, float(self.counts @ self.y) / max(top, 1e-12))
            if top <= 1 + gap and self.x.sum() <= (1 + gap) * self.low and self.held(self.x).min() >= 0:
                break
            if len(self.columns) > keep:
                own = np.sort(np.argsort(-self.x, kind="stable")[: keep // 2])
                self.columns, self.x = [self.columns[k] for k in own], self.x[own]
                known = set(self.columns)
            new = [c for c in found if c not in known]
            known.update(new)
            if new:
                self.add(new, np.full(len(new), 1e-3 * self.x.sum() / len(new)))


class Plan(NamedTuple):
    """sequences: (lengths, how many); by_program: pieces that rounding placed; bound: no packing has fewer sequences."""

    sequences: list[tuple[tuple[int, ...], int]]
    by_program: int
    bound: int


def configurations(histogram: dict[int, int], capacity: int = 1024, rounds: int = 60, steps: int = 100, rate: float = 0.5, gap: float = 1e-4, keep: int = 6000) -> Plan:
    """Which sequences to build, covering the histogram exactly.

    The configuration linear program (see Program) is started from a best-fit decreasing packing's configurations and
    solved by multiplicative weights with knapsack pricing. Its solution is rounded: whole parts first, then the
    largest fractions, as far as their pieces are left. Best-fit decreasing packs the pieces that rounding leaves,
    about half a sequence for each configuration in use. At most `keep` configurations are held at a
    time. Only the histogram is used: time and memory don't grow with the rows.
    """
    histogram = {int(k): int(n) for k, n in histogram.items() if n > 0}
    if not histogram:
        return Plan([], 0, 0)
    program = Program(histogram, capacity, best_fit(histogram, capacity))
    program.solve(rounds, steps, rate, gap, keep)
    left = np.zeros(capacity + 1, dtype=np.int64)
    left[program.lengths] = program.counts.astype(np.int64)
    plan: dict[tuple[int, ...], int] = defaultdict(int)

    def take(items, n):
        own, use = np.unique(items, return_counts=True)
        n = min(n, int((left[own] // use).min()))
        if n > 0:
            plan[items] += n
            left[own] -= use * n

    for k in np.argsort(-program.x, kind="stable").tolist():
        take(program.columns[k], int(program.x[k]))
    for k in np.argsort(np.floor(program.x) - program.x, kind="stable").tolist():
        if program.x[k] % 1 >= 0.5:
            take(program.columns[k], 1)
    by_program = sum(len(items) * n for items, n in plan.items())
    for items, n in best_fit({int(k): int(left[k]) for k in np.flatnonzero(left)}, capacity).items():
        plan[tuple(sorted(items, reverse=True))] += n
    volume = -(-sum(k * n for k, n in histogram.items()) // capacity)
    return Plan(sorted(plan.items()), by_program, max(volume, math.ceil(program.low - 1e-6 * program.low - 1e-6)))


def place(parts: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to pieces (a stored table with length): the packing itself.

    Rows: as given. The driver sees the length histogram (at most capacity rows). Rows of a length
    are numbered in two steps, within hashed shares and over the shares' counts, so that a length
    that most rows have is spread over all tasks.
    """
    spark = parts.sparkSession
    histogram = {r[0]: r[1] for r in parts.groupBy("length").count().collect()}
    keys, bases, offsets = [], [], []
    start: dict[int, int] = defaultdict(int)
    base = 0
    for items, n in configurations(histogram, capacity).sequences:
        offset = 0
        for length in items:
            keys.append((length << 44) + start[length])
            bases.append(base - start[length])
            offsets.append(offset)
            start[length] += n
            offset += length
        base += n
    order = np.argsort(np.asarray(keys, dtype=np.int64), kind="stable")
    keys, bases, offsets = (np.asarray(x, dtype=np.int64)[order] for x in (keys, bases, offsets))
    shares = shuffle_partitions(spark)
    salted = parts.withColumn("_share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares)).cast("int"))
    counts = salted.groupBy("length", "_share").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_share").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(own)).join(counts, ["length", "_share"])

    def seats(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            length, rank = (t[c].to_numpy().astype(np.int64) for c in ("length", "_rank"))
            k = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            t = t.drop_columns(["_rank"]).append_column("sequence_id", pa.array(bases[k] + rank)).append_column("offset", pa.array(offsets[k]))
            yield from t.to_batches()

    ranked = ranked.select(*parts.columns, (F.col("_before") + F.col("_rank") - 1).alias("_rank"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return ranked.mapInArrow(releasing(seats), f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Packs docs (doc_id, text; other columns are left out) into sequences of at most capacity tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).
    Null or empty texts hold the end id alone; rows with the same or a null doc_id are packed each
    on its own; an empty table gives none. Texts count whole: the longest are cut into pieces of capacity tokens, of which
    the first may be shorter.
    """
    return place(written(pieces(docs, path, capacity, end_id, with_ids), "pieces"), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
