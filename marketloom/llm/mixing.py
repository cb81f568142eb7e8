"""Operator 2: mixing sources to target weights by a multivariate-hypergeometric splitting tree (native)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, shuffle_partitions, table, written

#: Two primes for permuting blocks; the second where the number of blocks is a multiple of the first.
PRIMES = (1_000_003, 998_244_353)
#: A word with the white space before it.
PIECE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
#: Columns that the operator adds or uses; docs' own of these names are left out.
OWN = ("size", "source_size", "target", "taken", "draws", "sk", "passes", "_h", "_share", "_hash", "_at")
DRAWS = "array<struct<shard:int,position:bigint,pass:int,start:bigint,words:bigint>>"


def let(name: str, value: str, body: str) -> str:
    """SQL: body with name bound to value, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def split(total: str, own: str, draw: str, key: str) -> str:
    """SQL for how many of own blocks are among draw blocks drawn from total: one hypergeometric draw, by a hash of key.

    By inversion: likelihoods relative to that of the mode, by the ratio of neighbours, outwards as far as 12 standard
    deviations, beyond which they vanish in double precision. First they are summed, then walked up to a uniform share
    of the sum. The same at every size, with steps in proportion to the standard deviation.
    """
    least, most = f"greatest({draw} - ({total} - {own}), 0L)", f"least({draw}, {own})"
    spread = f"sqrt(greatest({draw} * ({own} / {total}) * (1 - {own} / {total}) * ({total} - {draw}) / greatest({total} - 1, 1L), 0D))"
    case = f"""named_struct('o', double({own}), 'd', double({draw}), 'rest', double({total} - {own} - {draw}),
        'm', greatest({least}, least({most}, floor(({draw} + 1D) * ({own} + 1D) / ({total} + 2D)))),
        'steps', least({most} - {least} + 1, ceil(12 * {spread}) + 20), 'r', (shiftrightunsigned(xxhash64({key}), 11) + 0.5D) / {1 << 53}D)"""
    up = "greatest(a.u * (c.o - (c.m + i - 1)) * (c.d - (c.m + i - 1)) / ((c.m + i) * (c.rest + c.m + i)), 0D)"
    down = "greatest(a.v * (c.m - i + 1) * (c.rest + c.m - i + 1) / ((c.o - c.m + i) * (c.d - c.m + i)), 0D)"
    both = f"named_struct('u', {up}, 'v', {down})"
    goal = f"""aggregate(sequence(1L, c.steps), named_struct('u', 1D, 'v', 1D, 's', 1D),
        (a, i) -> {let("x", both, "named_struct('u', x.u, 'v', x.v, 's', a.s + x.u + x.v)")}, a -> a.s * c.r)"""
    hit = "coalesce(a.k, case when g < a.s + x.u then c.m + i when g < a.s + x.u + x.v then c.m - i end)"
    found = f"""aggregate(sequence(1L, c.steps), named_struct('u', 1D, 'v', 1D, 's', 1D, 'k', if(g < 1, c.m, null)),
        (a, i) -> {let("x", both, f"named_struct('u', x.u, 'v', x.v, 's', a.s + x.u + x.v, 'k', {hit})")}, a -> coalesce(a.k, c.m))"""
    return f"if({least} >= {most}, {least}, {let('c', case, let('g', goal, found))})"


def splitting_tree(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """Deals quotas of blocks (rank, blocks) out to 2**levels shards: rank, shard, blocks.

    A node holds what each rank has left for its shards; half of a node's blocks, drawn without
    replacement, go left and the rest right. Column sums are the quotas, exactly, and shards differ by a block a level.
    """
    tree = quotas.agg(F.sort_array(F.collect_list(F.struct("rank", "blocks"))).alias("q")).withColumn("node", F.lit(0).cast("long"))
    for level in range(levels):
        # left half: from t blocks in all d are drawn; each rank in turn gives k of its own
        k = split("s.t", "x.blocks", "s.d", f"{seed}, {level}, node, x.rank")
        deal = let("k", k, "named_struct('t', s.t - x.blocks, 'd', s.d - k, 'out', concat(s.out, array(k)))")
        left = f"aggregate(q, named_struct('t', t, 'd', t div 2, 'out', cast(array() as array<bigint>)), (s, x) -> {deal}, s -> s.out)"
        tree = tree.selectExpr("node", "q", let("t", "aggregate(q, 0L, (s, x) -> s + x.blocks)", left) + " as left")
        halves = "array(zip_with(q, left, (x, k) -> named_struct('rank', x.rank, 'blocks', k)), zip_with(q, left, (x, k) -> named_struct('rank', x.rank, 'blocks', x.blocks - k)))"
        tree = tree.selectExpr("node", f"posexplode({halves}) as (side, q)").selectExpr("node * 2 + side as node", "q")
        if level % 6 == 5:
            # a few rows of the upper levels become many: they spread over tasks
            tree = tree.repartition("node")
    return tree.selectExpr("node as shard", "inline(q)")


def targets(totals: DataFrame, weights: tuple, share: float, most: float) -> DataFrame:
    """Adds rank and target to totals (sk, source_size): weights by rank, filled up to most times the size.

    One row a source; sources are a catalogue with weights, so this table is small.
    """
    everything, ranked = Window.partitionBy(), Window.orderBy("sk")
    t = totals.withColumn("rank", F.row_number().over(ranked).cast("long"))
    t = t.withColumn("w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    t = t.withColumn("limit", most * F.col("source_size")).withColumn("budget", share * F.sum("source_size").over(everything))
    upto = Window.orderBy(F.col("limit") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("spent", F.coalesce(F.sum("limit").over(upto), F.lit(0.0)))
    t = t.withColumn("rest", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
    t = t.withColumn("full", (F.col("budget") - F.col("spent")) * F.col("w") >= F.col("limit") * F.col("rest"))
    free = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(everything)
    level = (F.col("budget") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(everything)) / free
    return t.select("sk", "source_size", "rank", F.when(F.col("full"), F.col("limit")).otherwise(F.least(F.col("limit"), F.col("w") * level)).alias("target"))


def passes(totals: DataFrame, most: int, block: int) -> DataFrame:
    """A row for each pass over a source, of targets' rows: rank (its pass told), n blocks, blocks of them to draw, words to take.

    A source is gone through wholly as often as its target has room for; the last pass is drawn from.
    A block holds `block` words or one more or less; a source of less than 64 blocks is cut into smaller ones.
    """
    size = F.greatest(F.lit(1).cast("long"), F.least(F.lit(block).cast("long"), F.floor(F.col("source_size") / 64)))
    lines = totals.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).withColumn("n", F.ceil(F.col("source_size") / size).cast("long"))
    words = F.greatest(F.lit(0).cast("long"), F.least(F.col("source_size"), F.round("target").cast("long") - F.col("pass") * F.col("source_size")))
    lines = lines.withColumn("words", words).where("words > 0")
    # blocks hold at least floor(source_size / n) words, so these many give the words that are wanted
    need = F.least(F.col("n"), F.ceil(F.col("words") / F.floor(F.col("source_size") / F.col("n"))).cast("long"))
    return lines.select("sk", "source_size", "pass", (F.col("rank") * most + F.col("pass")).alias("line"), "n", "words", need.alias("blocks"))


def plan(sized: DataFrame, weights: tuple, share: float, most: int, levels: int | None, block: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Targets of sized's sources (sk, source_size, target) and what each source's passes give to each shard (sk, passes).

    The number of shards follows from the blocks: 2**levels, about the square root of the number of blocks drawn.
    For each pass there are the shards' pools: the source's permuted blocks are cut into as many stretches, as long as
    the quotas of the tree say, and ends: the quotas summed up. A pool never holds less than its quota.
    """
    totals = written(targets(sized.groupBy("sk").agg(F.sum("size").alias("source_size")), weights, share, most), "sources")
    lines = written(passes(totals, most, block), "passes")
    drawn = lines.agg(F.sum("blocks")).first()[0] or 0
    levels = math.ceil(math.log2(drawn + 1) / 2) if levels is None else levels
    shards = splitting_tree(lines.select(F.col("line").alias("rank"), "blocks"), levels, seed)
    upto = Window.partitionBy("rank").orderBy("shard")
    shards = shards.withColumn("end", F.sum("blocks").over(upto)).join(lines.withColumnRenamed("blocks", "q"), F.col("rank") == F.col("line"))
    spare = F.when(F.col("q") > 0, F.least(F.col("n") - F.col("q"), F.floor(F.col("end") * ((F.col("n") - F.col("q")) / F.col("q"))))).otherwise(0)
    last = F.lit((1 << levels) - 1)
    shards = shards.withColumn("pool", F.when(F.col("shard") == last, F.col("n")).otherwise(F.col("end") + spare).cast("long"))
    by = shards.groupBy("sk", "line", "pass", "n", "q", "words", "source_size").agg(F.sort_array(F.collect_list(F.struct("shard", "end", "pool"))).alias("s"))
    one = F.struct("pass", "line", "n", "q", "words", "source_size", F.col("s.end").alias("ends"), F.col("s.pool").alias("pools"))
    return totals.select("sk", "source_size", "target"), by.groupBy("sk").agg(F.sort_array(F.collect_list(one)).alias("passes"))


def measured(docs: DataFrame, seed: int, shares: int) -> DataFrame:
    """docs with their words counted and their place in their source's hashed line."""
    h = F.xxhash64(F.lit(seed), "doc_id")
    return docs.withColumns({
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long")),
        "sk": F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source").cast("string"))),
        "_h": F.shiftrightunsigned(h, 1),
        "_share": F.floor(F.shiftrightunsigned(h, 33) * shares / F.lit(float(1 << 31))).cast("int"),
        "_hash": F.xxhash64("text"),
    })


def drawn_blocks(levels: int, seed: int) -> str:
    """SQL for what a document's words, from _at on, have in the drawn blocks of its source's passes: an array of draws."""
    small, more = "(p.source_size div p.n)", "(p.source_size % p.n)"

    def edge(k):
        # block k begins here: the words are cut as evenly as whole numbers allow
        return f"(({k}) * {small} + least({k}, {more}))"

    def block_at(word):
        return f"if({word} < {more} * ({small} + 1), ({word}) div ({small} + 1), {more} + ({word} - {more} * ({small} + 1)) div greatest({small}, 1L))"

    def permuted(at, n, key, first, second):
        return f"pmod(pmod({at}, {n}) * if({n} % {first} = 0, {second}L, {first}L) + shiftrightunsigned(xxhash64({seed}, {key}), 32), {n})"

    # the shard in whose pool a place is: a binary search
    halves = f"cast(array({', '.join(str(1 << k) for k in reversed(range(levels)))}) as array<int>)"
    shard = f"aggregate({halves}, 0, (s, half) -> if(p.pools[s + half - 1] <= v.at, s + half, s))"
    pool = "named_struct('shard', j, 'lo', if(j > 0, p.pools[j - 1], 0L), 'end', if(j > 0, p.ends[j - 1], 0L))"
    # a shard draws the blocks that its own permutation of its pool puts first
    place = permuted("v.at - c.lo", "(p.pools[c.shard] - c.lo)", "'shard', p.line, c.shard", PRIMES[1], PRIMES[0])
    # the words wanted are dealt evenly over the drawn blocks; a block gives its first ones
    length = f"({edge('v.k + 1')} - {edge('v.k')})"
    even = "(p.words div p.q + if(o < p.words % p.q, 1, 0))"
    give = f"if(p.q = p.n, {length} - if(o < p.source_size - p.words, 1, 0), least({even}, {length}))"
    ends = f"named_struct('lo', greatest(_at, {edge('v.k')}), 'hi', least(_at + size, {edge('v.k')} + {give}))"
    row = f"named_struct('shard', c.shard, 'position', xxhash64({seed}, 'place', p.line, v.k), 'pass', p.pass, 'start', e.lo - _at, 'words', e.hi - e.lo)"
    given = let("o", "c.end + at", let("e", ends, f"if(e.hi > e.lo, {row}, null)"))
    taken = let("j", shard, let("c", pool, let("at", place, f"if(at < p.ends[c.shard] - c.end, {given}, null)")))
    one = let("v", f"named_struct('k', k, 'at', {permuted('k', 'p.n', chr(39) + 'line' + chr(39) + ', p.line', *PRIMES)})", taken)
    return f"flatten(transform(passes, p -> filter(transform(sequence({block_at('_at')}, {block_at('(_at + size - 1)')}), k -> {one}), x -> x is not null)))"


def draw(sized: DataFrame, rows: DataFrame, columns: list[str], weights: tuple, share: float, most: int, levels: int | None, block: int, seed: int) -> DataFrame:
    """Places the rows of measured() and draws: columns, size, source_size, target, taken, draws. sized, a stored table, has their sk, _share and size, or the sizes' sums."""
    zero = F.lit(0).cast("long")
    totals, given = plan(sized, weights, share, most, levels, block, seed)
    given = written(given, "given")
    levels = (given.select(F.max(F.size(F.col("passes")[0]["ends"]))).first()[0] or 1).bit_length() - 1
    before = Window.partitionBy("sk").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    lines = sized.groupBy("sk", "_share").agg(F.sum("size").alias("_size")).withColumn("_before", F.coalesce(F.sum("_size").over(before), zero)).drop("_size")
    own = Window.partitionBy("sk", "_share").orderBy("_h", "doc_id", "_hash")
    placed = rows.withColumn("_at", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.join(lines, ["sk", "_share"]).withColumn("_at", F.col("_at") + F.col("_before"))
    placed = placed.join(totals, "sk").join(given, "sk", "left")
    found = F.expr(f"cast(if(size > 0 and passes is not null, {drawn_blocks(levels, seed)}, array()) as {DRAWS})")
    placed = placed.withColumn("draws", found).withColumn("taken", F.expr("aggregate(draws, 0L, (s, x) -> s + x.words)"))
    return placed.select(*columns, "size", "source_size", "target", "taken", "draws")


def mix(docs: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, most: int = 2, levels: int | None = None, block: int = 512, seed: int = 17) -> DataFrame:
    """Draws from docs (doc_id, text, source) the mix whose sources come to their targets.

    Sources, ordered by code point with null last, have the weights in turn and share `share` times
    all words; a source's target stops at `most` (a whole number) times its size. The source's documents
    stand in an order hashed from doc_id, cut into blocks of about `block` words. Whole passes over it are taken as
    often as the target has room; of the last pass as many blocks as the rest of the target needs (see passes).

    The splitting tree deals the passes' numbers of blocks out to 2**levels shards by hypergeometric draws. The source's
    permuted blocks are cut into the shards' pools, and each shard draws its quota from its pool by a permutation of its
    own: which blocks are taken, and by which shard, follows from tree, levels and seed. A block is drawn once a pass.

    Returns docs' columns (those with names in OWN are left out) with size, source_size, target, taken and
    draws: an array of (shard, position, pass, start, words), start counting words from 0; position is
    the block's place in the shard's local shuffle. Null or empty texts have size 0 and no draws;
    rows alike are each a row of their own; an empty table gives none. The result depends neither on partitions nor on runs.
    """
    if most != int(most) or most < 1:
        raise ValueError("most must be a whole number")
    docs = docs.drop(*OWN)
    # the texts are read twice, for the sizes and for the draws: to write them again would take more room than that spares
    rows = measured(docs, seed, shuffle_partitions(docs.sparkSession))
    sized = written(rows.groupBy("sk", "_share").agg(F.sum("size").alias("size")), "sized")
    return draw(sized, rows, docs.columns, weights, share, int(most), levels, block, seed)


def shard_rows(mixed: DataFrame) -> DataFrame:
    """The mix as a row for each document's part of a drawn block: mixed's columns with shard, position, pass, start, words; text is the part's.

    A shard's rows lie together, in the order of its local shuffle; shards are of one size, so they spread evenly.
    The white space between words stays as it is in the text.
    """
    part = r"regexp_replace(array_join(slice(w, int(d.start) + 1, int(d.words)), ''), '^[\\x20\\x09-\\x0D]+', '')"
    rows = f"transform(draws, d -> named_struct('shard', d.shard, 'position', d.position, 'pass', d.pass, 'start', d.start, 'words', d.words, 'text', {part}))"
    cut = F.expr(let("w", f"regexp_extract_all(cast(text as string), '{PIECE}', 0)".replace("\\", "\\\\"), rows))
    kept = [c for c in mixed.columns if c not in ("text", "draws", "shard", "position", "pass", "start", "words", "_d")]
    rows = mixed.where(F.size("draws") > 0).select(*kept, F.explode(cut).alias("_d")).select(*kept, "_d.*")
    return rows.repartition("shard").sortWithinPartitions("shard", "position", "doc_id", "start", "text")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sized = written(measured(docs, 17, shuffle_partitions(spark)).drop("text"), "sized")
    return draw(sized, sized, ["doc_id"], (3, 1, 2), 1.5, 2, None, 512, 17).drop("draws")
