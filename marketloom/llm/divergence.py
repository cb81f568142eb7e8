"""Operator 11: audit of how sources of a language diverge in their words, by dominance skybands."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

#: A term's bytes: ASCII letters, lower-cased, and everything beyond ASCII; all else parts terms.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
#: Bytes of a text that are taken apart at a time, up to the next border of a term.
CHUNK = 1 << 20
#: Distinct terms that a task holds before it hands on their counts.
HELD = 400_000
#: Rows of a group after which a task reduces what it holds to their skyband, and rows of all groups together.
GROUP_ROWS, ALL_ROWS = 16_384, 400_000
#: Cells of one matrix of sources by terms, and the sources that one task sets against all.
CELLS, SOURCES = 1 << 16, 256


def term_counts(batches):
    """(lang, source, term, count, docs) from batches of (lang, source, text); a term's counts may come in several rows."""
    held, size = {}, 0

    def flush():
        for (lang, source), (counts, docs) in held.items():
            terms = list(counts)
            for lo in range(0, len(terms), 50_000):
                part = terms[lo : lo + 50_000]
                columns = [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string())]
                columns += [pa.array([c[t] for t in part], pa.int64()) for c in (counts, docs)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "count", "docs"])

    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            text, seen, at = text.as_py().translate(TERM_BYTES), set(), 0
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(counts)
            while at < len(text):
                end = text.find(b" ", at + CHUNK) if len(text) - at > CHUNK else -1
                end = len(text) if end < 0 else end
                terms = text[at:end].split()
                counts.update(terms)
                seen.update(terms)
                at = end
            docs.update(seen)
            size += len(counts) - before
            if size > HELD:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def skyband(count: np.ndarray, lang_count: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Which rows fewer than k others dominate: none lower in count, higher in lang_count or later in term, all three at once.

    Rows are gone through so that whatever dominates a row comes before it; k rows that dominate one and are
    themselves kept are always among those, so each block is set against what is kept, not against all.
    """
    order = np.lexsort((term, lang_count, -count))
    c, n, t = count[order], lang_count[order], term[order]
    kept = np.zeros(0, dtype=np.int64)
    for lo in range(0, len(c), 256):
        own = np.arange(lo, min(lo + 256, len(c)))
        over = np.zeros(len(own), dtype=np.int64)
        for at in range(0, len(kept), 8192):
            part = kept[at : at + 8192]
            over += ((n[part] <= n[own, None]) & (t[part] < t[own, None])).sum(1)
        # within the block the counts decide too: rows after a row never exceed its count
        over += ((c[own] >= c[own, None]) & (n[own] <= n[own, None]) & (t[own] < t[own, None])).sum(1)
        kept = np.concatenate((kept, own[over < k]))
    return order[kept]


def skybands(k: int):
    """A mapInArrow function that keeps each (lang, source)'s k-skyband of the rows of a task, in bounded memory.

    Where a task holds too much even so, it hands on what it has: that leaves more than the skyband, never less.
    """

    def reduced(rows: pa.Table) -> pa.Table:
        terms = rows["term"].to_pylist()
        place = np.empty(len(terms), dtype=np.int64)
        place[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
        return rows.take(pa.array(np.sort(skyband(rows["count"].to_numpy(), rows["lang_count"].to_numpy(), place, k))))

    def run(batches):
        held, floor = {}, {}
        for batch in batches:
            t = pa.Table.from_batches([batch])
            pair = pa.StructArray.from_arrays([t["lang"].combine_chunks(), t["source"].combine_chunks()], ["lang", "source"])
            groups = {}
            for at, group in enumerate(pair.to_pylist()):
                groups.setdefault((group["lang"], group["source"]), []).append(at)
            for group, rows in groups.items():
                own = t.take(pa.array(rows))
                held[group] = pa.concat_tables([held[group], own]) if group in held else own
                # twice what was left last time at least, so that the work stays in proportion to the rows
                if len(held[group]) > max(GROUP_ROWS, floor.get(group, 0)):
                    held[group] = reduced(held[group])
                    floor[group] = 2 * len(held[group])
            if sum(map(len, held.values())) > ALL_ROWS:
                for rows in held.values():
                    yield from reduced(rows).to_batches()
                held, floor = {}, {}
        for rows in held.values():
            yield from reduced(rows).to_batches()

    return run


def distances(key, rows):
    """Summed distances between the sources of one part of the terms. Rows without a term tell a source's p of terms that it lacks."""
    block = key[2].as_py()
    term, source, p = rows["term"].combine_chunks(), np.array(rows["source"].to_pylist(), dtype=object), rows["p"].to_numpy()
    own = term.is_null().to_numpy(zero_copy_only=False)
    place = np.argsort(source[own])
    names, zero = source[own][place], p[own][place]
    codes = term.filter(pa.array(~own)).dictionary_encode()
    m = np.repeat(zero[:, None], len(codes.dictionary), axis=1)
    m[np.searchsorted(names, source[~own]), codes.indices.to_numpy()] = p[~own]
    a, b, value = [], [], []
    for i in range(block * SOURCES, min((block + 1) * SOURCES, len(names))):
        far = np.abs(m - m[i]).sum(1)
        others = np.arange(len(names)) != i
        a.append(np.full(others.sum(), names[i], dtype=object))
        b.append(names[others])
        value.append(far[others])
    whole = [np.concatenate(x) if x else np.zeros(0) for x in (a, b, value)]
    lang = pa.array([key[0].as_py()] * len(whole[0]), pa.string())
    return pa.table([lang, pa.array(whole[0], pa.string()), pa.array(whole[1], pa.string()), pa.array(whole[2].astype(np.int64))], ["lang", "source", "item", "value"])


def chance(count: str, total: str) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * v)), exactly."""
    return F.expr(f"1 + (cast(1000000000 as decimal(10,0)) * cast({count} + 5 as decimal(20,0))) div cast({total} + 5 * v as decimal(20,0))")


def audit(docs: DataFrame, ranks: int = 50, least: int = 30) -> DataFrame:
    """How far the sources of each language are apart, and by which terms: lang, source, part, item, value, rank.

    Part `pair` ranks the other sources of the language by summed distance, part `term` the terms that a source has more
    often than its language, the first `ranks`. Terms count that at least `least` documents of the language hold. Null
    texts, languages and sources read as ''; repeated rows count each; groups without terms have pairs of distance by
    their zero counts, or 0 where the language keeps no term. No rows give none; other columns don't count.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    counts = docs.select(*text).mapInArrow(term_counts, "lang string, source string, term string, count long, docs long")
    # one shuffle, by (lang, term), serves the sums of groups and of languages
    counts = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    own = Window.partitionBy("lang", "term")
    counts = counts.withColumn("lang_count", F.sum("count").over(own)).withColumn("lang_docs", F.sum("docs").over(own))
    first = (F.row_number().over(own.orderBy("source")) == 1).cast("long")
    kept = written(counts.withColumn("first", first).where(F.col("lang_docs") >= least).drop("docs", "lang_docs"), "terms")

    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum(F.col("first") * F.col("lang_count")).alias("lang_n"), F.sum("first").alias("v"))
    groups = docs.select(*text[:2]).distinct()
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang").join(langs, "lang", "left").na.fill(0, ["n", "lang_n", "v"])
    parts = F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("sources") / CELLS).cast("long"))
    groups = written(groups.withColumn("parts", parts).withColumn("blocks", F.expr(f"1 + (sources - 1) div {SOURCES}")), "groups")

    rows = kept.join(groups, ["lang", "source"]).withColumn("p", chance("count", "n"))
    shape = "lang string, source string, term string, count long, lang_count long, value long"
    more = rows.withColumn("value", F.col("p") - chance("lang_count", "lang_n")).where("value > 0").select("lang", "source", "term", "count", "lang_count", "value")
    band = more.mapInArrow(skybands(ranks), shape).repartition("lang", "source").mapInArrow(skybands(ranks), shape)

    cells = rows.select("lang", "source", "term", "p", "blocks", F.pmod(F.xxhash64("term"), "parts").alias("part"))
    zeros = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.when(F.col("v") > 0, chance("0", "n")).otherwise(0).alias("p"), "blocks", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"))
    cells = cells.union(zeros).select("lang", "source", "term", "p", "part", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"))
    far = cells.groupBy("lang", "part", "block").applyInArrow(distances, "lang string, source string, item string, value long")
    far = far.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    terms = ranked(band.select("lang", "source", F.col("term").alias("item"), "value")).where(F.col("rank") <= ranks)
    named = [df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, df in (("pair", ranked(far)), ("term", terms))]
    return named[0].union(named[1])


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


SQL = r"""
with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
t as (select id, lang, source, unnest(terms) as term from d),
k as (select lang, term, count(*) as lang_count from t group by all having count(distinct id) >= 30),
l as (select lang, count(*) as v, sum(lang_count) as lang_n from k group by all),
g as (select distinct lang, source from d),
c as (select g.lang, g.source, k.term, k.lang_count, count(t.term) as c from g join k on g.lang = k.lang left join t on t.lang = g.lang and t.source = g.source and t.term = k.term group by all),
n as (select lang, source, sum(c) as n from c group by all),
p as (select lang, source, term, c, 1 + (1000000000::hugeint * (c + 5)) // (n + 5 * v)::hugeint as p, 1 + (1000000000::hugeint * (lang_count + 5)) // (lang_n + 5 * v)::hugeint as q from c join n using (lang, source) join l using (lang)),
f as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum(abs(x.p - y.p)), 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join p x on x.lang = a.lang and x.source = a.source left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term group by all
  union all select lang, source, 'term', term, p - q from p where c > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from f)
select lang, source, part, item, value::bigint as value, rank::int as rank from r where part = 'pair' or rank <= 50"""
