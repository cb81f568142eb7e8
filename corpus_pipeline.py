"""The corpus pipeline: language, near duplicates, personal data, mix, packing. Each stage takes all of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import jaccard_join, langid, mixing, packing, pii
from marketloom.llm.common import WORD, drop_written, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language the model tells; it learns from those of documents not held out. Null texts and texts without a letter have none and go."""
    out = F.coalesce(langid.held_out(), F.lit(False))
    found = langid.identify(docs, langid.fit(docs.where(~out)))
    return found.where("not rejected").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group, that with the smallest (doc_id, hash of its text), null last; rows without words are groups of their own."""
    keyed = docs.withColumn("_hash", F.xxhash64("text"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    groups = jaccard_join.labelled(docs.select("doc_id", "text")).where("component is not null")
    kept = groups.groupBy("component").agg(F.min(first).alias("first")).select(F.col("first.doc_id").alias("_id"), F.col("first.hash").alias("_kept"))
    found = keyed.join(kept, keyed.doc_id.eqNullSafe(kept._id) & (keyed._hash == kept._kept), "left_semi")
    # rows alike in both: the smallest by the other columns
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = found.groupBy("doc_id", "_hash").agg(F.min(F.struct(*others, "text")).alias("row")).select("doc_id", "row.*").select(*docs.columns)
    return found.union(docs.where(~F.coalesce(F.regexp_like("text", F.lit(WORD)), F.lit(False))))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts [EMAIL], [IP], [CARD] or [PHONE] where personal data was found, of overlapping finds the first; n_chars follows. Every row stays; null and empty texts as they are, with n_chars null and 0."""
    found = pii.detect(docs.withColumn("_whole", F.col("text")))
    spans = F.array_sort(F.transform("spans", lambda x: F.struct(x["start"].alias("s"), x["end"].alias("e"), x["kind"].alias("k"))))
    done = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, x: F.when(x["s"] < a["at"], a).otherwise(
            F.struct(F.concat(a["out"], F.substring("_whole", a["at"] + 1, x["s"] - a["at"]), F.lit("["), F.upper(x["k"]), F.lit("]")).alias("out"), x["e"].alias("at"))
        ),
        lambda a: F.concat(a["out"], F.substring("_whole", a["at"] + 1, F.length("_whole"))),
    )
    text = F.when(F.size("spans") > 0, done).otherwise(F.col("_whole"))
    return found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each part of a document that a shard of the mix draws, in the shards' shuffled order; n_chars follows the text."""
    rows = mixing.shard_rows(mixing.mix(docs))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens: a row a piece, null and empty texts as their end alone; rows alike are packed each."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("personal_data", personal_data_stage),
    ("mix_sources", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Stages use trained models, tokenisers and hashes that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        last, docs = docs, written(stage(spark, docs, sf_dir), name)
        if k:
            drop_written(last)
    return docs
