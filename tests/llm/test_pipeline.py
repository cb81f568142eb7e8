from collections import Counter

import corpus_pipeline as pipeline
import pytest

LONG = " ".join(f"word{k % 977}" for k in range(30_000))


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in pipeline.STAGES:
        docs = pipeline.written(stage(spark, docs, sf_dir), name)
        if name != "best_fit_packing":
            assert docs.columns == columns and docs.count() > 0
        if name in ("language_id", "ngram_jaccard_join"):
            assert docs.count() <= before
    seats = Counter()
    for r in docs.collect():
        seats[r.sequence_id] += r.length
    assert max(seats.values()) <= 1024
    assert "555-" not in "".join(r.text for r in pipeline.personal_data_stage(spark, spark.createDataFrame([(1, "call +1 (212) 555-0100 now", "en", "a", 26)], columns), sf_dir).collect())


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stages_take_odd_and_no_rows(spark, odd, none, name, stage):
    columns = [*odd.columns, "size", "rank"]
    for df in (odd, none):
        df = df.selectExpr("*", "'clash' as size", "7 as rank")
        rows = stage(spark, df, "").collect()
        if name == "best_fit_packing":
            assert len({(r.doc_id, r.piece, r.sequence_id, r.offset) for r in rows}) == len(rows) and (rows or df is not odd)
            continue
        assert all(list(r.asDict()) == columns for r in rows)
        own = df.collect()
        if name == "language_id":
            # every labelled text here is long made-up words or none: what is left is as it was
            assert not Counter(map(tuple, rows)) - Counter(map(tuple, own))
        elif name == "ngram_jaccard_join":
            kept = Counter((r.doc_id, r.text) for r in rows)
            assert not kept - Counter((r.doc_id, r.text) for r in own)
            assert {r.text for r in own} == {r.text for r in rows} and sum(n for (_, t), n in kept.items() if t == LONG) == (1 if own else 0)
        elif name == "personal_data":
            assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in own)
        else:
            words = sum(len((r.text or "").split()) for r in own)
            assert abs(sum(len(r.text.split()) for r in rows) - 1.5 * words) <= 3 and all(r.n_chars == len(r.text) for r in rows)


def test_an_empty_table_runs_through(spark, none, tmp_path):
    none.write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_keep_what_is_not_linked(spark):
    words = " ".join(f"w{k}" for k in range(40))
    other = [f"{c} one two three four five six seven eight {c}{c}" for c in "abcde"]
    rows = [(None, other[0], "en", "s", 1), (None, other[1], "en", "s", 1), (7, other[2], "en", "s", 1), (7, other[3], "de", "s", 1), (7, other[3], "en", "s", 1), (None, None, None, "s", 0), (None, None, None, "s", 0)]
    rows += [(9, words + " end", "en", "s", 1), (8, words, "en", "s", 1), (8, other[4], "en", "s", 1), (None, words, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = [rows[0], rows[1], rows[2], rows[3], rows[5], rows[6], rows[8], rows[9]]
    for parts in (1, 5):
        got = pipeline.near_duplicate_stage(spark, docs.repartition(parts), "").collect()
        assert Counter(map(tuple, got)) == Counter(want)
