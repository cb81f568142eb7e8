"""The registered queries themselves, on the test tables and on odd ones."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from marketloom.llm import entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_dir(spark, odd, tmp_path_factory):
    """Odd documents, vectors and pages with columns of clashing names, as a folder of tables."""
    folder = str(tmp_path_factory.mktemp("odd"))
    odd.selectExpr("*", "1 as size", "'x' as score", "2 as rank", "3 as node").write.parquet(f"{folder}/documents.parquet")
    vectors = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.01]), (2, None), (None, [1.0, 0.0]), (3, [0.0, 0.0]), (4, [float("inf"), 1.0]), (5, [1.0]), (6, []), (200, [1.0, 0.0]), (200, [1.0, 0.0])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "1 as node", "2 as cell", "'q' as query").write.parquet(f"{folder}/embeddings.parquet")
    pages = [(1, "http://a.net/x", None), (1, "http://a.net/x", None), (None, None, ""), (2, "", "<a href='http://b.com'>"), (3, "http://b.com/" + "y" * 30_000, "z" * 100_000)]
    spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'h' as host", "1 as trust").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, None, 1), (None, 1, 0), (5, 0, 0), (5, 0, 0)], "doc_id long, quality int, toxic int").selectExpr("*", "7 as label").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, odd_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "embeddings", "pages", "labels"):
        spark.read.parquet(f"{odd_dir}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


TABLES = {n: "embeddings" if n.startswith(("op3", "op10")) else "pages" if n.startswith("op9") else "documents" for n in entry.QUERIES}


@pytest.mark.parametrize("name", entry.QUERIES)
def test_queries_on_odd_and_no_rows(spark, odd_dir, empty_dir, name):
    got = entry.QUERIES[name](spark, odd_dir).collect()
    rows = spark.read.parquet(f"{odd_dir}/{TABLES[name]}.parquet").collect()
    if name.startswith("op3"):
        assert Counter(r.query_id for r in got) == {100: 8, 200: 8}
    elif name.startswith("op1_"):
        assert {r.doc_id for r in got} == {r.doc_id for r in rows} and sum(r.start == 0 for r in got) == len(rows)
    elif name.startswith("op11"):
        # "" has one source, de two and fr two, en three
        assert Counter((r.lang, r.part) for r in got) == {("de", "pair"): 2, ("fr", "pair"): 2, ("en", "pair"): 6}
    else:
        key = got[0].__fields__[0]
        assert Counter(r[key] for r in got) == Counter(r[key] for r in rows)
    assert entry.QUERIES[name](spark, empty_dir).count() == 0


@pytest.mark.parametrize("name", entry.SQL)
@pytest.mark.parametrize("where", ["real", "odd"])
def test_queries_match_sql(spark, odd_dir, name, where):
    folder = SF if where == "real" else odd_dir
    with duckdb.connect() as c:
        for p in Path(folder).glob("*.parquet"):
            c.execute(f"create view {p.stem} as select * from '{p if p.is_file() else str(p) + '/*.parquet'}'")
        want = c.execute(entry.SQL[name])
        names = [d[0] for d in want.description]
        want = Counter(want.fetchall())
    got = entry.QUERIES[name](spark, folder)
    assert Counter(tuple(r[n] for n in names) for r in got.collect()) == want and set(got.columns) == set(names)
