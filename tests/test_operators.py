"""Operators on hand-made rows: what the test tables don't hold."""

import zipfile
from collections import Counter
from datetime import date

from marketloom.functions import calendars, scalars
from marketloom.operators import coverage, holdings, matching, notices, relational
from marketloom.plans import catalog
from marketloom.sources import archives, readers, sinks
from pyspark.sql import functions as F


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def parsed(spark, text):
    return {(r.action, r.code, r.name) for r in notices.parse(spark.createDataFrame([(1, text)], "notice_id int, text string")).collect()}


def test_notices(spark):
    assert parsed(spark, "成分股納入(1)：3673 TPK-KY、1101B 台泥乙特、6456 GIS-KY、2379 瑞\n昱") == {("add", "3673", "TPK-KY"), ("add", "1101B", "台泥乙特"), ("add", "6456", "GIS-KY"), ("add", "2379", "瑞昱")}
    # the Chinese section ends where the English lists begin; a code that it lacks comes from these
    both = "成分股納入(1)：無\n成分股刪除(1)：2330 台積電\nInclusions(1): 5871 Chailease\nExclusions(1): 2330 TSMC\n"
    assert parsed(spark, both) == {("add", "5871", "Chailease"), ("delete", "2330", "台積電")}
    assert parsed(spark, "成分股納入(0)：無\n成分股不變：2330 台積電") == set() and parsed(spark, "") == set() and parsed(spark, None) == set()
    assert parsed(spark, "成分股納入(1)：韓國證券交易所掛牌股票：\n005930 SAMSUNG ELEC\n如欲取得 1234 名") == {("add", "005930", "SAMSUNG ELEC")}
    r = notices.parse(spark.createDataFrame([(1, "「甲\n 指數」2026/06/09 自2026年6月26日 起生效，定審資料日（20260529）\n成分股刪除(1):1234 甲")], "notice_id int, text string")).first()
    assert (r.index_name, r.announce_date, r.review_date, r.effective_date) == ("甲指數", date(2026, 6, 9), date(2026, 5, 29), date(2026, 6, 26))


def test_schedules(spark):
    text = "2026年6月 指數審核 日程表\n更新日期：2026/5/3\n甲指數 2026/06/09\n乙 2026/06/09 2026/06/26\n丙 指數 2026/6/9 2026/06/26\n"
    got = [tuple(r) for r in notices.schedule(spark.createDataFrame([(1, text), (2, None), (3, "")], "notice_id int, text string")).collect()]
    assert got == [(1, "2026年6月指數審核日程表", date(2026, 5, 3), "丙指數", date(2026, 6, 9), date(2026, 6, 26))]
    undated = notices.schedule(spark.createDataFrame([(1, text.replace("2026/5/3", "20260503"))], "notice_id int, text string")).first()
    assert undated.update_date is None and undated.index_name == "丙指數"


def test_names(spark):
    df = spark.createDataFrame([("Acer Corporation",), ("Asus Computer Inc",), ("X Holdings",), ("Taiwan Cement Corp",), (None,)], "c string")
    assert [r[0] for r in df.select(scalars.normalize_name(F.col("c"))).collect()] == ["aceroration", "asusmputer", "xs", "taiwan cement", None]
    names = spark.createDataFrame([("a b c",), ("a b",), ("q",), ("z y",)], "name string")
    stocks = spark.createDataFrame([(1, "1", "a b d"), (2, "2", "a c"), (3, "3", "y z")], "ordinal int, code string, eng string")
    assert rows(matching.by_words(names, stocks)) == Counter([("a b c", "1", 1, 2 / 3), ("a b", "1", 1, 2 / 3), ("z y", "3", 3, 1.0)])


def test_words_match_brute_force(spark):
    import random

    random.seed(3)
    pool = [f"w{k}" for k in range(12)]
    names = [" ".join(random.choices(pool, k=random.randint(1, 6))) for _ in range(150)] + ["the hot", "the hot w1"]
    stocks = [(k, str(k), " ".join(random.choices(pool, k=random.randint(1, 6)))) for k in range(120)]
    want = Counter()
    for name in set(names):
        a, best = set(name.split()), None
        for k, code, eng in stocks:
            b = set(eng.split())
            score = len(a & b) / max(len(a), len(b))
            if len(a) >= 2 and len(b) >= 2 and len(a & b) >= 2 and score >= 0.5 and (best is None or score > best[3]):
                best = (name, code, k, score)
        if best:
            want[best] += 1
    got = matching.by_words(spark.createDataFrame([(n,) for n in set(names)], "name string"), spark.createDataFrame(stocks, "ordinal int, code string, eng string"))
    assert rows(got) == want and len(want) > 50


def test_matching_of_a_catalogue_listed_over_and_over(spark):
    """Copies of a stock are matched once: what joins and automata get doesn't grow with them, and the first of them wins."""
    import random

    random.seed(5)
    pool = [f"word{k}" for k in range(9)]
    engs = sorted({" ".join(random.sample(pool, 4)) for _ in range(60)})
    names = spark.createDataFrame([(" ".join(e.split()[::-1][:3]),) for e in engs], "name string").distinct()
    once = [(k, f"c{k}", e) for k, e in enumerate(engs)]
    again = [(k + 1000 * i, f"c{k + 1000 * i}", e) for k, _, e in once for i in range(40)]
    one, many = (spark.createDataFrame(r, "ordinal long, code string, eng string") for r in (once, again))
    for tier in (matching.by_words, matching.by_containment):
        assert rows(tier(names, many)) == rows(tier(names, one)) and tier(names, one).count() > 0
    assert matching.firsts(many).count() == len(engs)


def test_dates_and_bytes(spark):
    df = spark.createDataFrame([("2026年6月26日",), ("2026/06/26",), ("(20260609)",), ("20260609 2026/1/2",), ("2026/13/1",), ("none",), (None,)], "c string")
    assert [r[0] for r in df.select(scalars.parse_date_any(F.col("c"))).collect()] == [date(2026, 6, 26), date(2026, 6, 26), date(2026, 6, 9), date(2026, 1, 2), None, None, None]
    sizes = spark.createDataFrame([(1536,), (0,), (5 * 1024**5,), (1024**4,)], "b long")
    assert [r[0] for r in sizes.select(scalars.human_bytes(F.col("b"))).collect()] == ["1.5KB", "0.0B", "5.0PB", "1.0TB"]
    span = spark.createDataFrame([(date(2024, 1, 1), date(2024, 3, 31)), (date(2024, 1, 2), date(2024, 1, 1))], "a date, b date")
    assert [tuple(r) for r in span.select(*(calendars.day_count(F.col("a"), F.col("b"), r) for r in ("all", "weekday", "mon_sat", "monday", "month_clamped", "quarter_end"))).collect()] == [(91, 65, 78, 13, 3, 1), (0,) * 6]


def test_truth_and_subscriptions(spark):
    df = spark.createDataFrame([("True", 200, "ok"), ("1", 200, "已到期"), ("0", 402, None), (None, None, None), ("yes", 200, None)], "f string, s int, m string")
    assert [tuple(r) for r in df.select(scalars.truthy(F.col("f")), scalars.subscribed(F.col("s"), F.col("m"))).collect()] == [(True, True), (True, False), (False, False), (False, False), (False, True)]


def test_latest_before(spark):
    asked = spark.createDataFrame([("a", date(2024, 1, 10)), ("a", date(2024, 1, 5)), ("a", date(2024, 1, 31)), ("b", date(2024, 1, 10))], "dataset string, d date")
    landed = spark.createDataFrame([("a", date(2024, 1, 8)), ("a", date(2024, 1, 6)), ("c", date(2024, 1, 1))], "dataset string, d date")
    assert rows(coverage.latest_before(asked, landed)) == Counter([("a", date(2024, 1, 10), date(2024, 1, 8)), ("a", date(2024, 1, 5), None), ("a", date(2024, 1, 31), None), ("b", date(2024, 1, 10), None)])


def test_holdings_report(spark):
    now = spark.createDataFrame([("1", 10.0, 60.0), ("2", 5.0, 40.0)], "stock_id string, holdings double, weight double")
    before = spark.createDataFrame([("1", 8.0, 50.0), ("3", 8.0, 50.0)], now.schema)
    d = holdings.diff(now, before, "stock_id")
    assert holdings.report(d, "stock_id") == ["both: 1", "left_only: 1", "right_only: 1", "1 ▲ 2 (+25.00%)"]
    assert relational.multiset_equal(now.unionAll(now), now.unionAll(now)) and not relational.multiset_equal(now.unionAll(now), now)


def test_files(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", "1,2")
        z.writestr("y.csv", "3")
    (tmp_path / "b.zip").write_bytes(b"no archive")
    valid = {r.path.rsplit("/", 1)[1]: r.valid for r in archives.begins_with(spark, f"file://{tmp_path}", b"PK").collect()}
    assert valid == {"a.zip": True, "b.zip": False}
    assert {(r.member, bytes(r.content)) for r in archives.contents(archives.members(spark, f"file://{tmp_path}", "a.zip")).collect()} == {("x.csv", b"1,2"), ("y.csv", b"3")}
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "one.txt").write_text("a\nb")
    assert [r.text for r in readers.whole_texts(spark, f"file://{tmp_path}/t").collect()] == ["a\nb"]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "m.json").write_text('{\n "k": 1,\n "v": ["a"]\n}')
    assert [tuple(r) for r in readers.json(spark, f"file://{tmp_path}/j", "k int, v array<string>").collect()] == [(1, ["a"])]


def test_entity_sink_leaves_other_buckets(spark, tmp_path):
    path = f"file://{tmp_path}/e"
    old = spark.createDataFrame([(f"s{k}", k) for k in range(200)], "id string, v int")
    sinks.entities(old, path, "id", buckets=16)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "e").rglob("*.parquet")}
    new = old.withColumn("v", F.when(F.col("id") == "s3", -1).otherwise(F.col("v")))
    sinks.entities(new, path, "id", buckets=16, changed=relational.change_types(old, new, "id").where("change_type <> 'unchanged'"))
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "e").rglob("*.parquet")}
    assert len({p.parent for p in set(before.items()) ^ set(after.items()) for p in [p[0]]}) == 1
    assert rows(spark.read.parquet(path).select("id", "v")) == rows(new)


def test_unknown_datasets_and_order(spark):
    known = [catalog.Dataset("Price", "daily", "2024-01-01")]
    plan = catalog.request_plan(spark, catalog.select(known, ["Price"]), "2024-01-01", "2024-01-03", newest_first=True)
    assert [r.d for r in plan.collect()] == [date(2024, 1, 3), date(2024, 1, 2), date(2024, 1, 1)]
    try:
        catalog.select(known, ["Nope"])
    except ValueError as e:
        assert "Nope" in str(e)
    else:
        raise AssertionError
    e = spark.createDataFrame([("a", 1)], "dataset string, d int")
    assert coverage.pending(e, e).count() == 0 and coverage.pending(e, e, refresh=True).count() == 1
