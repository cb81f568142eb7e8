"""Landed responses, judged payloads, versioned tables, stateful streams and containment on hand-made rows."""

import datetime
import json
import os
import random
import threading
from collections import Counter

import pytest
from marketloom.operators import containment, matching, relational
from marketloom.sources import landed, payloads, versions
from marketloom.streaming import ingest, runs
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, IsNull, StringContains

DAY = datetime.date


def plan_of(spark, folder, requests, bodies):
    """Lands bodies by (dataset, unit, d) and writes the plan of the requests."""
    rows = []
    for k, (key, body) in enumerate(bodies.items()):
        path = folder / f"r{k}.json"
        path.write_text(body)
        rows.append((*key, f"file://{path}"))
    shape = "dataset string, unit string, d date"
    landed.plan(spark.createDataFrame(requests, shape), spark.createDataFrame(rows, f"{shape}, file string"), f"file://{folder}/plan")
    return f"file://{folder}/plan"


def test_only_asked_responses_are_opened(spark, tmp_path, monkeypatch):
    days = [DAY(2024, 1, k) for k in range(1, 11)]
    requests = [("a", None, d) for d in days] + [("b", u, d) for u in "xy" for d in days] + [("snap", None, None), ("a", None, days[0])]
    bodies = {k: json.dumps({"key": str(k)}) for k in dict.fromkeys(requests) if k[2] != days[4]}
    path = plan_of(spark, tmp_path, requests, bodies)
    cases = [
        ([EqualTo(("dataset",), "a"), GreaterThanOrEqual(("d",), days[6])], lambda k: k[0] == "a" and k[2] and k[2] >= days[6]),
        ([In(("dataset",), ("b", "snap")), EqualTo(("unit",), "y")], lambda k: k[0] == "b" and k[1] == "y"),
        ([IsNull(("d",))], lambda k: k[2] is None), ([], lambda k: True), ([EqualTo(("dataset",), "none")], lambda k: False),
    ]
    for filters, keeps in cases:
        reader, opened = landed.PlanReader({"plan": path}), []
        assert list(reader.pushFilters([*filters, StringContains(("body",), "k")])) == [StringContains(("body",), "k")]
        monkeypatch.setattr(reader, "opened", lambda file, opened=opened: opened.append(file) or landed.PlanReader.opened(reader, file))
        got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        want = [k for k in dict.fromkeys(requests) if keeps(k)]
        assert Counter((r["dataset"], r["unit"], r["d"], r["body"]) for r in got) == Counter((*k, bodies.get(k)) for k in want)
        # a file for each asked request that has landed, no other
        assert len(opened) == len(set(opened)) == sum(k in bodies for k in want)
    # through Spark: what isn't asked for can't be opened at all
    for f in tmp_path.glob("r*.json"):
        if json.loads(f.read_text())["key"].startswith("('a'"):
            f.unlink()
            f.mkdir()
    asked = landed.load(spark, path).where((F.col("dataset") == "b") & (F.col("d") < F.lit(days[2])))
    assert {(r.unit, r.d) for r in asked.collect()} == {(u, d) for u in "xy" for d in days[:2]}
    with pytest.raises(Exception, match="r[0-9]+.json"):
        landed.load(spark, path).where("dataset = 'a'").collect()


def test_a_plan_of_no_requests(spark, tmp_path):
    path = plan_of(spark, tmp_path, [], {("a", None, None): "x"})
    assert landed.load(spark, path).count() == 0


def test_responses_are_judged(spark):
    want = {
        None: ("absent", "no response"), "": ("fail", "not json"), "<html>": ("fail", "not json"), "[1]": ("fail", "no object"), "null": ("fail", "no object"), "{}": ("fail", "rejected"),
        '{"status":200}': ("nodata", "no data"), '{"status":200,"data":null}': ("nodata", "no data"), '{"status":200,"data":[]}': ("nodata", "no data"), '{"status":200,"data":{}}': ("nodata", "no data"),
        '{"status":200.0,"data":[1]}': ("ok", None), '{"status":"200","data":[1]}': ("fail", "rejected"), '{"status":true,"data":[1]}': ("fail", "rejected"), '{"status":200,"data":{"a":1}}': ("fail", "data is no list"),
        '{"status":400,"msg":"Upper LIMIT"}': ("fail", "quota"), '{"status":402,"msg":"is 402"}': ("fail", "quota"), '{"status":1,"msg":"requests exceeded"}': ("fail", "quota"), '{"status":1,"msg":"request"}': ("fail", "rejected"), '{"status":1,"msg":5}': ("fail", "rejected"),
    }
    df = spark.createDataFrame([(b,) for b in want] * 2, "body string").withColumn("status", F.lit("clash"))
    assert Counter((r.body, r.status, r.reason) for r in payloads.judged(df, "body").collect()) == Counter({(b, *v): 2 for b, v in want.items()})
    body = '{"status":200,"data":[{"a":1,"b":"x","more":2},{"a":"2"},{"a":"z","b":"y"},{},{"a":null,"b":3},[1],null,5]}'
    got = payloads.rows(spark.createDataFrame([(body,), (None,)], "body string"), "body", "a long, b string").collect()
    assert Counter((r.status, r.ordinal, r.reason, r.a, r.b) for r in got) == Counter([
        ("ok", 0, None, 1, "x"), ("ok", 1, None, 2, None), ("ok", 2, "bad a", None, None), ("ok", 3, None, None, None), ("ok", 4, None, None, "3"), ("ok", 5, "item is no object", None, None),
        ("ok", 6, "item is no object", None, None), ("ok", 7, "item is no object", None, None), ("absent", None, "no response", None, None),
    ])
    assert payloads.rows(df.limit(0), "body", "a long").count() == 0


def test_positional_payloads_count_as_a_whole(spark):
    titles = '"Title":["a","b","c","d","e"]'
    rows = {
        "good": (f'{{{titles},"Data":[["20240301","2330","x","1.5","1,234,000"],["20240229","11","x","n/a","-5"]]}}', None), "none": (None, "not json"), "cut": ("{", "not json"), "list": ("[]", "no Title"),
        "titles": ('{"Title":["a"],"Data":[[1]]}', "no Title"), "empty": (f'{{{titles},"Data":[]}}', "no Data"), "missing": (f"{{{titles}}}", "no Data"), "short": (f'{{{titles},"Data":[["20240301","1","x","1","1"],["1"]]}}', "short row"),
        "number": (f'{{{titles},"Data":[["20240301","1","x","1","1"],["20240301","1","x","1","1.5"]]}}', "bad number"), "stale": (f'{{{titles},"Data":[["20240228","1","x","1","1"]]}}', "stale"), "null": (f'{{{titles},"Data":[["20240301","1","x","1",null]]}}', "bad number"),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in rows.items()], "etf string, payload string")
    got = payloads.positional(df, "payload", "etf", F.lit(DAY(2024, 3, 1))).collect()
    assert {r.etf: r.reason for r in got} == {k: v[1] for k, v in rows.items()} and len(got) == len(rows) + 1
    assert {(r.ordinal, r.date, r.stock_id, r.weight_pct, r.holdings) for r in got if r.etf == "good"} == {(0, DAY(2024, 3, 1), "2330", 1.5, 1234.0), (1, DAY(2024, 2, 29), "11", None, -0.005)}


def test_versions_are_pinned_and_one_writer_loses(spark, tmp_path):
    t = versions.Table(spark, f"file://{tmp_path}/t", "k", 4)
    assert t.head() is None
    rows = spark.range(40).selectExpr("id as k", "id * 2 as v")
    one = t.commit(rows, None, note="first")
    pinned = t.read(one)
    some = rows.where(t.bucket() == 1).withColumn("v", F.col("v") + 1)
    two = t.commit(some, one, [1])
    assert (two.number, two.facts) == (2, {"note": "first"}) and {two.buckets[b] == one.buckets[b] for b in (0, 2, 3)} == {True} and two.buckets[1] != one.buckets[1]
    key = lambda df: Counter(map(tuple, df.collect()))
    assert key(pinned) == key(rows) and key(t.read(t.head())) == key(rows.where(t.bucket() != 1).union(some))
    assert key(t.read(two, [1])) == key(some) and t.read(two, []).count() == 0
    # both build on version 2; the one that comes second loses and changes nothing
    with pytest.raises(versions.Conflict):
        t.commit(rows, one)
    found, start = [], threading.Barrier(4)

    def write(n):
        start.wait()
        try:
            found.append(t.commit(rows.withColumn("v", F.lit(n).cast("long")), two).number)
        except versions.Conflict:
            found.append(None)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert Counter(found) == {3: 1, None: 3} and t.versions() == [1, 2, 3] and t.read(t.head()).select("v").distinct().count() == 1
    with pytest.raises(ValueError):
        t.commit(rows, t.head(), [0])
    # an emptied bucket has no files; the first version's go
    t.commit(rows.limit(0), t.head(), [0, 1, 2, 3])
    assert t.read(t.head()).count() == 0
    t.vacuum(keep=2)
    assert t.versions() == [3, 4] and t.read(t.version(3)).count() == 40 and len(os.listdir(tmp_path / "t" / "data")) == 1


OLD = [(k, DAY(2024, 1, d), f"o{k}{d}") for k in range(6) for d in range(1, 8)] + [(9, None, "undated")]
BATCHES = [
    [(0, DAY(2024, 1, 3), "n"), (0, DAY(2024, 1, 3), "p"), (1, DAY(2024, 1, 4), "n")],
    [(2, DAY(2024, 1, 6), "n"), (0, DAY(2024, 1, 4), "q"), (9, DAY(2024, 1, 1), "n"), (77, DAY(2024, 1, 9), "new")],
    [(1, DAY(2024, 1, 3), "late"), (2, DAY(2024, 1, 8), "n")],
]


@pytest.mark.parametrize("crash", [None, "before", "after"])
def test_upserts_count_once_whatever_is_replayed(spark, tmp_path, monkeypatch, crash):
    """A crash between a batch's files and its commit, or between commit and checkpoint, leaves what the batch form gives."""
    shape = "k int, d date, v string"
    want = spark.createDataFrame(OLD, shape)
    target = versions.Table(spark, f"file://{tmp_path}/t", "k", 8)
    target.commit(want, None)
    for n, rows in enumerate(BATCHES):
        new = spark.createDataFrame(rows, shape)
        span = new.agg(F.min("d").cast("string"), F.max("d").cast("string")).first()
        want = relational.windowed_upsert(want, new, "k", ["k", "d"], "d", *span, [F.desc("v")])
        new.coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        os.utime(next((tmp_path / "in" / str(n)).glob("part-*")), (1e9 + n, 1e9 + n))
    commit = versions.Table.commit

    def run():
        stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        ingest.versioned_upserts(stream, target, ["k", "d"], "d", [F.desc("v")], f"{tmp_path}/log", "in")

    def failing(self, rows, base, touched=None, **facts):
        if facts["in"] == 1:
            self.write(rows) if crash == "before" else commit(self, rows, base, touched, **facts)
            raise OSError("killed")
        return commit(self, rows, base, touched, **facts)

    if crash:
        monkeypatch.setattr(versions.Table, "commit", failing)
        with pytest.raises(Exception, match="killed"):
            run()
        monkeypatch.setattr(versions.Table, "commit", commit)
    run()
    run()
    head = target.head()
    assert (head.number, head.facts) == (4, {"in": 2})
    assert Counter(map(tuple, target.read(head).collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_stateful_runs_and_sweeps_equal_batch(spark, tmp_path, seed):
    """However the input is cut, and with rows out of order by up to what is allowed."""
    rng = random.Random(seed)
    at = datetime.datetime(2024, 1, 1)
    rows = [(rng.choice("ab"), at + datetime.timedelta(minutes=3 * k), k, rng.random() < 0.6) for k in range(160)]
    shape = "k string, t timestamp, n long, bad boolean"
    whole = relational.run_lengths(spark.createDataFrame(rows, shape), ["k"], ["t", "n"], F.col("bad"))
    want = {(r.k, r.island): r.run_length for r in whole.collect()}
    sweeps = Counter()
    for k in "ab":
        due = None
        for _, t, _, bad in [r for r in rows if r[0] == k] + [(k, datetime.datetime.max, 0, False)]:
            if due and due < t:
                sweeps[(k, due)] += 1
                due = None
            due = (due or t + datetime.timedelta(minutes=30)) if bad else None
    # rows come up to an hour late
    order = sorted(rows, key=lambda r: r[1] + datetime.timedelta(minutes=rng.uniform(0, 58)))
    cuts = sorted(rng.sample(range(1, 160), 3))
    for n, (lo, hi) in enumerate(zip([0, *cuts, 160], [*cuts, 160, 161])):
        part = order[lo:hi] or [(None, datetime.datetime(2100, 1, 1), 0, False)]
        spark.createDataFrame(part, shape).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        os.utime(next((tmp_path / "in" / str(n)).glob("part-*")), (1e9 + n, 1e9 + n))

    def run(make, name):
        stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        before = spark.conf.get(runs.STORE[0])
        spark.conf.set(*runs.STORE)
        ingest.upsert_stream(make(stream), lambda df, batch: df.write.mode("overwrite").parquet(f"{tmp_path}/{name}/batch={batch}"), f"{tmp_path}/{name}-log")
        spark.conf.set(runs.STORE[0], before)
        return spark.read.parquet(f"{tmp_path}/{name}").collect()

    got = {}
    for r in run(lambda s: runs.failure_runs(s, "k", "t", "n", F.col("bad"), "1 hour"), "runs"):
        got[(r.k, r.island)] = max(r.run_length, got.get((r.k, r.island), 0))
    assert got == want
    assert Counter((r.k, r.due) for r in run(lambda s: runs.deferred_sweeps(s, "k", "t", "n", F.col("bad"), 1800, "1 hour"), "sweeps")) == sweeps


def test_containment_matches_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("ab ") for _ in range(rng.randint(0, 7)))
    names, stocks = [word() for _ in range(120)] + [None], [(k, word()) for k in range(90)] + [(None, "ab"), (90, None)]
    t, p = spark.createDataFrame([(n,) for n in names], "text string"), spark.createDataFrame(stocks, "ordinal long, pattern string")
    good = [(k, w) for k, w in stocks if k is not None and w]
    held = {n: min((k for k, w in good if w in n), default=None) for n in names if n}
    holder = {n: min((k for k, w in good if n in w), default=None) for n in names if n}
    for size in (7, 10**6):
        got = containment.first_held(t, p, size, size).collect()
        assert {r.text: r.ordinal for r in got} == {n: k for n, k in held.items() if k is not None} and len(got) == len({r.text for r in got})
        got = containment.first_holder(t.withColumnRenamed("text", "pattern"), p.withColumnRenamed("pattern", "text"), size, size).collect()
        assert {r.pattern: r.ordinal for r in got} == {n: k for n, k in holder.items() if k is not None}
    assert containment.first_held(t.limit(0), p).count() == 0 and containment.first_held(t, p.limit(0)).count() == 0


def test_match_labels(spark):
    names = spark.createDataFrame([("Acer Inc",), ("Acer Computer Works",), ("Giant Bicycle",), ("Abcd",), ("no",), (None,)], "name string")
    stocks = spark.createDataFrame([(4, "D", "acer computer"), (2, "B", "ACER"), (3, "C", "The Giant Bicycle Maker"), (1, "A", "Abcd"), (5, "E", "no")], "ordinal int, code string, eng string")
    got = {r["name"]: (r.code, r.method) for r in matching.by_containment(names, stocks).collect()}
    # acer has four signs only, so it is held by none
    assert got == {"Acer Inc": ("B", "exact"), "Acer Computer Works": ("D", "contains"), "Giant Bicycle": ("C", "reverse_contains"), "Abcd": ("A", "exact")}
    scores = spark.createDataFrame([(2 / 3,), (0.625,), (0.875,), (1.0,), (0.5,)], "s double")
    assert [r[0] for r in scores.select(matching.word_label(F.col("s"))).collect()] == [f"word_match({s:.2f})" for s in (2 / 3, 0.625, 0.875, 1.0, 0.5)]


def test_spans_of_days(spark):
    df = spark.createDataFrame([("x", DAY(2024, 1, 31), DAY(2024, 3, 1)), ("none", DAY(2024, 1, 2), DAY(2024, 1, 1)), ("null", None, DAY(2024, 1, 1))], "k string, a date, b date")
    from marketloom.functions import calendars

    count = lambda rule: [(r.k, r.d) for r in calendars.spans(df, "a", "b", rule).orderBy("d").collect()]
    assert len(count("all")) == 31 and count("month_clamped") == [("x", DAY(2024, 2, 1)), ("x", DAY(2024, 3, 1))]
    assert count("month_unclamped") == [("x", DAY(2024, 1, 1)), ("x", DAY(2024, 2, 1)), ("x", DAY(2024, 3, 1))] and count("quarter_end") == []


def test_a_response_is_parsed_once(spark):
    """However many questions are asked of a response, and a list is told by its first item, null or not."""
    df = spark.createDataFrame([('{"status":200,"data":[null]}',), ('{"data":[1]}',)], "body string")
    found = payloads.judged(df, "body")
    assert [(r.status, r.reason) for r in found.collect()] == [("ok", None), ("fail", "rejected")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_a_batch_of_a_key_is_one_value_of_the_state():
    from types import SimpleNamespace

    from marketloom.streaming import runs

    held, timers = [], []
    p = runs.Runs("k")
    p.held = SimpleNamespace(appendValue=held.append, appendList=held.extend, get=lambda: iter(held), clear=held.clear, put=lambda v: held.__setitem__(slice(None), v))
    p.handle = SimpleNamespace(registerTimer=timers.append)
    state = []
    p.folded = SimpleNamespace(exists=lambda: bool(state), get=lambda: state[0], update=lambda v: state.__setitem__(slice(None), [v]))
    for batch in (range(50, 100), range(50)):
        list(p.handleInputRows((1,), iter([SimpleNamespace(millis=k, tie=k, flag=k % 10 != 0) for k in batch]), None))
    assert len(held) == 2 and timers == [99, 49]
    got = [r for until in (59, 99) for r in p.handleExpiredTimer((1,), SimpleNamespace(getCurrentWatermarkInMs=lambda: until), None)]
    assert max(r.run_length for r in got) == 9 and not held and state == [(10, 9)]
