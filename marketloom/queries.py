"""The library's operators as queries on the test tables, each with its SQL."""

from __future__ import annotations

import datetime
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import calendars, scalars
from .operators import coverage, holdings, matching, notices, relational
from .plans import catalog
from .sources import landed as responses_source
from .sources import archives, payloads, readers, sinks, versions, workbooks
from .streaming import ingest, runs

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- holdings ----------------------------------------------------------------------------------


def snapshots(spark, sf_dir, *years: int) -> list[DataFrame]:
    """Yearly holdings with their weight in percent, from one scan of the years' rows: the date range reaches the scan."""
    ship = F.col("l_shipdate")
    rows = load(spark, sf_dir, "lineitem").where((ship >= F.lit(f"{min(years)}-01-01").cast("timestamp_ntz")) & (ship < F.lit(f"{max(years) + 1}-01-01").cast("timestamp_ntz")))
    held = rows.groupBy(F.year(ship).alias("y"), F.col("l_partkey").alias("stock_id")).agg(F.sum("l_quantity").alias("holdings"))
    total = held.groupBy("y").agg(F.sum("holdings").alias("t"))
    held = held.join(F.broadcast(total), "y").withColumn("weight", F.col("holdings") / F.col("t") * 100)
    return [held.where(F.col("y") == y).select("stock_id", "holdings", "weight") for y in years]


DIFF = """
with s as (select year(l_shipdate) y, l_partkey stock_id, sum(l_quantity) holdings from lineitem where year(l_shipdate) in (1998, 1999) group by 1, 2),
w as (select *, holdings / sum(holdings) over (partition by y) * 100 weight from s),
n as (select * from w where y = 1999), p as (select * from w where y = 1998),
d as (select coalesce(n.stock_id, p.stock_id) stock_id, coalesce(n.holdings, 0) holdings_now, coalesce(p.holdings, 0) holdings_prev,
  coalesce(n.weight, 0) weight_now, coalesce(p.weight, 0) weight_prev,
  case when p.stock_id is null then 'left_only' when n.stock_id is null then 'right_only' else 'both' end status
  from n full outer join p on n.stock_id is not distinct from p.stock_id)
"""


def whole_diff(spark, sf_dir):
    return holdings.diff(*snapshots(spark, sf_dir, 1999, 1998), "stock_id")


@query(DIFF + """select stock_id, holdings_now, holdings_prev, status, holdings_now - holdings_prev holdings_diff, round(weight_now - weight_prev, 6) weight_diff,
round((holdings_now - holdings_prev) / nullif(holdings_prev, 0) * 100, 6) change_pct from d""")
def holdings_diff(spark, sf_dir):
    d = whole_diff(spark, sf_dir)
    return d.select("stock_id", "holdings_now", "holdings_prev", "status", "holdings_diff", F.round("weight_diff", 6).alias("weight_diff"), F.round("change_pct", 6).alias("change_pct"))


@query(DIFF + "select stock_id, holdings_now, true is_new from d where status = 'left_only'")
def diff_new(spark, sf_dir):
    return whole_diff(spark, sf_dir).where("status = 'left_only'").select("stock_id", "holdings_now", F.lit(True).alias("is_new")).orderBy(F.desc("holdings_now"), "stock_id")


@query(DIFF + "select stock_id, holdings_prev from d where status = 'right_only'")
def diff_removed(spark, sf_dir):
    return whole_diff(spark, sf_dir).where("status = 'right_only'").select("stock_id", "holdings_prev").orderBy(F.desc("holdings_prev"), "stock_id")


@query(DIFF + """select stock_id, holdings_now - holdings_prev holdings_diff, case when holdings_now > holdings_prev then '▲' else '▼' end sign
from d where status = 'both' and abs(holdings_now - holdings_prev) > 0.5 order by abs(holdings_now - holdings_prev) desc, stock_id limit 15""")
def diff_top15(spark, sf_dir):
    return holdings.top_changes(whole_diff(spark, sf_dir), "stock_id").select("stock_id", "holdings_diff", "sign")


@query(DIFF + "select status, count(*) n, count(*) filter (abs(holdings_now - holdings_prev) > 0.5) changed from d group by 1")
def diff_summary(spark, sf_dir):
    return whole_diff(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"), F.count_if(F.abs("holdings_diff") > 0.5).alias("changed"))


# --- windows and dedup -------------------------------------------------------------------------


@query("""with e as (select *, cast(ts as date) d from events), r as (select *, dense_rank() over (partition by event_type order by d desc) k from e)
select event_id, event_type, d from r where k <= 2""")
def latest_two(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("d", F.col("ts").cast("date"))
    return relational.latest_n(e, ["event_type"], "d", 2).select("event_id", "event_type", "d")


@query("select distinct user_id from events where cast(ts as date) in (select distinct cast(ts as date) d from events order by d desc limit 7)")
def recent_n_ids(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("d", F.col("ts").cast("date"))
    return relational.latest_n(e, [], "d", 7).select("user_id").distinct()


LINE = "l_shipdate {0}, l_partkey {0}, l_suppkey {0}, l_quantity {0}, l_extendedprice {0}, l_discount {0}, l_tax {0}, l_returnflag {0}, l_linestatus {0}"


def keep_sql(way):
    return f"select l_orderkey, l_linenumber, l_partkey, l_quantity from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {LINE.format(way)}) k from lineitem) where k = 1"


def keep(spark, sf_dir, way):
    order = [F.expr(c.split()[0]).desc() if way == "desc" else F.expr(c.split()[0]).asc() for c in LINE.format(way).split(", ")]
    return relational.dedup(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(keep_sql("desc"))
def dedup_keep_last(spark, sf_dir):
    return keep(spark, sf_dir, "desc")


@query(keep_sql("asc"))
def dedup_keep_first(spark, sf_dir):
    return keep(spark, sf_dir, "asc")


@query("select user_id, event_type, cast(ts as date) d, arg_min(value, (ts, event_id)) first_value, bool_or(value > 200) is_new from events group by 1, 2, 3")
def or_flag_dedup(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("d"), "ts", "event_id", F.col("value").alias("first_value"), (F.col("value") > 200).alias("is_new"))
    return relational.flag_dedup(e, ["user_id", "event_type", "d"], ["ts", "event_id"], "is_new", ["first_value"])


@query("""with m as (select *, event_type = 'error' f, sum(case when event_type = 'error' then 0 else 1 end) over (partition by user_id order by ts, event_id) island from events)
select user_id, cast(island as bigint) island, count(*) run_length from m where f group by 1, 2 having count(*) >= 2""")
def failure_runs(spark, sf_dir):
    runs = relational.run_lengths(load(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return runs.where("run_length >= 2")


@query("""with f as (select o_custkey, arg_min(year(o_orderdate), (o_orderdate, o_orderkey)) y from orders group by 1)
select o_orderkey, o_custkey from orders where o_custkey in (select o_custkey from f where y = 1995)""")
def expected_date_gate(spark, sf_dir):
    return relational.expected_date_gate(load(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], F.year("o_orderdate"), 1995).select("o_orderkey", "o_custkey")


# --- joins -------------------------------------------------------------------------------------


@query("""with i as (select c_custkey id from customer union select o_custkey from orders union select user_id from events)
select id, coalesce(c_name, '') as name, c_custkey is not null in_customer, id in (select o_custkey from orders) in_orders, id in (select user_id from events) in_events
from i left join customer on id = c_custkey where id is not null""")
def id_universe(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    o, e = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), load(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    ids = c.select("id").union(o).union(e).where("id is not null").distinct()
    ids = relational.mark_join(ids, "id", in_customer=c.select("id"), in_orders=o, in_events=e)
    return relational.lookup_default(ids, c, "id", ["name"])


@query("select distinct o_custkey from orders where year(o_orderdate) = 1999 and o_custkey not in (select o_custkey from orders where year(o_orderdate) = 1998)")
def new_ids(spark, sf_dir):
    o = load(spark, sf_dir, "orders")

    def of(year):
        return o.where(f"o_orderdate >= timestamp_ntz'{year}-01-01' and o_orderdate < timestamp_ntz'{year + 1}-01-01'").select("o_custkey")

    return of(1999).distinct().join(of(1998), "o_custkey", "left_anti")


@query("select s_suppkey, coalesce(n_name, '') n_name from supplier left join (select * from nation where n_regionkey in (0, 2)) on s_nationkey = n_nationkey")
def lookup_default(spark, sf_dir):
    n = load(spark, sf_dir, "nation").where("n_regionkey in (0, 2)").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return relational.lookup_default(load(spark, sf_dir, "supplier"), n, "s_nationkey", ["n_name"]).select("s_suppkey", "n_name")


@query("""select r_name, coalesce(n_name, '') n_name from region left join (select * from nation where n_regionkey <> 3) on r_regionkey = n_regionkey""")
def one_to_many_lookup(spark, sf_dir):
    n = load(spark, sf_dir, "nation").where("n_regionkey <> 3").select(F.col("n_regionkey").alias("r_regionkey"), "n_name")
    return relational.lookup_default(load(spark, sf_dir, "region"), n, "r_regionkey", ["n_name"]).select("r_name", "n_name")


WORDS = [("greeting", "the"), ("greeting", "und"), ("legal", "license"), ("legal", "License"), ("mail", "@mail")]


@query("with w(label, word) as (values " + ", ".join(f"('{a}', '{b}')" for a, b in WORDS) + ") select distinct doc_id, label from documents join w on contains(text, word)")
def keyword_multi_match(spark, sf_dir):
    return notices.keyword_hits(load(spark, sf_dir, "documents"), "doc_id", "text", WORDS)


@query("""with s as (select s_suppkey k, s_name as name from supplier), c as (select c_custkey k, c_name as name from customer)
select * from s union all select * from c where k not in (select k from s)""")
def precedence_overlay(spark, sf_dir):
    s = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return relational.overlay(s, load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), "k")


# --- matching ----------------------------------------------------------------------------------

TICKERS = """with t as (select c_name as name, case c_custkey % 3 when 0 then cast(c_custkey as varchar) when 1 then '0' || c_custkey || 'T ' else '9 9' || c_custkey || 'X' end ticker from customer),
codes as (select cast(c_custkey as varchar) code from customer),
e as (select name, arg_min(code, ticker) code, 'ticker' as method from t join codes on replace(ticker, ' ', '') = code group by 1),
c as (select name, arg_min(code, ticker) code, 'ticker_cleaned' as method from t join codes on ltrim(rtrim(ticker, 'T '), '0') = code where name not in (select name from e) group by 1)
"""


def tickers(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    t = c.select(F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 == 0, key).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("0"), key, F.lit("T "))).otherwise(F.concat(F.lit("9 9"), key, F.lit("X"))).alias("ticker"))
    sets = t.groupBy("name").agg(F.array_sort(F.collect_set("ticker")).alias("tickers"))
    return sets, c.select(key.alias("code"))


@query(TICKERS + "select * from e union all select * from c")
def ticker_match(spark, sf_dir):
    return matching.by_ticker(*tickers(spark, sf_dir))


@query(TICKERS + ", m(name, code) as (select c_name, 'M' || c_nationkey from customer where c_nationkey < 5) select * from e union all select * from c union all select name, code, 'manual' from m where name not in (select name from e union select name from c)")
def cascade_match(spark, sf_dir):
    sets, codes = tickers(spark, sf_dir)
    manual = load(spark, sf_dir, "customer").where("c_nationkey < 5").select(F.col("c_name").alias("name"), F.concat(F.lit("M"), F.col("c_nationkey").cast("string")).alias("code"), F.lit("manual").alias("method"))
    return matching.cascade(sets.select("name"), matching.by_ticker(sets, codes), manual)


@query(TICKERS + "select name from t where name not in (select name from e union select name from c)")
def unmatched_names(spark, sf_dir):
    sets, codes = tickers(spark, sf_dir)
    return sets.join(matching.by_ticker(sets, codes), "name", "left_anti").select("name")


def norm_sql(c: str) -> str:
    out = f"lower(trim({c}))"
    for part in scalars.NAME_PARTS:
        out = f"replace({out}, '{part}', '')"
    return f"trim(regexp_replace(regexp_replace({out}, '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))"


#: Every part is a listed company and a held name, written in several ways.
STOCKS_SQL = """stocks as (select p_partkey ordinal, 'P' || p_partkey code,
case p_type when 'STANDARD' then p_name || ' Corp.' when 'PROMO' then 'The ' || p_name || ' ' || p_brand || ' Works' else p_name || ' ' || p_brand || ' ' || p_size || ' International Co., Ltd' end eng from part)"""
NAMES_SQL = """names as (select distinct case when p_size <= 10 then p_name when p_size <= 25 then p_name || ' ' || lower(p_type) when p_size <= 40 then p_name || ' ' || p_brand || ' ' || p_type
else string_split(p_name, ' ')[2] || ' ' || string_split(p_name, ' ')[1] || ' ' || p_size end as name from part)"""
MATCHED = f"""n as (select name, {norm_sql("name")} a from names), s as (select ordinal, code, {norm_sql("eng")} b from stocks)"""
CONTAINS = MATCHED + """, na as (select distinct a from n), sb as (select b, min(ordinal) ordinal from s where length(b) >= 3 group by b),
hit as (select a, ordinal, case when a = b then 0 when contains(a, b) and length(b) >= 5 then 1 else 2 end t from na join sb on a = b or (contains(a, b) and length(b) >= 5) or (contains(b, a) and length(a) >= 5) where a <> ''),
best as (select a, min((ordinal, t)) m from hit group by a),
held as (select name, code, list_value('exact', 'contains', 'reverse_contains')[m[2] + 1] as method from n join best using (a) join s on s.ordinal = m[1])"""


def keeper(spark):
    """Writes what it is given to a scratch folder and reads it."""
    path = scratch(spark)
    return lambda df: spark.read.schema(df.schema).parquet(sinks.snapshot(df, path))


def listed(spark, sf_dir):
    """Names and the catalogue of stocks, both of all parts."""
    p = load(spark, sf_dir, "part")
    eng = F.when(F.col("p_type") == "STANDARD", F.concat("p_name", F.lit(" Corp."))).when(F.col("p_type") == "PROMO", F.concat(F.lit("The "), "p_name", F.lit(" "), "p_brand", F.lit(" Works")))
    eng = eng.otherwise(F.concat("p_name", F.lit(" "), "p_brand", F.lit(" "), F.col("p_size").cast("string"), F.lit(" International Co., Ltd")))
    name = F.when(F.col("p_size") <= 10, F.col("p_name")).when(F.col("p_size") <= 25, F.concat("p_name", F.lit(" "), F.lower("p_type"))).when(F.col("p_size") <= 40, F.concat_ws(" ", "p_name", "p_brand", "p_type"))
    turned = F.split("p_name", " ")
    name = name.otherwise(F.concat_ws(" ", turned[1], turned[0], F.col("p_size").cast("string")))
    return p.select(name.alias("name")).distinct(), p.select(F.col("p_partkey").alias("ordinal"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"), eng.alias("eng"))


@query(f"with {STOCKS_SQL}, {NAMES_SQL}, {CONTAINS} select * from held")
def contains_match(spark, sf_dir):
    """Names that are, hold or are held by a stock's name, over the whole catalogue in one pass each way."""
    return matching.by_containment(*listed(spark, sf_dir), keep=keeper(spark))


@query(f"with {STOCKS_SQL}, {NAMES_SQL}, {MATCHED} select name, arg_max(code, ordinal) code, 'exact_norm' as method from n join s on a = b where length(b) > 1 group by 1")
def normal_name_match(spark, sf_dir):
    return matching.by_normal_name(*listed(spark, sf_dir))


RULES = [("hot plate", "GOV")]


@query(f"""with {STOCKS_SQL}, {NAMES_SQL}, {CONTAINS},
g as (select name, 'GOV' code, 'manual' as method from names where contains(lower(name), 'hot plate')),
x as (select name, arg_max(code, ordinal) code, 'exact_norm' as method from n join s on a = b where length(b) > 1 group by 1),
o as (select name, ordinal, code, len(list_intersect(u, v)) c, len(list_intersect(u, v)) / greatest(len(u), len(v)) score from (select name, list_distinct(string_split(a, ' ')) u from n), (select ordinal, code, list_distinct(string_split(b, ' ')) v from s)
  where len(u) >= 2 and len(v) >= 2 and len(list_intersect(u, v)) >= 2),
w as (select name, code, 'word_match(' || printf('%.2f', score) || ')' as method from (select *, row_number() over (partition by name order by score desc, ordinal) k from o where score >= 0.5) where k = 1),
every as (select *, 0 t from g union all select *, 1 from x union all select *, 2 from held union all select *, 3 from w)
select name, code, method from (select *, row_number() over (partition by name order by t) r from every) where r = 1""")
def name_cascade(spark, sf_dir):
    names, stocks = listed(spark, sf_dir)
    keep = keeper(spark)
    return matching.in_turn(
        names, keep, lambda rest: matching.by_rule(rest, RULES), lambda rest: matching.by_normal_name(rest, stocks), lambda rest: matching.by_containment(rest, stocks, keep=keep),
        lambda rest: matching.by_words(rest, stocks).withColumn("method", matching.word_label(F.col("score"))),
    )


@query("""with n as (select distinct p_name || ' ' || lower(p_type) as name from part), s as (select p_partkey ordinal, 'P' || p_partkey code, p_name || ' ' || lower(p_type) eng from part),
nw as (select name, list_distinct(string_split(lower(name), ' ')) w from n), sw as (select ordinal, code, list_distinct(string_split(lower(eng), ' ')) w from s),
m as (select name, code, ordinal, len(list_intersect(nw.w, sw.w)) c, round(len(list_intersect(nw.w, sw.w)) / greatest(len(nw.w), len(sw.w)), 6) score from nw, sw where len(list_intersect(nw.w, sw.w)) >= 2)
select name, code, ordinal, cast(score as double) score from (select *, row_number() over (partition by name order by score desc, ordinal) k from m where score >= 0.5) where k = 1""")
def word_match(spark, sf_dir):
    p = load(spark, sf_dir, "part").withColumn("name", F.concat_ws(" ", "p_name", F.lower("p_type")))
    s = p.select(F.col("p_partkey").alias("ordinal"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"), F.col("name").alias("eng"))
    return matching.by_words(p.select("name").distinct(), s).withColumn("score", F.round("score", 6))


@query("select c_nationkey, list_sort(list(distinct c_mktsegment)) segments from customer group by 1")
def ticker_sets(spark, sf_dir):
    c = load(spark, sf_dir, "customer").withColumn("t", F.when(F.col("c_acctbal") < 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))))
    found = matching.ticker_sets(c.unionByName(c.withColumn("t", F.col("c_mktsegment"))), "c_nationkey", "t")
    return found.select("c_nationkey", F.col("tickers").alias("segments"))


OFFICIAL = "'Acer Enterprises International Co., Ltd./Taiwan ' || c_name"


@query(f"select c_custkey, {norm_sql(OFFICIAL)} as norm from customer")
def normalize_name(spark, sf_dir):
    return load(spark, sf_dir, "customer").select("c_custkey", scalars.normalize_name(F.concat(F.lit("Acer Enterprises International Co., Ltd./Taiwan "), F.col("c_name"))).alias("norm"))


# --- upserts -----------------------------------------------------------------------------------

UPSERT = """with old as (select o_custkey, cast(o_orderdate as date) d, o_orderkey, o_totalprice from orders),
new as (select o_custkey, d, o_orderkey, o_totalprice + 1 o_totalprice from old join (select o_orderkey k from orders where o_orderpriority = '1-URGENT') on k = o_orderkey where d between date '1998-01-01' and date '1998-03-31'),
touched as (select distinct o_custkey from new),
mix as (select *, 0 src from old where o_custkey in (select o_custkey from touched) and not d between date '1998-01-01' and date '1998-03-31' union all select *, 1 from new),
up as (select o_custkey, d, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey, d order by src desc, o_orderkey desc, o_totalprice desc) k from mix) where k = 1
       union all select * from old where o_custkey not in (select o_custkey from touched))
"""


UPSERT_WINDOW = ("1998-01-01", "1998-03-31")


def upsert_inputs(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    old = orders.select("o_custkey", "d", "o_orderkey", "o_totalprice")
    new = orders.where("o_orderpriority = '1-URGENT' and d between date'1998-01-01' and date'1998-03-31'").select("o_custkey", "d", "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return old, new


def upserted(spark, sf_dir):
    old, new = upsert_inputs(spark, sf_dir)
    out = relational.windowed_upsert(old, new, "o_custkey", ["o_custkey", "d"], "d", *UPSERT_WINDOW, [F.desc("o_orderkey"), F.desc("o_totalprice")])
    return old, out


@query(UPSERT + "select o_custkey, d, o_orderkey, round(o_totalprice, 2) o_totalprice from up")
def windowed_upsert(spark, sf_dir):
    return upserted(spark, sf_dir)[1].select("o_custkey", "d", "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query(UPSERT + """, a as (select o_custkey, list_sort(list((d, o_orderkey, o_totalprice))) l from old group by 1), b as (select o_custkey, list_sort(list((d, o_orderkey, o_totalprice))) l from up group by 1)
select case when a.l is null then 'created' when b.l is null then 'removed' when a.l = b.l then 'unchanged' else 'updated' end change_type, count(*) n from a full join b using (o_custkey) group by 1""")
def upsert_stats(spark, sf_dir):
    return relational.change_types(*upserted(spark, sf_dir), "o_custkey").groupBy("change_type").agg(F.count("*").alias("n"))


@query("""with p(k, s) as (values (1, 'X'), (2, 'Y'), (-5, 'Z')) select coalesce(o_orderkey, k) o_orderkey, coalesce(s, o_orderstatus) o_orderstatus, o_custkey from orders full join p on o_orderkey = k""")
def corrections(spark, sf_dir):
    patch = spark.createDataFrame([(1, "X"), (2, "Y"), (-5, "Z")], "o_orderkey long, o_orderstatus string")
    return relational.corrections(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"), patch, "o_orderkey")


@query(UPSERT + "select o_custkey, d, o_orderkey, round(o_totalprice, 2) o_totalprice from up")
def entity_sink(spark, sf_dir):
    """The upsert written to a table of customers: of its buckets only those with a changed customer are written again."""
    old, merged = upserted(spark, sf_dir)
    path = scratch(spark)
    sinks.entities(old, path, "o_custkey")
    sinks.entities(merged, path, "o_custkey", changed=relational.change_types(old, merged, "o_custkey").where("change_type <> 'unchanged'"))
    return spark.read.parquet(path).select("o_custkey", "d", "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("select event_id, user_id from events where event_id not in (select event_id from events where event_type = 'click')")
def manifest_dedup(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return coverage.pending(e.select("event_id"), e.where("event_type = 'click'").select("event_id")).join(e, "event_id").select("event_id", "user_id")


# --- calendars ---------------------------------------------------------------------------------

CAL = {
    "cal_weekday": ("weekday", "isodow(d) < 6"), "cal_mon_sat": ("mon_sat", "isodow(d) <> 7"), "cal_all": ("all", "true"), "cal_monday": ("monday", "isodow(d) = 1"),
    "cal_month_clamped": ("month_clamped", "day(d) = 1"), "cal_quarter_end": ("quarter_end", "d = last_day(d) and month(d) in (3, 6, 9, 12)"), "cal_month_unclamped": ("month_unclamped", "day(d) = 1"),
}


def _calendar(name, rule, where):
    """Each order priority's days of a rule, from its first order to its last."""

    def run(spark, sf_dir):
        day = F.col("o_orderdate").cast("date")
        asked = load(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("dataset")).agg(F.min(day).alias("a"), F.max(day).alias("b"))
        return calendars.spans(asked, "a", "b", rule).select("dataset", "d")

    start = "date_trunc('month', a)" if rule == "month_unclamped" else "a"
    QUERIES[name] = run
    SQL[name] = f"""with s as (select o_orderpriority dataset, min(o_orderdate)::date a, max(o_orderdate)::date b from orders group by 1),
e as (select dataset, unnest(generate_series({start}, b, interval 1 day))::date d from s) select dataset, d from e where {where}"""


for _name, _rule in CAL.items():
    _calendar(_name, *_rule)


@query("select o_orderkey, cast(o_orderdate as date) - (case isodow(o_orderdate) when 1 then 3 when 7 then 2 else 1 end)::int prev from orders")
def prev_weekday(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", scalars.previous_weekday(F.col("o_orderdate").cast("date")).alias("prev"))


@query("select event_id from events where cast(ts as date) between (select max(cast(ts as date)) - 40 from events) and (select max(cast(ts as date)) from events)")
def rolling_window(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("d", F.col("ts").cast("date"))
    low, high = catalog.rolling_window(F.col("today"), 40)
    return e.crossJoin(F.broadcast(e.agg(F.max("d").alias("today")))).where(F.col("d").between(low, high)).select("event_id")


@query("select event_id from events where hour(ts) * 60 + minute(ts) >= 480 and hour(ts) * 60 + minute(ts) < 870")
def blackout_filter(spark, sf_dir):
    return load(spark, sf_dir, "events").where(scalars.in_blackout(F.col("ts"), 480, 870)).select("event_id")


CATALOGUE = [catalog.Dataset("Price", "daily", "1995-01-01"), catalog.Dataset("Futures", "daily_mon_sat", "1999-01-01"), catalog.Dataset("Week", "weekly", "1999-06-01"), catalog.Dataset("Info", "snapshot", "1990-01-01"), catalog.Dataset("Index", "range_snapshot", "1990-01-01"), catalog.Dataset("Revenue", "per_stock", "1995-01-01")]


@query("""with d as (select cast(unnest(generate_series(date '1999-06-01', date '1999-08-09', interval 1 day)) as date) d)
select 'Price' dataset, cast(null as varchar) unit, d, d from_date, d to_date from d where isodow(d) < 6 union all select 'Futures', null, d, d, d from d where isodow(d) < 7 union all select 'Week', null, d, d, d from d where isodow(d) = 1
union all select 'Info', null, null, date '1999-06-01', date '1999-08-09' union all select 'Index', null, null, date '1990-01-01', date '1999-08-09' union all select 'Revenue', n_name, null, date '1999-06-01', date '1999-08-09' from nation""")
def request_plan(spark, sf_dir):
    units = load(spark, sf_dir, "nation").select(F.col("n_name").alias("unit"))
    return catalog.request_plan(spark, CATALOGUE, "1999-06-01", "1999-08-09", units).drop("mode")


# --- coverage ----------------------------------------------------------------------------------


def landed(spark, sf_dir):
    return load(spark, sf_dir, "events").where("value > 150").select(F.col("event_type").alias("dataset"), F.col("ts").cast("date").alias("d"))


def expected(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    span = e.agg(F.min(F.col("ts").cast("date")).alias("a"), F.max(F.col("ts").cast("date")).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("d")).where("weekday(d) < 5")
    return e.select(F.col("event_type").alias("dataset")).distinct().crossJoin(F.broadcast(days))


LANDED = """with l as (select distinct event_type dataset, cast(ts as date) d from events where value > 150),
days as (select cast(unnest(generate_series((select min(cast(ts as date)) from events), (select max(cast(ts as date)) from events), interval 1 day)) as date) d),
x as (select dataset, d from (select distinct event_type dataset from events), days where isodow(d) < 6)
"""


@query(LANDED + """, c as (select x.dataset, count(*) candidates, count(l.d) done from x left join l on x.dataset = l.dataset and x.d = l.d group by 1), s as (select dataset, count(*) landed_all, min(d) first_day, max(d) last_day from l group by 1)
select c.dataset, candidates, done, coalesce(landed_all, 0) landed_all, first_day, last_day, round(done / candidates * 100, 4) pct from c left join s on c.dataset = s.dataset""")
def completeness(spark, sf_dir):
    return coverage.completeness(expected(spark, sf_dir), landed(spark, sf_dir))


@query(LANDED + "select dataset, d from x except select dataset, d from l")
def pending_partitions(spark, sf_dir):
    return coverage.pending(expected(spark, sf_dir), landed(spark, sf_dir))


@query("""select o_orderpriority, count(*) filter (s = 'ok') ok, count(*) filter (s = 'skip') skip, count(*) filter (s = 'fail') fail from
(select *, case o_orderstatus when 'F' then 'ok' when 'O' then 'skip' else 'fail' end s from orders) group by 1""")
def status_histogram(spark, sf_dir):
    o = load(spark, sf_dir, "orders").withColumn("s", F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "skip").otherwise("fail"))
    return coverage.status_histogram(o, "o_orderpriority", "s", ["ok", "skip", "fail"])


@query(LANDED + "select x.dataset, x.d, (select max(l.d) from l where l.dataset = x.dataset and l.d <= x.d and isodow(l.d) < 6 and date_diff('day', l.d, x.d) < 21) latest from x")
def latest_day_with_data(spark, sf_dir):
    """The last of 15 weekdays up to each day with landed data."""
    return coverage.latest_before(expected(spark, sf_dir), landed(spark, sf_dir))


@query("""with b as (select source dataset, cast(sum(n_chars::hugeint * 1024 * 1024) as bigint) bytes from documents group by rollup(source))
select dataset, bytes, case when bytes < 1024 then printf('%.1fB', bytes::double) when bytes < 1048576 then printf('%.1fKB', bytes / 1024) when bytes < 1073741824 then printf('%.1fMB', bytes / 1048576)
when bytes < 1099511627776 then printf('%.1fGB', bytes / 1073741824) when bytes < 1125899906842624 then printf('%.1fTB', bytes / 1099511627776) else printf('%.1fPB', bytes / 1125899906842624) end size from b""")
def rollup_total(spark, sf_dir):
    return coverage.sizes(load(spark, sf_dir, "documents").select(F.col("source").alias("dataset"), (F.col("n_chars") * 1024 * 1024).alias("length")))


@query("select o_orderpriority, count(*) n from orders group by 1")
def group_count(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("select l_returnflag, count(distinct l_partkey) parts from lineitem group by 1")
def distinct_count(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))


@query("select o_orderstatus, count(*) filter (o_totalprice > 150000) big, bool_and(o_totalprice > 0) positive from orders group by 1")
def cond_count(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count_if(F.col("o_totalprice") > 150000).alias("big"), F.bool_and(F.col("o_totalprice") > 0).alias("positive"))


@query("select event_type, array_to_string(list_slice(list_sort(list(event_id)), 1, 30), ', ') failed from events where value > 100 group by 1")
def failure_list(spark, sf_dir):
    failed = load(spark, sf_dir, "events").where("value > 100").select("event_type", F.col("event_id").alias("failed"))
    return relational.first_n(failed, "event_type", "failed", 30)


@query("select n_regionkey, list_transform(list_sort(list((n_nationkey, n_name))), lambda x: x[2]) n_names from nation group by 1")
def ordered_list(spark, sf_dir):
    return relational.ordered_list(load(spark, sf_dir, "nation"), "n_regionkey", "n_nationkey", "n_name")


PAGED = "e as (select event_id, cast(ts as date) d, (row_number() over (order by ts desc, event_id) - 1) // 50 page from events)"


@query(f"with {PAGED}, stop as (select min(page) p from (select page, max(d) m from e group by 1) where m < date '2024-01-20') select event_id, d from e where page <= coalesce((select p from stop), page)")
def paging_until_older(spark, sf_dir):
    """Event pages, newest first, up to the first that lies wholly before a date."""
    e = load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("d"), "ts")
    rank = F.row_number().over(Window.partitionBy("d").orderBy(F.desc("ts"), "event_id"))
    # pages run over the whole list: rank within a day plus the rows of later days
    days = e.groupBy("d").agg(F.count("*").alias("n")).withColumn("later", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    paged = e.withColumn("r", rank).join(F.broadcast(days), "d").withColumn("page", F.floor((F.col("r") + F.col("later") - 1) / 50))
    return relational.until_older(paged.select("event_id", "d", "page"), "page", "d", F.lit("2024-01-20").cast("date")).select("event_id", "d")


@query("select o_orderkey, o_orderpriority from orders where o_orderstatus in ('F', 'O')")
def truth_filter(spark, sf_dir):
    cell = F.when(F.col("o_orderstatus") == "F", "TRUE").when(F.col("o_orderstatus") == "O", "1").when(F.col("o_orderpriority") == "5-LOW", "0")
    return load(spark, sf_dir, "orders").where(scalars.truthy(cell)).select("o_orderkey", "o_orderpriority")


@query("select c_custkey from customer where c_nationkey < 20 and c_mktsegment <> 'BUILDING'")
def subscription_filter(spark, sf_dir):
    status, message = F.when(F.col("c_nationkey") < 20, 200).when(F.col("c_nationkey") < 23, 402), F.when(F.col("c_mktsegment") == "BUILDING", "已到期").when(F.col("c_mktsegment") == "MACHINERY", "ok")
    return load(spark, sf_dir, "customer").where(scalars.subscribed(status, message)).select("c_custkey")


@query("select s_suppkey, strftime(date '2024-01-01' + s_suppkey::int, '%Y%m%d') d from supplier")
def file_name_date(spark, sf_dir):
    name = F.concat(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_suppkey").cast("int")), "yyyyMMdd"), F.lit("_"), F.col("s_name"), F.lit("_x.csv"))
    return load(spark, sf_dir, "supplier").select("s_suppkey", scalars.name_prefix(name).alias("d"))


@query("""with o as (select o_orderkey, cast(o_orderdate as date) a, cast(o_orderdate as date) + 40 b from orders), l as (select o_orderkey, generate_series(a, b, interval 1 day) dd from o)
select o_orderkey, len(list_filter(dd, lambda x: isodow(x) < 6)) weekdays, len(list_filter(dd, lambda x: isodow(x) < 7)) mon_sat, len(list_filter(dd, lambda x: isodow(x) = 1)) mondays, len(list_filter(dd, lambda x: day(x) = 1)) first_days from l""")
def day_counts(spark, sf_dir):
    a = F.col("o_orderdate").cast("date")
    names = {"weekdays": "weekday", "mon_sat": "mon_sat", "mondays": "monday", "first_days": "month_clamped"}
    return load(spark, sf_dir, "orders").select("o_orderkey", *(calendars.day_count(a, F.date_add(a, 40), rule).cast("long").alias(n) for n, rule in names.items()))


@query("""select p_partkey, rpad(repeat('#', floor(least(p_size, 100) / 100 * 20)::int), 20, '-') bar, replace(replace(p_name, 'a', ''), ':', '') safe, date '1899-12-30' + p_size d from part""")
def text_cleaners(spark, sf_dir):
    """Progress bars, file names without the signs that file systems refuse, and days from serial numbers."""
    name = F.concat(F.lit(" "), F.replace("p_name", F.lit("a"), F.lit('/:"')), F.lit("\n"))
    return load(spark, sf_dir, "part").select("p_partkey", scalars.progress_bar(F.col("p_size")).alias("bar"), scalars.safe_file_name(name).alias("safe"), scalars.from_excel_serial(F.col("p_size")).alias("d"))


# --- scalars -----------------------------------------------------------------------------------


@query("""select event_id, coalesce(nullif(json_extract_string(props, '$.missing'), ''), nullif(json_extract_string(props, '$.k'), ''), '') v from events""")
def json_flatten(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", scalars.falsy_coalesce(F.get_json_object("props", "$.missing"), F.get_json_object("props", "$.k")).alias("v"))


@query("select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'filled' else o_orderstatus end label from orders")
def enum_map(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", scalars.enum_label(F.col("o_orderstatus"), {"O": "open", "F": "filled"}).alias("label"))


@query("select date '2024-03-01' as date, cast(p_partkey as varchar) stock_id, cast(p_size as double) weight_pct, p_partkey * 1234 / 1000 holdings, p_brand etf, cast(0 as int) ordinal from part")
def positional_rows(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    row = F.array(F.lit("20240301"), F.col("p_partkey").cast("string"), F.lit("x"), F.col("p_size").cast("string"), F.format_number(F.col("p_partkey") * 1234, 0))
    payload = F.to_json(F.struct(F.array(*(F.lit(x) for x in "abcde")).alias("Title"), F.array(row).alias("Data")))
    return readers.positional_rows(p.select("p_brand", payload.alias("payload")), "payload", "p_brand")


@query("select o_orderkey, floor(o_totalprice * 100) / 1000 lots from orders")
def thousands_to_lots(spark, sf_dir):
    text = F.format_number(F.floor(F.col("o_totalprice") * 100), 0)
    return load(spark, sf_dir, "orders").select("o_orderkey", scalars.to_lots(text).alias("lots"))


@query("""select doc_id, length(regexp_replace(text, '[ \t\n\r\f\v   -     　\u0085\x1c-\x1f]+', '', 'g')) n from documents""")
def norm_whitespace(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", F.length(scalars.norm_whitespace(F.col("text"))).cast("long").alias("n"))


@query("""select page_id, href, label from (select *, row_number() over (partition by page_id, href order by k) r from (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) href,
unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) label, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1), 1) k from pages)) where r = 1""")
def html_rows(spark, sf_dir):
    return notices.list_entries(load(spark, sf_dir, "pages"), r'<a href="([^"]*)">([^<]*)</a>', ["href", "label"])


def notice_texts(spark, sf_dir):
    """Notices made from suppliers, in both languages, with what makes them hard to read."""
    s = load(spark, sf_dir, "supplier")
    code = F.lpad((F.col("s_suppkey") % 9000 + 1000).cast("string"), 4, "0")
    text = F.concat(
        F.lit("「特選臺灣"), F.col("s_suppkey").cast("string"), F.lit("\n 指數 」定期審核\n2026/06/09\n定審資料日 (20260529)，自 2026 年 6 月 26 日 （星期五）起生效\n成分股納入(2)：\n臺灣證券交易所掛牌股票：\n"), code,
        F.lit(" 瑞\n昱、1101B 台泥乙特\n成分股刪除 （ 2 ）：3673 TPK-KY、6456GIS-KY\n* 9998 註\nReview Result\nInclusions(3): 5871 Chailease  Holding, 1101B TCC\nExclusions(1): 3673 TPK\n 2330 TSMC"),
    )
    return s.select(F.col("s_suppkey").alias("notice_id"), text.alias("text"))


NOTICES = """rows(action, code, name) as (values ('add', null, '瑞昱'), ('add', '1101B', '台泥乙特'), ('add', '5871', 'Chailease Holding'), ('delete', '3673', 'TPK-KY'), ('delete', '6456', 'GIS-KY'), ('delete', '2330', 'TSMC')),
parsed as (select s_suppkey notice_id, '特選臺灣' || s_suppkey || '指數' index_name, date '2026-06-09' announce_date, date '2026-05-29' review_date, date '2026-06-26' effective_date, action,
coalesce(code, lpad((s_suppkey % 9000 + 1000)::varchar, 4, '0')) code, name from supplier, rows)"""


@query(f"with {NOTICES} select * from parsed")
def section_slice(spark, sf_dir):
    return notices.parse(notice_texts(spark, sf_dir))


@query("""with r(name, a, e) as (values ('臺灣高股息指數', date '2026-06-09', date '2026-06-26'), ('臺灣科技指數', date '2026-12-01', date '2026-12-21'))
select s_suppkey notice_id, '2026年6月份審核日程表' report_title, date '2026-05-20' update_date, s_suppkey || name index_name, a announce_date, e effective_date from supplier, r""")
def schedule_rows(spark, sf_dir):
    key = F.col("s_suppkey").cast("string")
    text = F.concat(F.lit("2026 年 6 月份 審核日程表\n更新日期 ：2026/5/20\n指數 公告日期 2026/1/1\n"), key, F.lit(" 臺灣高股息 指數 2026/6/09 2026/06/26\n休市 2026/06/19 2026/06/20\n"), key, F.lit("臺灣科技指數　2026/12/1　(2026/12/21) 2027/01/01"))
    return notices.schedule(load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("notice_id"), text.alias("text")))


TRACKED = [("00X", "指數"), ("00Y", "特選臺灣7")]


@query(f"""with {NOTICES}, hits as (select notice_id, '00X' as label from parsed union select notice_id, '00Y' from parsed where contains(index_name, '特選臺灣7')),
found as (select label, announce_date, action, code, min(review_date) review_date, min(effective_date) effective_date from hits join parsed using (notice_id) group by all)
select coalesce(f.label, g.label) as label, coalesce(f.announce_date, g.d) announce_date, coalesce(f.action, g.action) as action, coalesce(f.code, g.code) code,
case when f.label is null then g.r else review_date end review_date, case when f.label is null then g.e else effective_date end effective_date, g.label is not null is_new
from found f full join (values ('00X', 'add', '5871', date '2026-06-09', date '2020-01-01', date '2020-01-02'), ('00Z', 'add', '0050', date '2003-06-25', null, date '2003-06-30')) g(label, action, code, d, r, e)
on f.label = g.label and f.action = g.action and f.code = g.code and f.announce_date = g.d""")
def history_rebuild(spark, sf_dir):
    """The tracked history, rebuilt from the landed notices and founding rows."""
    texts = notice_texts(spark, sf_dir)
    rows = notices.parse(texts)
    hits = notices.keyword_hits(rows.select("notice_id", "index_name").distinct(), "notice_id", "index_name", TRACKED)
    day = lambda x: x and datetime.date.fromisoformat(x)
    founding = [("00X", "2026-06-09", "2020-01-01", "2020-01-02", "add", "5871"), ("00Z", "2003-06-25", None, "2003-06-30", "add", "0050")]
    founding = spark.createDataFrame([(a, day(b), day(c), day(d), e, f) for a, b, c, d, e, f in founding], "label string, announce_date date, review_date date, effective_date date, action string, code string")
    return notices.history(hits, rows, founding)


@query("""with e(k, n, cc, ty, e, nn, o, s, vid, icc, v) as (values (0, 'Acer', 'TW', '0', 1.5, 10.0, 0.1, 'Tech', '2353', 'KY', 0.2), (1, 'Bond', 'TW', '1', null, null, null, 'Gov', 'B1', null, null), (2, 'Odd', null, '9', 3.0, null, null, '', '', null, null))
select s_name period, date '2024-12-31' period_date, s_suppkey % 2 = 0 interim, n company_name, cc country_code, case ty when '0' then 'Equity' when '1' then 'Fixed Income' else ty end asset_type, e::double market_value_nok, nn::double nominal_value, o::double ownership_pct, s sector, vid ticker, icc incorporation_country, v::double voting_pct
from supplier, e""")
def fund_holdings(spark, sf_dir):
    """Fund payloads made from suppliers, their data a list or an object that holds one."""
    entries = '[{"n":"Acer","cc":"TW","at":0,"o":0.1,"a":{"e":1.5,"n":10},"eq":{"s":"Tech","vid":"2353","icc":"KY","v":0.2}},{"n":"Bond","cc":"TW","at":1,"eq":{"s":""},"fi":{"s":"Gov","vid":"B1"}},{"n":"Odd","at":9,"a":{"e":3}}]'
    even = F.col("s_suppkey") % 2 == 0
    payload = F.concat(F.lit('{"date":"2024-12-31T00:00:00","interim":'), F.when(even, "true").otherwise("false"), F.lit(',"data":'), F.when(F.col("s_nationkey") < 12, F.lit(entries)).otherwise(F.lit('{"data":' + entries + "}")), F.lit("}"))
    return readers.fund_entries(load(spark, sf_dir, "supplier").select("s_name", payload.alias("payload")), "payload", "s_name")


@query("select o_orderkey, cast(o_orderdate as date) d1, cast(o_orderdate as date) d2, cast(o_orderdate as date) d3 from orders")
def date_parse_any(spark, sf_dir):
    o = load(spark, sf_dir, "orders").withColumn("d", F.add_months(F.col("o_orderdate").cast("date"), 360))
    forms = [scalars.parse_date_any(F.date_format("d", p)) for p in ("yyyy年M月d日", "yyyy/MM/dd", "yyyyMMdd")]
    return o.select("o_orderkey", *(F.when(f == F.col("d"), F.col("o_orderdate").cast("date")).alias(f"d{k + 1}") for k, f in enumerate(forms)))


@query("select o_orderkey, cast(date_diff('day', date '1899-12-30', cast(o_orderdate as date)) as int) serial from orders")
def excel_serial(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", scalars.excel_serial(F.col("o_orderdate").cast("date")).alias("serial"))


@query("select n_nationkey k, n_name as name, cast(null as double) bal from nation union all select s_suppkey, s_name, s_acctbal from supplier")
def align_columns(spark, sf_dir):
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("bal"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("k"))
    return relational.align(relational.union_all(n, s), ["k", "name", "bal", "missing"])


@query("select cast(user_id as bigint) user_id, event_id, coalesce(lead(event_id) over (partition by user_id order by event_id), 1000000000) as until from events")
def next_boundary(spark, sf_dir):
    return notices.next_boundary(load(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", "event_id", F.lit(1000000000).cast("long"))


# --- sources, sinks, streams -------------------------------------------------------------------


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("select unnest([" + ", ".join(f"'{t}'" for t in TABLES) + "]) as name, true has_bytes")
def file_listing(spark, sf_dir):
    """The landed tables by the listing of their files, one file or many each; contents aren't read."""
    files = readers.listing(spark, sf_dir, "*.parquet").withColumn("table", F.regexp_extract("path", r"([^/]+)\.parquet(/|$)", 1))
    return files.where(F.col("table").isin(*TABLES)).groupBy(F.col("table").alias("name")).agg((F.sum("length") > 0).alias("has_bytes"))


def scratch(spark) -> str:
    """A new folder that all executors share; a machine-local one only with a local master and none configured."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{shared}/roundtrip-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp()


@query("select o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::int as year from orders")
def roundtrip_parquet(spark, sf_dir):
    path = scratch(spark)
    sinks.dated(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year")), path, ["year"], ["o_orderkey"])
    return spark.read.parquet(path)


@query("select s_suppkey, s_name from supplier")
def roundtrip_csv(spark, sf_dir):
    path = scratch(spark)
    sinks.csv(load(spark, sf_dir, "supplier"), path, ["s_suppkey", "s_name"])
    return readers.csv(spark, path, "s_suppkey long, s_name string")


@query("select s_suppkey k, s_name as name from supplier union all select n_nationkey, n_name from nation")
def csv_append(spark, sf_dir):
    path = scratch(spark)
    sinks.csv(load(spark, sf_dir, "supplier").withColumnsRenamed({"s_suppkey": "k", "s_name": "name"}), path, ["k", "name"])
    sinks.csv(load(spark, sf_dir, "nation").withColumnsRenamed({"n_nationkey": "k", "n_name": "name"}), path, ["k", "name"], append=True)
    return readers.csv(spark, path, "k long, name string")


@query("select n_nationkey, n_name from nation")
def snapshot_versions(spark, sf_dir):
    """A new version beside the old one: who reads the old isn't disturbed, the new one is whole."""
    path = scratch(spark)
    old = spark.read.parquet(sinks.snapshot(load(spark, sf_dir, "nation").select("n_nationkey", "n_name").where("n_nationkey < 10"), path))
    new = sinks.snapshot(load(spark, sf_dir, "nation").select("n_nationkey", "n_name").where("n_nationkey >= 10"), path)
    return old.unionByName(spark.read.parquet(new))


@query("select distinct cast(o_orderdate as date) d from orders")
def date_list(spark, sf_dir):
    """Days written as lines, with blank ones among them, and read back."""
    path = scratch(spark)
    days = load(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    sinks.lines(days.select(F.explode(F.array(F.concat(F.lit(" "), F.col("d").cast("string")), F.lit(""))).alias("line")), "line", path)
    return readers.date_list(spark, path)


@query("select n_nationkey, n_name from nation where n_regionkey <> 3")
def json_envelopes(spark, sf_dir):
    """Responses {status, msg, data}, one a region, of which those with status 200 give rows."""
    path = scratch(spark)
    n = load(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list(F.struct("n_nationkey", "n_name")).alias("data"))
    sinks.json(n.select(F.when(F.col("n_regionkey") == 3, 402).otherwise(200).alias("status"), F.lit("msg").alias("msg"), "data").repartition(8), path)
    return readers.envelope(spark, path, "n_nationkey:int, n_name:string")


@query("select c_custkey, c_name, c_acctbal from customer")
def roundtrip_json(spark, sf_dir):
    path = scratch(spark)
    sinks.json(load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return spark.read.schema("c_custkey long, c_name string, c_acctbal double").json(path)


def events_stream(spark, sf_dir):
    """The events table as a file stream: where it is one file, that file of its folder."""
    source = load(spark, sf_dir, "events")
    one = [f.rsplit("/", 1)[-1] for f in source.inputFiles()] == ["events.parquet"]
    return ingest.file_stream(spark, sf_dir if one else f"{sf_dir}/events.parquet", source.schema, "ts", "events.parquet" if one else None)


def streamed(spark, sf_dir, make, mode):
    path = scratch(spark)
    ingest.run_once(make(events_stream(spark, sf_dir)), path, f"{path}-log", mode)
    return spark.read.parquet(path)


@query("select distinct event_id from events")
def stream_dedup(spark, sf_dir):
    return streamed(spark, sf_dir, lambda s: ingest.dedup_stream(s, ["event_id"], "ts", "4000 days").select("event_id"), "append")


@query("select cast(ts as date) d, event_type, count(*) n from events group by 1, 2")
def stream_tumbling(spark, sf_dir):
    """Daily counts by a stream in update mode: each micro-batch lands the windows that changed, and of a window the last batch counts."""
    path = scratch(spark)
    stream = ingest.tumbling(events_stream(spark, sf_dir), "ts", "1 day", ["event_type"], "1 day")
    ingest.upsert_stream(stream, lambda rows, batch: rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{path}/batch={batch:06d}"), f"{path}-log")
    found = spark.read.option("basePath", path).parquet(path)
    return relational.dedup(found, ["start", "event_type"], [F.desc("batch")]).select(F.col("start").cast("date").alias("d"), "event_type", "n")


@query(UPSERT + "select o_custkey, d, o_orderkey, round(o_totalprice, 2) o_totalprice from up")
def stream_upsert(spark, sf_dir):
    """The windowed upsert as a stream of three files, a micro-batch each, into a versioned table that starts with the old orders."""
    path = scratch(spark)
    old, new = upsert_inputs(spark, sf_dir)
    target = versions.Table(spark, f"{path}/table", "o_custkey", 16)
    target.commit(old, None)
    # a batch has all of its customers' rows of the window
    new.repartition(3, "o_custkey").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(new.schema).option("maxFilesPerTrigger", "1").parquet(f"{path}/in")
    ingest.versioned_upserts(stream, target, ["o_custkey", "d"], "d", [F.desc("o_orderkey"), F.desc("o_totalprice")], f"{path}/log", "orders", UPSERT_WINDOW)
    return target.read(target.head()).select("o_custkey", "d", "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


def in_order(spark, sf_dir, make):
    """What a stateful stream of the events hands on, once a row far ahead has moved the watermark over all of them."""
    path, source = scratch(spark), events_stream(spark, sf_dir)
    ahead = load(spark, sf_dir, "events").limit(1).withColumns({"user_id": F.lit(None).cast(source.schema["user_id"].dataType), "ts": F.lit("2100-01-01").cast("timestamp")})
    ahead.write.parquet(f"{path}-ahead")
    both = source.unionByName(spark.readStream.schema(ahead.schema).parquet(f"{path}-ahead"))
    before = spark.conf.get(runs.STORE[0])
    spark.conf.set(*runs.STORE)
    try:
        ingest.upsert_stream(make(both), lambda rows, batch: rows.write.mode("overwrite").parquet(f"{path}/batch={batch:06d}"), f"{path}-log")
    finally:
        spark.conf.set(runs.STORE[0], before)
    return spark.read.option("basePath", path).parquet(path)


@query(SQL["failure_runs"])
def stream_failure_runs(spark, sf_dir):
    """Runs of errors by a stateful stream; of an island that grew over several micro-batches the longest counts."""
    found = in_order(spark, sf_dir, lambda s: runs.failure_runs(s, "user_id", "ts", "event_id", F.col("event_type") == "error"))
    return found.groupBy("user_id", "island").agg(F.max("run_length").alias("run_length")).where("run_length >= 2")


@query("""with recursive e as (select user_id, epoch_us(ts) // 1000 ms, event_type = 'error' s, row_number() over (partition by user_id order by epoch_us(ts) // 1000, event_id) k from events),
w as (select user_id, 0::bigint k, null::bigint due, null::bigint fired from (select distinct user_id from e)
  union all select e.user_id, e.k, case when not e.s then null when w.due is null or w.due < e.ms then e.ms + 3600000 else w.due end, case when w.due < e.ms then w.due end from w join e on e.user_id = w.user_id and e.k = w.k + 1),
l as (select user_id, due from w where due is not null and (user_id, k) in (select user_id, max(k) from e group by 1) union all select user_id, fired from w where fired is not null)
select user_id, due from l""")
def stream_sweeps(spark, sf_dir):
    """Users to look at again an hour after their first error, unless something else than an error came by then."""
    found = in_order(spark, sf_dir, lambda s: runs.deferred_sweeps(s, "user_id", "ts", "event_id", F.col("event_type") == "error"))
    return found.select("user_id", F.unix_millis("due").alias("due"))


# --- landed responses --------------------------------------------------------------------------

#: How the test responses go wrong, in SQL: of whole responses and of items.
RESPONSE = """with x as (select event_type dataset, case when event_type = 'view' then 'u' || user_id % 2 end unit, cast(ts as date) d, event_id, user_id, value,
  case when event_id % 97 = 0 then 'item is no object' when event_id % 50 = 0 then 'bad user_id' end wrong, row_number() over (partition by event_type, case when event_type = 'view' then 'u' || user_id % 2 end, cast(ts as date) order by event_id) - 1 ordinal from events),
g as (select distinct dataset, unit, d, case when dataset = 'error' and day(d) % 2 = 1 then 'quota' when dataset = 'view' and unit = 'u1' and isodow(d) = 1 then 'not json' when dataset = 'click' and day(d) % 5 = 0 then 'no data'
  when dataset = 'purchase' and day(d) % 3 = 0 then 'rejected' end reason from x),
days as (select unnest(generate_series(min(d) - 3, max(d), interval 1 day))::date d from x),
plan as (select dataset, unit, days.d, case when g.d is null then 'no response' else reason end reason from (select distinct dataset, unit from x) a cross join days left join g using (dataset, unit, d) where unit is not null
  union all select dataset, null, days.d, case when g.d is null then 'no response' else reason end from (select distinct dataset from x where unit is null) a cross join days left join g using (dataset, d))
"""


def responses(spark, sf_dir):
    """Lands responses made from the events, one a dataset, unit and day, and the plan that asks for them and for days without any; returns the plan's folder."""
    root = scratch(spark)
    unit = F.when(F.col("event_type") == "view", F.concat(F.lit("u"), (F.col("user_id") % 2).cast("string")))
    e = load(spark, sf_dir, "events").select(F.col("event_type").alias("dataset"), unit.alias("unit"), F.col("ts").cast("date").alias("d"), "event_id", "user_id", "value")
    user = F.when(F.col("event_id") % 50 == 0, F.lit('"x"')).otherwise(F.col("user_id").cast("string"))
    item = F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"user_id":'), user, F.lit(',"value":'), F.col("value").cast("string"), F.lit(',"more":[1]}'))
    item = F.when(F.col("event_id") % 97 == 0, F.lit("7")).otherwise(item)
    each = e.groupBy("dataset", "unit", "d").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", item.alias("item")))), lambda x: x["item"]), ",").alias("items"))
    good = F.concat(F.lit('{"status":200,"msg":"success","data":['), "items", F.lit("]}"))
    body = (
        F.when((F.col("dataset") == "error") & (F.day("d") % 2 == 1), F.lit('{"status":402,"msg":"Requests exceeded"}'))
        .when((F.col("dataset") == "view") & (F.col("unit") == "u1") & (F.weekday("d") == 0), F.lit("<html>busy</html>"))
        .when((F.col("dataset") == "click") & (F.day("d") % 5 == 0), F.lit('{"status":200,"msg":"success","data":[]}'))
        .when((F.col("dataset") == "purchase") & (F.day("d") % 3 == 0), F.replace(good, F.lit(":200,"), F.lit(':"200",'))).otherwise(good)
    )
    each.select("dataset", "unit", "d", body.alias("value")).write.partitionBy("dataset", "unit", "d").text(f"{root}/landed")
    part = lambda name: F.nullif(F.regexp_extract("path", f"/{name}=([^/]+)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
    files = readers.listing(spark, f"{root}/landed", "*.txt").select(part("dataset").alias("dataset"), part("unit").alias("unit"), part("d").cast("date").alias("d"), F.col("path").alias("file"))
    span = e.agg(F.date_sub(F.min("d"), 3).alias("a"), F.max("d").alias("b"))
    asked = calendars.spans(e.select("dataset", "unit").distinct().crossJoin(F.broadcast(span)), "a", "b")
    responses_source.plan(asked, files, f"{root}/plan")
    return f"{root}/plan"


@query(RESPONSE + "select *, case when reason is null then 'ok' when reason = 'no data' then 'nodata' when reason = 'no response' then 'absent' else 'fail' end status from plan")
def landed_statuses(spark, sf_dir):
    """What became of every request of the plan."""
    return payloads.judged(responses_source.load(spark, responses(spark, sf_dir)), "body").select("dataset", "unit", "d", "status", "reason")


@query(RESPONSE + """select dataset, x.unit, d, event_id, user_id, round(value, 4) as value from x join g using (dataset, d) where x.unit is not distinct from g.unit and reason is null and wrong is null
and dataset in ('view', 'click') and d >= (select max(d) - 6 from x)""")
def landed_load(spark, sf_dir):
    """The rows of two datasets' last week: only these responses are opened."""
    last = load(spark, sf_dir, "events").agg((F.max(F.col("ts").cast("date")) - 6).alias("d")).first()[0]
    asked = responses_source.load(spark, responses(spark, sf_dir)).where(F.col("dataset").isin("view", "click") & (F.col("d") >= F.lit(last)))
    found = payloads.rows(asked, "body", "event_id long, user_id long, value double").where("reason is null")
    return found.select("dataset", "unit", "d", "event_id", "user_id", F.round("value", 4).alias("value"))


@query(RESPONSE + """select dataset, unit, d, cast(null as int) ordinal, reason from plan where reason is not null
union all select x.dataset, x.unit, x.d, ordinal::int, wrong from x join g on x.dataset = g.dataset and x.unit is not distinct from g.unit and x.d = g.d where reason is null and wrong is not null""")
def landed_rejects(spark, sf_dir):
    """Every response and item that gave no row, with its reason."""
    found = payloads.rows(responses_source.load(spark, responses(spark, sf_dir)), "body", "event_id long, user_id long, value double")
    return found.where("reason is not null").select("dataset", "unit", "d", "ordinal", "reason")


@query("""select p_brand etf, p_partkey, case p_size % 6 when 0 then 'no Title' when 1 then 'no Data' when 2 then 'short row' when 3 then 'bad number' when 4 then 'stale' end reason,
case when p_size % 6 = 5 then p_partkey * 1234 / 1000 end holdings from part""")
def positional_rejects(spark, sf_dir):
    """Positional payloads made from parts, five of six with one fault each."""
    p = load(spark, sf_dir, "part")
    k = F.col("p_size") % 6
    shares = F.when(k == 3, F.lit("1,2x")).otherwise(F.format_number(F.col("p_partkey") * 1234, 0))
    cells = F.array(F.when(k == 4, F.lit("20240229")).otherwise("20240301"), F.col("p_partkey").cast("string"), F.lit("x"), F.col("p_size").cast("string"), shares)
    titles = F.array(*(F.lit(x) for x in "abcde"))
    whole = F.struct(F.when(k == 0, F.slice(titles, 1, 4)).otherwise(titles).alias("Title"), F.when(k == 1, F.array().cast("array<array<string>>")).otherwise(F.array(F.when(k == 2, F.slice(cells, 1, 4)).otherwise(cells))).alias("Data"))
    found = payloads.positional(p.select(F.struct("p_brand", "p_partkey").alias("key"), F.to_json(whole).alias("payload")), "payload", "key", F.lit("2024-03-01").cast("date"))
    return found.select(F.col("etf.p_brand").alias("etf"), F.col("etf.p_partkey").alias("p_partkey"), "reason", "holdings")


@query("""select s_name period, case s_suppkey % 4 when 0 then 'not json' when 1 then 'data is no list' when 2 then 'no data' else 'item is no object' end reason, case when s_suppkey % 4 = 3 then 1 end::int ordinal from supplier""")
def fund_rejects(spark, sf_dir):
    """Fund payloads made from suppliers: cut off, without a list, with an empty one, or with an item that is no entry."""
    k = F.col("s_suppkey") % 4
    payload = F.when(k == 0, '{"date":').when(k == 1, '{"data":{"data":{"n":1}}}').when(k == 2, '{"data":[]}').otherwise('{"data":{"data":[{"n":"Acer"},"Acer"]}}')
    return payloads.fund_rejects(load(spark, sf_dir, "supplier").select("s_name", payload.alias("payload")), "payload", "s_name").select("period", "reason", "ordinal")


# --- archives, footers, counters ---------------------------------------------------------------


@query("""select n_name || '.zip' archive, count(*) members, sum(length(s_name) + length(s_suppkey::varchar) + 1)::bigint bytes, sum(s_suppkey)::bigint keys
from supplier join nation on n_nationkey = s_nationkey where s_suppkey % 2 = 0 group by 1""")
def archive_members(spark, sf_dir):
    """Archives of a nation's suppliers, one file each, of which every other is read."""
    root = f"{scratch(spark)}/archives"
    rows = load(spark, sf_dir, "supplier").join(load(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    line = F.concat_ws(",", "s_suppkey", "s_name")
    archives.packed(rows.select(F.concat("n_name", F.lit(".zip")).alias("archive"), F.concat(F.lit("s/"), F.col("s_suppkey").cast("string"), F.lit(".csv")).alias("member"), line.cast("binary").alias("content")), root)
    asked = archives.members(spark, root).where("cast(regexp_extract(member, '([0-9]+)', 1) as long) % 2 = 0")
    found = archives.contents(asked).select(F.substring_index("path", "/", -1).alias("archive"), F.decode("content", "utf-8").alias("line"))
    return found.groupBy("archive").agg(F.count("*").alias("members"), F.sum(F.length("line")).alias("bytes"), F.sum(F.split("line", ",")[0].cast("long")).alias("keys"))


@query(LANDED + """, c as (select x.dataset, count(*) candidates, count(l.d) done from x left join l on x.dataset = l.dataset and x.d = l.d group by 1), s as (select dataset, count(*) landed_all, min(d) first_day, max(d) last_day from l group by 1)
select c.dataset, candidates, done, coalesce(landed_all, 0) landed_all, first_day, last_day, round(done / candidates * 100, 4) pct, coalesce(r.n, 0) as rows
from c left join s on c.dataset = s.dataset left join (select event_type, count(*) n from events where value > 150 group by 1) r on r.event_type = c.dataset""")
def completeness_footers(spark, sf_dir):
    """Completeness of a table of landed days, from its partitions and footers alone."""
    path = scratch(spark)
    rows = load(spark, sf_dir, "events").where("value > 150").select(F.col("event_type").alias("dataset"), F.col("ts").cast("date").alias("d"), "event_id")
    sinks.dated(rows, path, ["dataset", "d"])
    return coverage.completeness_of_table(expected(spark, sf_dir), readers.parquet_by_footers(spark, path))


@query("select count(*) filter (s = 'ok') ok, count(*) filter (s = 'skip') skip, count(*) filter (s = 'fail') fail, count(*) rows_written from (select case o_orderstatus when 'F' then 'ok' when 'O' then 'skip' else 'fail' end s from orders)")
def status_counters(spark, sf_dir):
    """A load's counters, taken while its rows are written."""
    path = scratch(spark)
    o = load(spark, sf_dir, "orders").withColumn("s", F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "skip").otherwise("fail"))
    counts = {s: F.count_if(F.col("s") == s) for s in ("ok", "skip", "fail")} | {"rows_written": F.count(F.lit(1))}
    seen = sinks.counted(o, lambda df: df.write.partitionBy("s").parquet(path), **counts)
    return spark.createDataFrame([seen], ", ".join(f"{c} long" for c in counts))


@query(SQL["upsert_stats"])
def upsert_counters(spark, sf_dir):
    """upsert_stats as the upsert's buckets are written, not from a second look at both tables."""
    old, merged = upserted(spark, sf_dir)
    path = scratch(spark)
    sinks.entities(old, path, "o_custkey")
    kinds = ("created", "removed", "updated", "unchanged")
    types = relational.change_types(old, merged, "o_custkey")
    counts = {k: F.count_if(F.col("change_type") == k) for k in kinds}
    seen = sinks.counted(types, lambda df: sinks.entities(merged, path, "o_custkey", changed=df.where("change_type <> 'unchanged'")), **counts)
    return spark.createDataFrame([(k, seen[k]) for k in kinds if seen[k]], "change_type string, n long")


@query("select o_orderkey k, o_orderstatus as name, cast(null as double) bal, o_orderpriority extra from orders union all select s_suppkey, s_name, s_acctbal, null from supplier")
def align_extras(spark, sf_dir):
    """Known columns first, in order; others are kept after them."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("extra"), F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("name"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("bal"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("k"))
    return relational.align(relational.union_all(o, s), ["k", "name", "bal", "missing"], extras=True)


def books(spark, sf_dir) -> str:
    """Workbooks of each nation's suppliers: keys, names as shared strings, balances, and days as styled serial numbers."""
    root, w = f"{scratch(spark)}/books", Window.partitionBy("archive").orderBy("s_suppkey")
    s = load(spark, sf_dir, "supplier").join(load(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).withColumn("archive", F.concat("n_name", F.lit(".xlsx")))
    s = s.withColumn("n", F.row_number().over(w))
    at = lambda c: F.concat(F.lit(f'<c r="{c}'), (F.col("n") + 1).cast("string"), F.lit('"'))
    row = F.concat(
        F.lit('<row r="'), (F.col("n") + 1).cast("string"), F.lit('">'), at("A"), F.lit("><v>"), F.col("s_suppkey").cast("string"), F.lit("</v></c>"), at("B"), F.lit(' t="s"><v>'), (F.col("n") - 1).cast("string"), F.lit("</v></c>"),
        at("C"), F.lit("><v>"), F.col("s_acctbal").cast("string"), F.lit("</v></c>"), at("D"), F.lit(' s="1"><v>'), (F.col("s_suppkey") + 45292).cast("string"), F.lit("</v></c></row>"),
    )
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", c.alias("x")))), lambda y: y["x"]), "")
    made = s.groupBy("archive").agg(joined(row).alias("rows"), joined(F.concat(F.lit("<si><t>"), F.replace("s_name", F.lit("#"), F.lit(" &amp; ")), F.lit("</t></si>"))).alias("strings"))
    head = "".join(f'<c r="{c}1" t="inlineStr"><is><t>{name}</t></is></c>' for c, name in zip("ABCD", ("id", "name", "bal", "day")))
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    members = {
        workbooks.BOOK: F.lit(f'<workbook {space}><sheets><sheet name="調整" sheetId="1" r:id="rId1"/></sheets></workbook>'), workbooks.STRINGS: F.concat(F.lit(f"<sst {space}>"), "strings", F.lit("</sst>")),
        workbooks.RELATIONS: F.lit('<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="x" Target="worksheets/sheet1.xml"/></Relationships>'),
        workbooks.STYLES: F.lit(f'<styleSheet {space}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'),
        f"{workbooks.SHEETS}sheet1.xml": F.concat(F.lit(f'<worksheet {space}><dimension ref="A1:D2"/><sheetData><row r="1">{head}</row>'), "rows", F.lit("</sheetData></worksheet>")),
    }
    each = made.select("archive", F.explode(F.array(*(F.struct(F.lit(m).alias("member"), F.encode(x, "utf-8").alias("content")) for m, x in members.items()))).alias("m"))
    archives.packed(each.select("archive", "m.*"), root)
    return root


def book_rows(spark, path):
    found = workbooks.table(workbooks.cells(spark, path))
    v = lambda name, kind: F.col("values")[name].cast(kind).alias(name)
    return found.select(F.substring_index("path", "/", -1).alias("archive"), v("id", "long"), v("name", "string"), v("bal", "double"), v("day", "date"))


@query("select n_name || '.xlsx' archive, s_suppkey id, replace(s_name, '#', ' & ') as name, s_acctbal bal, date '2024-01-01' + s_suppkey::int as day from supplier join nation on n_nationkey = s_nationkey")
def workbook_rows(spark, sf_dir):
    """Rows of workbooks by the names in their first row: shared strings joined by index, days told by their style."""
    return book_rows(spark, books(spark, sf_dir))


@query("""with s as (select *, n_name || '.xlsx' archive, row_number() over (partition by n_name order by s_suppkey) n, count(*) over (partition by n_name) k from supplier join nation on n_nationkey = s_nationkey)
select archive, s_suppkey id, case when n % 3 = 0 then 'new <' || n || '>' else replace(s_name, '#', ' & ') end as name, case when n % 3 <> 1 then s_acctbal end bal, case when n % 3 = 0 then date '2020-02-29' else date '2024-01-01' + s_suppkey::int end as day from s
union all select archive, -1, null, 0.5, null from s where n = k""")
def workbook_patch(spark, sf_dir):
    """Workbooks with cells overwritten, emptied and added, and a row appended; what isn't named stays."""
    root = books(spark, sf_dir)
    rows = workbooks.cells(spark, root).where("column = 'A' and row > 1").select(F.substring_index("path", "/", -1).alias("archive"), "sheet", "row")
    n = F.col("row") - 1
    cell = lambda column, kind, value: F.struct(F.lit(column).alias("column"), F.lit(kind).alias("kind"), value.cast("string").alias("value"))
    named = F.array(cell("B", "text", F.concat(F.lit("new <"), n.cast("string"), F.lit(">"))), cell("D", "date", F.lit("2020-02-29")))
    changes = rows.select("archive", "sheet", "row", F.explode(F.when(n % 3 == 0, named).when(n % 3 == 1, F.array(cell("C", "number", F.lit(None))))).alias("c"))
    more = rows.groupBy("archive", "sheet").agg((F.max("row") + 1).alias("row")).select("archive", "sheet", "row", F.explode(F.array(cell("A", "number", F.lit(-1)), cell("C", "number", F.lit(0.5)))).alias("c"))
    workbooks.patch(spark, root, f"{root}-after", changes.unionByName(more).select("archive", "sheet", "row", "c.*", F.lit(None).cast("int").alias("style")))
    return book_rows(spark, f"{root}-after")


# --- reports, files and payloads of the tables' own rows ---------------------------------------


@query(DIFF + """, t as (select stock_id, holdings_now - holdings_prev c, (holdings_now - holdings_prev) / holdings_prev * 100 pct from d where status = 'both' and abs(holdings_now - holdings_prev) > 0.5 order by abs(c) desc, stock_id limit 15),
e as (select 0 part, status a, 0::double b, 0 k, status || ': ' || count(*) line from d group by status
  union all select 1, '', -abs(c), stock_id, stock_id || case when c > 0 then ' ▲ ' else ' ▼ ' end || format('{:,}', c::bigint) || ' (' || printf('%+.2f', pct) || '%)' from t)
select row_number() over (order by part, a, b, k)::int n, line from e""")
def holdings_report(spark, sf_dir):
    """The report of a day's differences, line by line."""
    return holdings.lines(whole_diff(spark, sf_dir), "stock_id")


@query(LANDED + "select dataset, d from x")
def refresh_plan(spark, sf_dir):
    """On a refresh all that is expected is loaded again, landed or not."""
    return coverage.pending(expected(spark, sf_dir), landed(spark, sf_dir), refresh=True)


@query("with s as (select event_type dataset, max(ts)::date b from events group by 1) select dataset, unnest(generate_series(b - 6, b, interval 1 day))::date d from s")
def last_seven_days(spark, sf_dir):
    """The last seven days of each event type, up to its last event's."""
    last = load(spark, sf_dir, "events").groupBy(F.col("event_type").alias("dataset")).agg(F.max(F.col("ts").cast("date")).alias("b"))
    return calendars.spans(last.withColumn("a", F.date_sub("b", 6)), "a", "b").select("dataset", "d")


@query("select unnest([" + ", ".join(f"'{t}'" for t in TABLES) + "]) as name, true valid")
def file_magic(spark, sf_dir):
    """Whether the tables' files begin as Parquet does; four bytes of each are read."""
    found = archives.begins_with(spark, sf_dir, b"PAR1", "*.parquet").withColumn("name", F.regexp_extract("path", r"([^/]+)\.parquet(/|$)", 1))
    return found.where(F.col("name").isin(*TABLES)).groupBy("name").agg(F.bool_and("valid").alias("valid"))


@query("select c_nationkey, count(*)::int members, max(c_name) last_name from customer group by 1")
def json_documents(spark, sf_dir):
    """One JSON document a nation, over several lines, each in a file of its own."""
    path = scratch(spark)
    c = load(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("members"), F.max("c_name").alias("last_name"))
    text = F.format_string('{\n  "c_nationkey": %d,\n  "members": %d,\n\n  "last_name": "%s"\n}', "c_nationkey", "members", "last_name")
    c.select(F.col("c_nationkey").alias("k"), text.alias("value")).write.partitionBy("k").text(path)
    return readers.json(spark, path, "c_nationkey int, members int, last_name string").select("c_nationkey", "members", "last_name")


@query("""with e as (select l_suppkey, l_partkey, max(l_extendedprice) e, sum(l_quantity) q from lineitem group by 1, 2)
select s_name period, date '1998-12-31' period_date, s_acctbal > 0 interim, p_name || ' ' || l_partkey company_name, n_name country_code, case p_size % 5 when 0 then 'Equity' when 1 then 'Fixed Income' when 2 then 'Real Estate' when 3 then 'Infrastructure' else '4' end asset_type,
case when p_size % 7 <> 0 then e end market_value_nok, case when p_size % 7 <> 0 then q end nominal_value, p_size / 100 ownership_pct, case when p_size % 2 = 0 then p_brand else p_type end sector,
case when p_size % 2 = 0 then l_partkey::varchar else 'B' || l_partkey end ticker, case when p_size % 2 = 0 then n_name end incorporation_country, case when p_size % 2 = 0 then p_size / 10 end voting_pct
from e join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join part on l_partkey = p_partkey""")
def fund_positions(spark, sf_dir):
    """Fund payloads of the parts that each supplier sold, a list or an object that holds one, taken apart again."""
    e = load(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.max("l_extendedprice").alias("e"), F.sum("l_quantity").alias("q"))
    e = e.join(load(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(load(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    key, even = F.col("l_partkey").cast("string"), F.col("p_size") % 2 == 0
    entry = F.struct(
        F.concat_ws(" ", "p_name", key).alias("n"), F.col("n_name").alias("cc"), (F.col("p_size") % 5).alias("at"), (F.col("p_size") / 100).alias("o"), F.when(F.col("p_size") % 7 != 0, F.struct("e", F.col("q").alias("n"))).alias("a"),
        F.when(even, F.struct(F.col("p_brand").alias("s"), key.alias("vid"), F.col("n_name").alias("icc"), (F.col("p_size") / 10).alias("v"))).alias("eq"), F.when(~even, F.struct(F.col("p_type").alias("s"), F.concat(F.lit("B"), key).alias("vid"))).alias("fi"),
    )
    held = e.groupBy("s_name", "s_acctbal", "s_nationkey").agg(F.to_json(F.collect_list(entry)).alias("items"))
    data = F.when(F.col("s_nationkey") < 12, F.col("items")).otherwise(F.concat(F.lit('{"data":'), "items", F.lit("}")))
    payload = F.concat(F.lit('{"date":"1998-12-31T00:00:00","interim":'), (F.col("s_acctbal") > 0).cast("string"), F.lit(',"data":'), data, F.lit("}"))
    return readers.fund_entries(held.select("s_name", payload.alias("payload")), "payload", "s_name")


@query("""with l as (select distinct l_suppkey, l_partkey, year(l_shipdate) y from lineitem where year(l_shipdate) in (1998, 1999)),
c as (select l_suppkey, case y when 1998 then 'add' else 'delete' end action, lpad((l_partkey % 9000 + 1000)::varchar, 4, '0') code, arg_min(p_name, l_partkey) as name from l join part on l_partkey = p_partkey group by all)
select l_suppkey notice_id, '供應' || l_suppkey || '指數' index_name, date '2026-06-09' announce_date, null::date review_date, date '2026-06-26' effective_date, action, code, name from c""")
def notice_lists(spark, sf_dir):
    """Notices that add the parts which a supplier shipped in one year and delete those of the next."""
    ship = F.col("l_shipdate")
    sold = load(spark, sf_dir, "lineitem").where((ship >= F.lit("1998-01-01").cast("timestamp_ntz")) & (ship < F.lit("2000-01-01").cast("timestamp_ntz"))).select("l_suppkey", "l_partkey", F.year(ship).alias("y")).distinct()
    sold = sold.join(load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    item = F.concat(F.lpad((F.col("l_partkey") % 9000 + 1000).cast("string"), 4, "0"), F.lit(" "), "p_name")

    def listed_in(year):
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("y") == year, F.struct("l_partkey", item.alias("x"))))), lambda x: x["x"]), "、")

    n = sold.groupBy("l_suppkey").agg(listed_in(1998).alias("a"), listed_in(1999).alias("b"), F.count_if(F.col("y") == 1998).alias("m"), F.count_if(F.col("y") == 1999).alias("k"))
    text = F.concat(
        F.lit("「供應"), F.col("l_suppkey").cast("string"), F.lit("指數」定期審核\n2026/06/09\n自 2026 年 6 月 26 日 起生效\n成分股納入("), F.col("m").cast("string"), F.lit(")："), F.when(F.col("m") > 0, F.col("a")).otherwise("無"),
        F.lit("\n成分股刪除 （ "), F.col("k").cast("string"), F.lit(" ）："), F.when(F.col("k") > 0, F.col("b")).otherwise("無"), F.lit("\n* 9998 註\n"),
    )
    return notices.parse(n.select(F.col("l_suppkey").alias("notice_id"), text.alias("text")))
