"""Payloads taken apart with what is wrong with them: nothing vanishes, rejects keep their reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import to_lots


def _kind(v: Column) -> Column:
    """object, array, number, string, ... of a variant; null for no value and for JSON's null."""
    name = F.schema_of_variant(v)
    kind = F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array").when(name.startswith("STRING"), "string").when(name.startswith("BOOLEAN"), "boolean").when(name != "VOID", "number")
    return F.when(v.isNotNull(), kind)


def _part(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def over_quota(message: Column) -> Column:
    """Whether a message tells that the quota is used up."""
    m = F.lower(message)
    return F.coalesce(F.contains(m, F.lit("limit")) | F.contains(m, F.lit("402")) | (F.contains(m, F.lit("request")) & F.contains(m, F.lit("exceed"))), F.lit(False))


def judged(df: DataFrame, body: str) -> DataFrame:
    """df with the status of each response {status, msg, data} in `body`: ok, nodata, fail or absent, its reason, and data as variants.

    Only the number 200 is a good status; a null body is absent; data that is missing, null, empty or false is nodata,
    any other than a list fails. The body stays as it is; columns named status, reason and data are replaced.
    """
    kept = [c for c in df.columns if c not in ("status", "reason", "data")]
    # each response is parsed once; kinds are told by a schema of the whole value, so what a look at one place can tell is told by that
    v, data = F.col("_v"), F.col("_data")
    parts = df.select(*kept, F.try_parse_json(F.col(body)).alias("_v"))
    parts = parts.select(*kept, "_v", _part(v, "$.status").alias("_code"), _part(v, "$.data").alias("_data"), _part(v, "$.data[0]").isNotNull().alias("_items"), _part(v, "$.msg", "string").alias("_msg"))
    code, items = F.col("_code"), F.col("_items")
    not_object = F.when(items | code.isNotNull(), False).otherwise(F.coalesce(_kind(v), F.lit("")) != "object")
    empty = F.when(items, False).otherwise(_kind(data).isNull() | F.to_json(data).isin("[]", "{}", '""', "0", "false"))
    no_list = F.when(items, False).otherwise(_kind(data) != "array")
    reason = (
        F.when(F.col(body).isNull(), "no response").when(v.isNull(), "not json").when(not_object, "no object")
        .when(~F.coalesce((_kind(code) == "number") & (F.try_variant_get(code, "$", "double") == 200), F.lit(False)), F.when(over_quota(F.col("_msg")), "quota").otherwise("rejected"))
        .when(empty, "no data").when(no_list, "data is no list")
    )
    status = F.when(F.col("reason").isNull(), "ok").when(F.col("reason") == "no response", "absent").when(F.col("reason") == "no data", "nodata").otherwise("fail")
    judged_ = parts.select(*kept, reason.alias("reason"), "_data")
    return judged_.select(*kept, "reason", F.when(F.col("reason").isNull(), _part(data, "$", "array<variant>")).alias("data")).withColumn("status", status)


def rows(df: DataFrame, body: str, row: str) -> DataFrame:
    """The items of judged responses under a declared row (DDL): df's other columns, status, reason, ordinal, item, and the row's fields.

    A response without items has one row with a null ordinal and its reason. An item that is no object, or has a value that
    its field can't hold, keeps its reason and text and has no fields; missing fields and JSON's null are null. Written once
    and partitioned by `reason is null`, rows and rejects come from one pass.
    """
    found = judged(df, body)
    kept = [c for c in found.columns if c not in ("data", body)]
    each = found.select(*kept, F.posexplode_outer("data").alias("ordinal", "item"))
    fields = T.StructType.fromDDL(row).fields
    value = {f.name: F.try_variant_get(F.col("item"), f"$.{f.name}", f.dataType.simpleString()) for f in fields}
    given = {f.name: _kind(_part(F.col("item"), f"$.{f.name}")).isNotNull() for f in fields}
    wrong = F.when(F.coalesce(_kind(F.col("item")), F.lit("")) != "object", "item is no object")
    for f in fields:
        wrong = wrong.when(given[f.name] & value[f.name].isNull(), f"bad {f.name}")
    reason = F.when(F.col("ordinal").isNotNull(), wrong).otherwise(F.col("reason"))
    good = (F.col("ordinal").isNotNull() & wrong.isNull()).alias("good")
    out = each.select(*(c for c in kept if c != "reason"), reason.alias("reason"), "ordinal", "item", good)
    return out.select(*(c for c in out.columns if c not in ("item", "good")), F.to_json("item").alias("item"), *(F.when(F.col("good"), value[f.name]).alias(f.name) for f in fields))


def positional(df: DataFrame, payload: str, etf: str, expected: Column | None = None) -> DataFrame:
    """Holdings of {Title, Data} payloads: ordinal, date, stock_id, weight_pct, holdings, etf, and reason.

    A payload counts as a whole: one of under five titles, without rows, with a row of under five cells, with holdings
    that are no whole number, or whose first date isn't `expected`, has one row, without values and with its reason.
    """
    p = df.withColumn("_v", F.try_parse_json(payload)).withColumn("_t", _part(F.col("_v"), "$.Title", "array<string>")).withColumn("_d", _part(F.col("_v"), "$.Data", "array<array<string>>"))
    lots = lambda r: F.replace(r[4], F.lit(","), F.lit(""))
    first = F.get(F.get("_d", F.lit(0)), F.lit(0))
    reason = (
        F.when(F.col(payload).isNull() | F.col("_v").isNull(), "not json").when(F.coalesce(F.size("_t"), F.lit(0)) < 5, "no Title").when(F.coalesce(F.size("_d"), F.lit(0)) < 1, "no Data")
        .when(F.exists("_d", lambda r: r.isNull() | (F.size(r) < 5)), "short row")
        .when(F.exists("_d", lambda r: ~F.coalesce(F.regexp_like(lots(r), F.lit(r"^\s*[+-]?[0-9]+\s*$")), F.lit(False))), "bad number")
    )
    if expected is not None:
        reason = reason.when(~F.coalesce(first == F.date_format(expected, "yyyyMMdd"), F.lit(False)), "stale")
    p = p.select(F.col(etf).alias("etf"), reason.alias("reason"), F.when(reason.isNull(), F.col("_d")).alias("_d"))
    r = F.col("r")
    found = p.select("etf", "reason", F.posexplode_outer("_d").alias("ordinal", "r"))
    return found.select("ordinal", F.try_to_date(r[0], "yyyyMMdd").alias("date"), r[1].alias("stock_id"), r[3].try_cast("double").alias("weight_pct"), to_lots(F.trim(r[4])).alias("holdings"), "etf", "reason")


def fund_rejects(df: DataFrame, payload: str, period: str) -> DataFrame:
    """What readers.fund_entries leaves out: period, ordinal (null for a whole payload), reason, item."""
    v = F.try_parse_json(payload)
    data, inner = _part(v, "$.data"), _part(v, "$.data.data")
    items = F.when(_kind(data) == "array", data).when(_kind(inner) == "array", inner)
    reason = F.when(F.col(payload).isNull() | v.isNull(), "not json").when(items.isNull(), "data is no list").when(F.to_json(items) == "[]", "no data")
    each = df.select(F.col(period).alias("period"), reason.alias("reason"), F.posexplode_outer(F.when(reason.isNull(), _part(items, "$", "array<variant>"))).alias("ordinal", "item"))
    bad = F.when(F.col("ordinal").isNotNull() & (F.coalesce(_kind(F.col("item")), F.lit("")) != "object"), "item is no object")
    return each.select("period", "ordinal", F.coalesce("reason", bad).alias("reason"), F.to_json("item").alias("item")).where("reason is not null")
