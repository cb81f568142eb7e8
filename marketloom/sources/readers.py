"""Readers for landed payloads. Fetching over HTTP is left to whoever lands the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import payloads

HOLDINGS = T.StructType([T.StructField("date", T.DateType()), T.StructField("stock_id", T.StringType()), T.StructField("weight_pct", T.DoubleType()), T.StructField("holdings", T.DoubleType()), T.StructField("etf", T.StringType())])


def envelope(spark: SparkSession, path: str, row: str) -> DataFrame:
    """Rows under `data` of landed JSON envelopes {status, msg, data}, with a declared row schema (DDL)."""
    df = spark.read.schema(f"status int, msg string, data array<struct<{row}>>").option("multiLine", True).json(path)
    return df.where("status = 200").select(F.explode("data").alias("r")).select("r.*")


def csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with a header (and perhaps a byte-order mark) under a declared schema: ids keep leading zeros."""
    return spark.read.schema(schema).option("header", True).csv(path)


def positional_rows(df: DataFrame, payload: str, etf: str) -> DataFrame:
    """Holdings from {Title, Data} payloads: positions 0, 1, 3, 4. Payloads with a fault give none; payloads.positional tells which."""
    return payloads.positional(df, payload, etf).where("reason is null").drop("reason")


#: The fund's asset types.
ASSET_TYPES = {0: "Equity", 1: "Fixed Income", 2: "Real Estate", 3: "Infrastructure"}


def fund_entries(df: DataFrame, payload: str, period: str, labels: dict = ASSET_TYPES) -> DataFrame:
    """Fund holdings from payloads {date, interim, data} whose data is a list, or an object that holds one; nested parts may be missing."""
    from ..functions.scalars import enum_label, falsy_coalesce

    entry = "array<struct<n:string,cc:string,at:int,o:double,a:struct<e:double,n:double>,eq:struct<s:string,vid:string,icc:string,v:double>,fi:struct<s:string,vid:string>>>"
    data = F.get_json_object(payload, "$.data")
    items = F.coalesce(F.from_json(F.when(F.startswith(F.ltrim(data), F.lit("[")), data), entry), F.from_json(F.get_json_object(payload, "$.data.data"), entry))
    # what a payload says once is read before its entries are rows
    whole = df.select(
        F.col(period).alias("period"), F.try_to_date(F.substring(F.get_json_object(payload, "$.date"), 1, 10), "yyyy-MM-dd").alias("period_date"), F.get_json_object(payload, "$.interim").cast("boolean").alias("interim"), items.alias("items"),
    )
    rows = whole.select("period", "period_date", "interim", F.explode("items").alias("e"))
    return rows.select(
        "period", "period_date", "interim",
        F.col("e.n").alias("company_name"), F.col("e.cc").alias("country_code"), enum_label(F.col("e.at"), labels).alias("asset_type"), F.col("e.a.e").alias("market_value_nok"), F.col("e.a.n").alias("nominal_value"),
        F.col("e.o").alias("ownership_pct"), falsy_coalesce(F.col("e.eq.s"), F.col("e.fi.s")).alias("sector"), falsy_coalesce(F.col("e.eq.vid"), F.col("e.fi.vid")).alias("ticker"),
        F.col("e.eq.icc").alias("incorporation_country"), F.col("e.eq.v").alias("voting_pct"),
    )


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files as rows: path, name, length, modified; contents aren't read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return df.select("path", F.substring_index("path", "/", -1).alias("name"), "length", F.col("modificationTime").alias("modified"))


def date_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("d")).where("d <> ''").select(F.col("d").cast("date").alias("d"))


def json(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON files that hold one document each, over several lines, under a declared schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def parquet_by_footers(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose counts, minima and maxima, grouped by its partition columns or not at all, are answered
    from its files' footers: no column is read. Sets the session's pushdown of aggregates; other tables are read as before."""
    kinds = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(kinds)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(kinds, ",".join(k for k in before.split(",") if k.strip().lower() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(kinds, before)
