"""Index-review notices: text to added and deleted codes, list pages to entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import norm_whitespace, parse_date_any
from .relational import dedup, flag_dedup

#: Fixed values, those of the notices' own format: a security code, the headings of its sections, what ends a section, subheadings, and where a date stands.
CODE = r"\d{4,6}(?:[A-Z](?![A-Za-z]))?"
HEADINGS = (("add", "成分股納入"), ("add", "Inclusions"), ("delete", "成分股刪除"), ("delete", "Exclusions"))
COUNT = r"\s*[（(]\s*\d+\s*[)）]\s*[:：]"
ENDING = r"成分股(?:納入|刪除|不變)|^\s*\*|如欲取得|Review\s+Result|Inclusions\s*[（(]|Exclusions\s*[（(]|\z"
SUBHEADING = r"[^\n、]*掛牌股票\s*[:：]"
INDEX_NAME = r"「\s*(.*?指數)\s*」"
EFFECTIVE = r"(20\d{2}\s*年\s*\d{1,2}\s*月\s*\d{1,2}\s*日)[^年。]*?起生效"
REVIEW = r"定審資料日\s*[（(]\s*(\d{8})\s*[)）]"
SCHEDULE_TITLE = r"(20\d{2}\s*年\s*\d{1,2}\s*月.*?日程表)"
UPDATED = r"更新日期\s*[:：]\s*([\d/]+)"
SLASH_FORM = r"(20\d{2})\s*/\s*(\d{1,2})\s*/\s*(\d{1,2})"
SLASHED = r"20\d{2}/\d{1,2}/\d{1,2}"
HAN = r"[\x{4E00}-\x{9FFF}]"


def section(text: Column, heading: str) -> Column:
    """What stands after the first heading with a count, up to the section's end, subheadings out; empty without it."""
    rest = F.regexp_extract(text, rf"(?Us){heading}{COUNT}(.*)\z", 1)
    return F.regexp_replace(F.regexp_extract(rest, rf"(?Usm)\A(.*?)(?={ENDING})", 1), rf"(?U){SUBHEADING}", "\n")


def codes_with_names(text: Column) -> Column:
    """Codes of a section, each with the text up to the next; those without a name are none. Line breaks inside Chinese names go."""
    found = F.regexp_extract_all(text, F.lit(rf"(?Us)({CODE})(.*?)(?={CODE}|\z)"), F.lit(0))

    def one(x):
        name = F.regexp_replace(F.regexp_replace(x, rf"(?U)^{CODE}[\s、，,]*", ""), r"(?U)\s+", " ")
        name = F.regexp_replace(F.regexp_replace(name, r"^[ 、，,]+|[ 、，,]+$", ""), rf"(?U)(?<={HAN})\s+(?={HAN})", "")
        return F.struct(F.regexp_extract(x, rf"(?U)^{CODE}", 0).alias("code"), name.alias("name"))

    return F.filter(F.transform(found, one), lambda x: x["name"] != "")


def parse(notices: DataFrame) -> DataFrame:
    """notices (notice_id, text) as rows: notice_id, index_name, announce_date, review_date, effective_date, action, code, name.

    The Chinese section of an action speaks first; the English one fills in codes it lacks. The announcement is the text's first date,
    the effective date the one before "takes effect". Dates that aren't there are null; a text without sections gives no rows.
    """
    flat = F.regexp_replace("text", r"\n", "")
    meta = notices.select(
        "notice_id", "text", norm_whitespace(F.regexp_extract(flat, rf"(?U){INDEX_NAME}", 1)).alias("index_name"), parse_date_any(F.col("text")).alias("announce_date"),
        parse_date_any(F.regexp_extract("text", rf"(?U){REVIEW}", 1)).alias("review_date"), parse_date_any(F.regexp_extract("text", rf"(?U){EFFECTIVE}", 1)).alias("effective_date"),
    )
    parts = F.array(*(F.struct(F.lit(a).alias("action"), F.lit(k).alias("tier"), codes_with_names(section(F.col("text"), h)).alias("codes")) for k, (a, h) in enumerate(HEADINGS)))
    kept = ["notice_id", "index_name", "announce_date", "review_date", "effective_date"]
    rows = meta.withColumn("part", F.explode(parts)).select(*kept, "part.action", "part.tier", F.posexplode("part.codes").alias("ord", "c"))
    rows = rows.select(*kept, "action", F.col("c.code").alias("code"), F.col("c.name").alias("name"), "tier", "ord")
    return dedup(rows, ["notice_id", "action", "code"], [F.asc("tier"), F.asc("ord")]).drop("tier", "ord")


def schedule(reports: DataFrame) -> DataFrame:
    """Review schedules (notice_id, text) as rows: notice_id, report_title, update_date, index_name, announce_date, effective_date.

    A row is a line with at least two dates and an index's name before the first of them. The update's date counts in the form Y/M/D only.
    """
    meta = reports.select("notice_id", "text", norm_whitespace(F.regexp_extract("text", rf"(?U){SCHEDULE_TITLE}", 1)).alias("report_title"), parse_date_any(F.regexp_extract("text", rf"(?U){UPDATED}", 1), (SLASH_FORM,)).alias("update_date"))
    lines = meta.select("notice_id", "report_title", "update_date", F.explode(F.split("text", r"\r\n|\n|\r")).alias("line"))
    lines = lines.withColumn("dates", F.regexp_extract_all("line", F.lit(SLASHED), F.lit(0))).where("size(dates) >= 2")
    name = norm_whitespace(F.expr("substring(line, 1, locate(dates[0], line) - 1)"))
    rows = lines.withColumn("index_name", name).where(F.contains("index_name", F.lit("指數")))
    return rows.select("notice_id", "report_title", "update_date", "index_name", parse_date_any(F.col("dates")[0]).alias("announce_date"), parse_date_any(F.col("dates")[1]).alias("effective_date"))


def list_entries(pages: DataFrame, pattern: str, names: list[str]) -> DataFrame:
    """Rows of list pages (page_id, html) by a pattern with a group for each name; of alike rows the first stays."""
    groups = [F.regexp_extract_all("html", F.lit(pattern), F.lit(k + 1)).alias(n) for k, n in enumerate(names)]
    rows = pages.select("page_id", F.posexplode(F.arrays_zip(*groups)).alias("ord", "e"))
    rows = rows.select("page_id", "ord", *(F.col(f"e.{n}").alias(n) for n in names))
    return dedup(rows, ["page_id", names[0]], [F.asc("ord")]).drop("ord")


def keyword_hits(titles: DataFrame, key: str, text: str, words: list[tuple[str, str]]) -> DataFrame:
    """Which of words (label, word), a short list that someone keeps, each text holds: key, label, once each. No join: the list is part of the expression."""
    each = F.array(*(F.struct(F.lit(a).alias("label"), F.lit(w).alias("word")) for a, w in words))
    labels = F.array_distinct(F.transform(F.filter(each, lambda x: F.contains(F.col(text), x["word"])), lambda x: x["label"]))
    return titles.select(key, F.explode(labels).alias("label"))


def history(hits: DataFrame, rows: DataFrame, founding: DataFrame) -> DataFrame:
    """The change history rebuilt from landed notices: hits (notice_id, label) times parsed rows, and founding rows (label, announce_date, review_date, effective_date, action, code).

    One row a (code, announce_date, action, label): its dates are a parsed row's if there is one, of the smallest notice; is_new tells whether a founding row is among them.
    """
    columns = ["label", "announce_date", "review_date", "effective_date", "action", "code"]
    found = hits.join(rows, "notice_id").select(*columns, F.lit(False).alias("is_new"), F.col("notice_id").cast("string").alias("_from"))
    every = found.unionByName(founding.select(*columns, F.lit(True).alias("is_new"), F.lit(None).cast("string").alias("_from")))
    return flag_dedup(every.withColumn("_last", F.col("_from").isNull()), ["label", "announce_date", "action", "code"], ["_last", "_from"], "is_new", ["review_date", "effective_date"])


def next_boundary(df: DataFrame, key: str, position: str, length: Column) -> DataFrame:
    """Where the text after each position ends: at the next position of the key, or at the text's end."""
    return df.withColumn("until", F.coalesce(F.lead(position).over(Window.partitionBy(key).orderBy(position)), length))
