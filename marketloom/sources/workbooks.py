"""Workbooks (XLSX) as rows of cells, and patches of single cells that leave the rest of a file as it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import archives

#: The members of a workbook, and the built-in number formats that are dates.
BOOK, RELATIONS, STRINGS, STYLES, SHEETS = "xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/sharedStrings.xml", "xl/styles.xml", "xl/worksheets/"
DATES = (*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59))
#: Blanks around texts count.
SPACES = {"ignoreSurroundingSpaces": "false"}
ROW = r"(?s)<row\b(?:[^>]*/>|[^>]*[^/]>.*?</row>)"
CELL = r"(?s)<c\b(?:[^>]*/>|[^>]*[^/]>.*?</c>)"


def texts(spark: SparkSession, path: str, pattern: str = "*.xlsx", only: Column | None = None) -> DataFrame:
    """The XML members of workbooks: path, member, xml. A member, a sheet at most, is one value; others, `only` apart, aren't read."""
    asked = archives.members(spark, path, pattern).where(F.coalesce(F.endswith("member", F.lit(".xml")) | F.endswith("member", F.lit(".rels")), F.lit(False)))
    found = archives.contents(asked if only is None else asked.where(only)).where("error is null")
    parts = F.array_sort(F.collect_list(F.struct("part", "content")))
    whole = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["content"]))
    return found.groupBy("path", "member").agg(F.decode(whole, "utf-8").alias("xml"))


def _sheets(parts: DataFrame) -> DataFrame:
    """path, member, sheet: the members of sheets with their names."""
    book = parts.where(F.col("member") == BOOK).select("path", F.explode(F.from_xml("xml", "sheets struct<sheet: array<struct<_name string, `_r:id` string>>>")["sheets"]["sheet"]).alias("s"))
    links = parts.where(F.col("member") == RELATIONS).select("path", F.explode(F.from_xml("xml", "Relationship array<struct<_Id string, _Target string>>")["Relationship"]).alias("r"))
    named = book.select("path", F.col("s._name").alias("sheet"), F.col("s")["_r:id"].alias("id"))
    target = F.regexp_replace(F.regexp_replace("r._Target", "^/?(xl/)?", ""), "^", "xl/")
    return named.join(links.select("path", F.col("r._Id").alias("id"), target.alias("member")), ["path", "id"]).select("path", "member", "sheet")


def cells(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """The cells of all workbooks below a folder: path, sheet, row, column (letters), kind, value.

    kind is text, number, date, boolean or error; value is its text, of dates the day. Shared strings are joined by their
    index, dates are told by the cell's style. Cells without a value aren't there.
    """
    parts = texts(spark, path, pattern)
    shape = "sheetData struct<row: array<struct<_r int, c: array<struct<_r string, _s int, _t string, v string, is struct<t string, r array<struct<t string>>>>>>>>"
    sheets = _sheets(parts).join(parts.where(F.startswith("member", F.lit(SHEETS))), ["path", "member"])
    rows = sheets.select("path", "sheet", F.explode(F.from_xml("xml", shape, SPACES)["sheetData"]["row"]).alias("r"))
    each = rows.select("path", "sheet", F.explode("r.c").alias("c"))
    each = each.select("path", "sheet", F.regexp_extract("c._r", "[0-9]+", 0).cast("int").alias("row"), F.regexp_extract("c._r", "[A-Z]+", 0).alias("column"), F.coalesce("c._t", F.lit("n")).alias("t"), F.coalesce("c._s", F.lit(0)).alias("style"), F.col("c.v").alias("v"), "c.is")
    runs = lambda x: F.coalesce(x["t"], F.array_join(F.transform(x["r"], lambda y: y["t"]), ""))
    strings = parts.where(F.col("member") == STRINGS).select("path", F.posexplode(F.from_xml("xml", "si array<struct<t string, r array<struct<t string>>>>", SPACES)["si"]).alias("index", "si"))
    strings = strings.select("path", F.col("index").alias("style_"), runs(F.col("si")).alias("shared"))
    styles = F.from_xml("xml", "numFmts struct<numFmt: array<struct<_numFmtId int, _formatCode string>>>, cellXfs struct<xf: array<struct<_numFmtId int>>>")
    s = parts.where(F.col("member") == STYLES).select("path", styles.alias("s"))
    own = F.filter(F.col("s.numFmts.numFmt"), lambda x: F.regexp_like(F.regexp_replace(F.lower(x["_formatCode"]), r'"[^"]*"|\[[^\]]*\]|\\.', ""), F.lit("[dmyhs]")))
    dates = F.concat(F.array(*map(F.lit, DATES)), F.coalesce(F.transform(own, lambda x: x["_numFmtId"]), F.array().cast("array<int>")))
    s = s.select("path", F.posexplode(F.transform("s.cellXfs.xf", lambda x: F.array_contains(dates, x["_numFmtId"]))).alias("style", "dated"))
    found = each.withColumn("style_", F.when(F.col("t") == "s", F.col("v").cast("int"))).join(strings, ["path", "style_"], "left").join(s, ["path", "style"], "left")
    day = F.date_add(F.lit("1899-12-30").cast("date"), F.floor(F.col("v").cast("double")).cast("int")).cast("string")
    dated = F.coalesce("dated", F.lit(False)) & (F.col("t") == "n")
    kind = F.when(F.col("t").isin("s", "str", "inlineStr"), "text").when(F.col("t") == "b", "boolean").when(F.col("t") == "e", "error").when(F.col("t") == "d", "date").when(dated, "date").otherwise("number")
    value = F.when(F.col("t") == "s", F.col("shared")).when(F.col("t") == "inlineStr", runs(F.col("is"))).when(F.col("t") == "b", F.when(F.col("v") == "1", "TRUE").otherwise("FALSE")).when(dated, day).otherwise(F.col("v"))
    return found.select("path", "sheet", "row", "column", kind.alias("kind"), value.alias("value")).where("value is not null")


def table(found: DataFrame, header: int = 1) -> DataFrame:
    """Rows of sheets by the names in their header row: path, sheet, row, values (map of name to text). Cells without a name are left out; of two like names the last column counts."""
    names = found.where(F.col("row") == header).select("path", "sheet", "column", F.col("value").alias("name"))
    width = F.struct(F.length("column"), "column")
    named = found.where(F.col("row") > header).join(names, ["path", "sheet", "column"]).groupBy("path", "sheet", "row", "name").agg(F.max_by("value", width).alias("value"))
    return named.groupBy("path", "sheet", "row").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("values"))


def _escaped(c: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def cell_xml(reference: Column, kind: Column, value: Column, style: Column) -> Column:
    """One cell's XML: text inline, dates as serial numbers."""
    start = F.concat(F.lit('<c r="'), reference, F.lit('"'), F.coalesce(F.concat(F.lit(' s="'), style.cast("string"), F.lit('"')), F.lit("")))
    number = F.when(kind == "date", F.datediff(value.cast("date"), F.lit("1899-12-30").cast("date")).cast("string")).otherwise(value)
    return (
        F.when(value.isNull(), F.concat(start, F.lit("/>")))
        .when(kind == "text", F.concat(start, F.lit(' t="inlineStr"><is><t xml:space="preserve">'), _escaped(value), F.lit("</t></is></c>")))
        .when(kind == "boolean", F.concat(start, F.lit(' t="b"><v>'), F.when(F.upper(value).isin("TRUE", "1"), "1").otherwise("0"), F.lit("</v></c>")))
        .otherwise(F.concat(start, F.lit("><v>"), number, F.lit("</v></c>")))
    )


def patch(spark: SparkSession, path: str, target: str, changes: DataFrame, pattern: str = "*.xlsx") -> None:
    """Writes the workbooks below path to the folder target with changes (archive, sheet, row, column, kind, value, style).

    archive is a file's name. A change overwrites its cell, keeping the cell's style where it names none, or adds it, and
    its row where there is none; a null value empties the cell. Rows without changes, and all other members, stay byte for byte as they are. A
    sheet's rows are parsed one by one; its text is put together again in one task, like the sheet of any workbook.
    """
    parts = texts(spark, path, pattern).withColumn("archive", F.substring_index("path", "/", -1))
    members = archives.members(spark, path, pattern)
    sheets = _sheets(parts).withColumn("archive", F.substring_index("path", "/", -1))
    asked = changes.join(sheets, ["archive", "sheet"]).select("path", "member", F.col("row").cast("int").alias("row"), "column", "kind", "value", "style")
    touched = parts.join(asked.select("path", "member").distinct(), ["path", "member"])
    number = lambda c: F.regexp_extract(c, r'\br="[A-Z]*([0-9]+)"', 1).cast("int")
    rows = touched.select("path", "member", F.explode(F.regexp_extract_all("xml", F.lit(ROW), F.lit(0))).alias("raw")).withColumn("row", number(F.col("raw")))
    changed = asked.select("path", "member", "row").distinct()
    kept = rows.join(changed, ["path", "member", "row"], "left_anti").select("path", "member", "row", "raw")
    old = rows.join(changed, ["path", "member", "row"]).select("path", "member", "row", F.regexp_extract("raw", r"<row\b[^>]*?(?=/?>)", 0).alias("open"), F.regexp_extract_all("raw", F.lit(CELL), F.lit(0)).alias("cells"))
    was = old.select("path", "member", "row", F.explode("cells").alias("was")).withColumn("column", F.regexp_extract("was", r'\br="([A-Z]+)', 1))
    both = was.join(asked.withColumn("_p", F.lit(True)), ["path", "member", "row", "column"], "full_outer")
    style = F.coalesce(F.col("style").cast("string"), F.nullif(F.regexp_extract("was", r'<c\b[^>]*\bs="([0-9]+)"', 1), F.lit("")))
    now = F.when(F.col("_p"), cell_xml(F.concat("column", F.col("row").cast("string")), F.col("kind"), F.col("value"), style)).otherwise(F.col("was"))
    line = F.array_sort(F.collect_list(F.struct(F.length("column").alias("w"), "column", now.alias("xml"))))
    made = both.groupBy("path", "member", "row").agg(F.array_join(F.transform(line, lambda x: x["xml"]), "").alias("cells"))
    opening = F.coalesce("open", F.concat(F.lit('<row r="'), F.col("row").cast("string"), F.lit('"')))
    made = made.join(old.drop("cells"), ["path", "member", "row"], "left").select("path", "member", "row", F.concat(opening, F.lit(">"), "cells", F.lit("</row>")).alias("raw"))
    body = kept.unionByName(made).groupBy("path", "member").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "raw"))), lambda x: x["raw"]), "").alias("body"), F.max("row").alias("last"))
    head = F.regexp_extract("xml", r"(?s)^(.*?<sheetData)\s*(?:/>|>)", 1)
    head = F.regexp_replace(head, F.lit(r'(<dimension ref="[A-Z]+[0-9]+:[A-Z]+)[0-9]+'), F.concat(F.lit("$1"), F.col("last").cast("string")))
    tail = F.regexp_extract("xml", r"(?s)(?:</sheetData>|<sheetData\s*/>)(.*)$", 1)
    sheet = touched.join(body, ["path", "member"]).select("path", "member", F.encode(F.concat(head, F.lit(">"), "body", F.lit("</sheetData>"), tail), "utf-8").alias("content"))
    others = archives.contents(members.join(sheet.select("path", "member"), ["path", "member"], "left_anti"))
    others = others.groupBy("path", "member").agg(F.aggregate(F.array_sort(F.collect_list(F.struct("part", "content"))), F.lit(b""), lambda a, x: F.concat(a, x["content"])).alias("content"))
    archives.packed(others.unionByName(sheet).select(F.substring_index("path", "/", -1).alias("archive"), "member", "content"), target)
