"""Column expressions for cleaning market-data text, dates and numbers. All of them are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the loose company-name normaliser removes, in this order, anywhere in the name.
NAME_PARTS = (
    " co ltd", " co. ltd", " co., ltd", " co.,ltd", " corp", " corporation", " inc", " ltd", " co", " holding", " holdings",
    " enterprise", " enterprises", " international", " group", "/taiwan", "/the", "/tw",
)


def strip_unicode(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def norm_whitespace(c: Column) -> Column:
    """Removes all white space, full-width spaces included."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def normalize_name(c: Column, parts=NAME_PARTS) -> Column:
    """Lower-cased, stripped, the parts removed in order (substrings, not suffixes), other signs dropped."""
    c = strip_unicode(F.lower(c))
    for p in parts:
        c = F.replace(c, F.lit(p), F.lit(""))
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?U)[^a-z0-9\s]", ""), r"(?U)\s+", " "))


def clean_ticker(c: Column) -> Column:
    """Trailing T and blanks off, then leading zeros off."""
    return F.regexp_replace(F.regexp_replace(c, r"[T ]+$", ""), r"^0+", "")


def to_lots(c: Column, lot: int = 1000) -> Column:
    """Shares with thousands separators as lots."""
    return F.replace(c, F.lit(","), F.lit("")).cast("bigint") / F.lit(float(lot))


def falsy_coalesce(*cols: Column) -> Column:
    """The first that is neither null nor empty; else an empty string."""
    return F.coalesce(*(F.nullif(c.cast("string"), F.lit("")) for c in cols), F.lit(""))


#: How a date stands in a text, year, month and day each a group; the first form goes before the second.
DATE_FORMS = (r"(20\d{2})\s*[年/]\s*(\d{1,2})\s*[月/]\s*(\d{1,2})", r"(20\d{2})(\d{2})(\d{2})")


def parse_date_any(c: Column, forms: tuple[str, ...] = DATE_FORMS) -> Column:
    """The first date in a text of the first of the forms that it has; null if it is no real day."""
    def parts(pattern):
        y, m, d = (F.regexp_extract(c, rf"(?U){pattern}", k) for k in (1, 2, 3))
        return F.when(y != "", F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))

    return F.try_to_date(F.coalesce(*map(parts, forms)), "yyyy-MM-dd")


def excel_serial(c: Column) -> Column:
    return F.datediff(c, F.lit("1899-12-30").cast("date"))


def from_excel_serial(c: Column) -> Column:
    return F.date_add(F.lit("1899-12-30").cast("date"), c.cast("int"))


def human_bytes(c: Column) -> Column:
    """Bytes with a unit up to PB, one place after the point."""
    size, units = c.cast("double"), ("B", "KB", "MB", "GB", "TB", "PB")
    texts = [F.format_string("%.1f" + unit, F.bround(size / F.lit(float(1024**k)), 1)) for k, unit in enumerate(units)]
    out = F.when(size < 1024.0, texts[0])
    for k in range(1, 5):
        out = out.when(size < float(1024 ** (k + 1)), texts[k])
    return out.otherwise(texts[5])


def truthy(c: Column) -> Column:
    """Whether a cell says true: true or 1, however it is stored."""
    return F.coalesce(F.lower(c.cast("string")).isin("true", "1"), F.lit(False))


def subscribed(status: Column, message: Column) -> Column:
    """Whether a subscription holds: status 200 and a message that isn't "expired"."""
    return F.coalesce(status == 200, F.lit(False)) & ~message.eqNullSafe(F.lit("已到期"))


def name_prefix(c: Column) -> Column:
    """A file name's part before the first underscore: its date."""
    return F.substring_index(c, "_", 1)


def enum_label(c: Column, labels: dict) -> Column:
    """The code's label; a code without one is itself, as text."""
    mapping = F.create_map(*(F.lit(x) for kv in labels.items() for x in kv))
    return F.coalesce(F.element_at(mapping, c), c.cast("string"))


def arrow(c: Column) -> Column:
    return F.when(c > 0, "▲").when(c < 0, "▼").otherwise("")


def progress_bar(percent: Column, width: int = 20) -> Column:
    done = F.least(F.greatest(F.floor(percent / 100 * width), F.lit(0)), F.lit(width)).cast("int")
    return F.concat(F.repeat(F.lit("#"), done), F.repeat(F.lit("-"), F.lit(width) - done))


def safe_file_name(c: Column, most: int = 80) -> Column:
    return F.substring(F.trim(F.regexp_replace(c, r'[\\/:*?"<>|\r\n\t]', "")), 1, most)


def percent_change(now: Column, before: Column) -> Column:
    """Null where the base is zero."""
    return F.try_divide(now - before, before) * 100


def in_blackout(ts: Column, start: int, end: int) -> Column:
    """Whether a time's minute of the day is in [start, end)."""
    minute = F.hour(ts) * 60 + F.minute(ts)
    return (minute >= start) & (minute < end)


def previous_weekday(d: Column) -> Column:
    return F.date_sub(d, F.when(F.weekday(d) == 0, 3).when(F.weekday(d) == 6, 2).otherwise(1))
