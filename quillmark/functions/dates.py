"""Date functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How months are written in file names.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
FILE_DATE = r"([12]\d\d\d)_([A-Z][a-z][a-z])_(\d{1,2})[\(_]"


def day_batch(c: Column) -> Column:
    return F.date_format(c, "MMddyyyy")


def month_start(c: Column, keep_time: bool = False) -> Column:
    """First of the month; keep_time keeps the time of day, as old logs have it."""
    start = F.trunc(c, "month").cast("timestamp_ntz")
    if not keep_time:
        return start
    return F.timestamp_add("SECOND", F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c), start)


def batch_month(c: Column) -> Column:
    """The first day of a yyyyMM batch, or null."""
    return F.try_to_date(F.concat(c, F.lit("01")), "yyyyMMdd") if hasattr(F, "try_to_date") else F.to_date(F.concat(c, F.lit("01")), "yyyyMMdd")


def file_date(c: Column) -> Column:
    """yyyy-MM-dd from a file name like X_2012_May_3_33(5)_1-2.nxml, or null."""
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(c, FILE_DATE, 2))
    text = date_text(F.regexp_extract(c, FILE_DATE, 1), month.cast("string"), F.regexp_extract(c, FILE_DATE, 3))
    return F.when(c.rlike(FILE_DATE) & (month > 0), text)


def date_text(year: Column, month: Column, day: Column) -> Column:
    """yyyy-MM-dd from parts."""
    return F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))


def update_year(text: Column, this_year: int) -> Column:
    """Latest year up to this one among the lines that speak of an update: the first 20xx of each line counts."""
    lines = F.filter(F.split(text, "[.]"), lambda s: F.lower(s).contains("update") & s.contains("20"))
    years = F.transform(lines, lambda s: F.regexp_extract(s, r"(20\d\d)", 1).try_cast("int"))
    return F.array_max(F.filter(years, lambda y: y <= this_year))


def repaired_year(line: Column, this_year: int) -> Column:
    """Year after 'updated' (the last one), or the end of a span of years, up to this one; null if there is none."""
    after = F.regexp_extract(line, r"(?i)updated?.+(20\d\d)", 1).try_cast("int")
    span = F.regexp_extract(line, r"20\d\d\s*-\s*(20\d\d)", 1).try_cast("int")
    best = F.greatest(F.when(after <= this_year, after), F.when(span <= this_year, span))
    return best
