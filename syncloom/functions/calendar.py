"""Date keys, business dates and Jalali dates as column arithmetic."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days of a 33-year cycle and of four years whose first is a leap year.
CYCLE_DAYS, FOUR_YEARS = 12_053, 1_461
#: First year of a cycle, and the Gregorian day on which it began: 1403-01-01 was 2024-03-20, 424 years (12 cycles and 28 years) later.
CYCLE_YEAR = 979
CYCLE_START = date(2024, 3, 20) - timedelta(days=12 * CYCLE_DAYS + 7 * FOUR_YEARS)


def to_day(c: Column) -> Column:
    """Date from YYYYMMDD or YYYY-MM-DD text, a number YYYYMMDD, a date or a timestamp; NULL if it is none."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd")).when(text.rlike(r"^\d{4}-\d{2}-\d{2}([ T].*)?$"), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd")


def is_date_key(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{8}$") & F.try_to_date(c, "yyyyMMdd").isNotNull(), F.lit(False))


def shifted_key(c: Column, days: int) -> Column:
    return date_key(F.date_add(F.try_to_date(c, "yyyyMMdd"), days))


def key_range(low: Column, high: Column) -> Column:
    """Array of the date keys from low to high, both included; empty if low is later."""
    a, b = F.try_to_date(low, "yyyyMMdd"), F.try_to_date(high, "yyyyMMdd")
    return F.when(a <= b, F.transform(F.sequence(a, b), date_key)).otherwise(F.array().cast("array<string>"))


def jalali(d: Column) -> Column:
    """struct(year, month, day) of a Gregorian date, by the 33-year cycle."""
    n = F.datediff(d, F.lit(CYCLE_START))
    cycle, in_cycle = F.floor(n / CYCLE_DAYS), F.pmod(n, F.lit(CYCLE_DAYS))
    four, rest = F.floor(in_cycle / FOUR_YEARS), F.pmod(in_cycle, F.lit(FOUR_YEARS))
    # the first of four years has 366 days
    later = rest > 365
    year = F.lit(CYCLE_YEAR) + cycle * 33 + four * 4 + F.when(later, F.floor((rest - 1) / 365)).otherwise(0)
    day = F.when(later, F.pmod(rest - 1, F.lit(365))).otherwise(rest)
    first_half = day < 186
    month = F.when(first_half, F.floor(day / 31) + 1).otherwise(F.floor((day - 186) / 30) + 7)
    of_month = F.when(first_half, F.pmod(day, F.lit(31))).otherwise(F.pmod(day - 186, F.lit(30))) + 1
    return F.when(d.isNotNull(), F.struct(year.cast("int").alias("year"), month.cast("int").alias("month"), of_month.cast("int").alias("day")))


def jalali_text(j: Column, style: str = "YYYYMMDD") -> Column:
    y, m, d = F.lpad(j["year"].cast("string"), 4, "0"), F.lpad(j["month"].cast("string"), 2, "0"), F.lpad(j["day"].cast("string"), 2, "0")
    forms = {"YYYY": y, "YYYYMM": F.concat(y, m), "YYYYMMDD": F.concat(y, m, d), "YYYY/MM/DD": F.concat_ws("/", y, m, d)}
    return F.when(j.isNotNull(), forms[style])


def partition_value(c: Column, style: str, column: str | None = "partition") -> Column:
    """Partition value of a business date. Styles: YYYYMMDD, YYYYMM, YYYY, or PERSIAN_, JALALI_ or SHAMSI_ with one of these or YYYY/MM/DD.

    Case doesn't matter; without a partition column the value is NULL; another style is an error.
    """
    if not column:
        return F.lit(None).cast("string")
    name = (style or "").strip().upper()
    gregorian = {"YYYYMMDD": "yyyyMMdd", "YYYYMM": "yyyyMM", "YYYY": "yyyy"}
    if name in gregorian:
        return F.date_format(to_day(c), gregorian[name])
    kind, _, form = name.partition("_")
    if kind in ("PERSIAN", "JALALI", "SHAMSI") and form in ("YYYY", "YYYYMM", "YYYYMMDD", "YYYY/MM/DD"):
        return jalali_text(jalali(to_day(c)), form)
    raise ValueError(f"unknown partition format: {style!r}")


def version_id(execution_date: Column) -> Column:
    """Digits of the date, the first 14, padded with zeros on the right; now if there are none."""
    digits = F.substring(F.regexp_replace(execution_date.cast("string"), r"\D", ""), 1, 14)
    given = F.when(F.length(digits) > 0, F.rpad(digits, 14, "0"))
    return F.coalesce(given, F.date_format(F.current_timestamp(), "yyyyMMddHHmmss")).cast("bigint")


def safe_name(c: Column, size: int = 50) -> Column:
    return F.substring(F.regexp_replace(c, r"[^\w]", "_"), 1, size)
