"""Date expressions: parsing, partition keys, calendar attributes, ranges.

Everything here is a ``Column``; nothing leaves the JVM or stops codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPACT = "yyyyMMdd"
DASHED = "yyyy-MM-dd"


def parse_date(value: Column, fmt: str = COMPACT, strict: bool = False) -> Column:
    """Text in ``fmt`` to DATE. Bad text raises when ``strict``, else gives NULL."""
    return F.to_date(value, fmt) if strict else F.try_to_date(value, fmt)


#: Year, month and day with one kind of separator, then perhaps a time of day.
_DAY = (
    r"^\s*([0-9]{4})([-/\\ ])([0-9]{1,2})\2([0-9]{1,2})"
    r"([ T]([01]?[0-9]|2[0-3]):[0-5]?[0-9](:[0-5]?[0-9](\.[0-9]+)?)?"
    r"( ?(Z|UTC|[+-][0-9]{2}(:?[0-9]{2})?))?)?\s*$"
)


def normalize_dt_text(value: Column) -> Column:
    """Text to a ``yyyy-MM-dd`` partition key, or NULL when it is no date.

    Accepts ``yyyyMMdd`` and year, month, day with ``-``, ``/``, a backslash or a
    blank between them (one or two digits for month and day), followed by a
    valid time or nothing. The patterns guard the cast, which on its own would
    also take ``2024`` or ``2024-01``. Special words and years that do not have
    four digits are no partition keys.
    """
    compact = F.trim(value)
    parsed = F.when(compact.rlike(r"^[0-9]{8}$"), F.try_to_date(compact, COMPACT)).when(
        value.rlike(_DAY), F.regexp_replace(value, _DAY, "$1-$3-$4").try_cast("date")
    )
    return F.date_format(parsed, DASHED)


def normalize_dt(df: DataFrame, column: str) -> Column:
    """Partition key from a column of any type (dates skip the text parsing)."""
    dtype = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, DASHED)
    return normalize_dt_text(value.cast("string"))


def coerce_date(df: DataFrame, column: str) -> Column:
    """DATE/TIMESTAMP columns as they are, anything else parsed, bad values NULL."""
    dtype = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value
    return F.to_date(normalize_dt_text(value.cast("string")), DASHED)


def compact_date(value: Column) -> Column:
    """``2024-01-05`` (text or DATE) to ``20240105``."""
    return F.replace(value.cast("string"), F.lit("-"), F.lit(""))


def dashed_date(value: Column) -> Column:
    """DATE or TIMESTAMP to ``yyyy-MM-dd`` text."""
    return F.date_format(value, DASHED)


def previous_day(instant: Column | None = None, zone: str = "Asia/Shanghai") -> Column:
    """The day before ``instant`` (default: now) as seen in ``zone``.

    Goes through TIMESTAMP_NTZ with the session zone named, so the answer does
    not depend on the session time zone.
    """
    moment = F.current_timestamp() if instant is None else instant
    local = F.convert_timezone(F.current_timezone(), F.lit(zone), moment.cast("timestamp_ntz"))
    return F.date_sub(F.to_date(local), 1)


def previous_day_utc(naive_utc: Column, zone: str = "Asia/Shanghai") -> Column:
    """``previous_day`` for a TIMESTAMP_NTZ column that holds UTC wall time."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), naive_utc)
    return F.date_sub(F.to_date(local), 1)


def calendar_columns(day: Column, compat: bool = False) -> list[Column]:
    """The eleven derived calendar attributes of a DATE column.

    ``trade_day_of_week`` counts from Sunday = 0. ``is_weekday`` means Monday to
    Friday; ``compat`` keeps the older rule "day number not 1 or 7" instead.
    """
    weekday_number = F.dayofweek(day) - 1
    is_weekday = ~weekday_number.isin(1, 7) if compat else weekday_number.between(1, 5)
    quarter_end = F.date_sub(F.add_months(F.trunc(day, "quarter"), 3), 1)
    return [
        F.year(day).alias("trade_year"),
        F.month(day).alias("trade_month"),
        F.quarter(day).alias("trade_quarter"),
        weekday_number.alias("trade_day_of_week"),
        F.dayofmonth(day).alias("trade_day_of_month"),
        F.dayofyear(day).alias("trade_day_of_year"),
        F.weekofyear(day).alias("trade_week_of_year"),
        is_weekday.alias("is_weekday"),
        (day == F.last_day(day)).alias("is_month_end"),
        (day == quarter_end).alias("is_quarter_end"),
        ((F.month(day) == 12) & (F.dayofmonth(day) == 31)).alias("is_year_end"),
    ]


def date_range_array(start: Column, end: Column) -> Column:
    """All days from ``start`` to ``end`` inclusive; empty when end < start."""
    return F.when(
        end >= start, F.sequence(start, end, F.expr("interval 1 day"))
    ).otherwise(F.array().cast("array<date>"))


def _anchors(start: Column, end: Column, unit: str) -> tuple[Column, Column]:
    """Cut points of a calendar unit: (all from start's period on, the first one >= start)."""

    def periods(name: str, step: str) -> Column:
        return F.sequence(F.trunc(start, name), F.trunc(end, name), F.expr(f"interval {step}"))

    def last_of(day: Column, months: int) -> Column:
        return F.date_sub(F.add_months(day, months), 1)

    if unit == "month end":
        return F.transform(periods("month", "1 month"), F.last_day), F.last_day(start)
    if unit == "quarter end":
        ends = F.transform(periods("quarter", "3 month"), lambda d: last_of(d, 3))
        return ends, last_of(F.trunc(start, "quarter"), 3)
    if unit == "year end":
        ends = F.transform(periods("year", "1 year"), lambda d: last_of(d, 12))
        return ends, last_of(F.trunc(start, "year"), 12)
    if unit == "month start":
        first = F.trunc(start, "month")
        following = F.when(first == start, start).otherwise(F.add_months(first, 1))
        return periods("month", "1 month"), following
    sunday = F.next_day(F.date_sub(start, 1), "Sun")
    weeks = F.when(sunday <= end, F.sequence(sunday, end, F.expr("interval 7 day")))
    return F.coalesce(weeks, F.array().cast("array<date>")), sunday


#: Frequency names and the calendar unit they cut at (fixed values).
FREQUENCIES = {
    "M": "month end",
    "ME": "month end",
    "MS": "month start",
    "Q": "quarter end",
    "QE": "quarter end",
    "Y": "year end",
    "YE": "year end",
    "A": "year end",
    "W": "week",
    "D": "day",
}


def chunk_ranges(start: Column, end: Column, freq: str = "1M") -> Column:
    """Contiguous ranges covering ``start``..``end`` as array<struct<start,end,shard_id>>.

    ``freq`` is a count and a name of ``FREQUENCIES``: ``nM`` cuts at every n-th
    month end after ``start``, ``nW`` at Sundays, ``nD`` after every n days, and
    so on; ``month`` cuts at calendar months. It is an array expression, so ranges
    can be made per row without a window or a join; explode it for one row per range.
    A range without any cut point keeps a NULL ``shard_id``, others carry yyyyMM.
    """
    start, end = start.cast("date"), end.cast("date")
    pattern = re.fullmatch(r"([0-9]*)([A-Z]+)|month", freq)
    name = pattern.group(2) if pattern else None
    step = int(pattern.group(1) or 1) if name else 1
    if not pattern or step < 1 or (name and name not in FREQUENCIES):
        raise ValueError(f"Unsupported frequency: {freq}")
    sharded = F.lit(True)
    if name is None:
        first = F.add_months(F.trunc(start, "month"), 1)
        later = F.when(first <= end, F.sequence(first, end, F.expr("interval 1 month")))
    elif name == "D":
        first = F.date_add(start, step)
        later = F.when(first <= end, F.sequence(first, end, F.expr(f"interval {step} day")))
    else:
        cuts, first = _anchors(start, end, FREQUENCIES[name])
        later = F.filter(cuts, lambda c: (c > start) & (c <= end))
        if step > 1:
            later = F.filter(later, lambda _, i: (i + 1) % step == 0)
        sharded = first <= end
    later = F.coalesce(later, F.array().cast("array<date>"))
    cut = F.zip_with(
        F.concat(F.array(start), later),
        F.concat(F.transform(later, lambda d: F.date_sub(d, 1)), F.array(end)),
        lambda first_day, last_day: F.struct(
            first_day.alias("start_date"),
            last_day.alias("end_date"),
            F.when(sharded, F.date_format(first_day, "yyyyMM")).alias("shard_id"),
        ),
    )
    whole = F.array(
        F.struct(
            start.alias("start_date"),
            end.alias("end_date"),
            F.lit(None).cast("string").alias("shard_id"),
        )
    )
    return F.when(end >= start, cut).otherwise(whole)
