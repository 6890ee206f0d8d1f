from __future__ import annotations

from datetime import date, timedelta

import pandas as pd
import pytest
from support import values
from pyspark.sql import functions as F

from lakeops.functions.dates import (
    calendar_columns,
    chunk_ranges,
    compact_date,
    date_range_array,
    normalize_dt,
    normalize_dt_text,
    parse_date,
    previous_day,
    previous_day_utc,
)
from lakeops.functions.text import (
    ingest_order,
    join_location,
    json_sorted,
    location_parts,
    partition_location,
    partition_of,
    sanitize_key,
    sha256_text,
)
from lakeops.operators.units import date_spine


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("20240105", "2024-01-05"),
        ("2024-01-05", "2024-01-05"),
        ("2024-1-5", "2024-01-05"),
        (" 2024-01-05 ", "2024-01-05"),
        ("2024-01-05 10:00:00", "2024-01-05"),
        ("2024-01-05T10:00:00", "2024-01-05"),
        ("2024/01/05", "2024-01-05"),
        ("2024-01", None),
        ("2024", None),
        ("x", None),
        ("", None),
        (None, None),
        ("2024-02-30", None),
        ("20241399", None),
        ("2024-01-05 junk", None),
        ("2024-01-05 25:00:00", None),
        ("2024-01-05 10", None),
        ("2024-01-05T", None),
        ("2024-01/05", None),
        ("2024-01-05T10:00:00Z", "2024-01-05"),
        ("2024-01-05 10:00:00.123+08:00", "2024-01-05"),
        ("2024 01 05", "2024-01-05"),
        ("2024\\01\\05", "2024-01-05"),
        ("\t2024-01-05\n", "2024-01-05"),
        ("\t20240105\t", None),
        ("epoch", None),
        ("24-1-5", None),
    ],
)
def test_normalize_dt_text(spark, text, expected):
    assert one(spark, normalize_dt_text(F.lit(text).cast("string"))) == expected


def test_normalize_dt_by_type(spark):
    frame = spark.sql(
        "SELECT DATE '2024-12-17' AS d, TIMESTAMP_NTZ '2024-12-17 23:59:59' AS t, "
        "20241217 AS i, 1.5D AS x"
    )
    row = frame.select(*[normalize_dt(frame, c).alias(c) for c in frame.columns]).first()
    assert tuple(row) == ("2024-12-17", "2024-12-17", "2024-12-17", None)


def test_parse_date_strict_and_lenient(spark):
    assert one(spark, parse_date(F.lit("20240229"))) == date(2024, 2, 29)
    assert one(spark, parse_date(F.lit("20230229"))) is None
    with pytest.raises(Exception, match="CANNOT_PARSE|date"):
        one(spark, parse_date(F.lit("20230229"), strict=True))
    assert one(spark, compact_date(F.lit("2024-01-05"))) == "20240105"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_previous_day_ignores_session_zone(spark, zone):
    cases = {
        "2024-12-17T02:00:00+08:00": date(2024, 12, 16),
        "2024-01-01T00:30:00+08:00": date(2023, 12, 31),
        "2024-03-01T12:00:00+08:00": date(2024, 2, 29),
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for text, expected in cases.items():
            assert one(spark, previous_day(F.lit(text).cast("timestamp"))) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    naive = F.lit("2023-12-31 17:00:00").cast("timestamp_ntz")
    assert one(spark, previous_day_utc(naive)) == date(2023, 12, 31)


def test_calendar_columns_against_python(spark):
    first = date(2019, 12, 20)
    days = [first + timedelta(days=n) for n in range(1200)]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    rows = frame.select("d", *calendar_columns(F.col("d"))).collect()
    compat = frame.select("d", *calendar_columns(F.col("d"), compat=True)).collect()
    for row, old in zip(rows, compat, strict=True):
        d, tomorrow = row["d"], row["d"] + timedelta(days=1)
        assert row["trade_day_of_week"] == d.isoweekday() % 7
        assert row["trade_week_of_year"] == d.isocalendar()[1]
        assert row["trade_day_of_year"] == d.timetuple().tm_yday
        assert row["is_weekday"] == (d.isoweekday() <= 5)
        assert old["is_weekday"] == (d.isoweekday() % 7 not in (1, 7))
        assert row["is_month_end"] == (tomorrow.day == 1)
        assert row["is_quarter_end"] == (tomorrow.day == 1 and tomorrow.month in (1, 4, 7, 10))
        assert row["is_year_end"] == ((d.month, d.day) == (12, 31))


def brute_chunks(start, end, freq):
    """Cursor walk with pandas offsets."""
    if len(pd.date_range(start, end, freq=freq)) == 0:
        return [(start, end, None)]
    offset = pd.tseries.frequencies.to_offset(freq)
    cursor, last, out = pd.Timestamp(start), pd.Timestamp(end), []
    while cursor <= last:
        following = cursor + offset
        stop = min(following - pd.Timedelta(days=1), last)
        out.append((str(cursor.date()), str(stop.date()), cursor.strftime("%Y%m")))
        cursor = following
    return out


@pytest.mark.parametrize(
    ("freq", "offset"),
    [
        ("1M", "ME"),
        ("2M", "2ME"),
        ("7D", "7D"),
        ("1D", "D"),
        ("W", "W"),
        ("2W", "2W"),
        ("MS", "MS"),
        ("3MS", "3MS"),
        ("Q", "QE"),
        ("2QE", "2QE"),
        ("Y", "YE"),
    ],
)
def test_chunk_ranges_against_pandas(spark, freq, offset):
    starts = ["2023-12-31", "2024-01-01", "2024-01-15", "2024-01-31", "2024-02-29", "2024-03-30"]
    pairs = [
        (s, str(date.fromisoformat(s) + timedelta(days=n)))
        for s in starts
        for n in (0, 1, 5, 6, 7, 15, 19, 30, 31, 60, 91, 200, 400, 800)
    ]
    frame = spark.createDataFrame(pairs, "s string, e string")
    chunks = chunk_ranges(F.col("s"), F.col("e"), freq)
    for row in frame.select("s", "e", chunks.alias("c")).collect():
        got = [(str(c[0]), str(c[1]), c[2]) for c in row["c"]]
        assert got == brute_chunks(row["s"], row["e"], offset), (row["s"], row["e"])


def test_chunk_ranges_examples(spark):
    def chunks(start, end, freq):
        return [
            (str(a), str(b)) for a, b, _ in one(spark, chunk_ranges(F.lit(start), F.lit(end), freq))
        ]

    assert chunks("2024-01-31", "2024-03-31", "1M") == [
        ("2024-01-31", "2024-02-28"),
        ("2024-02-29", "2024-03-30"),
        ("2024-03-31", "2024-03-31"),
    ]
    assert chunks("2024-01-15", "2024-03-02", "month") == [
        ("2024-01-15", "2024-01-31"),
        ("2024-02-01", "2024-02-29"),
        ("2024-03-01", "2024-03-02"),
    ]
    assert chunks("2024-02-01", "2024-01-01", "1M") == [("2024-02-01", "2024-01-01")]
    with pytest.raises(ValueError, match="frequency"):
        chunk_ranges(F.lit("2024-01-01"), F.lit("2024-01-01"), "1H")


def test_date_spine(spark):
    assert values(date_spine(spark, "2024-02-28", "2024-03-01")) == [
        ("2024-02-28",),
        ("2024-02-29",),
        ("2024-03-01",),
    ]
    assert values(date_spine(spark, "2024-01-01", "2024-01-01")) == [("2024-01-01",)]
    with pytest.raises(ValueError, match="before"):
        date_spine(spark, "2024-01-02", "2024-01-01")
    backwards = date_range_array(F.lit("2024-01-02").cast("date"), F.lit("2024-01-01").cast("date"))
    assert one(spark, backwards) == []


def test_text_functions(spark):
    lit = F.lit
    assert one(spark, sanitize_key(lit("a b/c-d_é1:x"))) == "a_b_c-d_é1_x"
    assert one(spark, sha256_text(lit("abc"))).startswith("ba7816bf8f01cfea")
    assert one(spark, join_location(lit("s3://b/"), lit("/k/x"))) == "s3://b/k/x"
    parts = one(spark, location_parts(lit("s3://bucket/lake/t")))
    assert tuple(parts) == ("s3", "bucket", "lake/t")
    where = partition_location(lit("s3://b/t"), lit("2024-01-05"))
    assert one(spark, where) == "s3://b/t/dt=2024-01-05"
    assert one(spark, partition_of(lit("f:/t/dt=2024-01-01/dt=2024-01-05/x.parquet"))) == "2024-01-05"
    assert one(spark, partition_of(lit("f:/t/x.parquet"))) is None
    assert one(spark, ingest_order(lit("f:/t/part_000012.parquet"))) == 12
    assert one(spark, ingest_order(lit("f:/t/part_000012.parquet/part-0-x.parquet"))) == 12
    assert one(spark, ingest_order(lit("f:/t/other.parquet"))) == 0
    text = one(spark, json_sorted(b=lit(1), a=lit("x"), c=lit(None).cast("string")))
    assert text == '{"a":"x","b":1,"c":null}'
