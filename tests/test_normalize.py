from __future__ import annotations

from datetime import date

import pytest
from support import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.normalize import (
    assign_partition,
    conform,
    drop_internal,
    enabled_only,
    exclude_dates,
    filter_date_range,
    keep_dates,
    only_partition,
    project_existing,
    rejected_by_conform,
    rename,
    require_columns,
    split_valid_partition,
    stamp,
    stamp_if_missing,
)
from lakeops.sources.schemas import SCHEMAS, describe_schema, empty_table

SPOT = SCHEMAS["ods_fund_etf_spot"]
FORMATS = {"trade_date": "yyyyMMdd"}


def test_conform_orders_casts_and_fills(spark):
    ddl = "trade_date string, amount string, symbol string, extra string"
    raw = spark.createDataFrame([("20240105", "1.5", "007", "x")], ddl)
    market = T.StructField("market", T.StringType(), True, {"default": "SH"})
    schema = T.StructType([*SPOT.fields, market])
    typed = conform(raw, schema, date_formats=FORMATS)
    assert typed.columns == ["symbol", "name", "amount", "trade_date", "market"]
    assert values(typed) == [("007", None, 1.5, date(2024, 1, 5), "SH")]


def test_conform_strict_raises_and_lenient_nulls(spark):
    raw = spark.createDataFrame([("a", "", "20241399")], "symbol string, amount string, trade_date string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        conform(raw, SPOT, date_formats=FORMATS).collect()
    typed = conform(raw, SPOT, strict=False, date_formats=FORMATS)
    assert values(typed) == [("a", None, None, None)]
    assert raw.select(rejected_by_conform(raw, SPOT, FORMATS)).first()[0] == "amount"


def test_columns(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "`日期` int, b int, _c int")
    assert rename(frame, {"日期": "trade_date", "none": "x"}).columns == ["trade_date", "b", "_c"]
    assert project_existing(frame, ["b", "z", "日期"]).columns == ["b", "日期"]
    assert drop_internal(frame).columns == ["日期", "b"]
    assert require_columns(frame, ["b"]) is frame
    with pytest.raises(ValueError, match="z"):
        require_columns(frame, ["b", "z"])
    assert values(stamp(frame, flag="W"), "flag") == [("W",)]
    assert stamp_if_missing(frame, "b", 9) is frame
    assert values(stamp_if_missing(frame, "q", 9), "q") == [(9,)]
    assert enabled_only(spark.sql("SELECT explode(array(0, 1, 2)) AS enabled")).count() == 1


def test_filter_date_range(spark):
    rows = [("20240101",), ("2024-01-02",), ("bad",), (None,), ("20240103",)]
    frame = spark.createDataFrame(rows, "trade_date string")
    assert filter_date_range(frame, "trade_date").count() == 5
    assert values(filter_date_range(frame, "trade_date", "2024-01-02")) == [
        ("2024-01-02",),
        ("20240103",),
    ]
    assert values(filter_date_range(frame, "trade_date", end="2024-01-02")) == [
        ("2024-01-02",),
        ("20240101",),
    ]
    moments = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ '2024-01-02 00:00:00', TIMESTAMP_NTZ '2024-01-02 10:00:00')) AS t"
    )
    assert filter_date_range(moments, "t", end="2024-01-02").count() == 1


def test_date_filter_reaches_the_scan(spark, tmp_path):
    spark.sql("SELECT DATE '2024-01-01' AS d, 1 AS x").write.parquet(str(tmp_path / "p"))
    frame = filter_date_range(spark.read.parquet(str(tmp_path / "p")), "d", "2024-01-01")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d" in plan


def test_date_sets(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "dt string, v int")
    other = spark.createDataFrame([("a",), ("a",)], "dt string")
    assert values(keep_dates(frame, ["a", "z"]), "v") == [(1,)]
    assert values(keep_dates(frame, other), "v") == [(1,)]
    assert values(exclude_dates(frame, ["a"]), "v") == [(2,), (3,)]
    assert values(exclude_dates(frame, other), "v") == [(2,), (3,)]
    assert exclude_dates(frame, []).count() == 3
    assert values(only_partition(frame, "b"), "v") == [(2,)]


def test_long_date_lists_stay_filters(spark, capsys):
    frame = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "dt string, v int")
    many = [f"x{k}" for k in range(20_000)]
    assert values(keep_dates(frame, ["a", "b", *many]), "v") == [(1,), (2,)]
    left = exclude_dates(frame, ["a", "b", *many])
    assert values(left, "v") == [(3,)]
    left.explain()
    assert "Join" not in capsys.readouterr().out


def test_split_valid_partition(spark):
    rows = [("20240101",), ("2024-01-02",), ("",), ("nan",), ("NaT",), (None,), ("20241399",), ("x",)]
    frame = spark.createDataFrame(rows, "k string")
    valid, bad = split_valid_partition(frame, "k")
    assert values(valid, "dt") == [("2024-01-01",), ("2024-01-02",)]
    assert values(bad.groupBy("reason").count()) == [("invalid", 2), ("missing", 4)]


def test_assign_partition(spark):
    frame = spark.createDataFrame([("20240101", 1)], "trade_date string, v int")
    dated, by_data = assign_partition(frame, "trade_date", None)
    assert by_data and values(dated, "dt", "trade_date") == [("2024-01-01", "20240101")]
    stamped, by_data = assign_partition(frame, "absent", "2024-02-02")
    assert not by_data and values(stamped, "dt") == [("2024-02-02",)]
    with pytest.raises(ValueError, match="run date"):
        assign_partition(frame, None, None)
    with pytest.raises(ValueError, match="reserved"):
        assign_partition(frame.withColumn("dt", F.lit("x")), "trade_date", None)


def test_schema_registry(spark):
    described = describe_schema(spark, SPOT)
    assert values(described) == [
        (0, "symbol", "VARCHAR", None),
        (1, "name", "VARCHAR", None),
        (2, "amount", "DOUBLE", None),
        (3, "trade_date", "DATE", None),
    ]
    calendar = SCHEMAS["dim_trade_calendar_full"]
    assert len(calendar) == 12 and empty_table(spark, calendar).count() == 0
