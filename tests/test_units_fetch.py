from __future__ import annotations

import pandas as pd
import pytest
from support import values
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.units import (
    chunk_units,
    distinct_items,
    in_unit_order,
    item_units,
    product,
    range_unit,
    single_unit,
    sql_units,
    with_chunks,
    with_options,
)
from lakeops.sources.fetch import fetch, standardize
from lakeops.sources.schemas import struct_of

ROWS = struct_of(symbol=T.StringType(), value=T.LongType())


def listed(units):
    rows = in_unit_order(units).collect()
    return [(r["job_index"], dict(r["params"]), dict(r["meta"])) for r in rows]


def test_simple_units(spark):
    assert listed(single_unit(spark)) == [(0, {}, {})]
    dates = {"start_date": "2024-01-01", "end_date": "2024-01-01"}
    assert listed(range_unit(spark, "2024-01-01")) == [(0, dates, {})]
    assert listed(range_unit(spark, None)) == [(0, {"start_date": None, "end_date": None}, {})]
    assert listed(chunk_units(spark, None))[0][1] == {"start_date": None, "end_date": None}
    whole = {"start_date": "2024-01-01", "end_date": "2024-01-20"}
    assert listed(chunk_units(spark, "2024-01-01", "2024-01-20")) == [(0, whole, {})]


def test_chunks_carry_a_shard(spark):
    assert listed(chunk_units(spark, "2024-01-15", "2024-02-10")) == [
        (0, {"start_date": "2024-01-15", "end_date": "2024-01-30"}, {"shard_id": "202401"}),
        (1, {"start_date": "2024-01-31", "end_date": "2024-02-10"}, {"shard_id": "202401"}),
    ]


def test_items(spark):
    frame = spark.createDataFrame([("b", 2), ("a", 1), (None, 3), ("b", 4)], "symbol string, n int")
    assert [u[:2] for u in listed(item_units(frame))] == [(0, {"symbol": "a"}), (1, {"symbol": "b"})]
    assert values(distinct_items(frame.select("n"), "symbol")) == [("1",), ("2",), ("3",), ("4",)]
    frame.createOrReplaceTempView("items_view")
    assert len(listed(sql_units(spark, "SELECT symbol FROM items_view WHERE n < 3"))) == 2
    assert listed(sql_units(spark, "SELECT symbol FROM no_such_table", missing_ok=True)) == []
    with pytest.raises(AnalysisException):
        sql_units(spark, "SELECT symbol FROM no_such_table")
    assert listed(sql_units(spark, "SELECT symbol FROM items_view WHERE n > 9")) == []


def test_product_is_complete_ordered_and_later_wins(spark):
    items = item_units(spark.range(7).select(F.col("id").alias("symbol")))
    chunks = chunk_units(spark, "2024-01-01", "2024-03-10", "month")
    both = listed(product(items, chunks))
    assert [u[0] for u in both] == list(range(21))
    assert [(u[1]["symbol"], u[1]["start_date"]) for u in both] == [
        (str(i), d) for i in range(7) for d in ("2024-01-01", "2024-02-01", "2024-03-01")
    ]
    assert both == listed(with_chunks(items, "2024-01-01", "2024-03-10", "month"))
    gaps = items.withColumn("job_index", F.col("job_index") * 7 + 3)  # indexes with gaps give the same combinations
    assert both == listed(product(gaps, chunks)) == listed(product(items, chunks.withColumn("job_index", F.col("job_index") + 5)))
    clash = product(range_unit(spark, "2020-01-01"), range_unit(spark, "2024-01-01"))
    assert listed(clash)[0][1]["start_date"] == "2024-01-01"
    three = product(items, items, single_unit(spark))
    assert three.count() == 49 and three.select("job_index").distinct().count() == 49
    with pytest.raises(ValueError, match="strategy"):
        product()


def test_own_range_per_unit(spark):
    units = item_units(spark.range(2).select(F.col("id").alias("symbol")))
    end = F.when(F.col("params")["symbol"] == "0", "2024-01-10").otherwise("2024-02-10")
    found = listed(with_chunks(units, F.lit("2024-01-05"), end, "month"))
    assert [(u[0], u[1]["end_date"]) for u in found] == [
        (0, "2024-01-10"),
        (2, "2024-01-31"),
        (3, "2024-02-10"),
    ]


def test_fetch_kinds_of_results(spark):
    units = item_units(spark.createDataFrame([(c,) for c in "abcde"], "symbol string"))

    class Payload:
        csv_bytes = b"value,symbol\n7,csv\n"

    payload = Payload()

    def get(symbol):
        import pandas as pd

        if symbol == "a":
            return None
        if symbol == "b":
            return pd.DataFrame({"symbol": []})
        if symbol == "c":
            return payload
        if symbol == "d":
            return (pd.DataFrame({"symbol": [n], "value": [n], "extra": [0]}) for n in (1, 2))
        return pd.DataFrame({"symbol": [symbol, None]})

    found = values(fetch(units, get, ROWS), "symbol", "value", "_ingest_order", "_row_index")
    assert found == [
        ("1", 1, 3, 0),
        ("2", 2, 3, 1),
        (None, None, 4, 1),
        ("csv", 7, 2, 0),
        ("e", None, 4, 0),
    ]


def test_fetch_matches_parameters_and_raises(spark):
    units = with_chunks(
        item_units(spark.createDataFrame([("a",)], "symbol string")), "2024-01-01", "2024-01-02"
    )

    def everything(**kwargs):
        import pandas as pd

        return pd.DataFrame({"symbol": [",".join(sorted(kwargs))], "value": [1]})

    assert values(fetch(units, everything, ROWS), "symbol") == [("end_date,start_date,symbol",)]

    def boom(symbol):
        raise RuntimeError(f"no data for {symbol}")

    with pytest.raises(Exception, match="no data for a"):
        fetch(units, boom, ROWS).collect()


def test_each_unit_is_called_once_on_many_tasks(spark):
    units = item_units(spark.range(200).select(F.col("id").alias("symbol")))

    def who(symbol):
        import pandas as pd
        from pyspark import TaskContext

        return pd.DataFrame({"symbol": [symbol], "value": [TaskContext.get().partitionId()]})

    rows = fetch(units, who, ROWS, parallelism=8).collect()
    assert len(rows) == 200 and len({r["value"] for r in rows}) == 8


def test_standardize(spark):
    raw = spark.createDataFrame(
        pd.DataFrame({"日期": ["2024-01-01", "x", "2024-01-09"], "收盘": [1.0, 2.0, 3.0], "z": [0, 0, 0]})
    )
    names = {"日期": "trade_date", "收盘": "close", "开盘": "open"}
    columns = ["trade_date", "open", "close"]
    frame = standardize(raw, names, columns, start="2024-01-02", compact=True)
    assert values(frame) == [("20240109", 3.0)]
    assert standardize(raw, names, columns).count() == 3


def test_options_need_no_join(spark):
    units = range_unit(spark, "2024-01-01", "2024-01-31")
    both = with_options(units, [{"adjust": "qfq"}, {"adjust": "hfq", "start_date": "2024-01-15"}])
    rows = [(r["job_index"], dict(r["params"])) for r in both.orderBy("job_index").collect()]
    assert rows == [
        (0, {"start_date": "2024-01-01", "end_date": "2024-01-31", "adjust": "qfq"}),
        (1, {"start_date": "2024-01-15", "end_date": "2024-01-31", "adjust": "hfq"}),
    ]
    assert "Join" not in both._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="option"):
        with_options(units, [])
