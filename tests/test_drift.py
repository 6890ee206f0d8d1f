"""Files of one table or run whose types or headers differ from file to file."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from support import values

from lakeops.sources import drift, scan
from lakeops.sources.scan import scan_parts, scan_table
from lakeops.sources.schemas import struct_of


def stored(spark, path, dt, kind, rows, more=""):
    frame = spark.createDataFrame([(r,) for r in rows], f"v {kind}")
    frame.withColumn("k", F.lit(more)).coalesce(1).write.parquet(f"{path}/dt={dt}")


@pytest.fixture
def mixed(spark, tmp_path):
    path = str(tmp_path / "t")
    stored(spark, path, "2024-01-01", "long", [1, None])
    stored(spark, path, "2024-01-02", "double", [2.5])
    stored(spark, path, "2024-01-03", "string", ["x"])
    stored(spark, path, "2024-01-04", "long", [4])
    stored(spark, path, "1900-01-01", "int", [])
    return path


def test_types_of_a_table_meet_in_text(spark, mixed):
    rows = scan_table(spark, mixed)
    assert dict(rows.dtypes) == {"v": "string", "k": "string", "dt": "string"}
    assert values(rows, "v", "dt") == [
        ("1", "2024-01-01"),
        ("2.5", "2024-01-02"),
        ("4", "2024-01-04"),
        (None, "2024-01-01"),
        ("x", "2024-01-03"),
    ]


def test_declared_types(spark, mixed):
    declared = struct_of(v=T.DoubleType(), absent=T.IntegerType())
    lenient = scan_table(spark, mixed, declared, mixed_types=True, strict=False)
    assert lenient.columns == ["v", "absent", "dt"]
    assert values(lenient, "v", "dt") == [(1.0, "2024-01-01"), (2.5, "2024-01-02"), (4.0, "2024-01-04"), (None, "2024-01-01"), (None, "2024-01-03")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        scan_table(spark, mixed, declared, mixed_types=True).collect()
    fine = scan_table(spark, mixed, declared, mixed_types=True).where("dt < '2024-01-03'")
    assert values(fine, "v") == [(1.0,), (2.5,), (None,)]  # the third date is not read at all


def test_dates_are_pruned(spark, mixed):
    one = scan_table(spark, mixed).where("dt = '2024-01-02'")
    assert len(one.inputFiles()) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert values(one, "v") == [("2.5",)]


def test_groups_do_not_grow_with_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in range(1, 13):
        stored(spark, path, f"2024-01-{day:02d}", "long" if day % 2 else "double", [day if day % 2 else float(day)])
    groups = drift.schema_groups(spark, [path])
    assert sorted((s["v"].dataType.simpleString(), len(f)) for s, f in groups) == [("bigint", 6), ("double", 6)]
    listed = [f for _, some in groups for f in some]
    by_merging = drift._by_merging(spark, listed)  # the way for stores that only Spark opens
    assert sorted((s["v"].dataType.simpleString(), sorted(f)) for s, f in by_merging) == sorted(
        (s["v"].dataType.simpleString(), f) for s, f in groups
    )
    assert dict(scan_table(spark, path).dtypes)["v"] == "double"
    assert scan_table(spark, path).agg(F.sum("v")).first()[0] == 78.0


def test_common_type(spark):
    kinds = {
        (T.LongType(), T.DoubleType()): "double",
        (T.IntegerType(), T.LongType(), T.IntegerType()): "bigint",
        (T.DateType(), T.TimestampNTZType()): "timestamp_ntz",
        (T.LongType(), T.StringType()): "string",
        (T.BooleanType(), T.DateType()): "string",
        (T.DecimalType(10, 2), T.LongType()): "decimal(22,2)",
        (T.DoubleType(),): "double",
    }
    for given, wanted in kinds.items():
        assert drift.common_type(spark, given).simpleString() == wanted


def test_parts_keep_their_order(spark, tmp_path):
    for number, (kind, v) in enumerate([("long", 1), ("double", 2.5), ("string", "3")]):
        spark.createDataFrame([("a", v)], f"k string, v {kind}").coalesce(1).write.parquet(f"{tmp_path}/part_{number:06d}.parquet")
    rows = scan_parts(spark, str(tmp_path / "part_*"))
    assert rows.columns[-3:] == ["_ingest_order", "_ingest_file", "_row_index"]
    assert values(rows, "v") == [("1",), ("2.5",), ("3",)]
    declared = scan_parts(spark, str(tmp_path), schema=struct_of(k=T.StringType(), v=T.DoubleType()), mixed_types=True)
    assert values(declared, "v") == [(1.0,), (2.5,), (3.0,)]
    with pytest.raises(ValueError, match="No Parquet file"):
        (tmp_path / "none").mkdir()
        scan_parts(spark, str(tmp_path / "none"), mixed_types=True)


def test_headers_by_file(spark, tmp_path):
    folder = tmp_path / "dt=2024-01-01"
    folder.mkdir()
    texts = {
        "a.csv": "x,y\n1,2\n",
        "b.csv": "\ufeffy,x\r\n3,4\r\n",
        "c.csv": '"x","odd, ""name"""\n5,6\n',
        "d.csv": "x,y",
        "e.csv": "",
    }
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())
    groups = scan.files_by_header(spark, [str(folder)])
    assert {h: [f.rsplit("/", 1)[1] for f in some] for h, some in groups.items()} == {
        ("x", "y"): ["a.csv", "d.csv"],
        ("y", "x"): ["b.csv"],
        ("x", 'odd, "name"'): ["c.csv"],
    }
    first = {r["path"].rsplit("/", 1)[1]: r["seen"] for r in scan._first_lines(spark, [str(folder)]).collect()}
    assert first["a.csv"] == "x,y" and first["c.csv"] == '"x","odd, ""name"""'
    rows = scan.scan_raw_csv(spark, str(tmp_path), ["y", "x", 'odd, "name"'])
    assert values(rows) == [("2", "1", None), ("3", "4", None), (None, "5", "6")]


def test_long_header(spark, tmp_path):
    folder = tmp_path / "dt=2024-01-01"
    folder.mkdir()
    names = [f"column_{i:05d}" for i in range(9_000)]  # longer than what is read at first
    (folder / "a.csv").write_text(",".join(names) + "\n" + ",".join(map(str, range(9_000))) + "\n")
    assert values(scan.scan_raw_csv(spark, str(tmp_path), ["column_08999", "column_00000"])) == [("8999", "0")]
