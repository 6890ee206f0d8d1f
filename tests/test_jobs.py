from __future__ import annotations

import logging
from datetime import date

import pandas as pd
import pytest
from support import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.publish import LakeTable, publish_partitions, publish_snapshot
from lakeops.operators.units import item_units, range_unit, single_unit
from lakeops.plans.backfill import BackfillError, backfill
from lakeops.plans.compact import compact
from lakeops.plans.ingest import IngestSource, default_run_date, ingest, ingest_all
from lakeops.plans.models import (
    MissingVariableError,
    Model,
    calendar_dim,
    entity_dim,
    landing_model,
    render,
    run_model,
)
from lakeops.plans.views import Entry, add_partitions, create_databases, named, register, register_all
from lakeops.sources.scan import (
    dates_with_files,
    raw_csv_input,
    scan_parts,
    scan_partition,
    scan_raw_csv,
    scan_reference_list,
    scan_table,
    scan_table_nested,
)
from lakeops.sources.schemas import SCHEMAS, struct_of

logging.getLogger("SQLQueryContextLogger").setLevel(logging.CRITICAL)

SAMPLE = struct_of(symbol=T.StringType(), trade_date=T.StringType(), value=T.LongType())


#: Readings of three gauges; the second one of ``g2`` on the 7th arrived in the same part and counts.
READINGS = [("g1", "20240307", 5), ("g2", "20240307", 6), ("g2", "20240307", 8), ("g3", "20240319", 7)]


def sample_rows(start_date=None, end_date=None):
    """The readings within the asked days."""
    import pandas as pd

    low, high = ((d or default).replace("-", "") for d, default in ((start_date, "0"), (end_date, "9")))
    kept = [r for r in READINGS if low <= r[1] <= high]
    return pd.DataFrame(kept, columns=["symbol", "trade_date", "value"])


# ------------------------------------------------------------------------- compaction


def test_compact_parts(spark, lake, tmp_path):
    """Six parts of shifting days, each newer than the last: the newest value of a gauge and day stays."""
    newest, paths = {}, []
    for part in range(6):
        rows = [(f"g{g}", f"2024030{1 + (g + part) % 3}", 100 * part + g) for g in range(5)]
        newest |= {(s, d): v for s, d, v in rows}
        paths.append(str(tmp_path / f"part_{part:06}.parquet"))
        spark.createDataFrame(rows, SAMPLE).toPandas().to_parquet(paths[-1])
    table = lake("gauges", "csv", "raw")
    by_day = {"keys": list(SAMPLE.fieldNames()[:2]), "partition_column": "trade_date"}
    report = compact(scan_parts(spark, *reversed(paths)), table, **by_day)
    assert (report.partition_count, report.row_count) == (3, len(newest))
    found = values(scan_raw_csv(spark, table.path, SAMPLE.fieldNames(), expose_dt=True))
    assert found == sorted((s, d, str(v), f"{d[:4]}-{d[4:6]}-{d[6:]}") for (s, d), v in newest.items())
    idle = compact(scan_parts(spark, *paths), table, mode="skip_existing", **by_day)
    assert idle.skipped == [p["dt"] for p in report.partitions] and idle.status == "skipped"


def test_compact_to_the_run_date(spark, lake):
    parts = spark.createDataFrame([(1, 10), (2, 20), (2, 25), (3, 30)], "id int, value int")
    parts = parts.withColumn("_ingest_order", F.col("value"))
    table = lake()
    report = compact(parts, table, keys=["id"], partition_column="absent", run_date="2024-05-06")
    assert report.partitions[0]["dt"] == "2024-05-06"
    assert values(scan_table(spark, table.path)) == [
        (1, 10, "2024-05-06"),
        (2, 25, "2024-05-06"),
        (3, 30, "2024-05-06"),
    ]
    with pytest.raises(ValueError, match="run date"):
        compact(parts, table, keys=["id"])


# -------------------------------------------------------------------------- ingestion


def test_ingest_fixture(spark, tmp_path):
    source = IngestSource(
        "sample", lambda s, a, b: range_unit(s, a, b), sample_rows, SAMPLE,
        ["symbol", "trade_date"], "trade_date",
    )
    root = str(tmp_path / "lake")
    result = ingest(spark, source, root, start="2024-03-01", end="2024-03-31", run_date="2024-04-01")
    assert result.status == "ok" and result.fetched_rows == len(READINGS)
    assert [p["dt"] for p in result.report.partitions] == ["2024-03-07", "2024-03-19"]
    rows = scan_raw_csv(spark, f"{root}/raw/sample", ["symbol", "trade_date", "value"])
    assert values(rows, "symbol", "value") == [("g1", "5"), ("g2", "8"), ("g3", "7")]
    empty = ingest(spark, source, root, start="2030-01-01", run_date="2030-01-01")
    assert (empty.status, empty.reason) == ("skipped", "no_data")
    idle = IngestSource("idle", lambda s, a, b: item_units(s.range(0), "id"), sample_rows, SAMPLE)
    results = ingest_all(spark, [source, idle], root, ["idle"], run_date="2024-01-01")
    assert [(r.target, r.status, r.reason) for r in results] == [("idle", "skipped", "no_jobs")]


def test_ingest_without_partition_column_uses_the_run_date(spark, tmp_path):
    source = IngestSource("list", lambda s, a, b: single_unit(s), sample_rows, SAMPLE, ["symbol"])
    root = str(tmp_path / "lake")
    result = ingest(spark, source, root, run_date="2024-03-03")
    assert [(p["dt"], p["row_count"]) for p in result.report.partitions] == [("2024-03-03", 3)]
    assert len(default_run_date(spark)) == 10


def test_ingest_failure_leaves_no_staging(spark, tmp_path):
    def boom():
        raise RuntimeError("source down")

    source = IngestSource("x", lambda s, a, b: single_unit(s), boom, SAMPLE)
    with pytest.raises(Exception, match="source down"):
        ingest(spark, source, str(tmp_path / "lake"), run_date="2024-03-03")
    assert not list((tmp_path / "lake").rglob("*_parts"))


# ----------------------------------------------------------------------------- models


def test_render():
    assert render("SELECT '${A}' AS x ; ;\n", {"A": "1"}) == "SELECT '1' AS x"
    assert render("SELECT '$$5' AS x") == "SELECT '$5' AS x"
    assert render("SELECT '$A', r'x$' AS x", {"A": "1"}) == "SELECT '1', r'x$' AS x"
    with pytest.raises(MissingVariableError, match="A, B"):
        render("${B} ${A}", {})
    for text in ("", " ;; "):
        with pytest.raises(ValueError, match="empty"):
            render(text)


def test_model_files(tmp_path):
    path = tmp_path / "dwd_x.sql"
    path.write_text("SELECT 1 AS x, DATE '${PARTITION_DATE}' AS dt;")
    model = Model.from_file(path)
    assert (model.name, model.kind) == ("dwd_x", "date")
    assert Model("a", "SELECT 1").kind == "snapshot"
    assert Model("a", "SELECT 1 WHERE :start_date < :end_date").kind == "range"
    path.write_text(" \n")
    with pytest.raises(ValueError, match="empty"):
        Model.from_file(path)


def test_smoke_model(spark, lake):
    table = lake("dwd_smoke", layer="dwd")
    model = Model("dwd_smoke", "SELECT 1 AS x, DATE '${PARTITION_DATE}' AS dt;")
    report = run_model(spark, model, table, ["2025-01-01"])
    assert report.row_count == 1
    assert values(scan_table(spark, table.path)) == [(1, "2025-01-01")]
    assert values(table.completed(spark)) == [("2025-01-01",)]
    with pytest.raises(ValueError, match="one date"):
        run_model(spark, model, table, [])


def test_model_without_input_clears_its_date(spark, lake, tmp_path):
    table = lake()
    data = spark.createDataFrame([(1, "2024-01-01")], "x int, dt string")
    publish_partitions(data, table)
    hook = raw_csv_input(str(tmp_path / "nothing"), ["x"])
    model = Model("m", "SELECT x, '${PARTITION_DATE}' AS dt FROM tmp_m", inputs={"tmp_m": hook})
    report = run_model(spark, model, table, ["2024-01-01"])
    assert report.cleared == ["2024-01-01"] and report.partition_count == 0
    assert scan_table(spark, table.path, data.schema).count() == 0


def test_landing_models(spark, tmp_path):
    base = tmp_path / "raw" / "dt=2024-01-02"
    base.mkdir(parents=True)
    (base / "a.csv").write_text("symbol,name,enabled\n510300,沪深300,1\n001,\"x, y\",0\n")
    raw = scan_reference_list(spark, str(base), "20240102")
    typed = landing_model(raw, "ods_etf_universe_whitelist", "2024-01-02")
    assert values(typed) == [
        ("001", "x, y", 0, date(2024, 1, 2), "2024-01-02"),
        ("510300", "沪深300", 1, date(2024, 1, 2), "2024-01-02"),
    ]
    dim = entity_dim(typed, dt="2024-01-02")
    assert dim.columns == [*SCHEMAS["dim_etf_full"].fieldNames(), "dt"]
    assert values(dim, "symbol", "flag") == [("001", "WHITELIST"), ("510300", "WHITELIST")]
    assert entity_dim(typed, dt="2024-01-03").count() == 0


def test_calendar_dim_matches_its_schema(spark):
    days = spark.createDataFrame([(date(2024, 3, 31), "x")], "trade_date date, dt string")
    calendar = calendar_dim(days)
    declared = [(f.name, f.dataType) for f in SCHEMAS["dim_trade_calendar_full"].fields]
    assert [(f.name, f.dataType) for f in calendar.schema.fields[:-1]] == declared
    assert tuple(calendar.first()) == (
        date(2024, 3, 31), 2024, 3, 1, 0, 31, 91, 13, False, True, True, False, "x",
    )
    plan = calendar._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


# --------------------------------------------------------------------------- backfill

RANGE_SQL = """
SELECT x, CAST(amount AS INT) AS amount, dt FROM tmp_b WHERE dt BETWEEN :start_date AND :end_date
"""


def days_model(spark, bad=(), sql=RANGE_SQL, absent=()):
    days = [f"2024-02-{n:02d}" for n in range(20, 30)] + ["2024-03-01"]
    rows = [
        (n, "oops" if day in bad else "5", day) for n, day in enumerate(days) if day not in absent
    ]
    frame = spark.createDataFrame(rows, "x int, amount string, dt string")
    return Model("b", sql, inputs={"tmp_b": lambda s, dates: frame})


def test_range_backfill_is_one_job(spark, lake):
    table = lake()
    report = backfill(spark, days_model(spark), table, "2024-02-28", "2024-03-01")
    assert report.jobs == 1 and report.row_count == 3
    assert report.dates("success") == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert values(scan_table(spark, table.path), "dt") == [(d,) for d in report.dates("success")]
    row = report.summary(spark).first()
    assert (row["total_dates"], row["failed_count"]) == (3, 0)
    with pytest.raises(ValueError, match="before"):
        backfill(spark, days_model(spark), table, "2024-03-02", "2024-03-01")


def test_backfill_stops_or_continues(spark, lake):
    bad = ["2024-02-22", "2024-02-29"]
    table = lake("stop")
    with pytest.raises(BackfillError, match="stopped"):
        backfill(spark, days_model(spark, bad), table, "2024-02-20", "2024-03-01")
    assert values(table.completed(spark)) == []
    table = lake("go")
    report = backfill(
        spark, days_model(spark, bad), table, "2024-02-20", "2024-03-01", continue_on_error=True
    )
    assert report.dates("failed") == bad and len(report.dates("success")) == 9
    assert report.jobs < 2 * 11
    assert scan_table(spark, table.path).count() == 9
    failed = report.summary(spark).first()["failed_dates"]
    assert [f["date"] for f in failed] == bad and failed[0]["error_type"]


def test_backfill_date_model_runs_per_date(spark, lake):
    sql = "SELECT x, CAST(amount AS INT) AS amount, dt FROM tmp_b WHERE dt = '${PARTITION_DATE}'"
    model = days_model(spark, ["2024-02-21"], sql, absent=["2024-02-23"])
    table = lake()
    publish_partitions(spark.sql("SELECT 1 AS x, 1 AS amount, '2024-02-23' AS dt"), table)
    report = backfill(spark, model, table, "2024-02-20", "2024-02-24", continue_on_error=True)
    assert report.jobs == 5 and report.dates("failed") == ["2024-02-21"]
    assert report.cleared == ["2024-02-23"]
    assert values(scan_table(spark, table.path), "dt") == [
        ("2024-02-20",),
        ("2024-02-22",),
        ("2024-02-24",),
    ]
    table = lake("stop")
    with pytest.raises(BackfillError, match="1 dates done"):
        backfill(spark, model, table, "2024-02-20", "2024-02-24")
    assert values(table.completed(spark)) == [("2024-02-20",)]


def test_backfill_targets_and_snapshots(spark, lake):
    table = lake("b")
    report = backfill(
        spark, days_model(spark), table, "2024-02-20", "2024-02-21", targets=["dim.other"]
    )
    assert report.dates("skipped") == ["2024-02-20", "2024-02-21"] and report.jobs == 0
    assert backfill(
        spark, days_model(spark), table, "2024-02-20", "2024-02-20", targets=["ods.b"]
    ).dates("success") == ["2024-02-20"]
    snapshot = lake("s")
    report = backfill(spark, Model("s", "SELECT 1 AS x"), snapshot, "2024-02-20", "2024-02-25")
    assert report.jobs == 1 and report.dates("success") == ["2024-02-20"]
    assert spark.read.parquet(snapshot.path).count() == 1


# ------------------------------------------------------------------ scans and catalog


def test_scans_skip_what_is_not_data(spark, lake):
    table = lake()
    publish_partitions(
        spark.sql("SELECT 1 AS x, explode(array('1900-01-01', '2024-01-01', '2024-01-02')) AS dt"),
        table,
    )
    with open(f"{table.partition_path('2024-01-01')}/manifest.json", "w") as handle:
        handle.write("{}")
    rows = scan_table(spark, table.path)
    assert values(rows) == [(1, "2024-01-01"), (1, "2024-01-02")]
    assert scan_partition(spark, table.path, "2024-01-02").count() == 1
    assert scan_partition(spark, table.path, "2031-01-01").columns == ["x", "dt"]
    plan = rows.where("dt = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    wanted = scan_table_nested(spark, table.path, struct_of(x=T.IntegerType()), ["2024-01-02", "x"])
    assert values(wanted) == [(1, "2024-01-02")]
    assert scan_table_nested(spark, table.path, rows.schema, ["x"]).count() == 0


def test_dates_with_files(spark, tmp_path):
    for dt, name in (("2024-01-01", "a.csv"), ("2024-01-02", "a.parquet"), ("2024-01-03", "b.csv")):
        (tmp_path / f"dt={dt}").mkdir()
        (tmp_path / f"dt={dt}" / name).write_text("x\n1\n")
    base = str(tmp_path)
    assert dates_with_files(spark, base) == ["2024-01-01", "2024-01-03"]
    assert dates_with_files(spark, base, dates=["2024-01-03", "2025-01-01"]) == ["2024-01-03"]
    assert scan_raw_csv(spark, base, ["x"], ["2024-01-03"]).columns == ["x"]
    assert scan_raw_csv(spark, base, ["x"], ["2030-01-03"]).count() == 0


def test_catalog_tables_and_functions(spark, lake, tmp_path):
    table = lake("daily")
    publish_partitions(spark.sql("SELECT 1 AS x, '2024-01-01' AS dt"), table)
    place = str(tmp_path / "db")
    register_all(spark, {"v_ods": [Entry(table, struct_of(x=T.IntegerType()))]}, place)
    publish_partitions(
        spark.sql("SELECT 2 AS x, 'new' AS y, explode(array('1900-01-01', '2024-01-02')) AS dt"), table
    )
    wider = Entry(table, struct_of(x=T.IntegerType(), y=T.StringType()))
    register_all(spark, {"v_ods": [wider]}, place)
    assert values(spark.table("v_ods.daily")) == [(1, None, "2024-01-01"), (2, "new", "2024-01-02")]
    one = spark.sql("SELECT * FROM v_ods_daily_dt('2024-01-02')")
    assert values(one) == [(2, "new", "2024-01-02")]
    assert "dt" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    publish_partitions(spark.sql("SELECT 3 AS x, 'more' AS y, '2024-01-03' AS dt"), table)
    add_partitions(spark, "v_ods", "daily", ["2024-01-03"])
    add_partitions(spark, "v_ods", "daily", [])
    assert spark.table("v_ods.daily").count() == 3


def test_functions_of_two_layers_do_not_meet(spark, lake, tmp_path):
    a, b = lake("same", layer="a"), lake("same", layer="b")
    for table, x in ((a, 1), (b, 2)):
        publish_partitions(spark.sql(f"SELECT {x} AS x, '2024-01-01' AS dt"), table)
    schema = struct_of(x=T.IntegerType())
    register_all(spark, {"l_a": [Entry(a, schema)], "l_b": [Entry(b, schema)]}, str(tmp_path / "db"))
    assert [spark.sql(f"SELECT x FROM l_{k}_same_dt('2024-01-01')").first().x for k in "ab"] == [1, 2]
    clash = LakeTable(str(tmp_path / "lake"), "a", "b_same")
    publish_partitions(spark.sql("SELECT 3 AS x, '2024-01-01' AS dt"), clash)
    create_databases(spark, ["l"], str(tmp_path / "db"))
    with pytest.raises(ValueError, match="already reads"):
        register(spark, "l", Entry(clash, schema))


def test_snapshot_and_csv_tables(spark, lake, tmp_path):
    flat, csv = lake("flat"), LakeTable(str(tmp_path / "lake"), "raw", "c", "csv")
    publish_snapshot(spark.sql("SELECT 1 AS x"), flat)
    publish_partitions(spark.sql("SELECT 'a \"b\", c' AS x, '2024-01-01' AS dt"), csv)
    create_databases(spark, ["s_raw"], str(tmp_path / "db"))
    register(spark, "s_raw", Entry(flat, struct_of(x=T.IntegerType()), partitioned=False))
    register(spark, "s_raw", Entry(csv, struct_of(x=T.StringType())))
    assert values(spark.table("s_raw.flat")) == [(1,)]
    assert values(spark.table("s_raw.c")) == [('a "b", c', "2024-01-01")]
    with pytest.raises(ValueError, match="laid out twice"):
        register(spark, "s_raw", Entry(csv, struct_of(x=T.StringType()), doubled=True))
    assert named("a`b", "c") == "`a``b`.`c`"
    with pytest.raises(ValueError, match="empty"):
        named("a", "")


def test_records_that_span_lines_are_declared(spark, tmp_path):
    folder = tmp_path / "dt=2024-01-01"
    folder.mkdir()
    (folder / "a.csv").write_text('x,y\n1,"a ""b"", c"\n2,d\n')
    assert scan_raw_csv(spark, str(tmp_path), ["x", "y"]).count() == 2
    (folder / "b.csv").write_text('x,y\n3,"two\nlines"\n')
    assert values(scan_raw_csv(spark, str(tmp_path), ["x", "y"], multiline=True)) == [
        ("1", 'a "b", c'),
        ("2", "d"),
        ("3", "two\nlines"),
    ]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    for dt, text in (("2024-01-01", "b,a\n1,2\n"), ("2024-01-02", "b,a\n3,4\n")):
        (tmp_path / f"dt={dt}").mkdir()
        (tmp_path / f"dt={dt}" / "x.csv").write_text(text)
    for multiline in (True, False):
        rows = scan_raw_csv(
            spark, str(tmp_path), ["a", "absent", "b"], expose_dt=True, multiline=multiline
        )
        assert values(rows) == [("2", None, "1", "2024-01-01"), ("4", None, "3", "2024-01-02")]
        assert values(rows, "a") == [("2",), ("4",)] and rows.count() == 2
    (tmp_path / "dt=2024-01-03").mkdir()
    (tmp_path / "dt=2024-01-03" / "x.csv").write_text("a,b\n5,6\n")
    (tmp_path / "dt=2024-01-04").mkdir()
    (tmp_path / "dt=2024-01-04" / "x.csv").write_text("c,b\n7,8\n")
    rows = scan_raw_csv(spark, str(tmp_path), ["a", "b", "c"])
    assert values(rows) == [("2", "1", None), ("4", "3", None), ("5", "6", None), (None, "8", "7")]
    alone = scan_raw_csv(spark, str(tmp_path), ["a", "b"], ["2024-01-03"])
    assert values(alone) == [("5", "6")]
    # files of one date with headers of their own
    (tmp_path / "dt=2024-01-03" / "y.csv").write_text("b,a\n9,10\n")
    (tmp_path / "dt=2024-01-03" / "empty.csv").write_text("")
    for multiline in (True, False):
        rows = scan_raw_csv(spark, str(tmp_path), ["a", "b"], ["2024-01-03"], expose_dt=True, multiline=multiline)
        assert values(rows) == [("10", "9", "2024-01-03"), ("5", "6", "2024-01-03")]


