"""Models of one date, run for many dates in one plan where that is provably the same."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from support import values

from lakeops.plans.backfill import backfill
from lakeops.plans.models import Model, NotOverDays
from lakeops.sources.scan import raw_csv_input, scan_table

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
ROWS = [("a", 1, "2024-01-01"), ("a", 2, "2024-01-01"), ("b", 3, "2024-01-02"), ("a", 4, "2024-01-04"), ("c", 9, "2024-02-01"), ("d", 8, None)]


def rows_input(spark, dates):
    return spark.createDataFrame(ROWS, "k string, v int, dt string")


def only_those_dates(spark, dates):
    return rows_input(spark, dates).where(F.col("dt").isin(list(dates)))


SETS = [
    "SELECT k, sum(v) AS v, '${PARTITION_DATE}' AS dt FROM t WHERE dt = '${PARTITION_DATE}' GROUP BY k",
    "SELECT k, v, dt FROM t WHERE dt = '$PARTITION_DATE' AND v > 1",
    "SELECT k, v, :partition_date AS dt FROM t WHERE dt = :partition_date",
    "SELECT count(*) AS n, coalesce(max(k), 'none') AS k, '${PARTITION_DATE}' AS dt FROM t WHERE dt = '${PARTITION_DATE}'",
    "SELECT a.k, b.v, '${PARTITION_DATE}' AS `dt` FROM t a JOIN t b ON a.k = b.k AND a.dt = '${PARTITION_DATE}' AND b.dt = '${PARTITION_DATE}'",
    "SELECT k, v, '${PARTITION_DATE}' AS dt FROM t WHERE DATE(dt) = DATE '${PARTITION_DATE}' AND dt = '${PARTITION_DATE}'",
    "SELECT k, max(v) AS v, dt FROM t WHERE dt = '${PARTITION_DATE}' GROUP BY k, dt HAVING max(v) > ${least}",
]
LOOPS = [
    "SELECT k, sum(v) AS v, '${PARTITION_DATE}' AS dt FROM t WHERE dt <= '${PARTITION_DATE}' GROUP BY k",
    "SELECT k, v, '${PARTITION_DATE}' AS dt FROM t",
    "SELECT k, v, '${PARTITION_DATE}' AS dt FROM t WHERE dt = '${PARTITION_DATE}' OR v = 9",
    "SELECT concat(k, '_${PARTITION_DATE}') AS k, '${PARTITION_DATE}' AS dt FROM t WHERE dt = '${PARTITION_DATE}'",
    "SELECT a.k, b.v, '${PARTITION_DATE}' AS dt FROM t a JOIN t b ON a.k = b.k AND a.dt = '${PARTITION_DATE}'",
]


def by_loop(spark, model, table):
    """The reference: one plan for each date."""
    rows = []
    for day in DAYS:
        frame = model.frame(spark, [day])
        rows += [] if frame is None else values(frame)
    return sorted(rows, key=str)


@pytest.mark.parametrize("hook", [rows_input, only_those_dates])
@pytest.mark.parametrize("sql", SETS)
def test_runs_as_a_set(spark, lake, sql, hook):
    model = Model("m", sql, inputs={"t": hook}, variables={"least": "1"})
    table = lake("m")
    report = backfill(spark, model, table, DAYS[0], DAYS[-1])
    assert (report.form, report.jobs, report.why_loop) == ("set", 1, None)
    assert values(scan_table(spark, table.path, report.schema)) == by_loop(spark, model, table)
    assert report.dates("success") == DAYS


@pytest.mark.parametrize("hook", [rows_input, only_those_dates])
@pytest.mark.parametrize("sql", LOOPS)
def test_runs_as_a_loop(spark, lake, sql, hook):
    model = Model("m", sql, inputs={"t": hook})
    table = lake("m")
    report = backfill(spark, model, table, DAYS[0], DAYS[-1])
    assert (report.form, report.jobs) == ("loop", 4) and report.why_loop
    want = by_loop(spark, model, table)
    assert values(scan_table(spark, table.path, report.schema)) == want


def test_rows_of_another_date_keep_the_loop(spark):
    model = Model("m", "SELECT k, '2024-01-09' AS dt FROM t WHERE dt = '${PARTITION_DATE}'", inputs={"t": rows_input})
    with pytest.raises(NotOverDays, match="another date"):
        model.frame_of_days(spark, DAYS)


def test_dates_without_files_are_left_out(spark, lake, tmp_path):
    for name, days in (("a", DAYS[:3]), ("b", DAYS[1:])):
        for day in days:
            folder = tmp_path / name / f"dt={day}"
            folder.mkdir(parents=True)
            (folder / "x.csv").write_text(f"k,v\n{name},{day[-1]}\n")
    sql = """SELECT a.k AS k, b.v AS v, '${PARTITION_DATE}' AS dt FROM a JOIN b ON a.v = b.v
             WHERE a.dt = '${PARTITION_DATE}' AND b.dt = '${PARTITION_DATE}'"""
    inputs = {name: raw_csv_input(str(tmp_path / name), ["k", "v"]) for name in ("a", "b")}
    model, table = Model("m", sql, inputs=inputs), lake("m")
    report = backfill(spark, model, table, DAYS[0], DAYS[-1])
    assert (report.form, report.jobs) == ("set", 1)
    assert values(scan_table(spark, table.path, report.schema)) == [("a", "2", "2024-01-02"), ("a", "3", "2024-01-03")]
    assert set(report.dates("success")) == set(DAYS)


def test_failing_date_stands_alone(spark, lake):
    sql = "SELECT CAST(k AS INT) AS n, '${PARTITION_DATE}' AS dt FROM t WHERE dt = '${PARTITION_DATE}'"
    rows = [("1", DAYS[0]), ("x", DAYS[1]), ("3", DAYS[2])]
    model = Model("m", sql, inputs={"t": lambda spark, dates: spark.createDataFrame(rows, "k string, dt string")})
    table = lake("m")
    report = backfill(spark, model, table, DAYS[0], DAYS[-1], continue_on_error=True)
    assert report.form == "set" and report.dates("failed") == [DAYS[1]]
    assert values(scan_table(spark, table.path, report.schema)) == [(1, DAYS[0]), (3, DAYS[2])]
