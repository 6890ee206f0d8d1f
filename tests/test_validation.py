"""Checks before anything is replaced, reconciliation, and modes that meet existing dates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from support import values

from lakeops.operators import checks, publish
from lakeops.operators.checks import ValidationError, raise_on_violations
from lakeops.operators.publish import PartitionExistsError, complete_dates, publish_partitions, publish_snapshot, reconcile
from lakeops.plans import compact as plan
from lakeops.plans.compact import compact, without_complete
from lakeops.plans.views import Entry, add_partitions, create_databases, register
from lakeops.sources import files
from lakeops.sources.scan import scan_parts, scan_table

ROWS = [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02"), (4, "d", "2024-01-03")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id int, v string, dt string")


def test_rows_under_another_date_are_refused(spark, lake, monkeypatch):
    """Totals agree, the dates do not."""
    table = lake()
    publish_partitions(frame(spark), table)
    real = publish.partition_files

    def swapped(df, keys=("dt",)):
        found = real(df, keys)
        return found.withColumn("dt", F.when(F.col("dt") == "2024-01-02", "2024-01-03").when(F.col("dt") == "2024-01-03", "2024-01-02").otherwise(F.col("dt")))

    three = [*ROWS, (5, "e", "2024-01-02")]  # two rows on one date, one on the other: exchanged, the total stays
    monkeypatch.setattr(publish, "partition_files", swapped)
    with pytest.raises(ValidationError, match="other keys"):
        publish_partitions(frame(spark, three), table)
    monkeypatch.undo()
    assert values(scan_table(spark, table.path, frame(spark).schema)) == ROWS
    assert publish_partitions(frame(spark, [(9, "x", None), (8, "y", "2024-01-04")]), table).rejected_rows == 1


def test_expected_metrics_are_compared_before_the_swap(spark, lake):
    table = lake()
    publish_partitions(frame(spark), table)
    due = spark.createDataFrame([("2024-01-01", 2, 1), ("2024-01-02", 5, 1), ("2024-01-09", 1, 1)], "dt string, row_count long, file_count long")
    with pytest.raises(ValidationError) as caught:
        publish_partitions(frame(spark).withColumn("v", F.lit("new")), table, expected=due)
    assert [(v["dt"], v["problem"]) for v in caught.value.violations] == [
        ("2024-01-02", "row_count_mismatch"),
        ("2024-01-03", "unexpected_files"),
        ("2024-01-09", "no_files"),
    ]
    assert values(scan_table(spark, table.path, frame(spark).schema)) == ROWS
    fine = spark.createDataFrame([("2024-01-01", 2, 1), ("2024-01-02", 1, 1), ("2024-01-03", 1, 1)], "dt string, row_count long, file_count long")
    assert publish_partitions(frame(spark), table, expected=fine).row_count == 4


def test_all_violations_go_with_the_error(spark):
    rows = [(f"2024-01-{d:02d}", "no_files", 1, 0) for d in range(1, 31)]
    found = spark.createDataFrame(rows, "dt string, problem string, expected long, actual long")
    with pytest.raises(ValidationError, match="and 10 more") as caught:
        raise_on_violations(found)
    assert len(caught.value.violations) == 30
    raise_on_violations(found.limit(0))


def test_key_mark(spark):
    rows = spark.createDataFrame([("a", "x"), ("", "x"), (None, "x"), ("x", "a")], "a string, b string")
    marks = [r[0] for r in rows.select(checks.key_mark(["a", "b"])).collect()]
    assert marks[1] == marks[2] and len(set(marks)) == 3


def test_reconcile(spark, lake):
    table = lake()
    assert reconcile(spark, table).collect() == []
    publish_partitions(frame(spark), table)
    assert {r["state"] for r in reconcile(spark, table).collect()} == {"ok"}
    files.delete(spark, table.partition_path("2024-01-01"))
    frame(spark, [(7, "z", "2024-01-02"), (8, "z", "2024-02-02"), (9, "s", "1900-01-01")]).write.mode("append").partitionBy("dt").parquet(table.path)
    found = {r["dt"]: r["state"] for r in reconcile(spark, table).collect()}
    assert found == {"2024-01-01": "files_missing", "2024-01-02": "file_count_differs", "2024-01-03": "ok", "2024-02-02": "unrecorded"}
    assert complete_dates(spark, table) == ["2024-01-02", "2024-01-03"]
    # the date without files is published again, the others are skipped
    report = publish_partitions(frame(spark), table, mode="skip_existing")
    assert report.skipped == ["2024-01-02", "2024-01-03"] and [p["dt"] for p in report.partitions] == ["2024-01-01"]


def test_emptied_snapshot_is_not_complete(spark, lake):
    table = lake()
    publish_snapshot(frame(spark), table, run_date="2024-01-05")
    assert values(table.completed(spark)) == [("2024-01-05",)]
    report = publish_snapshot(frame(spark, []), table, run_date="2024-01-06")
    assert (report.status, report.cleared) == ("cleared", ["2024-01-05"])
    assert values(table.completed(spark)) == [] and not files.exists(spark, table.path)


def parts_of(spark, tmp_path, *parts):
    for number, rows in enumerate(parts):
        frame(spark, rows).withColumnRenamed("dt", "day").coalesce(1).write.parquet(f"{tmp_path}/parts/part_{number:06d}.parquet")
    return scan_parts(spark, f"{tmp_path}/parts/part_*", schema=frame(spark).withColumnRenamed("dt", "day").schema)


@pytest.mark.parametrize("keys", [["id", "day"], ["id"]])
def test_one_dedup_whatever_the_mode(spark, lake, tmp_path, monkeypatch, keys):
    table = lake()
    publish_partitions(frame(spark, [(1, "old", "2024-01-01")]).withColumn("day", F.col("dt")).select("id", "v", "day", "dt"), table)
    # row 2 moves from a complete date to a new one, row 5 from a new one to a complete one
    parts = parts_of(spark, tmp_path, [*ROWS, (5, "e", "2024-01-04")], [(2, "b2", "2024-01-02"), (5, "e2", "2024-01-01")])
    runs = []
    real = plan.publish_partitions

    def spied(df, target, **kwargs):
        collects = []
        monkeypatch.setattr(publish, "keep_dates", lambda *a, **k: collects.append(a) or real_keep(*a, **k))
        done = real(df, target, **kwargs)
        runs.append(len(collects))
        return done

    real_keep = publish.keep_dates
    monkeypatch.setattr(plan, "publish_partitions", spied)
    report = compact(parts, table, keys=keys, partition_column="day", mode="skip_existing")
    assert runs == [0]  # the dates are not worked out from the deduplicated frame first
    assert report.skipped == ["2024-01-01"] and report.rejected == []
    got = values(scan_table(spark, table.path, report.schema).select("id", "v", "dt"))
    moved = [] if keys == ["id"] else [(5, "e", "2024-01-04")]
    assert got == sorted([(1, "old", "2024-01-01"), (2, "b2", "2024-01-02"), (3, "c", "2024-01-02"), (4, "d", "2024-01-03"), *moved], key=str)
    with pytest.raises(PartitionExistsError) as caught:
        compact(parts, table, keys=keys, partition_column="day", mode="fail_if_exists")
    assert "2024-01-01" in caught.value.dates


def test_complete_dates_are_filtered_below_the_dedup(spark, tmp_path):
    parts = parts_of(spark, tmp_path, ROWS)
    kept, held = without_complete(parts, "day", ["2024-01-01", "2024-01-09"])
    assert held == ["2024-01-01"]
    plan_text = plan.compacted(kept, ["id", "day"], "day")[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan_text.index("Window") < plan_text.rindex("2024-01-01")


def test_doubled_layout_is_pruned(spark, lake):
    table = lake("daily")
    frame(spark).withColumn("inner", F.col("dt")).write.partitionBy("dt", "inner").parquet(table.path)
    for found in files.glob(spark, f"{table.path}/dt=*/inner=*"):
        files.move(spark, found, found.replace("inner=", "dt="))
    frame(spark, [(9, "s", "2024-01-05")]).drop("dt").write.parquet(f"{table.path}/dt=2024-01-05")  # one date lies singly
    frame(spark, [(0, "seed", "1900-01-01")]).drop("dt").write.parquet(f"{table.path}/dt=1900-01-01/dt=1900-01-01")
    create_databases(spark, ["doubled"], f"{table.root}/db")
    entry = Entry(table, frame(spark).schema, doubled=True)
    shown = register(spark, "doubled", entry)
    assert values(shown) == [*ROWS, (9, "s", "2024-01-05")]
    one = shown.where("dt = '2024-01-01'")
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()
    assert len(one.inputFiles()) == 1 or all("dt=2024-01-01" in f for f in one.inputFiles())
    assert values(spark.sql("SELECT id FROM doubled_daily_dt('2024-01-01')")) == [(1,), (2,)]
    frame(spark, [(10, "n", "2024-01-06")]).drop("dt").write.parquet(f"{table.path}/dt=2024-01-06/dt=2024-01-06")
    add_partitions(spark, "doubled", entry, ["2024-01-06"])
    assert spark.table("doubled.daily").count() == 6
    frame(spark, [(11, "n", "2024-01-06")]).drop("dt").write.mode("append").parquet(f"{table.path}/dt=2024-01-06")
    with pytest.raises(ValueError, match="above and below"):
        add_partitions(spark, "doubled", entry)
