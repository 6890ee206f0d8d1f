from __future__ import annotations

import os

import pytest
from support import values
from pyspark.sql import functions as F

from lakeops.operators import publish
from lakeops.operators.checks import (
    ValidationError,
    backfill_summary,
    partition_files,
    raise_on_violations,
    validate_metrics,
)
from lakeops.operators.manifest import latest_manifest, manifest_json
from lakeops.operators.publish import (
    LakeTable,
    PartitionExistsError,
    adopt_partitions,
    cleanup,
    clear_partitions,
    materialize,
    publish_partitions,
    publish_snapshot,
    read_quarantine,
    write_partitioned,
)
from lakeops.sources import files
from lakeops.sources.scan import has_rows, missing_dates, scan_raw_csv, scan_snapshot, scan_table

DDL = "id int, v string, dt string"


def rows(spark, *tuples, ddl=DDL):
    return spark.createDataFrame(list(tuples), ddl)


def staging_is_empty(table):
    folder = f"{table.root}/_staging/{table.layer}/{table.name}"
    return not os.path.isdir(folder) or os.listdir(folder) == []


@pytest.mark.parametrize("copy", [False, True])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_only_produced_dates_are_replaced_and_runs_repeat(spark, lake, fmt, copy):
    table = lake(fmt=fmt)
    first = rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-02"))
    second = rows(spark, (3, "c", "2024-01-02"), (4, "d", "2024-01-03"))
    for _ in range(2):
        publish_partitions(first, table, copy=copy)
        report = publish_partitions(second, table, copy=copy)
    assert report.row_count == 2 and report.partition_count == 2
    found = table.read(spark, first.select("id", "v").schema)
    assert values(found.select(F.col("id").cast("int"), "v", "dt")) == [
        (1, "a", "2024-01-01"),
        (3, "c", "2024-01-02"),
        (4, "d", "2024-01-03"),
    ]
    assert values(table.completed(spark)) == [("2024-01-01",), ("2024-01-02",), ("2024-01-03",)]
    assert staging_is_empty(table)


def test_date_typed_partition_column_and_layout(spark, lake):
    table = lake()
    publish_partitions(spark.sql("SELECT 42 AS value, DATE '2024-01-01' AS dt"), table)
    folder = table.partition_path("2024-01-01")
    names = [n for n in os.listdir(folder) if n.endswith(".parquet")]
    assert len(names) == 1
    assert spark.read.parquet(f"{folder}/{names[0]}").columns == ["value"]
    assert dict(scan_table(spark, table.path).dtypes)["dt"] == "string"


def test_write_modes(spark, lake):
    table = lake()
    publish_partitions(rows(spark, (1, "old", "2024-01-01")), table)
    more = rows(spark, (1, "new", "2024-01-01"), (2, "new", "2024-01-02"))
    with pytest.raises(PartitionExistsError, match="2024-01-01"):
        publish_partitions(more, table, mode="fail_if_exists")
    assert values(scan_table(spark, table.path), "v") == [("old",)]
    report = publish_partitions(more, table, mode="skip_existing")
    assert report.skipped == ["2024-01-01"] and report.partition_count == 1
    assert values(scan_table(spark, table.path), "v") == [("new",), ("old",)]
    again = publish_partitions(more, table, mode="skip_existing")
    assert again.status == "skipped" and again.skipped == ["2024-01-01", "2024-01-02"]
    publish_partitions(more, table)
    assert values(scan_table(spark, table.path), "v") == [("new",), ("new",)]
    with pytest.raises(ValueError, match="mode"):
        publish_partitions(more, table, mode="append")


def test_skip_existing_reads_no_finished_dates(spark, lake, tmp_path, monkeypatch):
    """Finished dates are partition filters of the scan that is written from."""
    source, table = str(tmp_path / "source"), lake()
    days = [f"2024-01-{d:02}" for d in range(1, 6)]
    rows(spark, *[(k, "old", d) for k, d in enumerate(days)]).write.partitionBy("dt").parquet(source)
    publish_partitions(scan_table(spark, source).where("dt < '2024-01-05'"), table)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plans = []
    whole = publish.materialize

    def watched(frame, *args):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return whole(frame, *args)

    monkeypatch.setattr(publish, "materialize", watched)
    report = publish_partitions(scan_table(spark, source), table, mode="skip_existing")
    assert report.skipped == days[:4] and [p["dt"] for p in report.partitions] == days[4:]
    assert all(day in plans[0].split("PartitionFilters", 1)[1].split("]", 1)[0] for day in days[:4])
    again = publish_partitions(scan_table(spark, source), table, mode="skip_existing", requested=days)
    assert again.skipped == days and again.cleared == [] and again.status == "skipped"


def test_fail_if_exists_writes_nothing(spark, lake, monkeypatch):
    table = lake()
    publish_partitions(rows(spark, (1, "old", "2024-01-01")), table)
    monkeypatch.setattr(publish, "materialize", lambda *a, **k: pytest.fail("staged before the check"))
    for requested in (["2024-01-01", "2024-01-02"], None):
        with pytest.raises(PartitionExistsError) as caught:
            publish_partitions(rows(spark, (1, "new", "2024-01-01")), table, mode="fail_if_exists", requested=requested)
        assert caught.value.dates == ["2024-01-01"]


def test_requested_dates_without_rows_are_cleared(spark, lake):
    table, neighbour = lake("t"), lake("t_full")
    data = rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-02"))
    publish_partitions(data, table)
    publish_partitions(data, neighbour)
    report = publish_partitions(
        data.where("id = 1"), table, requested=["2024-01-01", "2024-01-02", "2024-01-03"]
    )
    assert report.cleared == ["2024-01-02"]
    assert values(scan_table(spark, table.path), "id") == [(1,)]
    assert values(table.completed(spark)) == [("2024-01-01",)]
    assert scan_table(spark, neighbour.path).count() == 2
    assert clear_partitions(spark, table, ["2024-01-02"]) == []
    with pytest.raises(ValueError, match="date"):
        clear_partitions(spark, table, [""])


def test_requested_dates_limit_the_run(spark, lake):
    table = lake()
    data = rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-02"))
    publish_partitions(data, table, requested=["2024-01-02"])
    assert values(scan_table(spark, table.path), "id") == [(2,)]


def test_rows_without_a_key(spark, lake):
    data = rows(spark, (1, "a", "2024-01-01"), (2, "b", None), (3, "c", None))
    table = lake("q")
    report = publish_partitions(data, table)
    assert report.rejected_rows == 2 and report.row_count == 1
    assert values(read_quarantine(spark, table, data.schema), "id", "v", "dt", "_outcome") == [
        (2, "b", None, "invalid_key"),
        (3, "c", None, "invalid_key"),
    ]
    dropped = lake("d")
    assert publish_partitions(data, dropped, on_invalid="drop").rejected_rows == 2
    assert not has_rows(read_quarantine(spark, dropped, data.schema))
    strict = lake("r")
    with pytest.raises(ValidationError, match="2 rows"):
        publish_partitions(data, strict, on_invalid="raise")
    assert not os.path.exists(strict.path) and staging_is_empty(strict)


def test_row_checks_hold_back_whole_dates(spark, lake):
    table = lake()
    publish_partitions(rows(spark, (9, "old", "2024-01-02")), table)
    data = rows(spark, (1, "a", "2024-01-01"), (2, None, "2024-01-02"), (3, "c", "2024-01-02"))
    checks = {"v_present": "v IS NOT NULL", "id_positive": F.col("id") > 0}
    with pytest.raises(ValidationError, match="2024-01-02"):
        publish_partitions(data, table, checks=checks)
    assert values(scan_table(spark, table.path), "v") == [("old",)]
    report = publish_partitions(data, table, checks=checks, fail_dates="skip")
    assert report.rejected == [{"outcome": "v_present", "dt": "2024-01-02", "row_count": 1}]
    assert values(scan_table(spark, table.path), "v") == [("a",), ("old",)]


def test_a_failure_while_publishing_loses_nothing(spark, lake, monkeypatch):
    table = lake()
    old = rows(spark, (1, "old", "2024-01-01"), (2, "old", "2024-01-02"))
    publish_partitions(old, table)

    def broken(*args):
        raise OSError("store unreachable")

    with monkeypatch.context() as patched:
        patched.setattr(files, "replace_dirs", broken)
        with pytest.raises(OSError, match="unreachable"):
            publish_partitions(old.withColumn("v", F.lit("new")), table)
    assert values(scan_table(spark, table.path), "v") == [("old",), ("old",)]
    assert staging_is_empty(table)
    publish_partitions(old.withColumn("v", F.lit("new")), table)
    assert values(scan_table(spark, table.path), "v") == [("new",), ("new",)]


def test_a_failed_move_puts_the_old_partition_back(spark, tmp_path):
    old = tmp_path / "t" / "dt=1"
    old.mkdir(parents=True)
    (old / "keep").write_text("old")
    with pytest.raises(Exception, match="move|exist"):
        files.replace_dirs(spark, [(str(tmp_path / "none"), str(old))], str(tmp_path / "aside"))
    assert (old / "keep").read_text() == "old"


def test_a_failing_task_leaves_the_table_alone(spark, lake):
    table = lake()
    publish_partitions(rows(spark, (1, "old", "2024-01-01")), table)
    bad = rows(spark, (1, "x", "2024-01-01")).withColumn("v", F.col("v").cast("int").cast("string"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        publish_partitions(bad, table)
    assert values(scan_table(spark, table.path), "v") == [("old",)] and staging_is_empty(table)


def test_a_hot_date_is_split_over_tasks_and_small_ones_stay_single(spark, lake):
    table = lake()
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    try:
        wide = spark.range(0, 60_000, 1, 16).select(
            F.col("id").cast("int").alias("id"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
            F.when(F.col("id") < 30_000, "2024-01-01")
            .otherwise(F.format_string("2024-02-%02d", (F.col("id") % 20 + 1).cast("int")))
            .alias("dt"),
        )
        publish_partitions(wide, table)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    found = {r["dt"]: r for r in partition_files(scan_table(spark, table.path)).collect()}
    assert found["2024-01-01"]["file_count"] > 3
    assert sum(r["row_count"] for r in found.values()) == 60_000
    assert scan_table(spark, table.path).agg(F.count_distinct("v")).first()[0] == 60_000


def test_csv_keeps_texts_whole(spark, lake):
    table = lake(fmt="csv")
    texts = ['a "quoted", text', "two\nlines", "  blanks  ", "", None, "back\\slash", "é中", "x\r\ny"]
    data = spark.createDataFrame(
        [(n, t, "2024-01-01") for n, t in enumerate(texts)], "id int, v string, dt string"
    )
    publish_partitions(data, table)
    back = scan_raw_csv(spark, table.path, ["id", "v"], ["2024-01-01"], multiline=True)
    # CSV has no way to tell an empty text from no value; both read as NULL.
    expected = {n: t or None for n, t in enumerate(texts)}
    assert {int(r["id"]): r["v"] for r in back.collect()} == expected


def test_csv_row_with_one_empty_column_is_not_lost_silently(spark, lake):
    data = spark.createDataFrame([(None, "2024-01-01"), ("x", "2024-01-01")], "v string, dt string")
    table = lake(fmt="csv")
    try:
        publish_partitions(data, table)
    except ValidationError:
        return
    assert scan_raw_csv(spark, table.path, ["v"]).count() == 2


def test_snapshot(spark, lake):
    for copy in (False, True):
        table = lake(f"s{copy}")
        publish_snapshot(spark.range(5), table, run_date="2024-01-01", copy=copy)
        report = publish_snapshot(spark.range(3), table, run_date="2024-01-02", copy=copy)
        assert report.row_count == 3 and scan_snapshot(spark, table.path).count() == 3
        assert values(table.completed(spark)) == [("2024-01-01",), ("2024-01-02",)]
        gone = publish_snapshot(spark.range(0), table, copy=copy)
        assert gone.status == "cleared" and not os.path.exists(table.path)
        assert staging_is_empty(table)


def test_manifest(spark, lake):
    table = lake()
    data = rows(spark, (1, "a", "2024-01-01"), (2, "a", "2024-01-01"))
    publish_partitions(data, table, run_id="first run")
    publish_partitions(data.where("id = 1"), table, run_id="second")
    assert table.manifest(spark).count() == 2
    row = latest_manifest(table.manifest(spark)).first()
    assert (row["dest"], row["run_id"], row["row_count"], row["file_count"], row["status"]) == (
        "ods.t",
        "second",
        1,
        1,
        "success",
    )
    assert row["target_prefix"] == table.partition_path("2024-01-01")
    text = manifest_json(latest_manifest(table.manifest(spark))).first()["manifest"]
    assert text.startswith('{"dest":"ods.t","file_count":1,"generated_at":"')


def test_partitions_of_another_tool_are_adopted(spark, lake):
    table = lake()
    data = rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "b", "2024-01-02"))
    write_partitioned(data, table.path)
    open(f"{table.partition_path('2024-01-02')}/_SUCCESS", "w").close()
    assert adopt_partitions(spark, table, data.schema) == ["2024-01-02"]
    row = latest_manifest(table.manifest(spark)).first()
    assert (row["partition_date"], row["row_count"]) == ("2024-01-02", 2)
    report = publish_partitions(data, table, mode="skip_existing")
    assert report.skipped == ["2024-01-02"]
    assert adopt_partitions(spark, table, data.schema) == []


def test_table_paths():
    table = LakeTable("s3://bucket/lake/", "raw/daily", "x")
    assert table.path == "s3://bucket/lake/raw/daily/x"
    assert table.staging("a:b") == "s3://bucket/lake/_staging/raw/daily/x/run_a_b"
    assert not files.file_system_handles_renames(None, table.path)
    for bad in (("", "l", "n"), ("r", " ", "n"), ("r", "l", "")):
        with pytest.raises(ValueError, match="required"):
            LakeTable(*bad)
    with pytest.raises(ValueError, match="format"):
        LakeTable("r", "l", "n", "orc")
    with pytest.raises(ValueError, match="run_id"):
        table.staging("")


def test_write_partitioned_arguments(spark, tmp_path):
    with pytest.raises(ValueError, match="format"):
        write_partitioned(spark.range(1), str(tmp_path / "x"), ("id",), "txt")
    with pytest.raises(ValueError, match="column"):
        write_partitioned(spark.range(1), str(tmp_path / "x"), ())


def test_cleanup_twice(spark, lake):
    table = lake()
    cleanup(spark, table, "r1")
    cleanup(spark, table, "r1")


def test_validate_metrics(spark):
    ddl = "dt string, row_count long, file_count long"
    expected = spark.createDataFrame(
        [("a", 10, 2, 1), ("b", 100, 2, 1), ("c", 0, 0, 0), ("d", 5, 1, 1), ("e", -1, 1, 1), ("f", 0, 0, 0)],
        ddl + ", has_data int",
    )
    actual = spark.createDataFrame(
        [("a", 10, 2), ("b", 100, 1), ("d", 4, 1), ("e", 1, 1), ("f", 3, 1), ("g", 1, 1)], ddl
    )
    found = validate_metrics(expected, actual)
    assert values(found) == [
        ("b", "file_count_mismatch", 2, 1),
        ("d", "row_count_mismatch", 5, 4),
        ("e", "negative_row_count", -1, 1),
        ("f", "unexpected_files", 0, 1),
        ("g", "unexpected_files", 0, 1),
    ]
    with pytest.raises(ValidationError, match="b: file_count_mismatch"):
        raise_on_violations(found)
    raise_on_violations(found.where("dt = 'none'"))


def test_missing_dates(spark):
    present = spark.createDataFrame([("a",), ("a",), (None,)], "dt string")
    asked = spark.createDataFrame([("a",), ("b",), ("b",)], "dt string")
    assert values(missing_dates(present, asked)) == [("b",)]


def test_backfill_summary(spark):
    ddl = "dt string, status string, error_type string, error string"
    outcomes = spark.createDataFrame(
        [
            ("2024-01-02", "success", None, None),
            ("2024-01-01", "failed", "E", "broken"),
            ("2024-01-03", "success", None, None),
        ],
        ddl,
    )
    row = backfill_summary(outcomes).first()
    assert row[:6] == (3, 2, 1, 0, "2024-01-02", "2024-01-03")
    assert [tuple(f) for f in row["failed_dates"]] == [("2024-01-01", "broken", "E")]


def test_materialize_a_query(spark, tmp_path):
    sql = "SELECT id, CAST(id % 2 AS STRING) AS dt FROM range(10)"
    found = materialize(sql, str(tmp_path / "staging"))
    assert sorted((m["dt"], m["row_count"], m["file_count"]) for m in found) == [
        ("0", 5, 1),
        ("1", 5, 1),
    ]


def test_without_adaptive_execution(spark, lake):
    table = lake()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        data = spark.range(100).selectExpr("id", "concat('2024-01-0', id % 3 + 1) AS dt")
        report = publish_partitions(data, table)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert report.row_count == 100 and report.partition_count == 3


def test_copy_records_the_files_it_wrote(spark, lake):
    table = lake()
    data = spark.range(0, 100, 1, 4).selectExpr("id", "'2024-01-01' AS dt")
    report = publish_partitions(data, table, copy=True, rebalance=False)
    names = os.listdir(table.partition_path("2024-01-01"))
    on_disk = [n for n in names if n.endswith(".parquet")]
    assert report.partitions[0]["file_count"] == len(on_disk) and report.row_count == 100
