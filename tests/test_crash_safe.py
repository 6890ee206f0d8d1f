"""Failures before and after each step of a publication, then the same run again."""

from __future__ import annotations

import os

import pytest
from support import values

from lakeops.operators import manifest as log
from lakeops.operators import publish
from lakeops.operators.publish import publish_partitions, publish_snapshot, read_quarantine
from lakeops.sources import files
from lakeops.sources.scan import scan_snapshot, scan_table

DAYS = [f"2024-03-0{d}" for d in range(1, 6)]


class Crash(RuntimeError):
    pass


def leftovers(table):
    top = os.path.dirname(table.staging("x"))
    return sorted(os.listdir(top)) if os.path.isdir(top) else []


def old_and_new(spark, table):
    """Days 1 to 4 exist; the run brings days 2 to 4 anew, none for day 1, and a row without a key."""
    old = spark.createDataFrame([(k, "old", d) for k, d in enumerate(DAYS[:4])], "id int, v string, dt string")
    publish_partitions(old, table)
    rows = [(k, "new", d) for k, d in enumerate(DAYS[1:4])] + [(9, "lost", None)]
    return spark.createDataFrame(rows, "id int, v string, dt string")


def run(data, table, copy=None):
    return publish_partitions(data, table, run_id="run 1", requested=DAYS[:4], copy=copy)


def final_state(spark, table, data):
    assert values(scan_table(spark, table.path), "id", "v", "dt") == [(k, "new", d) for k, d in enumerate(DAYS[1:4])]
    assert values(table.completed(spark)) == [(d,) for d in DAYS[1:4]]
    assert values(read_quarantine(spark, table, data.schema), "id", "v") == [(9, "lost")]
    assert leftovers(table) == []


STEPS = {
    "stage": (publish, "materialize"),
    "quarantine": (publish, "_keep_rejected"),
    "swap": (files, "replace_dirs"),
    "manifest": (log, "append_manifest"),
    "clear": (publish, "clear_partitions"),
    "delete": (files, "delete_all"),
}


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("step", list(STEPS))
def test_rerun_after_a_failed_step(spark, lake, monkeypatch, step, when):
    table = lake()
    data = old_and_new(spark, table)
    module, name = STEPS[step]
    whole = getattr(module, name)

    def crash(*args, **kwargs):
        if when == "after":
            whole(*args, **kwargs)
        raise Crash(step)

    with monkeypatch.context() as patch:
        patch.setattr(module, name, crash)
        with pytest.raises(Crash):
            run(data, table)
    # What is complete by the manifest has its rows.
    complete = {d for (d,) in values(table.completed(spark))}
    assert complete <= {d for (d,) in values(scan_table(spark, table.path), "dt")}
    run(data, table)
    final_state(spark, table, data)


@pytest.mark.parametrize("at", [0, 1, 2])
def test_manifest_tells_what_was_moved(spark, lake, monkeypatch, at):
    table = lake()
    data = old_and_new(spark, table)
    whole, moved = files.replace_dirs, []

    def broken(spark, moves, aside, on_moved):
        def count(target):
            on_moved(target)
            moved.append(target)

        whole(spark, [*moves[:at], ("/nowhere/at/all", moves[at][1]), *moves[at + 1 :]], aside, count)

    with monkeypatch.context() as patch:
        patch.setattr(files, "replace_dirs", broken)
        with pytest.raises(Exception, match="nowhere|move"):
            run(data, table)
    assert len(moved) == at
    assert values(scan_table(spark, table.path).where("v = 'new'"), "dt") == [(d,) for d in DAYS[1 : 1 + at]]
    newest = log.latest_manifest(table.manifest(spark)).where("run_id = 'run 1'")
    assert values(newest, "partition_date") == [(d,) for d in DAYS[1 : 1 + at]]
    assert scan_table(spark, table.path).count() == 4 and leftovers(table) == []
    run(data, table)
    final_state(spark, table, data)


def test_data_aside_returns_after_a_killed_driver(spark, lake):
    """The old partition stepped aside and the driver died before the new one took its place."""
    table = lake()
    data = old_and_new(spark, table)
    aside = f"{table.staging('run 1')}_replaced"
    files.make_dir(spark, aside)
    files.move(spark, table.partition_path(DAYS[0]), f"{aside}/dt={DAYS[0]}")
    publish.cleanup(spark, table, "run 1")
    assert scan_table(spark, table.path).count() == 4 and leftovers(table) == []
    run(data, table)
    final_state(spark, table, data)


def test_failed_copies_leave_the_old_data(spark, lake, monkeypatch):
    table, snapshot = lake("t"), lake("s")
    data = old_and_new(spark, table)
    publish_snapshot(data.where("id < 2"), snapshot)
    whole = publish._writer

    def broken(df, fmt, mode="overwrite"):
        writer = whole(df, fmt, mode)
        if mode == "append":
            whole(df.selectExpr("*", "assert_true(id < 0) AS never"), fmt, mode).save(f"{table.root}/elsewhere")
        return writer

    with monkeypatch.context() as patch:
        patch.setattr(publish, "_writer", broken)
        with pytest.raises(Exception, match="assert|id"):
            run(data, table, copy=True)
        with pytest.raises(Exception, match="assert|id"):
            publish_snapshot(data, snapshot, run_id="run 1", copy=True)
    assert scan_table(spark, table.path).where("v = 'old'").count() == 4
    assert scan_snapshot(spark, snapshot.path).count() == 2
    run(data, table, copy=True)
    final_state(spark, table, data)
    publish_snapshot(data, snapshot, run_id="run 1", copy=True)
    assert scan_snapshot(spark, snapshot.path).count() == 4


def test_copied_rows_are_written_once(spark, lake):
    """Into the final place: one write, and no file of the staged ones or the old ones is left."""
    table = lake()
    data = old_and_new(spark, table)
    run(data, table, copy=True)
    found = [f for d in DAYS[1:4] for f in os.listdir(table.partition_path(d)) if f.startswith("part")]
    assert len(found) == 3
    final_state(spark, table, data)


def test_quarantine_of_foreign_dates(spark, lake):
    table = lake()
    data = old_and_new(spark, table)
    report = publish_partitions(data, table, requested=[DAYS[1]])
    kinds = {(r["outcome"], r["dt"]): r["row_count"] for r in report.rejected}
    assert kinds == {("invalid_key", None): 1, ("outside_range", DAYS[2]): 1, ("outside_range", DAYS[3]): 1}
    assert report.row_count + report.rejected_rows == data.count()
    with pytest.raises(publish.ValidationError, match="3 rows"):
        publish_partitions(data, table, requested=[DAYS[1]], on_invalid="raise")
