from __future__ import annotations

import random

import pandas as pd
import pytest
from support import values

from lakeops.operators.dedup import dedup_last, dedup_latest
from lakeops.sources.scan import scan_parts


@pytest.fixture
def part_of(spark, tmp_path):
    """A part file with this number, from rows and their columns."""

    def write(number, columns, *rows):
        path = tmp_path / f"part_{number:06}.parquet"
        pd.DataFrame(list(rows), columns=columns).to_parquet(path, index=False)
        return str(path)

    return write


def test_later_part_wins_and_ties_go_to_the_last_row(spark, part_of):
    """Parts count by their number, whatever the order they are named in."""
    columns = ["tank", "day", "level"]
    named = [
        part_of(0, columns, ("north", 7, 11), ("south", 7, 12), ("south", 7, 13), ("west", 9, 14)),
        part_of(10, columns, ("north", 7, 21), ("west", 8, 22)),
        part_of(2, columns, ("north", 7, 31), ("west", 9, 32)),
    ]
    kept = dedup_last(scan_parts(spark, *named), columns[:2])
    assert values(kept, *columns) == [("north", 7, 21), ("south", 7, 13), ("west", 8, 22), ("west", 9, 32)]


def test_parts_of_different_versions_stack_by_name(spark, part_of):
    old, new = part_of(0, ["id", "value"], (1, 10)), part_of(1, ["value", "id", "note"], (20, 2, "x"))
    assert values(scan_parts(spark, old, new), "id", "value", "note") == [(1, 10, None), (2, 20, "x")]


def test_null_keys_missing_keys_and_no_keys(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), (5, 3)], "k int, v int")
    assert values(dedup_latest(frame, ["k", "absent"], ["v"]), "v") == [(2,), (3,)]
    assert dedup_latest(frame, ["absent"], ["v"]) is frame
    assert dedup_latest(frame, [], ["v"]) is frame
    assert values(dedup_latest(frame, ["k"], ["absent"]), "v") == [(2,), (3,)]


def test_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    rows = [
        ("hot" if rng.random() < 0.4 else f"k{rng.randrange(500)}", n, rng.random())
        for n in range(20_000)
    ]
    expected = {}
    for key, order, value in rows:
        if key not in expected or order > expected[key][0]:
            expected[key] = (order, value)
    frame = spark.createDataFrame(rows, "k string, n long, v double").repartition(16)
    got = {r["k"]: (r["n"], r["v"]) for r in dedup_latest(frame, ["k"], ["n"]).collect()}
    assert got == expected


def test_rows_are_pruned_before_the_shuffle(spark):
    frame = spark.range(100).selectExpr("id % 3 AS k", "id AS n")
    plan = dedup_latest(frame, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2 and "Partial" in limits[-1]
    assert plan.index("Exchange") < plan.index("Partial")
