"""Random sequences of runs against a plain dictionary of partitions."""

from __future__ import annotations

import random

import pytest
from support import values

from lakeops.operators.publish import (
    PartitionExistsError,
    clear_partitions,
    publish_partitions,
)
from lakeops.sources.scan import scan_table

DATES = [f"2024-01-0{n}" for n in range(1, 6)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_of_runs(spark, lake, seed):
    rng = random.Random(seed)
    table, state, number = lake(), {}, 0
    for _ in range(9):
        rows = []
        for dt in rng.sample(DATES, rng.randrange(1, 4)):
            for _ in range(rng.randrange(1, 4)):
                number += 1
                rows.append((number, dt))
        made = {dt: sorted(n for n, d in rows if d == dt) for dt in {d for _, d in rows}}
        data = spark.createDataFrame(rows, "id int, dt string")
        step = rng.choice(["overwrite", "skip", "fail", "requested", "clear", "copy"])
        if step == "skip":
            report = publish_partitions(data, table, mode="skip_existing")
            assert report.skipped == sorted(set(made) & set(state))
            state = {**made, **state}
        elif step == "fail" and set(made) & set(state):
            with pytest.raises(PartitionExistsError):
                publish_partitions(data, table, mode="fail_if_exists")
        elif step == "requested":
            asked = rng.sample(DATES, 3)
            report = publish_partitions(data, table, requested=asked)
            assert report.cleared == sorted(dt for dt in asked if dt in state and dt not in made)
            state = {dt: ids for dt, ids in state.items() if dt not in asked}
            state |= {dt: ids for dt, ids in made.items() if dt in asked}
        elif step == "clear":
            gone = rng.sample(DATES, 2)
            assert clear_partitions(spark, table, gone) == sorted(set(gone) & set(state))
            state = {dt: ids for dt, ids in state.items() if dt not in gone}
        else:
            publish_partitions(data, table, copy=step == "copy")
            state |= made
        assert values(table.completed(spark)) == [(dt,) for dt in sorted(state)]
        if state:
            expected = sorted((n, dt) for dt, ids in state.items() for n in ids)
            found = scan_table(spark, table.path, data.schema).collect()
            assert sorted((r["id"], r["dt"]) for r in found) == expected
