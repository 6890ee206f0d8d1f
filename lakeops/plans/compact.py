"""Compaction: parts in, deduplicated dated table out, in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lakeops.operators.dedup import LANDING_ORDER, dedup_latest
from lakeops.functions.dates import normalize_dt
from lakeops.operators.normalize import assign_partition, drop_internal, exclude_dates, keep_dates
from lakeops.operators.publish import LakeTable, PublishReport, complete_dates, publish_partitions


def compacted(
    parts: DataFrame,
    keys: Sequence[str] = (),
    partition_column: str | None = None,
    run_date: str | None = None,
    order: Sequence[str] = LANDING_ORDER,
) -> tuple[DataFrame, bool]:
    """Newest row per key with its ``dt``, bookkeeping columns dropped.

    Also tells whether the data decided the dates.
    """
    newest = dedup_latest(parts, keys, order)
    dated, by_data = assign_partition(newest, partition_column, run_date)
    return drop_internal(dated), by_data


def compact(
    parts: DataFrame,
    table: LakeTable,
    *,
    keys: Sequence[str] = (),
    partition_column: str | None = None,
    run_date: str | None = None,
    order: Sequence[str] = LANDING_ORDER,
    mode: str = "overwrite",
    on_invalid: str = "quarantine",
    run_id: str | None = None,
) -> PublishReport:
    """Deduplicate parts, derive ``dt`` and publish every produced date.

    With a ``partition_column`` that exists the data decide the dates, otherwise
    all rows go to ``run_date`` and need no shuffle by date.

    The dedup runs once in every mode. If the date is one of the keys, all rows of a key have one date, so complete dates are
    left out of the parts themselves. If it is not, a key's newest row decides its date, and rows that turn out to be of a
    complete date are staged and not published.
    """
    by_data = bool(partition_column) and partition_column in parts.columns
    existing = None
    if mode != "overwrite" and by_data and partition_column in keys:
        parts, existing = without_complete(parts, partition_column, complete_dates(parts.sparkSession, table))
    frame, by_data = compacted(parts, keys, partition_column, run_date, order)
    return publish_partitions(
        frame,
        table,
        mode=mode,
        on_invalid=on_invalid,
        rebalance=by_data,
        run_id=run_id,
        existing=existing,
        stage_existing=by_data and existing is None,
    )


def without_complete(parts: DataFrame, partition_column: str, done: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The parts without rows of complete dates, and which of these dates the parts hold (from the date column alone)."""
    if not done:
        return parts, []
    dated = parts.withColumn("_dt", normalize_dt(parts, partition_column))
    held = sorted(r[0] for r in keep_dates(dated.select("_dt"), done, "_dt").distinct().collect())
    return exclude_dates(dated, held, "_dt").drop("_dt"), held
