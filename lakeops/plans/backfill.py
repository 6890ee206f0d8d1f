"""Run a model over a range of dates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from lakeops.operators.checks import backfill_summary
from lakeops.operators.publish import (
    INVALID_KEY,
    OUTSIDE_RANGE,
    LakeTable,
    PublishReport,
    days_between,
    new_run_id,
    publish_no_data,
    publish_partitions,
)
from lakeops.plans.models import Model, NotOverDays, run_model

OUTCOME_SCHEMA = "dt string, status string, error_type string, error string"


class BackfillError(RuntimeError):
    """A date failed and the run was told not to continue."""


@dataclass
class BackfillReport:
    """Per-date outcomes; ``jobs`` counts the publishing jobs that were needed."""

    table: str
    outcomes: dict[str, tuple[str, str | None, str | None]]
    row_count: int = 0
    jobs: int = 0
    cleared: list[str] = field(default_factory=list)
    #: How the model ran: ``range``, ``set`` (a date model for all dates in one plan), ``loop`` or ``snapshot``.
    form: str = "range"
    #: Why a date model ran as a loop.
    why_loop: str | None = None
    #: Rows that were not published: outcome, ``dt`` and ``row_count`` of each kind.
    rejected: list[dict] = field(default_factory=list)
    schema: T.StructType | None = field(default=None, repr=False)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(dt, *outcome) for dt, outcome in sorted(self.outcomes.items())]
        return spark.createDataFrame(rows, OUTCOME_SCHEMA)

    def summary(self, spark: SparkSession) -> DataFrame:
        return backfill_summary(self.frame(spark))

    def dates(self, status: str) -> list[str]:
        return sorted(dt for dt, outcome in self.outcomes.items() if outcome[0] == status)


def backfill(
    spark: SparkSession,
    model: Model,
    table: LakeTable,
    start: str,
    end: str,
    *,
    checks: dict[str, Column | str] | None = None,
    continue_on_error: bool = False,
    targets: Sequence[str] | None = None,
    run_id: str | None = None,
) -> BackfillReport:
    """Publish the model for every date from start to end inclusive.

    A range model runs as one job for all dates. Rows whose ``dt`` is NULL or outside the run's dates are not
    published but kept in quarantine and counted in ``rejected``; the model's SQL prunes what is read by
    its ``:start_date`` and ``:end_date``. Dates whose rows fail a check
    are left out and reported; dates without rows succeed and are cleared. When
    the job itself raises and ``continue_on_error`` is set, the range is halved
    until the failing dates stand alone, so k bad dates among n cost about
    k log n jobs instead of n. A date model runs for all dates in one job too if it provably asks for its own date
    alone (``Model.frame_of_days``), else one job per date; ``form`` in the report says which. A snapshot runs
    once. Without ``continue_on_error`` a range model publishes nothing when any
    date fails, and a date model the dates before the failing one.
    """
    days = days_between(start, end)
    if targets is not None and table.dest not in targets and table.layer not in targets:
        return BackfillReport(table.dest, {d: ("skipped", None, None) for d in days})
    run = run_id or new_run_id("backfill")
    report = BackfillReport(table.dest, {})
    if model.kind == "snapshot":
        report.form = "snapshot"
        _attempt(
            report, [start], continue_on_error,
            lambda: run_model(spark, model, table, run_id=run, run_date=start),
        )
        return report
    if model.kind == "date":
        report.form = "set"
        try:
            model.frame_of_days(spark, days)
            if not continue_on_error:
                # One job for all dates. If it fails, the loop publishes those before the bad one and stops there.
                _attempt(
                    report, days, False,
                    lambda: _publish(spark, model, table, days, checks, False, _run_of(run, days)),
                )
                return report
        except NotOverDays as reason:
            report.form, report.why_loop = "loop", str(reason)
        except BackfillError as error:
            report.form, report.why_loop = "loop", f"the job for all dates failed: {type(error.__cause__).__name__}"
    if report.form == "loop":
        for day in days:
            _attempt(
                report, [day], continue_on_error,
                lambda day=day: _publish(
                    spark, model, table, [day], checks, continue_on_error, _run_of(run, [day])
                ),
            )
        return report
    pending = [days]
    while pending:
        block = pending.pop()
        fine = _attempt(
            report, block, continue_on_error,
            lambda block=block: _publish(
                spark, model, table, block, checks, continue_on_error, _run_of(run, block)
            ),
        )
        if not fine and len(block) > 1:
            half = len(block) // 2
            pending += [block[half:], block[:half]]
    return report


def _run_of(run: str, days: Sequence[str]) -> str:
    """Run id unique per block of dates."""
    return f"{run}_{days[0].replace('-', '')}_{len(days)}"


def _publish(
    spark: SparkSession,
    model: Model,
    table: LakeTable,
    days: Sequence[str],
    checks: dict[str, Column | str] | None,
    continue_on_error: bool,
    run_id: str,
) -> PublishReport:
    one_date = model.kind == "date" and len(days) == 1
    frame = model.frame(spark, days) if one_date or model.kind != "date" else model.frame_of_days(spark, days)
    if frame is None:
        return publish_no_data(spark, table, days, run_id)
    return publish_partitions(
        frame,
        table,
        requested=days,
        checks=checks,
        fail_dates="skip" if continue_on_error else "raise",
        run_id=run_id,
        rebalance=not one_date,
    )


def _attempt(report: BackfillReport, days: Sequence[str], continue_on_error: bool, job) -> bool:
    """Run one job and note the outcome of its dates; False when it raised."""
    report.jobs += 1
    try:
        result = job()
    except Exception as error:
        if not continue_on_error:
            raise BackfillError(
                f"Backfill of {report.table} stopped at {days[0]}..{days[-1]}: "
                f"{len(report.dates('success'))} dates done"
            ) from error
        if len(days) == 1:
            report.outcomes[days[0]] = ("failed", type(error).__name__, str(error))
        return False
    report.row_count += result.row_count
    report.schema = result.schema or report.schema
    report.cleared += result.cleared
    for day in days:
        report.outcomes[day] = ("success", None, None)
    report.rejected += result.rejected
    for bad in result.rejected:
        if bad["outcome"] not in (INVALID_KEY, OUTSIDE_RANGE):
            note = f"{bad['row_count']} rows failed {bad['outcome']}"
            known = report.outcomes[bad["dt"]]
            text = note if known[0] == "success" else f"{known[2]}; {note}"
            report.outcomes[bad["dt"]] = ("failed", "RowCheck", text)
    return True
