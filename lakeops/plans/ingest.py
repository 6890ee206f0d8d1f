"""Ingestion: work units, fetch, compact."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.dates import dashed_date, previous_day
from lakeops.operators.publish import LakeTable, PublishReport, new_run_id, safe_run_id
from lakeops.plans.compact import compact
from lakeops.sources import files
from lakeops.sources.fetch import ORDER_COLUMNS, fetch


@dataclass(frozen=True)
class IngestSource:
    """What to fetch and how to store it.

    ``units(spark, start, end)`` gives the work-unit frame, ``fn`` is called once
    per unit, ``schema`` types what it returns.
    """

    target: str
    units: Callable[[SparkSession, str, str], DataFrame]
    fn: Callable
    schema: T.StructType
    keys: Sequence[str] = ()
    partition_column: str | None = None
    fmt: str = "csv"
    parallelism: int | None = None


@dataclass
class IngestResult:
    """``ok``, or ``skipped`` with reason ``no_jobs`` or ``no_data``."""

    target: str
    status: str
    reason: str | None = None
    fetched_rows: int = 0
    report: PublishReport | None = field(default=None, repr=False)


def default_run_date(spark: SparkSession, zone: str = "Asia/Shanghai") -> str:
    """Yesterday in ``zone``."""
    return spark.range(1).select(dashed_date(previous_day(zone=zone))).first()[0]


def ingest(
    spark: SparkSession,
    source: IngestSource,
    root: str,
    *,
    start: str | None = None,
    end: str | None = None,
    run_date: str | None = None,
    mode: str = "overwrite",
    on_invalid: str = "quarantine",
    run_id: str | None = None,
    layer: str = "raw",
) -> IngestResult:
    """Fetch every unit on the executors, write the parts down, compact, publish.

    The fetched rows are written before they are used: a lost executor then
    re-reads parts instead of calling the user function again. The run date
    defaults to yesterday, start to the run date, end to start.
    """
    run_date = run_date or default_run_date(spark)
    start = start or run_date
    end = end or start
    run = safe_run_id(run_id or new_run_id("ingest"))
    units = source.units(spark, start, end)
    table = LakeTable(root, layer, source.target, source.fmt)
    landing = f"{table.staging(run)}_parts"
    try:
        rows = fetch(units, source.fn, source.schema, source.parallelism)
        rows.write.mode("overwrite").parquet(landing)
        parts = spark.read.schema(rows.schema).parquet(landing)
        fetched = parts.agg(F.count(F.lit(1))).first()[0]
        if fetched == 0:
            reason = "no_jobs" if units.isEmpty() else "no_data"
            return IngestResult(source.target, "skipped", reason)
        report = compact(
            parts,
            table,
            keys=source.keys,
            partition_column=source.partition_column,
            run_date=run_date,
            order=ORDER_COLUMNS,
            mode=mode,
            on_invalid=on_invalid,
            run_id=run,
        )
        return IngestResult(source.target, "ok", None, fetched, report)
    finally:
        files.delete(spark, landing)


def ingest_all(
    spark: SparkSession,
    sources: Iterable[IngestSource],
    root: str,
    targets: Sequence[str] | None = None,
    **options,
) -> list[IngestResult]:
    """Ingest several sources in turn, all or only the named targets."""
    wanted = set(targets or [])
    return [
        ingest(spark, source, root, **options)
        for source in sources
        if not wanted or source.target in wanted
    ]
