"""Stage, validate, publish, record, clean up.

A run writes into a staging directory beside the table (never inside it), is
measured there, and only then replaces the partitions it produced. Every step
works on the whole set of partitions; the driver holds per-partition metrics
and directory names, never rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.text import partition_of
from lakeops.operators import manifest as log
from lakeops.operators.checks import ValidationError, key_mark, partition_files, raise_on_violations, validate_metrics
from lakeops.operators.normalize import exclude_dates, keep_dates
from lakeops.sources import files, peek
from lakeops.sources.scan import CSV_OPTIONS, dates_with_files, scan_raw_csv, scan_snapshot, scan_table
from lakeops.sources.schemas import PARTITION_COLUMN, SEED_PARTITION, all_text

WRITE_MODES = ("overwrite", "skip_existing", "fail_if_exists")
FORMATS = ("parquet", "csv")
INVALID_MODES = ("quarantine", "drop", "raise")

#: Hash slots for gathering rows by partition. Above 2000 Spark keeps only average
#: block sizes per map task, and a hot slot would no longer be seen and split.
HASH_SLOTS = 2000

#: Staged rows are split by outcome; only this one is published.
OK = "ok"
INVALID_KEY = "invalid_key"
OUTSIDE_RANGE = "outside_range"
EXISTING = "existing"
OUTCOME = "_outcome"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class PartitionExistsError(RuntimeError):
    """``fail_if_exists`` met partitions that are already complete: all of them in ``dates``."""

    def __init__(self, dates: Sequence[str]):
        self.dates = list(dates)
        super().__init__(f"Partitions already exist: {shortened(self.dates)}")


class RowChecksError(ValidationError):
    """Rows failed their checks: all dates that have such rows in ``dates``."""

    def __init__(self, dates: Sequence[str]):
        self.dates = list(dates)
        super().__init__(f"Row checks failed for {len(self.dates)} dates: {shortened(self.dates)}")


def shortened(values: Sequence[str], shown: int = 20) -> str:
    """A list as message text; whoever needs all of it reads the list itself."""
    more = f" and {len(values) - shown} more" if len(values) > shown else ""
    return ", ".join(values[:shown]) + more


def new_run_id(prefix: str = "run") -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def safe_run_id(run_id: str) -> str:
    """A run id fit for a directory name: word characters and hyphens stay."""
    return re.sub(r"[^\w-]", "_", run_id)


@dataclass(frozen=True)
class LakeTable:
    """Where a table and its side directories live below one lake root."""

    root: str
    layer: str
    name: str
    fmt: str = "parquet"

    def __post_init__(self) -> None:
        for part in (self.root, self.layer, self.name):
            if not part or not part.strip():
                raise ValueError("root, layer and name are required")
        if self.fmt not in FORMATS:
            raise ValueError(f"Unsupported format: {self.fmt}")

    def _below(self, area: str) -> str:
        return f"{self.root.rstrip('/')}{area}/{self.layer.strip('/')}/{self.name}"

    @property
    def path(self) -> str:
        return self._below("")

    @property
    def manifest_path(self) -> str:
        return self._below("/_manifest")

    @property
    def quarantine_path(self) -> str:
        return self._below("/_quarantine")

    @property
    def dest(self) -> str:
        return f"{self.layer}.{self.name}"

    def partition_path(self, dt: str) -> str:
        return f"{self.path}/{PARTITION_COLUMN}={dt}"

    def staging(self, run_id: str) -> str:
        if not run_id:
            raise ValueError("run_id is required")
        return f"{self._below('/_staging')}/run_{safe_run_id(run_id)}"

    def manifest(self, spark: SparkSession) -> DataFrame:
        return log.read_manifest(spark, self.manifest_path)

    def completed(self, spark: SparkSession) -> DataFrame:
        """Partitions published successfully, as ``dt``."""
        return log.completed_partitions(self.manifest(spark))

    def read(self, spark: SparkSession, schema: T.StructType | None = None, multiline: bool = False) -> DataFrame:
        """The published rows; CSV tables need their schema and come as text.

        Spark splits CSV files. Say ``multiline=True`` where values hold line breaks: each file is then read by one task.
        """
        if self.fmt == "csv":
            if schema is None:
                raise ValueError("A CSV table is read with its column list")
            return scan_raw_csv(spark, self.path, schema, expose_dt=True, multiline=multiline)
        return scan_table(spark, self.path, schema)


def read_csv_files(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True
) -> DataFrame:
    return (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS)
        .option("multiLine", str(multiline).lower())
        .option("pathGlobFilter", "*.csv")
        .csv(path)
    )


@dataclass
class PublishReport:
    """What one run did to its table."""

    run_id: str
    status: str
    row_count: int = 0
    partitions: list[dict] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    cleared: list[str] = field(default_factory=list)
    rejected: list[dict] = field(default_factory=list)
    schema: T.StructType | None = field(default=None, repr=False)

    @property
    def partition_count(self) -> int:
        return len(self.partitions)

    @property
    def rejected_rows(self) -> int:
        return sum(r["row_count"] for r in self.rejected)


# --------------------------------------------------------------------------- writers


def _gathered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, in as many tasks as its size needs.

    Adaptive execution splits hash slots above the advisory size and joins small
    ones. With far more slots than partitions a slot rarely holds two of them,
    so splitting a hot partition does not cut its neighbours into small files.
    Where adaptive splitting is switched off the rows stay where they are: more
    files, but no task that has to write a hot partition alone.
    """
    conf = df.sparkSession.conf
    splits = (
        conf.get("spark.sql.adaptive.enabled"),
        conf.get("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled"),
    )
    return df.hint("rebalance", HASH_SLOTS, *keys) if splits == ("true", "true") else df


def _writer(df: DataFrame, fmt: str, mode: str = "overwrite"):
    writer = df.write.mode(mode).format(fmt)
    return writer.options(**CSV_OPTIONS) if fmt == "csv" else writer


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = (PARTITION_COLUMN,),
    fmt: str = "parquet",
    rebalance: bool = True,
) -> None:
    """One directory per key value, the key columns not stored in the files.

    The rebalance hint gathers each partition's rows, so a small partition is
    one file. Adaptive execution splits whatever exceeds the advisory size, so a
    partition with a third of all rows is written by many tasks.
    """
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    if not keys:
        raise ValueError("At least one partition column is required")
    spread = _gathered(df, keys) if rebalance else df
    _writer(spread, fmt).partitionBy(*keys).save(path)


def write_single_file(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One file per partition for partitions up to the advisory partition size.

    A larger partition becomes several files of about that size: one task could
    not hold it. Raise ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` for
    larger single files.
    """
    write_partitioned(df, path, (PARTITION_COLUMN,), fmt, rebalance=True)


def write_snapshot(
    df: DataFrame, path: str, fmt: str = "parquet", rebalance: bool = False
) -> None:
    """A whole table without partitions.

    Tasks write what they hold, without a shuffle. Turn ``rebalance`` on when a
    selective filter would leave many small files.
    """
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    _writer(df.hint("rebalance") if rebalance else df, fmt).save(path)


# ------------------------------------------------------------------- stage and measure


def _read_staged(
    spark: SparkSession,
    path: str,
    data: T.StructType,
    keys: Sequence[str],
    fmt: str,
    multiline: bool = True,
) -> DataFrame:
    fields = [f for f in data.fields if f.name not in keys]
    if fmt == "csv":
        fields = all_text(T.StructType(fields)).fields
    schema = T.StructType([*fields, *[T.StructField(k, T.StringType()) for k in keys]])
    if fmt == "csv":
        return read_csv_files(spark, path, schema, multiline)
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)


def _has_line_breaks(df: DataFrame) -> Column:
    """Whether any text of a row contains a line break (one CSV row, many lines)."""
    texts = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    found = [F.contains(t, F.lit(mark)) for t in texts for mark in ("\n", "\r")]
    return F.coalesce(*[F.when(f, True) for f in found], F.lit(False))


def materialize(
    df: DataFrame | str,
    staging: str,
    keys: Sequence[str] = (PARTITION_COLUMN,),
    fmt: str = "parquet",
    rebalance: bool = True,
) -> list[dict]:
    """Write a frame or a query to staging, measure what arrived, check nothing got lost.

    Rows are counted on their way into the files (after the last shuffle, so a
    retried task counts once) and again from the files; the two must agree, in all and,
    by a checksum over the keys of all rows, for each key. Returns one metrics dict per key combination.
    """
    if isinstance(df, str):
        df = SparkSession.active().sql(df)
    spark = df.sparkSession
    seen = Observation()
    spread = df
    if rebalance:
        spread = _gathered(df, keys) if keys else df.hint("rebalance")
    breaks = _has_line_breaks(df) if fmt == "csv" else F.lit(False)
    marks = F.sum(key_mark(keys) if keys else F.lit(0).cast("decimal(38,0)")).alias("marks")
    counted = spread.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(breaks).alias("breaks"), marks)
    writer = _writer(counted, fmt)
    (writer.partitionBy(*keys) if keys else writer).save(staging)
    # Without line breaks in any value CSV rows are lines: splittable, no parsing to count.
    multiline = seen.get["breaks"] is not False
    staged = _read_staged(spark, staging, df.schema, keys, fmt, multiline)
    found = partition_files(staged, keys)
    metrics = [row.asDict() for row in (found.withColumn("_mark", key_mark(keys)) if keys else found).collect()]
    arrived = sum(m["row_count"] or 0 for m in metrics)
    if arrived != seen.get["rows"]:
        raise ValidationError(f"Wrote {seen.get['rows']} rows to {staging} but found {arrived}")
    if keys and sum(int(m["_mark"]) * m["row_count"] for m in metrics) != int(seen.get["marks"] or 0):
        raise ValidationError(f"Rows written to {staging} lie under other keys than they were written for")
    return [{k: v for k, v in m.items() if k != "_mark"} for m in metrics]


# ----------------------------------------------------------------------------- publish


def _added_then_replaced(
    spark: SparkSession, pattern: str, keep: Callable[[str], bool], write: Callable[[], None]
) -> None:
    """Write new files beside the old ones, then delete the old ones.

    For stores where a rename is a copy: Spark writes each row straight into the table (give the store's own committer;
    the default one renames task output). A failed write leaves the old files and takes its own back. If the driver dies between
    the write and the deletion both are visible, until the next run, to which both are old.
    """
    old = {f for f in files.glob(spark, pattern) if keep(f)}
    try:
        write()
    except BaseException:
        files.delete_all(spark, {f for f in files.glob(spark, pattern) if keep(f)} - old)
        raise
    files.delete_all(spark, old)


def _copy_partitions(
    spark: SparkSession, staging: str, table: LakeTable, data: T.StructType, dates: Sequence[str]
) -> dict[str, dict]:
    """Publish by copying with Spark.

    Returns the metrics of the copied partitions, whose files differ from the staged ones.
    """
    base = f"{staging}/{OUTCOME}={OK}"
    staged = _read_staged(spark, base, data, (PARTITION_COLUMN,), table.fmt)
    columns = [f.name for f in data.fields if f.name not in (OUTCOME, PARTITION_COLUMN)]
    rows = keep_dates(staged, dates).select(*columns, PARTITION_COLUMN)
    wanted = {f"{PARTITION_COLUMN}={d}" for d in dates}
    _added_then_replaced(
        spark,
        f"{table.path}/{PARTITION_COLUMN}=*/*",
        lambda location: location.rsplit("/", 2)[1] in wanted,
        lambda: _writer(rows, table.fmt, "append").partitionBy(PARTITION_COLUMN).save(table.path),
    )
    plain = T.StructType([f for f in data.fields if f.name != OUTCOME])
    copied = _read_staged(spark, table.path, plain, (PARTITION_COLUMN,), table.fmt)
    metrics = partition_files(keep_dates(copied, dates)).collect()
    return {m[PARTITION_COLUMN]: m.asDict() for m in metrics}


def days_between(start: str, end: str) -> list[str]:
    """Inclusive list of days; an error when the end comes first."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    if last < first:
        raise ValueError(f"End date {end} is before start date {start}")
    return [(first + timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]


def outcome_of_checks(checks: dict[str, Column | str]) -> Column:
    """Name of the first check a row fails, ``ok`` when it passes all."""
    failed = [
        F.when(~F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(False)), F.lit(name))
        for name, c in checks.items()
    ]
    return F.coalesce(*failed, F.lit(OK))


def publish_partitions(
    df: DataFrame,
    table: LakeTable,
    *,
    run_id: str | None = None,
    mode: str = "overwrite",
    requested: Sequence[str] | None = None,
    on_invalid: str = "quarantine",
    checks: dict[str, Column | str] | None = None,
    fail_dates: str = "raise",
    rebalance: bool = True,
    copy: bool | None = None,
    expected: DataFrame | None = None,
    existing: Sequence[str] | None = None,
    stage_existing: bool = False,
) -> PublishReport:
    """Publish a frame with a ``dt`` column; exactly the produced dates are replaced.

    ``requested`` names the run's dates: those without rows are cleared, and rows of other
    dates are rejected as ``outside_range``. Filter the inputs to prune what is read; nothing is
    left out of the result uncounted. Rejected rows, those whose ``dt`` is NULL too, go to
    quarantine, are dropped, or raise; they are counted either way. ``checks`` are named row
    conditions: a date with a failing row is not published, and raises unless
    ``fail_dates="skip"``. ``rebalance=False`` saves the shuffle by date when the rows of a
    date already sit together. ``copy`` forces publishing by Spark copy instead of renames.

    ``skip_existing`` leaves complete dates out before anything is read, and ``fail_if_exists``
    looks for them before anything is written. Where ``requested`` does not name the dates,
    both look at the ``dt`` column alone first, unless ``existing`` names the frame's complete dates. If already the dates
    cost much, say ``stage_existing``: rows of complete dates are staged with the others, under an outcome of their
    own, and not published. A date that is recorded as complete but has no files is not complete.

    ``expected`` holds ``dt, row_count, file_count`` (and ``has_data``) of the dates as the caller knows them; staged
    dates that differ raise with all violations before anything is replaced.

    Everything is written once. Rejected rows share the staging write under
    their own ``_outcome`` directory, so no second pass over the input is needed
    to find or count them. A run that failed can be repeated under its ``run_id``.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"Invalid write mode: {mode}")
    if on_invalid not in INVALID_MODES:
        raise ValueError(f"Invalid on_invalid: {on_invalid}")
    if PARTITION_COLUMN not in df.columns:
        raise ValueError(f"A {PARTITION_COLUMN} column is required")
    spark = df.sparkSession
    report = PublishReport(run_id or new_run_id(), "success", schema=df.schema)
    staging = table.staging(report.run_id)
    cleanup(spark, table, report.run_id)  # what a run with this id has left behind
    dt = F.col(PARTITION_COLUMN)
    frame = df.withColumn(PARTITION_COLUMN, dt.cast("string"))
    asked = None if requested is None else sorted(set(requested))

    done: list[str] = []
    late = stage_existing and asked is None and mode != "overwrite"
    if mode != "overwrite":
        done = complete_dates(spark, table)
        if asked is not None:
            report.skipped = sorted(set(asked) & set(done))
        elif existing is not None:
            report.skipped = sorted(set(existing) & set(done))
        elif done and not late:
            report.skipped = sorted(r[0] for r in keep_dates(frame.select(PARTITION_COLUMN), done).distinct().collect())
        if mode == "fail_if_exists" and report.skipped:
            raise PartitionExistsError(report.skipped)
        if not late:
            frame = exclude_dates(frame, report.skipped if asked is not None else done)

    outcome = F.when(dt.isNull(), F.lit(INVALID_KEY))
    if late and done:
        outcome = outcome.when(dt.isin(done), F.lit(EXISTING))
    if asked is not None:
        outcome = outcome.when(~dt.isin(asked), F.lit(OUTSIDE_RANGE))
    frame = frame.withColumn(OUTCOME, outcome.otherwise(outcome_of_checks(checks or {})))

    try:
        metrics = materialize(frame, staging, (OUTCOME, PARTITION_COLUMN), table.fmt, rebalance)
        if late:
            report.skipped = sorted(m[PARTITION_COLUMN] for m in metrics if m[OUTCOME] == EXISTING)
            if mode == "fail_if_exists" and report.skipped:
                raise PartitionExistsError(report.skipped)
        good = {m[PARTITION_COLUMN]: m for m in metrics if m[OUTCOME] == OK}
        bad = [m for m in metrics if m[OUTCOME] not in (OK, EXISTING)]
        if expected is not None:
            raise_on_violations(validate_metrics(expected, _measured(spark, list(good.values()))))
        report.rejected = sorted(
            (
                {"outcome": m[OUTCOME], "dt": m[PARTITION_COLUMN], "row_count": m["row_count"]}
                for m in bad
            ),
            key=lambda r: (r["dt"] or "", r["outcome"]),
        )
        unusable = [m for m in bad if m[OUTCOME] in (INVALID_KEY, OUTSIDE_RANGE)]
        if on_invalid == "raise" and unusable:
            rows = sum(m["row_count"] for m in unusable)
            raise ValidationError(f"{rows} rows without a valid partition key")
        failed_dates = {m[PARTITION_COLUMN] for m in bad if m not in unusable}
        if failed_dates and fail_dates == "raise":
            raise RowChecksError(sorted(failed_dates))
        dates = sorted(set(good) - failed_dates)
        if copy is None:
            copy = not files.file_system_handles_renames(spark, table.path)
        if on_invalid == "quarantine":
            _keep_rejected(spark, table, staging, report.run_id, bad, frame.schema if copy else None)
        if dates and copy:
            copied = _copy_partitions(spark, staging, table, frame.schema, dates)
            # Files may be cut otherwise, rows may not.
            staged = [good[d] | {"file_count": copied.get(d, {}).get("file_count", 0)} for d in dates]
            raise_on_violations(validate_metrics(_measured(spark, staged), _measured(spark, list(copied.values()))))
            good |= copied
            _record(spark, table, report, good, dates)
        elif dates:
            base = f"{staging}/{OUTCOME}={OK}"
            moves = [(f"{base}/{PARTITION_COLUMN}={d}", table.partition_path(d)) for d in dates]
            moved: list[str] = []
            try:
                files.replace_dirs(spark, moves, f"{staging}_replaced", moved.append)
            finally:
                # Also when a move fails: the manifest says what lies in the table.
                _record(spark, table, report, good, [d for d in dates if table.partition_path(d) in moved])
        if asked is not None:
            untouched = set(dates) | failed_dates | set(report.skipped)
            report.cleared = clear_partitions(
                spark, table, sorted(set(asked) - untouched), report.run_id
            )
        if not report.partitions and not report.cleared:
            report.status = "skipped"
        return report
    finally:
        cleanup(spark, table, report.run_id)


def _measured(spark: SparkSession, metrics: Sequence[dict]) -> DataFrame:
    """Metrics as a frame, one row for each date."""
    rows = [(m[PARTITION_COLUMN], m["row_count"], m["file_count"]) for m in metrics]
    return spark.createDataFrame(rows, f"{PARTITION_COLUMN} string, row_count long, file_count long")


def complete_dates(spark: SparkSession, table: LakeTable) -> list[str]:
    """Dates recorded as complete whose files are there."""
    recorded = [r[0] for r in table.completed(spark).collect()]
    return dates_with_files(spark, table.path, table.fmt, recorded) if recorded else []


def reconcile(spark: SparkSession, table: LakeTable) -> DataFrame:
    """The manifest against one listing of the table: ``dt, state, recorded_files, found_files``, a row for each date.

    state is ``ok``, ``files_missing`` (recorded, nothing there), ``unrecorded`` (there, never recorded or cleared since) or
    ``file_count_differs``. Spark lists the files; none is opened. The seed partition is no date.
    """
    marker = f"/{PARTITION_COLUMN}="
    if files.glob(spark, f"{table.path}{marker}*/*.{table.fmt}"):
        listed = peek.data_files(spark, [table.path], table.fmt)
    else:
        listed = spark.createDataFrame([], "path string")
    dated = listed.select(partition_of(F.col("path")).alias(PARTITION_COLUMN)).where(F.col(PARTITION_COLUMN) != SEED_PARTITION)
    found = dated.groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("found_files"))
    latest = log.latest_manifest(table.manifest(spark)).where(F.col("status") == log.SUCCESS)
    known = latest.select(F.col("partition_date").alias(PARTITION_COLUMN), F.col("file_count").alias("recorded_files"))
    state = (
        F.when(F.col("found_files").isNull(), "files_missing")
        .when(F.col("recorded_files").isNull(), "unrecorded")
        .when(F.col("recorded_files") != F.col("found_files"), "file_count_differs")
        .otherwise("ok")
    )
    return known.join(found, PARTITION_COLUMN, "full_outer").select(PARTITION_COLUMN, state.alias("state"), "recorded_files", "found_files")


def _record(
    spark: SparkSession, table: LakeTable, report: PublishReport, metrics: dict[str, dict], dates: Sequence[str]
) -> None:
    """Note published dates in the report and the manifest."""
    source = f"{table.staging(report.run_id)}/{OUTCOME}={OK}"
    measured = ("row_count", "file_count", "byte_count")
    report.partitions = [{"dt": d, **{k: metrics[d][k] for k in measured}} for d in dates]
    report.row_count = sum(p["row_count"] for p in report.partitions)
    rows = [
        (
            table.dest,
            p["dt"],
            report.run_id,
            p["file_count"],
            p["row_count"],
            log.SUCCESS,
            f"{source}/{PARTITION_COLUMN}={p['dt']}",
            table.partition_path(p["dt"]),
        )
        for p in report.partitions
    ]
    log.append_manifest(spark, table.manifest_path, rows)


def _keep_rejected(
    spark: SparkSession,
    table: LakeTable,
    staging: str,
    run_id: str,
    bad: list[dict],
    data: T.StructType | None = None,
) -> None:
    """Put rejected rows below the quarantine path, by outcome and run; a repeated run replaces its own.

    With a schema they are copied by Spark, else their directories are renamed.
    """
    for outcome in sorted({m[OUTCOME] for m in bad}):
        target = f"{table.quarantine_path}/{OUTCOME}={outcome}/run={safe_run_id(run_id)}"
        source = f"{staging}/{OUTCOME}={outcome}"
        files.delete(spark, target)
        if data is None:
            files.move(spark, source, target)
        else:
            plain = T.StructType([f for f in data.fields if f.name != OUTCOME])
            rows = _read_staged(spark, source, plain, (PARTITION_COLUMN,), table.fmt)
            _writer(rows, table.fmt).partitionBy(PARTITION_COLUMN).save(target)


def read_quarantine(spark: SparkSession, table: LakeTable, schema: T.StructType) -> DataFrame:
    """Rejected rows with ``_outcome``, ``run`` and ``dt`` (NULL without a key)."""
    keys = (OUTCOME, "run", PARTITION_COLUMN)
    if not files.exists(spark, table.quarantine_path):
        fields = [f for f in schema.fields if f.name not in keys]
        fields += [T.StructField(k, T.StringType()) for k in keys]
        return spark.createDataFrame([], T.StructType(fields))
    return _read_staged(spark, table.quarantine_path, schema, keys, table.fmt)


def clear_partitions(
    spark: SparkSession, table: LakeTable, dates: Sequence[str], run_id: str | None = None
) -> list[str]:
    """Remove the data of these dates and their completion; returns those that had any."""
    for dt in dates:
        if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", dt):
            raise ValueError(f"Not a partition date: {dt}")
    present = set(files.partition_values(spark, table.path)) if dates else set()
    recorded = {r[0] for r in keep_dates(table.completed(spark), dates).collect()} if dates else set()
    gone = sorted(set(dates) & (present | recorded))
    run = run_id or new_run_id("clear")
    # The record goes first: a date that looks complete must have its rows.
    log.append_manifest(
        spark,
        table.manifest_path,
        [
            (table.dest, dt, run, 0, 0, log.CLEARED, "", table.partition_path(dt))
            for dt in gone
        ],
    )
    files.delete_all(spark, [table.partition_path(dt) for dt in gone if dt in present])
    return gone


def adopt_partitions(
    spark: SparkSession, table: LakeTable, schema: T.StructType, run_id: str | None = None
) -> list[str]:
    """Record partitions another tool completed (``_SUCCESS`` inside ``dt=...``).

    Afterwards ``skip_existing`` and ``fail_if_exists`` respect them. Partitions
    already in the manifest stay as they are.
    """
    marked = files.glob(spark, f"{table.path}/{PARTITION_COLUMN}=*/_SUCCESS")
    found = sorted(m.rsplit(f"/{PARTITION_COLUMN}=", 1)[1].split("/")[0] for m in marked)
    listed = spark.createDataFrame([(dt,) for dt in found], f"{PARTITION_COLUMN} string")
    fresh = sorted(r[0] for r in exclude_dates(listed, table.completed(spark)).collect())
    rows = keep_dates(table.read(spark, schema, multiline=True), fresh)
    run = run_id or new_run_id("adopt")
    log.append_manifest(
        spark,
        table.manifest_path,
        [
            (
                table.dest,
                m[PARTITION_COLUMN],
                run,
                m["file_count"],
                m["row_count"],
                log.SUCCESS,
                "",
                table.partition_path(m[PARTITION_COLUMN]),
            )
            for m in partition_files(rows).collect()
        ],
    )
    return fresh


def publish_no_data(
    spark: SparkSession, table: LakeTable, requested: Sequence[str], run_id: str | None = None
) -> PublishReport:
    """A run whose source had nothing: it succeeds and clears the requested dates."""
    report = PublishReport(run_id or new_run_id(), "success")
    report.cleared = clear_partitions(spark, table, requested, report.run_id)
    return report


def publish_snapshot(
    df: DataFrame,
    table: LakeTable,
    *,
    run_id: str | None = None,
    run_date: str | None = None,
    rebalance: bool = False,
    copy: bool | None = None,
) -> PublishReport:
    """Replace a table without partitions; no rows means the table is emptied."""
    spark = df.sparkSession
    report = PublishReport(run_id or new_run_id(), "success", schema=df.schema)
    staging = table.staging(report.run_id)
    try:
        metrics = materialize(df, staging, (), table.fmt, rebalance)
        total = metrics[0] if metrics else {}
        report.row_count = int(total.get("row_count") or 0)
        if report.row_count == 0:
            # The record goes first: a snapshot that looks complete must have its rows.
            recorded = [r[0] for r in table.completed(spark).collect()]
            log.append_manifest(
                spark,
                table.manifest_path,
                [(table.dest, dt, report.run_id, 0, 0, log.CLEARED, "", table.path) for dt in recorded],
            )
            report.cleared = sorted(recorded)
            files.delete(spark, table.path)
            report.status = "cleared"
            return report
        if copy is None:
            copy = not files.file_system_handles_renames(spark, table.path)
        if copy:
            schema = all_text(df.schema) if table.fmt == "csv" else df.schema
            staged = scan_snapshot(spark, staging, table.fmt, schema, multiline=True)
            _added_then_replaced(
                spark, f"{table.path}/*", lambda _: True, lambda: _writer(staged, table.fmt, "append").save(table.path)
            )
        else:
            files.replace_dirs(spark, [(staging, table.path)], f"{staging}_replaced")
        dt = run_date or ""
        report.partitions = [
            {"dt": dt, "row_count": report.row_count, "file_count": total["file_count"]}
        ]
        log.append_manifest(
            spark,
            table.manifest_path,
            [
                (
                    table.dest,
                    dt,
                    report.run_id,
                    total["file_count"],
                    report.row_count,
                    log.SUCCESS,
                    staging,
                    table.path,
                )
            ],
        )
        return report
    finally:
        cleanup(spark, table, report.run_id)


def cleanup(spark: SparkSession, table: LakeTable, run_id: str) -> None:
    """Remove a run's staging directories; safe to call at any time.

    Data that had stepped aside for the run and was not replaced returns to its place.
    """
    staging = table.staging(run_id)
    aside = f"{staging}_replaced"
    partitions = any("=" in name.rsplit("/", 1)[1] for name in files.glob(spark, f"{aside}/*"))
    files.put_back(spark, table.path if partitions else table.path.rsplit("/", 1)[0], aside)
    files.delete(spark, staging)
