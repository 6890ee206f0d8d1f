"""Counts per partition and the checks made on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.sources.schemas import PARTITION_COLUMN

METRIC_COLUMNS = ("dt", "row_count", "file_count", "byte_count", "has_data")


class ValidationError(ValueError):
    """Staged output does not match what was expected of it; ``violations`` holds all that was found, if it was compared by date."""

    def __init__(self, message: str, violations: Sequence[dict] = ()):
        self.violations = list(violations)
        super().__init__(message)


def partition_counts(df: DataFrame, column: str = PARTITION_COLUMN) -> DataFrame:
    """Rows per partition value, rows without one left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("row_count"))


def row_count(df: DataFrame, dt: str | None = None) -> DataFrame:
    """One row: the number of rows, of one partition if given."""
    frame = df if dt is None else df.where(F.col(PARTITION_COLUMN) == dt)
    return frame.agg(F.count(F.lit(1)).alias("row_count"))


def total_rows(metrics: DataFrame) -> DataFrame:
    """Sum of per-partition (or per-unit) row counts; 0 when there are none."""
    return metrics.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("partition_count"),
    )


def partition_files(df: DataFrame, keys: Sequence[str] = (PARTITION_COLUMN,)) -> DataFrame:
    """Rows, files and bytes per partition of a file-backed frame.

    Two levels: per file first, so each task ships one row per file it read and
    no distinct count is needed. For Parquet only footers are read.
    """
    per_file = (
        df.select(
            *keys,
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_size").alias("_size"),
        )
        .groupBy(*keys, "_file")
        .agg(F.count(F.lit(1)).alias("_rows"), F.max("_size").alias("_size"))
    )
    return per_file.groupBy(*keys).agg(
        F.sum("_rows").alias("row_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.sum("_size").alias("byte_count"),
    )


def key_totals(df: DataFrame, key: str) -> DataFrame:
    """One row: number of distinct key values and of rows carrying one.

    Counts per key first (combined map-side), then sums, so a frequent key does
    not gather its rows anywhere.
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
    )


def validate_metrics(
    expected: DataFrame, actual: DataFrame, column: str = PARTITION_COLUMN
) -> DataFrame:
    """Violations between expected and staged metrics, matched per partition.

    Both sides hold ``dt, row_count, file_count``; ``expected.has_data`` (default
    1) says whether output was due at all. One row per violation: dt, problem,
    expected, actual.
    """
    has_data = F.col("has_data") if "has_data" in expected.columns else F.lit(1)
    due = expected.select(
        column,
        has_data.cast("int").alias("due"),
        F.col("row_count").alias("e_rows"),
        F.col("file_count").alias("e_files"),
    )
    found = actual.select(
        column, F.col("row_count").alias("a_rows"), F.col("file_count").alias("a_files")
    )
    both = due.join(found, column, "full_outer").select(
        column,
        F.coalesce("due", F.lit(0)).alias("due"),
        F.coalesce("e_rows", F.lit(0)).alias("e_rows"),
        F.coalesce("e_files", F.lit(0)).alias("e_files"),
        F.coalesce("a_rows", F.lit(0)).alias("a_rows"),
        F.coalesce("a_files", F.lit(0)).alias("a_files"),
    )
    problem = (
        F.when((F.col("due") == 0) & (F.col("a_files") > 0), "unexpected_files")
        .when(F.col("due") == 0, None)
        .when(F.col("e_rows") < 0, "negative_row_count")
        .when(F.col("a_files") == 0, "no_files")
        .when(F.col("a_files") != F.col("e_files"), "file_count_mismatch")
        .when(F.col("a_rows") != F.col("e_rows"), "row_count_mismatch")
    )
    about_files = F.col("problem").isin("unexpected_files", "no_files", "file_count_mismatch")
    return (
        both.withColumn("problem", problem)
        .where(F.col("problem").isNotNull())
        .select(
            column,
            "problem",
            F.when(about_files, F.col("e_files")).otherwise(F.col("e_rows")).alias("expected"),
            F.when(about_files, F.col("a_files")).otherwise(F.col("a_rows")).alias("actual"),
        )
    )


def raise_on_violations(violations: DataFrame, shown: int = 20) -> None:
    """Raise when the frame has rows: all of them go with the error, the first few into its message.

    There is at most one row for each date.
    """
    rows = [r.asDict() for r in violations.orderBy(*violations.columns[:2]).collect()]
    if rows:
        column = violations.columns[0]
        listed = "; ".join(f"{r[column]}: {r['problem']} (expected {r['expected']}, found {r['actual']})" for r in rows[:shown])
        more = f" and {len(rows) - shown} more" if len(rows) > shown else ""
        raise ValidationError(f"Output failed validation: {listed}{more}", rows)


def key_mark(keys: Sequence[str]) -> Column:
    """A number for a row's keys. Its sum over all rows changes if a row moves from one key to another.

    An empty text counts as NULL, which is what becomes of it in a directory name.
    """
    parts = [F.nullif(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.xxhash64(*parts).cast("decimal(38,0)")


def backfill_summary(outcomes: DataFrame) -> DataFrame:
    """Totals over per-date outcomes ``dt, status, error_type, error``.

    status is ``success``, ``failed`` or ``skipped``. The failed list holds at
    most one entry per date, so it is bounded by the length of the range.
    """
    # Names of the columns and statuses are fixed values.
    status = F.col("status")
    failed = F.struct(
        F.col("dt").alias("date"), F.col("error"), F.col("error_type")
    )
    return outcomes.agg(
        F.count(F.lit(1)).alias("total_dates"),
        F.count_if(status == "success").alias("successful_count"),
        F.count_if(status == "failed").alias("failed_count"),
        F.count_if(status == "skipped").alias("skipped_count"),
        F.min(F.when(status == "success", F.col("dt"))).alias("first_success"),
        F.max(F.when(status == "success", F.col("dt"))).alias("last_success"),
        F.sort_array(F.collect_list(F.when(status == "failed", failed))).alias("failed_dates"),
    )
