"""Typing, naming and row filters that bring a frame into its declared form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.dates import coerce_date, normalize_dt, parse_date
from lakeops.sources.schemas import PARTITION_COLUMN

#: Texts that stand for "no value" in a partition key (fixed values).
EMPTY_KEYS = ("", "None", "nan", "NaT")


def conform(
    df: DataFrame,
    schema: T.StructType,
    *,
    strict: bool = True,
    date_formats: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Cast to the declared types, in declared order; absent columns get their default.

    ``strict`` casts raise on bad text (ANSI mode, Spark's default), lenient ones
    give NULL. ``date_formats`` names the pattern of text dates per column.
    ``keep`` lists columns to pass through behind the declared ones.
    """
    formats = date_formats or {}
    present = set(df.columns)
    columns = []
    for field in schema.fields:
        if field.name not in present:
            default = F.lit((field.metadata or {}).get("default")).cast(field.dataType)
            columns.append(default.alias(field.name))
            continue
        value = F.col(f"`{field.name}`")
        if field.name in formats and isinstance(field.dataType, T.DateType):
            typed = parse_date(value.cast("string"), formats[field.name], strict)
        else:
            typed = value.cast(field.dataType) if strict else value.try_cast(field.dataType)
        columns.append(typed.alias(field.name))
    return df.select(*columns, *[F.col(f"`{c}`") for c in keep if c in present])


def rejected_by_conform(
    df: DataFrame, schema: T.StructType, date_formats: Mapping[str, str] | None = None
) -> Column:
    """Name of the first column whose value a lenient cast would lose, else NULL."""
    formats = date_formats or {}
    present = set(df.columns)
    tests = []
    for field in schema.fields:
        if field.name not in present:
            continue
        value = F.col(f"`{field.name}`")
        if field.name in formats and isinstance(field.dataType, T.DateType):
            typed = parse_date(value.cast("string"), formats[field.name])
        else:
            typed = value.try_cast(field.dataType)
        tests.append(F.when(value.isNotNull() & typed.isNull(), F.lit(field.name)))
    return F.coalesce(*tests, F.lit(None).cast("string"))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Source names to canonical names; names not present are ignored."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def project_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in columns if c in present])


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, or an error naming the columns it lacks."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"Missing expected columns: {', '.join(lacking)}")
    return df


def filter_date_range(
    df: DataFrame, column: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Rows within the inclusive bounds; values that are no date fail any bound.

    On DATE and TIMESTAMP columns the bounds reach the Parquet scan.
    """
    dtype = df.schema[column].dataType
    bound_type = (
        dtype.simpleString() if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else "date"
    )
    day = coerce_date(df, column)
    if start:
        df = df.where(day >= F.lit(start).cast(bound_type))
    if end:
        df = df.where(day <= F.lit(end).cast(bound_type))
    return df


def stamp(df: DataFrame, **values: object) -> DataFrame:
    """Add constant columns (flags, run dates)."""
    return df.withColumns(
        {name: v if isinstance(v, Column) else F.lit(v) for name, v in values.items()}
    )


def stamp_if_missing(df: DataFrame, column: str, value: object) -> DataFrame:
    return df if column in df.columns else stamp(df, **{column: value})


def drop_internal(df: DataFrame) -> DataFrame:
    """Drop the bookkeeping columns (leading underscore)."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def enabled_only(df: DataFrame, flag: str = "enabled") -> DataFrame:
    return df.where(F.col(flag) == 1)


def only_partition(df: DataFrame, dt: str | date, column: str = PARTITION_COLUMN) -> DataFrame:
    return df.where(F.col(column) == str(dt))


def keep_dates(
    df: DataFrame, dates: Sequence[str] | DataFrame, column: str = PARTITION_COLUMN
) -> DataFrame:
    """Rows of the given dates.

    A list known to the driver (at most one entry per partition, which the driver
    knows anyhow) becomes a set filter, which prunes partitions without a join. A
    frame is semi-joined on its key, with the join strategy left to Spark's own
    size statistics. The kind of the argument decides, never its length.
    """
    if isinstance(dates, DataFrame):
        return df.join(dates.select(column), column, "left_semi")
    return df.where(F.col(column).isin(sorted(set(dates))))


def exclude_dates(
    df: DataFrame, dates: Sequence[str] | DataFrame, column: str = PARTITION_COLUMN
) -> DataFrame:
    """Rows of all other dates; rows without a date stay."""
    if isinstance(dates, DataFrame):
        return df.join(dates.select(column), column, "left_anti")
    unwanted = sorted(set(dates))
    if not unwanted:
        return df
    return df.where(F.col(column).isNull() | ~F.col(column).isin(unwanted))


def key_problem(df: DataFrame, column: str) -> Column:
    """Why a partition key cannot be used: ``missing``, ``invalid`` or NULL (fine)."""
    text = F.trim(F.col(f"`{column}`").cast("string"))
    return F.when(text.isNull() | text.isin(*EMPTY_KEYS), F.lit("missing")).when(
        normalize_dt(df, column).isNull(), F.lit("invalid")
    )


def split_valid_partition(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a usable key and its ``dt``, the others with a ``reason``)."""
    valid = df.withColumn(PARTITION_COLUMN, normalize_dt(df, column)).where(
        F.col(PARTITION_COLUMN).isNotNull()
    )
    bad = df.withColumn("reason", key_problem(df, column)).where(F.col("reason").isNotNull())
    return valid, bad


def assign_partition(
    df: DataFrame, partition_column: str | None, run_date: str | None
) -> tuple[DataFrame, bool]:
    """Add ``dt``: from the data when the column exists, else the run date.

    Returns the frame and whether the data decided.
    """
    if partition_column and partition_column in df.columns:
        if partition_column != PARTITION_COLUMN and PARTITION_COLUMN in df.columns:
            raise ValueError(f"Column {PARTITION_COLUMN} is reserved for the partition key")
        return df.withColumn(PARTITION_COLUMN, normalize_dt(df, partition_column)), True
    if not run_date:
        raise ValueError("A run date is required when no partition column is present")
    return df.withColumn(PARTITION_COLUMN, F.lit(run_date)), False


__all__ = [
    "assign_partition",
    "conform",
    "drop_internal",
    "enabled_only",
    "exclude_dates",
    "filter_date_range",
    "keep_dates",
    "key_problem",
    "only_partition",
    "project_existing",
    "rejected_by_conform",
    "rename",
    "require_columns",
    "split_valid_partition",
    "stamp",
    "stamp_if_missing",
]
