"""Table and file scans."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.text import ingest_order, partition_of
from lakeops.sources import files, peek
from lakeops.sources.drift import scan_groups
from lakeops.sources.schemas import (
    PARTITION_COLUMN,
    SEED_PARTITION,
    all_text,
    empty_table,
    with_partition,
)

#: CSV dialect shared by reader and writer: quotes double inside quoted text,
#: blanks at the ends of a value belong to the value.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

#: Bytes read from the head of a file to find its header line; doubled until the line ends.
HEAD_BYTES = 65_536


def _partition_paths(spark: SparkSession, base: str, dates: Iterable[str]) -> list[str]:
    """Directories of the wanted dates that exist, so no other one is listed."""
    present = set(files.partition_values(spark, base, PARTITION_COLUMN))
    return [f"{base}/{PARTITION_COLUMN}={dt}" for dt in sorted(set(dates) & present)]


def _heads(size: int):
    def look(store, path: str) -> str:
        """The file's first record: up to a line break outside quotes."""
        wanted, text = size, b""
        while True:
            with store.open_input_stream(path) as stream:
                text = stream.read(wanted)
            quoted = False
            for place, byte in enumerate(text):
                if byte == 34:
                    quoted = not quoted
                elif byte in (10, 13) and not quoted:
                    return text[:place].decode("utf-8-sig")
            if len(text) < wanted:
                return text.decode("utf-8-sig")
            wanted *= 2

    return look


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, seen``: the first line of each file, found by Spark's text reader in the files' first blocks."""
    lines = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").text(list(paths))
    place = F.monotonically_increasing_id().alias("place")
    starts = lines.where(F.col("_metadata.file_block_start") == 0).select(F.col("_metadata.file_path").alias("path"), "value", place)
    return starts.groupBy("path").agg(F.min_by("value", "place").alias("seen"))


def files_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """CSV files below the directories, grouped by their own header; one job, whatever their number.

    The driver holds file names, as it does for any scan, and one line for each kind of header. Empty files have no header and
    no rows.
    """
    if not paths:
        return {}
    if peek.opened_by_tasks(paths):
        seen = peek.seen_in_files(peek.data_files(spark, paths, "csv"), _heads(HEAD_BYTES))
    else:
        seen = _first_lines(spark, paths)
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in seen.where(F.trim("seen") != "").toLocalIterator():
        (header,) = csv.reader(io.StringIO(row["seen"]))
        groups.setdefault(tuple(header), []).append(row["path"])
    return {header: sorted(found) for header, found in sorted(groups.items())}


def scan_raw_csv(
    spark: SparkSession,
    base: str,
    columns: T.StructType | list[str],
    dates: Sequence[str] | None = None,
    *,
    expose_dt: bool = False,
    multiline: bool = False,
    view: str | None = None,
) -> DataFrame:
    """Header CSV files of one, many or all ``dt`` directories, all columns as text.

    Columns are found by their header names, whatever their order; absent ones are NULL. Each
    file is read by its own header, so a source may gain, lose or reorder columns from one file
    to the next. One small job looks at the files' first lines, whatever the number of dates.
    Types are never inferred; ``conform`` casts later. Empty values read as NULL.

    Say ``multiline=True`` for a source whose values hold line breaks: Spark then
    reads each file in one task, so such files should be of bounded size. Otherwise
    files are split. Data are read once, by the job that uses the frame.
    """
    wanted = all_text(columns)
    known = files.partition_values(spark, base, PARTITION_COLUMN) if dates is None else dates
    groups = files_by_header(spark, _partition_paths(spark, base, known))
    none = F.lit(None).cast("string")
    frames = []
    for header, paths in groups.items():
        rows = (
            spark.read.schema(with_partition(all_text(list(header))))
            .options(**CSV_OPTIONS)
            .option("multiLine", str(multiline).lower())
            .option("enforceSchema", "false")
            .option("basePath", base)
            .csv(paths)
        )
        found = [
            F.col(f"`{name}`") if name in header else none.alias(name)
            for name in wanted.fieldNames()
            if name != PARTITION_COLUMN
        ]
        frames.append(rows.select(*found, PARTITION_COLUMN))
    frame = reduce(DataFrame.unionByName, frames) if frames else empty_table(spark, with_partition(wanted))
    if not expose_dt:
        frame = frame.drop(PARTITION_COLUMN)
    if view:
        frame.createOrReplaceTempView(view)
    return frame


def scan_parts(
    spark: SparkSession, *paths: str, schema: T.StructType | None = None, mixed_types: bool = False, strict: bool = True
) -> DataFrame:
    """Parquet part files plus their place in the landing order.

    ``_ingest_order`` comes from the file name, ``_ingest_file`` and
    ``_row_index`` make the order total. Columns are matched by name, so parts
    written by different versions stack with NULLs. Parts that store a column in different
    types are read by their own and cast to the declared or else the common type; a declared
    schema is taken at its word, without a look at the footers, unless ``mixed_types`` is said.
    """
    if schema is not None and not mixed_types:
        rows = spark.read.option("pathGlobFilter", "*.parquet").schema(schema).parquet(*paths)
        return rows.select(
            "*",
            ingest_order(F.col("_metadata.file_path")).alias("_ingest_order"),
            F.col("_metadata.file_path").alias("_ingest_file"),
            F.col("_metadata.row_index").alias("_row_index"),
        )
    places = {"_ingest_file": "_metadata.file_path", "_row_index": "_metadata.row_index"}
    found = scan_groups(spark, paths, schema, strict=strict, metadata=places)
    if found is None:
        raise ValueError(f"No Parquet file below {', '.join(paths)}")
    data = [F.col(f"`{c}`") for c in found.columns if c not in places]
    return found.select(*data, ingest_order(F.col("_ingest_file")).alias("_ingest_order"), *places)


def _text_partition(
    spark: SparkSession, path: str, schema: T.StructType | None, merge: bool = True
) -> T.StructType:
    """The schema to read with: ``dt`` as text whatever its values look like."""
    if schema is None:
        reader = spark.read.option("pathGlobFilter", "*.parquet")
        schema = reader.option("mergeSchema", str(merge).lower()).parquet(path).schema
    return with_partition(schema)


def scan_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, *, mixed_types: bool = False, strict: bool = True
) -> DataFrame:
    """A ``dt``-partitioned Parquet table, columns matched by name, seed dropped.

    Give the declared ``schema`` for large tables: without it one job reads the footers of all files.

    Files that store a column in different types are read by their own types and cast to the declared or else the common one
    (wider numbers, text where there is no other). A declared schema is taken at its word, without a look at the footers, unless
    ``mixed_types`` is said. Filters on ``dt`` prune files either way. ``strict`` casts raise on what does not fit.
    """
    if schema is not None and not mixed_types:
        rows = spark.read.schema(with_partition(schema)).option("pathGlobFilter", "*.parquet").parquet(path)
    else:
        rows = scan_groups(spark, [path], schema, base=path, strict=strict)
        if rows is None:
            return empty_table(spark, with_partition(schema or T.StructType([])))
    return rows.where(F.col(PARTITION_COLUMN) != SEED_PARTITION)


def scan_table_nested(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    dates: Sequence[str] | None = None,
) -> DataFrame:
    """A table that may hold ``dt=X/dt=X/*.parquet``; ``dt`` comes from the path.

    Pass ``dates`` to read only those directories: a value taken from the file
    path cannot prune partitions by itself.
    """
    data = T.StructType([f for f in schema.fields if f.name != PARTITION_COLUMN])
    reader = (
        spark.read.schema(data)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    if dates is None:
        frame = reader.parquet(path)
    else:
        paths = _partition_paths(spark, path, dates)
        if not paths:
            return empty_table(spark, with_partition(data))
        frame = reader.parquet(*paths)
    dt = partition_of(F.col("_metadata.file_path"))
    return frame.select("*", dt.alias(PARTITION_COLUMN)).where(
        F.col(PARTITION_COLUMN) != SEED_PARTITION
    )


def scan_snapshot(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """A table without partitions, as Parquet or header CSV (read as text).

    Spark splits CSV files. Say ``multiline=True`` where values hold line breaks: each file is then read by one task.

    CSV files whose header does not fit the others, or the schema, fail the scan.
    """
    if fmt not in {"parquet", "csv"}:
        raise ValueError(f"Unsupported format: {fmt}")
    reader = spark.read.option("pathGlobFilter", f"*.{fmt}")
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return _checked_csv(reader, path, multiline)
    return reader.parquet(path)


def _checked_csv(reader: DataFrameReader, path: str, multiline: bool) -> DataFrame:
    """CSV with every file's header compared."""
    options = {**CSV_OPTIONS, "multiLine": str(multiline).lower(), "enforceSchema": "false"}
    return reader.options(**options).csv(path)


def scan_partition(
    spark: SparkSession, path: str, dt: str, schema: T.StructType | None = None
) -> DataFrame:
    """Exactly one partition; only its own directory is listed."""
    location = f"{path}/{PARTITION_COLUMN}={dt}"
    if not files.exists(spark, location):
        known = with_partition(schema) if schema else _text_partition(spark, path, None, merge=False)
        return empty_table(spark, known)
    found = schema
    if found is None:
        found = (
            spark.read.option("pathGlobFilter", "*.parquet")
            .option("basePath", path)
            .parquet(location)
            .schema
        )
    return (
        spark.read.schema(with_partition(found))
        .option("pathGlobFilter", "*.parquet")
        .option("basePath", path)
        .parquet(location)
    )


def dates_with_files(
    spark: SparkSession, base: str, fmt: str = "csv", dates: Iterable[str] | None = None
) -> list[str]:
    """Dates (all, or those asked for) whose directory holds a file of the format."""
    known = files.partition_values(spark, base, PARTITION_COLUMN) if dates is None else dates
    marker = f"/{PARTITION_COLUMN}="
    listed = files.glob(spark, f"{base}/{PARTITION_COLUMN}=*/*.{fmt}")
    return sorted(set(known) & {location.rsplit(marker, 1)[1].split("/")[0] for location in listed})


def missing_dates(df: DataFrame, requested: DataFrame, column: str = PARTITION_COLUMN) -> DataFrame:
    """Requested dates for which ``df`` holds no row.

    The presence test aggregates before its shuffle, so what moves is one row
    per date and task, however many rows a date has.
    """
    present = df.select(column).where(F.col(column).isNotNull()).distinct()
    return requested.select(column).distinct().join(present, column, "left_anti")


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def scan_reference_list(
    spark: SparkSession,
    path: str,
    run_date: str,
    date_column: str = "trade_date",
    multiline: bool = False,
) -> DataFrame:
    """A CSV list read as text, stamped with the run date unless it carries one.

    Say ``multiline=True`` where values hold line breaks.
    """
    frame = _checked_csv(spark.read, path, multiline)
    if date_column in frame.columns:
        return frame
    return frame.withColumn(date_column, F.lit(run_date))


#: A custom input: gives the rows for the wanted dates, or None without any.
InputHook = Callable[[SparkSession, Sequence[str]], "DataFrame | None"]


def register_inputs(
    spark: SparkSession, inputs: dict[str, InputHook], dates: Sequence[str]
) -> bool:
    """Create one temp view per input; False as soon as one has no data.

    A hook with ``present(spark, dates)`` names the dates it has data for. All inputs are limited to the dates
    that every such hook has, so a date for which one of them is missing is a date without data.
    """
    common = list(dates)
    for hook in inputs.values():
        if dates and hasattr(hook, "present"):
            common = hook.present(spark, common)
            if not common:
                return False
    for view, hook in inputs.items():
        frame = hook(spark, common)
        if frame is None:
            return False
        frame.createOrReplaceTempView(view)
    return True


def raw_csv_input(base: str, columns: T.StructType | list[str], *, multiline: bool = False) -> InputHook:
    """Input hook over dated CSV directories; ``dt`` stays visible for date ranges."""

    def present(spark: SparkSession, dates: Sequence[str]) -> list[str]:
        return dates_with_files(spark, base, "csv", dates)

    def hook(spark: SparkSession, dates: Sequence[str]) -> DataFrame | None:
        days = present(spark, dates)
        return scan_raw_csv(spark, base, columns, days, expose_dt=True, multiline=multiline) if days else None

    hook.present = present
    return hook
