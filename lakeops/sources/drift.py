"""Parquet files of one table whose columns differ in type from file to file.

Spark reads all files of a scan with one schema and fails where a file stores another type. Here files with equal footers
form a group; each group is read by its own schema, cast to the common one, and stacked by name. The number of scans is
the number of different footers, whatever the number of files.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.sources import peek
from lakeops.sources.schemas import PARTITION_COLUMN

#: Merges tried at a time where files are compared by merging their schemas.
AT_ONCE = 8

Groups = list[tuple[T.StructType, list[str]]]


def _footers():
    def look(store, path: str) -> str:
        import pyarrow.parquet as pq

        schema = pq.read_metadata(path, filesystem=store).schema
        columns = [schema.column(i) for i in range(len(schema.names))]
        return "\n".join(sorted(f"{c.path} {c.physical_type} {c.logical_type} {c.converted_type}" for c in columns))

    return look


def _merged(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The one schema of the files, read by a Spark job; None where their types differ."""
    try:
        return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_" in str(error):
            return None
        raise


def _by_footer(spark: SparkSession, listing: DataFrame) -> Groups:
    groups: dict[str, list[str]] = {}
    for row in peek.seen_in_files(listing, _footers()).toLocalIterator():
        groups.setdefault(row["seen"], []).append(row["path"])
    # files with equal footers: one of them names Spark's types
    return [(spark.read.parquet(min(paths)).schema, sorted(paths)) for _, paths in sorted(groups.items())]


def _by_merging(spark: SparkSession, paths: list[str]) -> Groups:
    """Halve the files until the schemas of each part merge, then join the parts that agree."""
    parts, pending = [], [sorted(paths)]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        while pending:
            tried = list(zip(pending, pool.map(lambda p: _merged(spark, p), pending), strict=True))
            parts += [(schema, some) for some, schema in tried if schema is not None]
            pending = [half for some, schema in tried if schema is None for half in (some[: len(some) // 2], some[len(some) // 2 :])]
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, some in parts:
        key = ",".join(sorted(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields))
        groups.setdefault(key, (schema, []))[1].extend(some)
    return [groups[key] for key in sorted(groups)]


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> Groups:
    """Files below the paths by schema; the driver holds their names, as it does for any scan."""
    listing = peek.data_files(spark, paths, "parquet")
    if peek.opened_by_tasks(paths):
        return _by_footer(spark, listing)
    files = [r["path"] for r in listing.toLocalIterator()]
    return _by_merging(spark, files) if files else []


def common_type(spark: SparkSession, kinds: Sequence[T.DataType]) -> T.DataType:
    """The type that holds the values of all: the same one, a wider number or date, else text."""
    different = list(dict.fromkeys(k for k in kinds if not isinstance(k, T.NullType)))
    if len(different) < 2:
        return different[0] if different else T.StringType()
    if any(isinstance(k, T.StringType) for k in different):
        return T.StringType()
    casts = ", ".join(f"CAST(NULL AS {k.simpleString()})" for k in different)
    try:
        return spark.sql(f"SELECT coalesce({casts}) AS c").schema["c"].dataType
    except AnalysisException:
        return T.StringType()


def common_schema(spark: SparkSession, schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns in the order in which they first occur, each in its common type."""
    kinds: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for field in schema.fields:
            kinds.setdefault(field.name, []).append(field.dataType)
    return T.StructType([T.StructField(name, common_type(spark, found)) for name, found in kinds.items()])


def scan_groups(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | None = None,
    *,
    base: str | None = None,
    strict: bool = True,
    metadata: dict[str, str] | None = None,
) -> DataFrame | None:
    """Files of any types as one frame in the declared (or common) schema; None without files.

    With ``base`` the rows carry the partition column of their path as text, and filters on it prune files. ``strict`` casts
    raise on text that does not fit a declared type, lenient ones give NULL. ``metadata`` names columns to take from
    the file's metadata, as expressions over ``_metadata``.
    """
    groups = schema_groups(spark, paths)
    if not groups:
        return None
    hidden = {PARTITION_COLUMN} if base is not None else set()
    known = [T.StructType([f for f in found.fields if f.name not in hidden]) for found, _ in groups]
    common = common_schema(spark, known)
    target = T.StructType([f for f in (schema or common).fields if f.name not in hidden])
    partition = [T.StructField(name, T.StringType()) for name in sorted(hidden)]
    reader = spark.read if base is None else spark.read.option("basePath", base)

    def rows_of(own: T.StructType, some: Sequence[str]) -> DataFrame:
        rows = reader.schema(T.StructType([*own.fields, *partition])).parquet(*some)
        columns = []
        for field in target.fields:
            if field.name in own.fieldNames():
                value = F.col(f"`{field.name}`")
                typed = value.cast(field.dataType) if strict else value.try_cast(field.dataType)
            else:
                typed = F.lit((field.metadata or {}).get("default")).cast(field.dataType)
            columns.append(typed.alias(field.name))
        columns += [F.col(f.name) for f in partition] + [F.expr(e).alias(name) for name, e in (metadata or {}).items()]
        return rows.select(*columns)

    if all(common[f.name].dataType == f.dataType for own in known for f in own.fields):
        return rows_of(common, [path for _, some in groups for path in some])  # nothing differs: one scan
    return reduce(DataFrame.unionByName, [rows_of(own, some) for own, (_, some) in zip(known, groups, strict=True)])
