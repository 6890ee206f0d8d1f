"""Text expressions: key cleaning, locations, hashes, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitize_key(value: Column) -> Column:
    """Replace everything but letters, digits, ``-`` and ``_`` by ``_``."""
    return F.regexp_replace(value, r"[^\p{L}\p{N}_-]", "_")


def sha256_text(value: Column) -> Column:
    return F.sha2(value, 256)


def join_location(base: Column, key: Column) -> Column:
    """Join a base location and a key with exactly one slash between them."""
    return F.concat(
        F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(key, "^/+", "")
    )


def location_parts(uri: Column) -> Column:
    """struct<scheme, authority, path> of a ``scheme://authority/path`` text."""
    shape = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)/*(.*)$"
    return F.struct(
        F.regexp_extract(uri, shape, 1).alias("scheme"),
        F.regexp_extract(uri, shape, 2).alias("authority"),
        F.regexp_extract(uri, shape, 3).alias("path"),
    )


def partition_location(table: Column, dt: Column) -> Column:
    """``<table>/dt=<dt>``."""
    return join_location(table, F.concat(F.lit("dt="), dt))


def partition_of(location: Column) -> Column:
    """The innermost ``dt=`` value in a location, NULL when there is none."""
    return F.nullif(
        F.regexp_extract(location, r"dt=([^/]+)(?!.*dt=)", 1), F.lit("")
    )


def ingest_order(location: Column) -> Column:
    """Order number of a part ``part_<n>.parquet``; 0 for any other location.

    A part is a file, or the directory of that name Spark writes one into.
    """
    pattern = r"part_([0-9]+)\.parquet(?:/[^/]*)?$"
    return F.when(
        location.rlike(pattern), F.regexp_extract(location, pattern, 1).cast("long")
    ).otherwise(F.lit(0).cast("long"))


def json_sorted(**fields: Column) -> Column:
    """A JSON object text with its keys in sorted order."""
    return F.to_json(
        F.struct(*[fields[name].alias(name) for name in sorted(fields)]),
        {"ignoreNullFields": "false"},
    )
