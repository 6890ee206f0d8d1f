"""Rows that carry a whole CSV text as bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A record runs to a line break outside quotes; a field to a comma outside them.
_RECORD = r'((?:[^"\n]++|"[^"]*+"?)++)'
_FIELD = r',("(?:[^"]|"")*+"|[^,]*+)'


def _fields(record: Column) -> Column:
    """Values of one CSV record, quotes removed."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_FIELD), F.lit(1))
    return F.transform(
        raw,
        lambda f: F.when(
            f.startswith('"'),
            F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(F.nullif(f, F.lit(""))),
    )


def explode_csv_payload(
    df: DataFrame, payload: str, schema: T.StructType, *, strict: bool = False
) -> DataFrame:
    """One typed row per CSV line held in the binary column ``payload``.

    The first record names the columns, so their order may differ from row to
    row; names missing there give NULL. Line breaks and commas inside quotes are
    part of the value. Other columns of ``df`` are kept, ``_line`` counts from 1.
    """
    text = F.regexp_replace(F.decode(F.col(payload), "UTF-8"), "\r\n", "\n")
    text = F.regexp_replace(text, "^﻿", "")
    records = F.regexp_extract_all(text, F.lit(_RECORD), F.lit(1))
    others = [F.col(f"`{c}`") for c in df.columns if c != payload]
    # Everything about the header is settled once per payload, before the lines
    # fan out, so that only the small position array travels with each line.
    header = _fields(F.get("_records", F.lit(0)))
    places = F.array(
        *[F.array_position("_header", name).cast("int") for name in schema.fieldNames()]
    )
    lines = (
        df.select(*others, records.alias("_records"))
        .select(*others, "_records", header.alias("_header"))
        .select(*others, "_records", places.alias("_places"))
        .select(
            *others,
            "_places",
            F.posexplode(F.slice("_records", F.lit(2), F.size("_records"))).alias(
                "_line", "_record"
            ),
        )
        .withColumn("_values", _fields(F.col("_record")))
    )
    columns = []
    for number, field in enumerate(schema.fields):
        place = F.get("_places", F.lit(number))
        value = F.when(place > 0, F.get("_values", place - 1))
        cast = value.cast(field.dataType) if strict else value.try_cast(field.dataType)
        columns.append(cast.alias(field.name))
    return lines.select(*others, (F.col("_line") + 1).alias("_line"), *columns)
