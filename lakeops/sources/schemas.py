"""Declared table schemas (fixed values: names, types and their order)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMN = "dt"
#: Reserved partition of tables that carry a typed empty seed file.
SEED_PARTITION = "1900-01-01"


def struct_of(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_text, _double, _int, _date, _flag = (
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.DateType(),
    T.BooleanType(),
)

SCHEMAS: dict[str, T.StructType] = {
    "ods_fund_etf_spot": struct_of(symbol=_text, name=_text, amount=_double, trade_date=_date),
    "ods_etf_universe_whitelist": struct_of(
        symbol=_text, name=_text, enabled=_int, trade_date=_date
    ),
    "ods_fund_etf_history": struct_of(
        symbol=_text,
        trade_date=_date,
        open=_double,
        high=_double,
        low=_double,
        close=_double,
        volume=_double,
        amount=_double,
        amplitude=_double,
        change_percent=_double,
        change_amount=_double,
        turnover_rate=_double,
    ),
    "ods_trade_date_hist": struct_of(trade_date=_date),
    "dim_trade_calendar_full": struct_of(
        trade_date=_date,
        trade_year=_int,
        trade_month=_int,
        trade_quarter=_int,
        trade_day_of_week=_int,
        trade_day_of_month=_int,
        trade_day_of_year=_int,
        trade_week_of_year=_int,
        is_weekday=_flag,
        is_month_end=_flag,
        is_quarter_end=_flag,
        is_year_end=_flag,
    ),
    "dim_etf_full": struct_of(
        symbol=_text, name=_text, enabled=_int, flag=_text, trade_date=_date
    ),
}

#: Names used in declared schemas for the types above (fixed values).
TYPE_NAMES: Mapping[str, str] = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed relation without rows."""
    return spark.createDataFrame([], schema)


def all_text(schema: T.StructType | list[str]) -> T.StructType:
    """The same columns, every one as text (how raw CSV is read)."""
    names = schema if isinstance(schema, list) else schema.fieldNames()
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def with_partition(schema: T.StructType, column: str = PARTITION_COLUMN) -> T.StructType:
    """Schema plus the text partition column, which stays last."""
    kept = [f for f in schema.fields if f.name != column]
    return T.StructType([*kept, T.StructField(column, T.StringType())])


def type_name(dtype: T.DataType) -> str:
    return TYPE_NAMES.get(dtype.simpleString(), dtype.simpleString().upper())


def schema_map(schema: T.StructType) -> Column:
    """map<position, struct<name, type, default_value>> describing a schema."""
    entries: list[Column] = []
    for position, field in enumerate(schema.fields):
        default = (field.metadata or {}).get("default")
        entries.append(F.lit(position))
        entries.append(
            F.struct(
                F.lit(field.name).alias("name"),
                F.lit(type_name(field.dataType)).alias("type"),
                F.lit(None if default is None else str(default))
                .cast("string")
                .alias("default_value"),
            )
        )
    return F.create_map(*entries)


def describe_schema(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per declared column: position, name, type, default_value."""
    return (
        spark.range(1)
        .select(F.explode(schema_map(schema)).alias("position", "column"))
        .select("position", "column.*")
    )
