"""Inputs shared by the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.dates import dashed_date
from lakeops.operators.publish import LakeTable
from lakeops.session import scratch_path

#: Column list of the published event tables.
EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value", "dt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their partition key."""
    events = table(spark, sf_dir, "events")
    return events.withColumn("dt", dashed_date(F.col("ts"))).select(*EVENT_COLUMNS)


def fresh_table(spark: SparkSession, name: str, fmt: str = "parquet") -> LakeTable:
    """A table in a lake of its own below the shared folder."""
    return LakeTable(scratch_path(spark, "lake"), "ods", name, fmt)
