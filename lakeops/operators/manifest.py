"""The manifest table: one appended row per (dest, partition_date, run)."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.text import json_sorted
from lakeops.sources import files

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("dest", T.StringType()),
        T.StructField("partition_date", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("file_count", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_prefix", T.StringType()),
        T.StructField("target_prefix", T.StringType()),
        T.StructField("generated_at", T.TimestampType()),
    ]
)

SUCCESS = "success"
CLEARED = "cleared"


def append_manifest(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    """Append rows (all fields but ``generated_at``); one small file per run."""
    if not rows:
        return
    for row in rows:
        if row[3] < 0 or row[4] < 0:
            raise ValueError("file_count and row_count cannot be negative")
    names = MANIFEST_SCHEMA.fieldNames()[:-1]
    columns = pa.table({name: [row[i] for row in rows] for i, name in enumerate(names)})
    (
        spark.createDataFrame(columns)
        .withColumn("generated_at", F.current_timestamp())
        .coalesce(1)
        .write.mode("append")
        .parquet(path)
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every manifest row ever written; empty before the first run."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def latest_manifest(manifest: DataFrame) -> DataFrame:
    """The last state per destination and partition, cleared ones left out."""
    newest = Window.partitionBy("dest", "partition_date").orderBy(
        F.col("generated_at").desc(), F.col("run_id").desc()
    )
    return (
        manifest.withColumn("_rank", F.row_number().over(newest))
        .where((F.col("_rank") == 1) & (F.col("status") != CLEARED))
        .drop("_rank")
    )


def completed_partitions(manifest: DataFrame) -> DataFrame:
    """Partitions whose last run succeeded, as ``dt``."""
    done = latest_manifest(manifest).where(F.col("status") == SUCCESS)
    return done.select(F.col("partition_date").alias("dt"))


def manifest_json(manifest: DataFrame) -> DataFrame:
    """partition_date and the row as a JSON object with sorted keys."""
    fields = {c: F.col(c) for c in manifest.columns}
    return manifest.select("partition_date", json_sorted(**fields).alias("manifest"))
