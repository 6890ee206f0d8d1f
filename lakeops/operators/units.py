"""Work units: one row per piece of work, ``job_index, params, meta``.

``params`` and ``meta`` are map<string,string>. Units are described by
expressions and joins, not driver lists, so a million of them is only a frame.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.functions.dates import chunk_ranges, date_range_array
from lakeops.session import scratch_path

UNIT_SCHEMA = "job_index long, params map<string,string>, meta map<string,string>"

logger = logging.getLogger(__name__)


def _text_map(**values: Column | str | None) -> Column:
    entries: list[Column] = []
    for key, value in values.items():
        entries += [F.lit(key), value if isinstance(value, Column) else F.lit(value).cast("string")]
    return F.create_map(*entries).cast("map<string,string>") if entries else _no_entries()


def _no_entries() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))


def _one_unit(spark: SparkSession, params: Column) -> DataFrame:
    return spark.range(1).select(
        F.lit(0).cast("long").alias("job_index"),
        params.alias("params"),
        _no_entries().alias("meta"),
    )


def date_spine(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """Every day from start to end inclusive, as ``dt`` text in order."""
    if date.fromisoformat(str(end)) < date.fromisoformat(str(start)):
        raise ValueError(f"End date {end} is before start date {start}")
    days = date_range_array(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    spine = spark.range(1).select(F.explode(days).alias("dt"))
    return spine.select(F.col("dt").cast("string"))


def single_unit(spark: SparkSession) -> DataFrame:
    """One unit without parameters."""
    return _one_unit(spark, _no_entries())


def range_unit(spark: SparkSession, start: str | None, end: str | None = None) -> DataFrame:
    """One unit for a whole range; NULL dates without a start, end defaults to start."""
    return _one_unit(spark, _text_map(start_date=start, end_date=(end or start) if start else None))


def chunk_units(
    spark: SparkSession, start: str | None, end: str | None = None, freq: str = "1M"
) -> DataFrame:
    """One unit per contiguous chunk of the range, in date order."""
    if not start:
        return range_unit(spark, None)
    chunks = chunk_ranges(F.lit(start), F.lit(end or start), freq)
    return spark.range(1).select(F.posexplode(chunks).alias("job_index", "chunk")).select(
        F.col("job_index").cast("long").alias("job_index"),
        _text_map(
            start_date=F.col("chunk.start_date").cast("string"),
            end_date=F.col("chunk.end_date").cast("string"),
        ).alias("params"),
        F.when(
            F.col("chunk.shard_id").isNotNull(), _text_map(shard_id=F.col("chunk.shard_id"))
        )
        .otherwise(_no_entries())
        .alias("meta"),
    )


def distinct_items(df: DataFrame, key: str) -> DataFrame:
    """Distinct values as text, NULL left out; the first column if ``key`` is absent."""
    source = key if key in df.columns else df.columns[0]
    value = F.col(f"`{source}`")
    return df.where(value.isNotNull()).select(value.cast("string").alias(key)).distinct()


def numbered(df: DataFrame, order: str, out: str) -> DataFrame:
    """Rows numbered 0.. without gaps in the order of a column.

    That needs a global sort, not a global window: the range sort spreads the rows, and each partition's rows only add
    the count of those before it. The sorted rows are written down first, so that places and counts are of one sort.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "work-units")
    sorted_rows = df.orderBy(order).withColumn("_place", F.monotonically_increasing_id())
    sorted_rows.write.parquet(path)
    placed = spark.read.schema(sorted_rows.schema).parquet(path).withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(offsets, "_part").withColumn(out, F.col("_offset") + within).drop("_part", "_place", "_offset")


def item_units(df: DataFrame, key: str = "symbol") -> DataFrame:
    """One unit per distinct item, indexed 0.. in item order."""
    items = distinct_items(df, key).select(F.col(key).alias("item"))
    return numbered(items, "item", "job_index").select(
        "job_index", _text_map(**{key: F.col("item")}).alias("params"), _no_entries().alias("meta")
    )


def sql_units(spark: SparkSession, sql: str, key: str = "symbol", missing_ok: bool = False) -> DataFrame:
    """Item units from a query; no rows give no units.

    A query that cannot be resolved raises, unless ``missing_ok`` says that its tables may not exist yet: then it is
    logged and gives no units.
    """
    try:
        items = spark.sql(sql)
    except AnalysisException as error:
        if not missing_ok:
            raise
        logger.warning("No work units, the query failed: %s", error)
        return spark.createDataFrame([], UNIT_SCHEMA)
    return item_units(items, key)


def _merged(left: str, right: str) -> Column:
    """Union of two maps where the right one wins on a key clash."""
    fresh = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(fresh, F.col(right))


def _placed(units: DataFrame, side: str) -> tuple[DataFrame, int]:
    """Units with a place 0.. without gaps in index order, and their number."""
    found = units.agg(F.count(F.lit(1)), F.min("job_index"), F.max("job_index")).first()
    dense = found[0] == 0 or (found[1], found[2]) == (0, found[0] - 1)
    placed = units.withColumn("_at", F.col("job_index")) if dense else numbered(units, "job_index", "_at")
    return placed.select(F.col("_at").alias(f"_{side}"), F.col("params").alias(f"_p{side}"), F.col("meta").alias(f"_m{side}")), found[0]


def product(*strategies: DataFrame) -> DataFrame:
    """Every combination of the strategies' units; later ones win on key clashes.

    The combinations are numbered: number i stands for left unit ``i div m`` and right unit ``i mod m``. So a plain range,
    dealt evenly whatever the sizes, is joined to either side by its place; no side is repeated or compared with
    the other. The number is the index, which keeps the order of nested loops, left outermost. For a side of a few
    options see :func:`with_options`, which needs no join.
    """
    if not strategies:
        raise ValueError("At least one strategy is required")

    def combine(left: DataFrame, right: DataFrame) -> DataFrame:
        (left_units, n), (right_units, m) = _placed(left, "l"), _placed(right, "r")
        number = left.sparkSession.range(n * m).select(F.col("id").alias("job_index"))
        places = number.select("job_index", F.expr(f"job_index div {max(m, 1)}").alias("_l"), F.expr(f"job_index % {max(m, 1)}").alias("_r"))
        return (
            places.join(left_units, "_l")
            .join(right_units, "_r")
            .select("job_index", _merged("_pl", "_pr").alias("params"), _merged("_ml", "_mr").alias("meta"))
        )

    return reduce(combine, strategies)


def with_options(units: DataFrame, options: Sequence[Mapping[str, str]]) -> DataFrame:
    """Product of any units with a declared list of parameters: one unit for each option, in order, without a join."""
    if not options:
        raise ValueError("At least one option is required")
    listed = F.array(*[_text_map(**option) for option in options])
    spread = units.select("job_index", "params", "meta", F.posexplode(listed).alias("_i", "_option"))
    return spread.select(
        (F.col("job_index") * F.lit(len(options)) + F.col("_i")).alias("job_index"), _merged("params", "_option").alias("params"), "meta"
    )


def with_chunks(
    units: DataFrame, start: str | Column, end: str | Column, freq: str = "1M"
) -> DataFrame:
    """Product of any units with the chunks of a range, without a join.

    Bounds may be columns, so every unit can have its own range; the index then
    has gaps after units with fewer chunks, and stays unique and in order.
    """
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    chunks = chunk_ranges(as_column(start), as_column(end), freq)
    constant = not isinstance(start, Column) and not isinstance(end, Column)
    measured = units.sparkSession.range(1) if constant else units
    width = measured.agg(F.max(F.size(chunks))).first()[0] or 1
    spread = units.select(
        "job_index", "params", "meta", F.posexplode(chunks).alias("_i", "_chunk")
    )
    return spread.select(
        (F.col("job_index") * F.lit(width) + F.col("_i")).alias("job_index"),
        F.map_concat(
            F.map_filter("params", lambda k, _: ~k.isin("start_date", "end_date")),
            _text_map(
                start_date=F.col("_chunk.start_date").cast("string"),
                end_date=F.col("_chunk.end_date").cast("string"),
            ),
        ).alias("params"),
        F.map_concat(
            F.map_filter("meta", lambda k, _: k != "shard_id"),
            F.when(
                F.col("_chunk.shard_id").isNotNull(), _text_map(shard_id=F.col("_chunk.shard_id"))
            ).otherwise(_no_entries()),
        ).alias("meta"),
    )


def in_unit_order(df: DataFrame, column: str = "job_index") -> DataFrame:
    return df.orderBy(column)
