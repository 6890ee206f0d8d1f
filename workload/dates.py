"""Date expressions, calendars, ranges and work units."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.dates import (
    chunk_ranges,
    compact_date,
    dashed_date,
    normalize_dt_text,
    previous_day_utc,
)
from lakeops.operators.units import (
    date_spine,
    distinct_items,
    item_units,
    product,
    range_unit,
    with_chunks,
)
from lakeops.plans.models import calendar_dim
from workload import query
from workload.common import table

_CALENDAR_ORACLE = """
SELECT d AS trade_date,
       CAST(year(d) AS INTEGER) AS trade_year,
       CAST(month(d) AS INTEGER) AS trade_month,
       CAST(quarter(d) AS INTEGER) AS trade_quarter,
       CAST(dayofweek(d) AS INTEGER) AS trade_day_of_week,
       CAST(day(d) AS INTEGER) AS trade_day_of_month,
       CAST(dayofyear(d) AS INTEGER) AS trade_day_of_year,
       CAST(weekofyear(d) AS INTEGER) AS trade_week_of_year,
       {is_weekday} AS is_weekday,
       d = CAST(date_trunc('month', d + INTERVAL 1 MONTH) - INTERVAL 1 DAY AS DATE)
           AS is_month_end,
       d = CAST(date_trunc('quarter', d + INTERVAL 3 MONTH) - INTERVAL 1 DAY AS DATE)
           AS is_quarter_end,
       month(d) = 12 AND day(d) = 31 AS is_year_end,
       '2001-08-01' AS dt
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
"""


def _order_days(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.to_date("o_orderdate").alias("trade_date")).distinct()


@query("calendar_dim", _CALENDAR_ORACLE.format(is_weekday="isodow(d) <= 5"))
def calendar(spark, sf_dir):
    return calendar_dim(_order_days(spark, sf_dir), dt="2001-08-01")


@query("calendar_dim_compat", _CALENDAR_ORACLE.format(is_weekday="dayofweek(d) NOT IN (1, 7)"))
def calendar_compat(spark, sf_dir):
    return calendar_dim(_order_days(spark, sf_dir), dt="2001-08-01", compat=True)


@query(
    "normalize_dt",
    """
    WITH texts AS (
      SELECT o_orderkey,
             CASE o_orderpriority
               WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y%m%d')
               WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y/%m/%d')
               WHEN '3-MEDIUM' THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') || ' '
               WHEN '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:00:00'
               ELSE strftime(o_orderdate, '%Y-%m') END AS v
      FROM orders)
    SELECT o_orderkey, v,
           coalesce(CASE
             WHEN try_cast(v AS DATE) IS NOT NULL THEN strftime(try_cast(v AS DATE), '%Y-%m-%d')
             WHEN regexp_matches(trim(v), '^[0-9]{8}$')
               THEN strftime(strptime(trim(v), '%Y%m%d'), '%Y-%m-%d')
           END, 'none') AS dt
    FROM texts
    """,
)
def normalized_keys(spark, sf_dir):
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", compact_date(dashed_date(day)))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "yyyy/MM/dd"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.format_string(" %s ", dashed_date(day)))
        .when(F.col("o_orderpriority") == "5-LOW", F.format_string("%s 10:00:00", dashed_date(day)))
        .otherwise(F.date_format(day, "yyyy-MM"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("v"))
    return orders.withColumn("dt", F.coalesce(normalize_dt_text(F.col("v")), F.lit("none")))


@query(
    "t_minus_one",
    """
    SELECT event_id,
           strftime(CAST(ts + INTERVAL 8 HOUR AS DATE) - 1, '%Y-%m-%d') AS run_date,
           strftime(CAST(ts + INTERVAL 8 HOUR AS DATE) - 1, '%Y%m%d') AS compact_run_date
    FROM events
    """,
)
def day_before(spark, sf_dir):
    run_date = dashed_date(previous_day_utc(F.col("ts")))
    return table(spark, sf_dir, "events").select(
        "event_id", run_date.alias("run_date"), compact_date(run_date).alias("compact_run_date")
    )


@query(
    "date_spine",
    """
    WITH bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
                    FROM orders),
         spine AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d
                   FROM bounds),
         per_day AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
    SELECT strftime(spine.d, '%Y-%m-%d') AS dt, coalesce(n, 0) AS orders
    FROM spine LEFT JOIN per_day ON spine.d = per_day.d
    """,
)
def spine(spark, sf_dir):
    days = table(spark, sf_dir, "orders").groupBy(dashed_date(F.to_date("o_orderdate")).alias("dt"))
    per_day = days.agg(F.count(F.lit(1)).alias("n"))
    bounds = per_day.agg(F.min("dt"), F.max("dt")).first()
    all_days = date_spine(spark, *bounds)
    return all_days.join(per_day, "dt", "left").select("dt", F.coalesce("n", F.lit(0)).alias("orders"))


def _chunks_per_customer(spark, sf_dir, freq):
    spans = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e"))
    )
    return spans.select(
        "o_custkey", F.explode(chunk_ranges(F.col("s"), F.col("e"), freq)).alias("c")
    ).select(
        "o_custkey",
        "c.start_date",
        "c.end_date",
        F.coalesce("c.shard_id", F.lit("none")).alias("shard_id"),
    )


@query(
    "chunk_ranges_month_end",
    """
    WITH spans AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s,
                          CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY o_custkey),
         ends AS (SELECT o_custkey, s, e, last_day(CAST(m AS DATE)) AS cut
                  FROM (SELECT o_custkey, s, e, unnest(generate_series(
                          date_trunc('month', s), date_trunc('month', e), INTERVAL 1 MONTH)) AS m
                        FROM spans)),
         sharded AS (SELECT DISTINCT o_custkey FROM ends WHERE cut BETWEEN s AND e),
         starts AS (SELECT o_custkey, e, s AS st FROM spans
                    UNION ALL
                    SELECT o_custkey, e, cut FROM ends WHERE cut > s AND cut <= e)
    SELECT starts.o_custkey, st AS start_date,
           least(coalesce(CAST(lead(st) OVER (PARTITION BY starts.o_custkey ORDER BY st) AS DATE) - 1,
                          e), e) AS end_date,
           CASE WHEN sharded.o_custkey IS NULL THEN 'none' ELSE strftime(st, '%Y%m') END AS shard_id
    FROM starts LEFT JOIN sharded ON starts.o_custkey = sharded.o_custkey
    """,
)
def month_end_chunks(spark, sf_dir):
    return _chunks_per_customer(spark, sf_dir, "1M")


@query(
    "chunk_ranges_7d",
    """
    WITH spans AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s,
                          CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY o_custkey),
         starts AS (SELECT o_custkey, e,
                           CAST(unnest(generate_series(s, e, INTERVAL 7 DAY)) AS DATE) AS st
                    FROM spans)
    SELECT o_custkey, st AS start_date, least(st + 6, e) AS end_date,
           strftime(st, '%Y%m') AS shard_id
    FROM starts
    """,
)
def weekly_chunks(spark, sf_dir):
    return _chunks_per_customer(spark, sf_dir, "7D")


@query(
    "distinct_items",
    "SELECT DISTINCT CAST(c_mktsegment AS VARCHAR) AS segment FROM customer "
    "WHERE c_mktsegment IS NOT NULL",
)
def items(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return distinct_items(customer.select("c_mktsegment"), "segment")


def _order_span(spark, sf_dir):
    row = (
        table(spark, sf_dir, "orders")
        .agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
        .select(dashed_date(F.col("s")), dashed_date(F.col("e")))
        .first()
    )
    return row[0], row[1]


@query(
    "work_unit_product",
    """
    WITH items AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS i
                   FROM (SELECT DISTINCT p_brand AS item FROM part)),
         span AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
                  FROM orders),
         months AS (SELECT s, e, CAST(unnest(generate_series(date_trunc('month', s), e,
                           INTERVAL 1 MONTH)) AS DATE) AS m FROM span),
         chunks AS (SELECT greatest(m, s) AS st, least(last_day(m), e) AS en,
                           row_number() OVER (ORDER BY m) - 1 AS j, count(*) OVER () AS n
                    FROM months)
    SELECT i * n + j AS job_index, item AS symbol, strftime(st, '%Y-%m-%d') AS start_date,
           strftime(en, '%Y-%m-%d') AS end_date, strftime(st, '%Y%m') AS shard_id
    FROM items CROSS JOIN chunks
    """,
)
def unit_product(spark, sf_dir):
    start, end = _order_span(spark, sf_dir)
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol"))
    units = with_chunks(item_units(parts, "symbol"), start, end, "month")
    return units.select(
        "job_index",
        F.col("params")["symbol"].alias("symbol"),
        F.col("params")["start_date"].alias("start_date"),
        F.col("params")["end_date"].alias("end_date"),
        F.col("meta")["shard_id"].alias("shard_id"),
    )


@query(
    "work_unit_product_items",
    """
    WITH a AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS i
               FROM (SELECT DISTINCT p_brand AS item FROM part)),
         b AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS j, count(*) OVER () AS n
               FROM (SELECT DISTINCT c_name AS item FROM customer))
    SELECT i * n + j AS job_index, a.item AS brand, b.item AS customer
    FROM a CROSS JOIN b
    """,
)
def unit_product_items(spark, sf_dir):
    """Two item lists combined; brands are few, so the result is linear in customers."""
    brands = item_units(table(spark, sf_dir, "part").select("p_brand"), "brand")
    names = item_units(table(spark, sf_dir, "customer").select("c_name"), "customer")
    return product(brands, names).select(
        "job_index",
        F.col("params")["brand"].alias("brand"),
        F.col("params")["customer"].alias("customer"),
    )


@query(
    "work_unit_override",
    """
    WITH a AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS i
               FROM (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS item FROM customer)),
         span AS (SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS s,
                         strftime(max(o_orderdate), '%Y-%m-%d') AS e FROM orders)
    SELECT i AS job_index, item AS symbol, s AS start_date, e AS end_date
    FROM a CROSS JOIN span
    """,
)
def unit_override(spark, sf_dir):
    """A later strategy wins: the whole span replaces the dates of the first one."""
    start, end = _order_span(spark, sf_dir)
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("symbol"))
    first = with_chunks(item_units(keys, "symbol"), start, start, "1D")
    return product(first, range_unit(spark, start, end)).select(
        "job_index",
        F.col("params")["symbol"].alias("symbol"),
        F.col("params")["start_date"].alias("start_date"),
        F.col("params")["end_date"].alias("end_date"),
    )
