"""Projections, filters, deduplication, set operations, counts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.dates import date_range_array
from lakeops.functions.text import (
    join_location,
    json_sorted,
    location_parts,
    partition_location,
    partition_of,
    sanitize_key,
    sha256_text,
)
from lakeops.operators.checks import (
    key_totals,
    partition_counts,
    row_count,
    total_rows,
    validate_metrics,
)
from lakeops.operators.dedup import dedup_latest
from lakeops.operators.normalize import (
    conform,
    enabled_only,
    exclude_dates,
    filter_date_range,
    keep_dates,
    key_problem,
    project_existing,
    rejected_by_conform,
    rename,
    require_columns,
    stamp,
)
from lakeops.plans.models import entity_dim
from lakeops.sources.payload import explode_csv_payload
from lakeops.sources.scan import missing_dates
from lakeops.sources.schemas import SCHEMAS, schema_map, struct_of
from workload import query
from workload.common import dated_events, table



@query(
    "dedup_latest",
    """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                 l_linestatus DESC) AS rn
      FROM lineitem) WHERE rn = 1
    """,
)
def newest_lines(spark, sf_dir):
    order = (
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    )
    lines = table(spark, sf_dir, "lineitem")
    return dedup_latest(lines, ["l_orderkey", "l_linenumber", "no_such_key"], order)


@query(
    "dedup_hot_key",
    """
    SELECT event_type, max(event_id) AS event_id FROM events GROUP BY event_type
    """,
)
def newest_per_type(spark, sf_dir):
    """Few keys, each with a large share of all rows."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    return dedup_latest(events, ["event_type"], ["event_id"])


@query(
    "ods_strict_vs_lenient",
    """
    SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'amount'
                WHEN o_orderstatus = 'P' THEN 'trade_date'
                ELSE 'none' END AS rejected_column,
           count(*) AS row_count,
           count(CASE WHEN o_orderpriority <> '1-URGENT' THEN 1 END) AS typed_amounts,
           count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS typed_dates
    FROM orders GROUP BY 1
    """,
)
def lenient_typing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    raw = orders.select(
        F.col("o_orderkey").cast("string").alias("symbol"),
        F.col("o_orderpriority").alias("name"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "n/a")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("amount"),
        F.when(F.col("o_orderstatus") == "P", "20241399")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
        .alias("trade_date"),
    )
    schema, formats = SCHEMAS["ods_fund_etf_spot"], {"trade_date": "yyyyMMdd"}
    marked = raw.withColumn("rejected_column", rejected_by_conform(raw, schema, formats))
    typed = conform(
        marked, schema, strict=False, date_formats=formats, keep=("rejected_column",)
    )
    return typed.groupBy(F.coalesce("rejected_column", F.lit("none")).alias("rejected_column")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("amount").alias("typed_amounts"),
        F.count("trade_date").alias("typed_dates"),
    )


@query(
    "key_problems",
    """
    SELECT reason, count(*) AS row_count FROM (
      SELECT CASE event_type WHEN 'error' THEN 'missing' WHEN 'signup' THEN 'missing'
                             WHEN 'view' THEN 'invalid' END AS reason
      FROM events) WHERE reason IS NOT NULL GROUP BY reason
    """,
)
def key_problems(spark, sf_dir):
    """Reasons why partition keys are unusable, counted."""
    kind = F.col("event_type")
    key = (
        F.when(kind == "error", " ")
        .when(kind == "signup", "NaT")
        .when(kind == "view", "2024-02-30")
        .otherwise(F.date_format("ts", "yyyyMMdd"))
    )
    events = table(spark, sf_dir, "events").select(key.alias("trade_date"))
    reasons = events.select(key_problem(events, "trade_date").alias("reason"))
    return (
        reasons.where(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "entity_dim",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS symbol, p_name AS name,
           CAST(p_size <= 10 AS INTEGER) AS enabled, 'WHITELIST' AS flag,
           DATE '2024-01-05' AS trade_date, '2024-01-05' AS dt
    FROM part
    """,
)
def entities(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("symbol"),
        F.col("p_name").alias("name"),
        (F.col("p_size") <= 10).cast("int").alias("enabled"),
    )
    dated = stamp(parts, trade_date=F.lit("2024-01-05").cast("date"), dt="2024-01-05")
    return entity_dim(dated)


@query(
    "enabled_items",
    "SELECT CAST(p_partkey AS VARCHAR) AS symbol FROM part WHERE p_size <= 10",
)
def enabled_items(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("symbol"),
        (F.col("p_size") <= 10).cast("int").alias("enabled"),
    )
    return enabled_only(parts).select("symbol")


@query(
    "rename_project",
    "SELECT p_partkey AS symbol, p_name AS name, p_retailprice AS close FROM part",
)
def renamed(spark, sf_dir):
    names = {"p_partkey": "symbol", "p_name": "name", "p_retailprice": "close", "p_none": "volume"}
    frame = rename(table(spark, sf_dir, "part"), names)
    require_columns(frame, ["symbol", "name"])
    return project_existing(frame, ["symbol", "name", "volume", "close"])


@query(
    "date_range_filter",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate <= TIMESTAMP '1999-02-28'
    """,
)
def date_range(spark, sf_dir):
    orders = filter_date_range(
        table(spark, sf_dir, "orders"), "o_orderdate", "1997-03-01", "1999-02-28"
    )
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_day"))


@query(
    "date_range_filter_text",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS trade_date FROM orders
    WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) >= DATE '1998-06-15'
    """,
)
def date_range_text(spark, sf_dir):
    """Unreadable dates drop out once a bound is given."""
    text = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(
        F.date_format("o_orderdate", "yyyyMMdd")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("trade_date"))
    return filter_date_range(orders, "trade_date", start="1998-06-15")


@query(
    "csv_payload_explode",
    """
    SELECT p_partkey, 1 AS line, 'the "' || p_name || '", boxed' AS name, p_size AS size,
           p_retailprice AS price FROM part
    UNION ALL
    SELECT p_partkey, 2, p_brand || chr(10) || p_type, p_size + 1, p_retailprice FROM part
    """,
)
def payload_rows(spark, sf_dir):
    """Each part carries a two-line CSV text with quotes, commas and a line break."""
    text = F.format_string(
        'price,name,size\r\n%s,"the ""%s"", boxed",%s\r\n%s,"%s\n%s",%s\r\n',
        F.col("p_retailprice").cast("string"),
        F.col("p_name"),
        F.col("p_size").cast("string"),
        F.col("p_retailprice").cast("string"),
        F.col("p_brand"),
        F.col("p_type"),
        (F.col("p_size") + 1).cast("string"),
    )
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.encode(text, "UTF-8").alias("csv_bytes")
    )
    schema = struct_of(name=T.StringType(), size=T.IntegerType(), price=T.DoubleType())
    return explode_csv_payload(parts, "csv_bytes", schema).withColumnRenamed("_line", "line")


@query(
    "union_by_name",
    """
    SELECT event_id, event_type, value,
           CASE WHEN event_type = 'click' THEN 'none' ELSE props END AS props FROM events
    """,
)
def stacked(spark, sf_dir):
    """Two versions of a table; the older one lacks a column."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props")
    old = events.where("event_type = 'click'").drop("props")
    new = events.where("event_type <> 'click'").select("props", "value", "event_type", "event_id")
    both = old.unionByName(new, allowMissingColumns=True)
    return both.withColumn("props", F.coalesce("props", F.lit("none")))


@query(
    "partition_counts",
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS row_count FROM events GROUP BY 1",
)
def counts(spark, sf_dir):
    return partition_counts(dated_events(spark, sf_dir)).orderBy("dt")


@query(
    "total_rows",
    """
    SELECT count(*) AS row_count, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS partition_count
    FROM events
    """,
)
def totals(spark, sf_dir):
    return total_rows(partition_counts(dated_events(spark, sf_dir)))


@query(
    "row_count_one_partition",
    "SELECT count(*) AS row_count FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-05'",
)
def one_count(spark, sf_dir):
    return row_count(dated_events(spark, sf_dir), "2024-01-05")


@query(
    "key_totals",
    "SELECT count(DISTINCT user_id) AS distinct_keys, count(user_id) AS row_count FROM events",
)
def users(spark, sf_dir):
    return key_totals(table(spark, sf_dir, "events"), "user_id")


@query(
    "validate_metrics",
    """
    WITH days AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS all_rows,
                         count(CASE WHEN event_type <> 'click' THEN 1 END) AS kept
                  FROM events GROUP BY 1)
    SELECT dt,
           CASE WHEN dt > '2024-01-25' THEN 'unexpected_files'
                WHEN dt > '2024-01-20' THEN 'no_files'
                WHEN dt > '2024-01-15' THEN 'file_count_mismatch'
                ELSE 'row_count_mismatch' END AS problem,
           CASE WHEN dt > '2024-01-25' THEN 0 WHEN dt > '2024-01-15' THEN 1
                ELSE all_rows END AS expected,
           CASE WHEN dt > '2024-01-25' THEN 2 WHEN dt > '2024-01-20' THEN 0
                WHEN dt > '2024-01-15' THEN 2 ELSE kept END AS actual
    FROM days
    """,
)
def violations(spark, sf_dir):
    """Expected counts against deviating ones, matched per date."""
    events = dated_events(spark, sf_dir)
    dt = F.col("dt")
    expected = partition_counts(events).select(
        "dt",
        (dt <= "2024-01-25").cast("int").alias("has_data"),
        F.when(dt <= "2024-01-25", F.col("row_count")).otherwise(0).alias("row_count"),
        F.when(dt <= "2024-01-25", 1).otherwise(0).cast("long").alias("file_count"),
    )
    found = partition_counts(events.where("event_type <> 'click'"))
    actual = found.where((dt <= "2024-01-20") | (dt > "2024-01-25")).select(
        "dt",
        "row_count",
        F.when(dt > "2024-01-15", 2).otherwise(1).cast("long").alias("file_count"),
    )
    return validate_metrics(expected, actual)


@query(
    "semi_join_allowed",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt FROM events
    WHERE strftime(ts, '%Y-%m-%d') IN (
      SELECT strftime(ts, '%Y-%m-%d') FROM events WHERE value > 250)
      AND strftime(ts, '%Y-%m-%d') NOT IN ('2024-01-03', '2024-01-04')
    """,
)
def allowed(spark, sf_dir):
    """Dates from a frame are semi-joined, dates from a list become a filter."""
    events = dated_events(spark, sf_dir)
    busy = events.where("value > 250").select("dt").distinct()
    kept = keep_dates(events, busy)
    return exclude_dates(kept, ["2024-01-03", "2024-01-04"]).select("event_id", "dt")


@query(
    "missing_dates",
    """
    WITH spine AS (SELECT CAST(unnest(generate_series(
                     (SELECT CAST(min(o_orderdate) AS DATE) FROM orders),
                     (SELECT CAST(max(o_orderdate) AS DATE) FROM orders),
                     INTERVAL 1 DAY)) AS DATE) AS d)
    SELECT strftime(d, '%Y-%m-%d') AS dt FROM spine
    WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P')
    """,
)
def absent(spark, sf_dir):
    """Days of the order period without a pending order."""
    orders = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"), "o_orderstatus"
    )
    bounds = orders.agg(
        F.min("dt").cast("date").alias("s"), F.max("dt").cast("date").alias("e")
    )
    days = bounds.select(F.explode(date_range_array(F.col("s"), F.col("e"))).alias("dt"))
    spine = days.select(F.col("dt").cast("string"))
    return missing_dates(orders.where("o_orderstatus = 'P'"), spine)


@query(
    "schema_registry",
    """
    WITH profile AS (
      SELECT count(*) AS n, count(c_custkey) AS a, count(c_name) AS b, count(c_nationkey) AS c,
             count(c_acctbal) AS d, count(c_mktsegment) AS e FROM customer)
    SELECT 0 AS position, 'c_custkey' AS name, 'BIGINT' AS type, a AS filled FROM profile
    UNION ALL SELECT 1, 'c_name', 'VARCHAR', b FROM profile
    UNION ALL SELECT 2, 'c_nationkey', 'INTEGER', c FROM profile
    UNION ALL SELECT 3, 'c_acctbal', 'DOUBLE', d FROM profile
    UNION ALL SELECT 4, 'c_mktsegment', 'VARCHAR', e FROM profile
    """,
)
def described(spark, sf_dir):
    """The schema map of a table with the number of filled values per column."""
    customer = table(spark, sf_dir, "customer")
    schema = customer.schema
    filled = customer.agg(*[F.count(c).alias(c) for c in customer.columns]).select(
        F.create_map(*[x for c in customer.columns for x in (F.lit(c), F.col(c))]).alias("filled")
    )
    rows = filled.select("filled", F.explode(schema_map(schema)).alias("position", "column"))
    return rows.select(
        "position",
        "column.name",
        "column.type",
        F.element_at("filled", F.col("column.name")).alias("filled"),
    )


@query(
    "string_key_utils",
    """
    SELECT c_custkey,
           regexp_replace(c_name || ' / ' || c_mktsegment, '[^A-Za-z0-9_-]', '_', 'g') AS key,
           sha256(c_name) AS name_hash,
           's3://lake/' || c_mktsegment || '/dt=1999-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR),
             2, '0') AS location,
           '1999-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS dt,
           's3' AS scheme, 'lake' AS authority,
           c_mktsegment || '/dt=1999-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS path
    FROM customer
    """,
)
def text_keys(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    day = F.format_string("1999-01-%02d", F.col("c_nationkey") + 1)
    base = join_location(F.lit("s3://lake/"), F.concat(F.lit("/"), F.col("c_mktsegment")))
    keyed = customer.select(
        "c_custkey",
        sanitize_key(F.concat_ws(" / ", "c_name", "c_mktsegment")).alias("key"),
        sha256_text(F.col("c_name")).alias("name_hash"),
        partition_location(base, day).alias("location"),
    )
    return keyed.select(
        "*",
        partition_of(F.col("location")).alias("dt"),
        location_parts(F.col("location"))["scheme"].alias("scheme"),
        location_parts(F.col("location"))["authority"].alias("authority"),
        location_parts(F.col("location"))["path"].alias("path"),
    )


@query(
    "manifest_json",
    """
    SELECT dt, '{"dest":"ods.events","partition_date":"' || dt || '","row_count":' ||
           CAST(n AS VARCHAR) || ',"status":"success"}' AS manifest
    FROM (SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n FROM events GROUP BY 1)
    """,
)
def json_rows(spark, sf_dir):
    per_day = partition_counts(dated_events(spark, sf_dir))
    body = json_sorted(
        status=F.lit("success"),
        dest=F.lit("ods.events"),
        row_count=F.col("row_count"),
        partition_date=F.col("dt"),
    )
    return per_day.select("dt", body.alias("manifest"))


@query(
    "preview",
    "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 100",
)
def preview(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return events.orderBy("event_id").limit(100)
