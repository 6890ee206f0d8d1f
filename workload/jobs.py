"""Models, backfills and ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.dates import dashed_date
from lakeops.operators.publish import publish_partitions, read_quarantine
from lakeops.operators.units import item_units, with_chunks
from lakeops.plans.backfill import backfill
from lakeops.plans.ingest import IngestSource, ingest
from lakeops.plans.models import Model, run_model
from lakeops.session import scratch_path
from lakeops.sources.fetch import fetch, standardize
from lakeops.sources.scan import raw_csv_input, scan_snapshot, scan_table
from lakeops.sources.schemas import struct_of
from workload import query
from workload.common import dated_events, fresh_table, table


#: Daily totals per type over a view of dated events, for any range of dates.
DAILY_SQL = """
    SELECT event_type, count(*) AS events, max(value) AS max_value, dt
    FROM tmp_events
    WHERE dt BETWEEN :start_date AND :end_date
    GROUP BY event_type, dt;
"""

_DAILY_ORACLE = """
    SELECT event_type, count(*) AS events, max(value) AS max_value,
           strftime(ts, '%Y-%m-%d') AS dt FROM events
    WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-03' AND '2024-01-12' GROUP BY 1, 4
"""


def _events_input(sf_dir):
    return lambda spark, dates: dated_events(spark, sf_dir)


def daily_model(sf_dir):
    return Model("daily_events", DAILY_SQL, inputs={"tmp_events": _events_input(sf_dir)})


@query("backfill_range", _DAILY_ORACLE)
def backfill_range(spark, sf_dir):
    """Ten dates in one job."""
    target = fresh_table(spark, "daily_events")
    report = backfill(spark, daily_model(sf_dir), target, "2024-01-03", "2024-01-12")
    return scan_table(spark, target.path, report.schema)


@query(
    "backfill_quarantine",
    """
    SELECT CASE WHEN event_type = 'click' THEN 'invalid_key'
                WHEN strftime(ts, '%Y-%m-%d') NOT BETWEEN '2024-01-03' AND '2024-01-12' THEN 'outside_range'
                ELSE 'published' END AS outcome, count(*) AS row_count
    FROM events GROUP BY 1
    """,
)
def quarantined(spark, sf_dir):
    """A model that returns foreign dates and rows without one: all are published or counted as rejected."""
    sql = """
        SELECT event_id, value, CASE WHEN event_type <> 'click' THEN dt END AS dt FROM tmp_events
        WHERE :start_date <= :end_date
    """
    target = fresh_table(spark, "events")
    model = Model("events", sql, inputs={"tmp_events": _events_input(sf_dir)})
    report = backfill(spark, model, target, "2024-01-03", "2024-01-12")
    published = scan_table(spark, target.path, report.schema).select(F.lit("published").alias("outcome"))
    rejected = read_quarantine(spark, target, report.schema).select(F.col("_outcome").alias("outcome"))
    return published.unionByName(rejected).groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "backfill_summary",
    """
    WITH days AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, max(value) > 150 AS bad FROM events
                  WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-03' AND '2024-01-12' GROUP BY 1)
    SELECT count(*) AS total_dates, count(CASE WHEN NOT bad THEN 1 END) AS successful_count,
           count(CASE WHEN bad THEN 1 END) AS failed_count, CAST(0 AS BIGINT) AS skipped_count,
           coalesce(min(CASE WHEN NOT bad THEN dt END), 'none') AS first_success,
           coalesce(max(CASE WHEN NOT bad THEN dt END), 'none') AS last_success,
           coalesce(string_agg(CASE WHEN bad THEN dt END, ',' ORDER BY dt), '') AS failed_dates
    FROM days
    """,
)
def summarized(spark, sf_dir):
    """Dates with a row that fails a check are left out and reported."""
    target = fresh_table(spark, "daily_events")
    report = backfill(
        spark,
        daily_model(sf_dir),
        target,
        "2024-01-03",
        "2024-01-12",
        checks={"value_in_bounds": "max_value <= 150"},
        continue_on_error=True,
    )
    summary = report.summary(spark)
    return summary.select(
        "total_dates",
        "successful_count",
        "failed_count",
        "skipped_count",
        F.coalesce("first_success", F.lit("none")).alias("first_success"),
        F.coalesce("last_success", F.lit("none")).alias("last_success"),
        F.concat_ws(",", F.col("failed_dates")["date"]).alias("failed_dates"),
    )


@query(
    "backfill_isolates_errors",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS events FROM events
    WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-03' AND '2024-01-12'
      AND strftime(ts, '%Y-%m-%d') <> '2024-01-08' GROUP BY 1
    """,
)
def isolated(spark, sf_dir):
    """One date breaks the job itself; halving the range finds it, the rest is published."""
    sql = """
        SELECT dt, count(amount) AS events
        FROM (SELECT dt, CAST(amount AS DOUBLE) AS amount FROM tmp_amounts
              WHERE dt BETWEEN :start_date AND :end_date)
        GROUP BY dt
    """

    def amounts(spark, dates):
        text = F.when(F.col("dt") == "2024-01-08", "n/a").otherwise(F.col("value").cast("string"))
        return dated_events(spark, sf_dir).select("dt", text.alias("amount"))

    target = fresh_table(spark, "amounts")
    model = Model("amounts", sql, inputs={"tmp_amounts": amounts})
    days = "2024-01-03", "2024-01-12"
    report = backfill(spark, model, target, *days, continue_on_error=True)
    return scan_table(spark, target.path, report.schema)


@query(
    "model_sql_params",
    """
    SELECT event_type, count(*) AS events, 'daily' AS label, strftime(ts, '%Y-%m-%d') AS dt
    FROM events WHERE value >= 25 GROUP BY 1, 4
    """,
)
def model_params(spark, sf_dir):
    """A range model with a typed parameter, over every date of the events."""
    sql = """
        SELECT event_type, count(*) AS events, '${LABEL}' AS label, dt FROM tmp_events
        WHERE value >= :floor AND dt BETWEEN :start_date AND :end_date GROUP BY event_type, dt;
    """
    days = dated_events(spark, sf_dir).agg(F.min("dt"), F.max("dt")).first()
    target = fresh_table(spark, "daily_events")
    model = Model(
        "daily_events",
        sql,
        inputs={"tmp_events": _events_input(sf_dir)},
        variables={"LABEL": "daily"},
        params={"floor": 25.0},
    )
    report = backfill(spark, model, target, days[0], days[1])
    return scan_table(spark, target.path, report.schema)


@query(
    "model_one_date",
    """
    SELECT event_id, value, '2024-01-05' AS dt FROM events
    WHERE strftime(ts, '%Y-%m-%d') = '2024-01-05'
    """,
)
def one_date(spark, sf_dir):
    """A template with ${PARTITION_DATE} runs for one date."""
    sql = """
        SELECT event_id, value, '${PARTITION_DATE}' AS dt
        FROM tmp_events WHERE dt = '${PARTITION_DATE}';
    """
    target = fresh_table(spark, "events_of_day")
    model = Model("events_of_day", sql, inputs={"tmp_events": _events_input(sf_dir)})
    report = run_model(spark, model, target, ["2024-01-05"])
    return scan_table(spark, target.path, report.schema)


@query(
    "model_snapshot",
    "SELECT c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY 1",
)
def snapshot_model(spark, sf_dir):
    target = fresh_table(spark, "segments")
    model = Model(
        "segments",
        "SELECT c_mktsegment AS segment, count(*) AS customers FROM tmp_customer GROUP BY 1",
        inputs={"tmp_customer": lambda spark, dates: table(spark, sf_dir, "customer")},
    )
    report = run_model(spark, model, target)
    return scan_snapshot(spark, target.path, schema=report.schema)


@query(
    "model_over_raw_csv",
    """
    SELECT event_type, count(*) AS events, strftime(ts, '%Y-%m-%d') AS dt FROM events
    WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-10' AND '2024-01-19' GROUP BY 1, 3
    """,
)
def raw_model(spark, sf_dir):
    """A range model reading dated CSV directories through an input hook."""
    raw = fresh_table(spark, "events", "csv")
    publish_partitions(dated_events(spark, sf_dir), raw)
    sql = """
        SELECT event_type, count(*) AS events, dt FROM tmp_raw_events
        WHERE dt BETWEEN :start_date AND :end_date GROUP BY event_type, dt
    """
    hook = raw_csv_input(raw.path, ["event_id", "user_id", "event_type", "value"])
    target = fresh_table(spark, "daily_events")
    model = Model("daily_events", sql, inputs={"tmp_raw_events": hook})
    report = backfill(spark, model, target, "2024-01-10", "2024-01-19")
    return scan_table(spark, target.path, report.schema)


@query(
    "model_two_inputs_gap",
    """
    SELECT count(*) AS events, strftime(ts, '%Y-%m-%d') AS dt FROM events
    WHERE strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-10' AND '2024-01-19'
      AND strftime(ts, '%Y-%m-%d') NOT IN ('2024-01-12', '2024-01-15') GROUP BY 2
    """,
)
def two_inputs(spark, sf_dir):
    """Two raw inputs, each without one of the dates: neither of these is published from the other's half."""
    a, b = (fresh_table(spark, name, "csv") for name in ("a", "b"))
    events = dated_events(spark, sf_dir)
    publish_partitions(events.where("dt <> '2024-01-12'").select("event_id", "dt"), a)
    publish_partitions(events.where("dt <> '2024-01-15'").select("event_id", "dt"), b)
    sql = """
        SELECT count(DISTINCT event_id) AS events, dt
        FROM (SELECT * FROM tmp_a UNION ALL SELECT * FROM tmp_b)
        WHERE dt BETWEEN :start_date AND :end_date GROUP BY dt
    """
    target = fresh_table(spark, "daily")
    inputs = {f"tmp_{t.name}": raw_csv_input(t.path, ["event_id"]) for t in (a, b)}
    report = backfill(spark, Model("daily", sql, inputs=inputs), target, "2024-01-10", "2024-01-19")
    return scan_table(spark, target.path, report.schema)


def _greet(symbol):
    """A user function: one row per work unit."""
    import pandas as pd

    if symbol.endswith("7"):
        return None
    return pd.DataFrame({"symbol": [symbol], "label": [f"c-{symbol}"], "size": [len(symbol)]})


@query(
    "fetch_units",
    """
    SELECT symbol, 'c-' || symbol AS label, length(symbol) AS size, i AS _ingest_order,
           CAST(0 AS BIGINT) AS _row_index
    FROM (SELECT symbol, row_number() OVER (ORDER BY symbol) - 1 AS i
          FROM (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS symbol FROM customer))
    WHERE symbol NOT LIKE '%7'
    """,
)
def fetched(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("symbol"))
    schema = struct_of(symbol=T.StringType(), label=T.StringType(), size=T.LongType())
    return fetch(item_units(keys, "symbol"), _greet, schema)


def _padded(symbol):
    """A user function whose result is CSV text: padded keys, NA and gaps."""
    from types import SimpleNamespace

    number = int(symbol)
    size = "" if number % 3 == 0 else str(number)
    label = "NA" if number % 2 else ""
    return SimpleNamespace(csv_bytes=f"symbol,label,size,other\n{number:08},{label},{size},x\n".encode())


@query(
    "fetch_csv_payload",
    """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS symbol,
           CASE WHEN c_custkey % 2 = 1 THEN 'NA' ELSE 'none' END AS label,
           CASE WHEN c_custkey % 3 = 0 THEN CAST(-1 AS BIGINT) ELSE c_custkey END AS size
    FROM (SELECT DISTINCT c_custkey FROM customer)
    """,
)
def fetched_csv(spark, sf_dir):
    """Texts of a CSV payload arrive as they were, and gaps as NULL."""
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("symbol"))
    schema = struct_of(symbol=T.StringType(), label=T.StringType(), size=T.LongType())
    rows = fetch(item_units(keys, "symbol"), _padded, schema)
    gaps = F.coalesce("label", F.lit("none")).alias("label"), F.coalesce("size", F.lit(-1)).alias("size")
    return rows.select("symbol", *gaps)


@query(
    "standardize_fetched",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS symbol, strftime(o_orderdate, '%Y%m%d') AS trade_date,
           o_totalprice AS close FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1999-12-31'
    """,
)
def standardized(spark, sf_dir):
    """Rename, project, coerce the date, filter the range."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("code"),
        dashed_date(F.col("o_orderdate")).alias("day"),
        F.col("o_totalprice").alias("last"),
    )
    return standardize(
        orders,
        {"code": "symbol", "day": "trade_date", "last": "close", "first": "open"},
        ["symbol", "trade_date", "open", "close"],
        start="1996-01-01",
        end="1999-12-31",
        compact=True,
    )


def _prices(symbol, start_date, end_date):
    """A user function: one row per unit, and a second one that repeats its key."""
    import pandas as pd

    day = start_date.replace("-", "")
    return pd.DataFrame(
        {
            "symbol": [symbol, symbol],
            "trade_date": [day, day],
            "value": [len(symbol), int(end_date[-2:])],
        }
    )


@query(
    "ingest_flow",
    """
    WITH items AS (SELECT DISTINCT p_brand AS item FROM part),
         span AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
                  FROM orders),
         months AS (SELECT s, e, CAST(unnest(generate_series(date_trunc('month', s), e,
                           INTERVAL 1 MONTH)) AS DATE) AS m FROM span)
    SELECT item AS symbol, strftime(greatest(m, s), '%Y%m%d') AS trade_date,
           CAST(day(least(last_day(m), e)) AS BIGINT) AS value,
           strftime(greatest(m, s), '%Y-%m-%d') AS dt
    FROM items CROSS JOIN months
    """,
)
def ingest_flow(spark, sf_dir):
    """Brands x months fetched on the executors, deduplicated, published by date."""
    span = (
        table(spark, sf_dir, "orders")
        .agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
        .select(dashed_date(F.col("s")), dashed_date(F.col("e")))
        .first()
    )

    def units(spark, start, end):
        brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol"))
        return with_chunks(item_units(brands, "symbol"), start, end, "month")

    schema = struct_of(symbol=T.StringType(), trade_date=T.StringType(), value=T.LongType())
    source = IngestSource(
        "prices", units, _prices, schema, ["symbol", "trade_date"], "trade_date", "parquet"
    )
    root = scratch_path(spark, "lake")
    result = ingest(spark, source, root, start=span[0], end=span[1])
    return scan_table(spark, f"{root}/raw/prices", result.report.schema)


@query("backfill_date_model_set", _DAILY_ORACLE.replace("max(value)", "count(DISTINCT user_id) AS users, max(value)").replace("1, 4", "1, 5"))
def date_model_as_set(spark, sf_dir):
    """A model written for one date, run for ten dates in one job."""
    sql = """
        SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users, max(value) AS max_value, '${PARTITION_DATE}' AS dt
        FROM tmp_events WHERE dt = '${PARTITION_DATE}' GROUP BY event_type
    """
    target = fresh_table(spark, "daily_events")
    model = Model("daily_events", sql, inputs={"tmp_events": _events_input(sf_dir)})
    report = backfill(spark, model, target, "2024-01-03", "2024-01-12")
    if (report.form, report.jobs) != ("set", 1):
        raise AssertionError(f"The model ran as {report.form}: {report.why_loop}")
    return scan_table(spark, target.path, report.schema)
