"""Queries that publish a table to the shared folder and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.checks import partition_files
from lakeops.operators.manifest import latest_manifest
from lakeops.operators.normalize import key_problem
from lakeops.operators.publish import (
    LakeTable,
    PartitionExistsError,
    clear_partitions,
    publish_partitions,
    publish_snapshot,
    read_quarantine,
    reconcile,
    write_partitioned,
    write_single_file,
    write_snapshot,
)
from lakeops.plans.compact import compact
from lakeops.plans.models import landing_model
from lakeops.plans.views import Entry, add_partitions, create_databases, register, register_all
from lakeops.session import scratch_path
from lakeops.sources import files
from lakeops.sources.scan import (
    dates_with_files,
    scan_parts,
    scan_partition,
    scan_raw_csv,
    scan_reference_list,
    scan_snapshot,
    scan_table,
    scan_table_nested,
)
from lakeops.sources.schemas import SCHEMAS
from workload import query
from workload.common import EVENT_COLUMNS, dated_events, fresh_table, table

_EVENTS = (
    "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS dt FROM events"
)


def _published(spark, sf_dir, fmt="parquet"):
    """A fresh table holding all events, and the frame it was made from."""
    target = fresh_table(spark, "events", fmt)
    events = dated_events(spark, sf_dir)
    publish_partitions(events, target)
    return target, events


def _event_parts(spark, sf_dir):
    """Two overlapping parts: all events, then the clicks again with value + 1."""
    base = scratch_path(spark, "parts")
    events = table(spark, sf_dir, "events").drop("props")
    clicks = events.where("event_type = 'click'").withColumn("value", F.col("value") + 1)
    paths = [f"{base}/part_000000.parquet", f"{base}/part_000001.parquet"]
    events.write.parquet(paths[0])
    clicks.write.parquet(paths[1])
    return scan_parts(spark, *paths, schema=events.schema)


def compact_events(spark, sf_dir):
    """Overlapping parts compacted into a dated table, read back."""
    target = fresh_table(spark, "events")
    parts = _event_parts(spark, sf_dir)
    report = compact(parts, target, keys=["event_id"], partition_column="ts")
    return scan_table(spark, target.path, report.schema)


@query(
    "compact_partitions",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS row_count,
           max(CASE WHEN event_type = 'click' THEN value + 1 ELSE value END) AS max_value
    FROM events GROUP BY 1
    """,
)
def compacted_counts(spark, sf_dir):
    return compact_events(spark, sf_dir).groupBy("dt").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("value").alias("max_value")
    )


@query(
    "dedup_last_part",
    """
    SELECT event_id, user_id, event_type,
           CASE WHEN event_type = 'click' THEN value + 1 ELSE value END AS value
    FROM events
    """,
)
def last_part(spark, sf_dir):
    return compact_events(spark, sf_dir).select("event_id", "user_id", "event_type", "value")


@query("publish_readback", _EVENTS)
def readback(spark, sf_dir):
    target, events = _published(spark, sf_dir)
    return scan_table(spark, target.path, events.schema)


@query("publish_by_copy", _EVENTS)
def readback_copy(spark, sf_dir):
    """Published twice by Spark's writer instead of renames."""
    target = fresh_table(spark, "events")
    events = dated_events(spark, sf_dir)
    publish_partitions(events.withColumn("value", F.lit(0.0)), target, copy=True)
    publish_partitions(events, target, copy=True)
    return scan_table(spark, target.path, events.schema)


@query("publish_rerun", _EVENTS + " WHERE event_type <> 'view'")
def rerun(spark, sf_dir):
    """The same run twice, with rejected rows: the second time replaces the first."""
    target = fresh_table(spark, "events")
    events = dated_events(spark, sf_dir)
    keyed = events.withColumn("dt", F.when(F.col("event_type") != "view", F.col("dt")))
    for value in (F.lit(0.0), F.col("value")):
        publish_partitions(keyed.withColumn("value", value), target, run_id="nightly/1")
    return scan_table(spark, target.path, events.schema)


@query("snapshot_by_copy", "SELECT * FROM customer")
def snapshot_copied(spark, sf_dir):
    """A snapshot replaced by Spark's writer instead of renames."""
    target = fresh_table(spark, "customer")
    customer = table(spark, sf_dir, "customer")
    publish_snapshot(customer.where("c_acctbal > 0"), target, copy=True)
    publish_snapshot(customer, target, copy=True)
    return scan_snapshot(spark, target.path)


@query(
    "publish_csv_readback",
    """
    SELECT doc_id, text, lang, n_chars, source AS source,
           '2024-01-05' AS dt FROM documents
    """,
)
def csv_readback(spark, sf_dir):
    """Whole texts through CSV: quotes, commas, line breaks and blanks survive."""
    target = fresh_table(spark, "documents", "csv")
    documents = table(spark, sf_dir, "documents").withColumn("dt", F.lit("2024-01-05"))
    publish_partitions(documents, target)
    rows = scan_raw_csv(
        spark,
        target.path,
        ["doc_id", "text", "lang", "source", "n_chars"],
        dates_with_files(spark, target.path, "csv"),
        expose_dt=True,
        multiline=True,
    )
    return rows.withColumns(
        {"doc_id": F.col("doc_id").cast("long"), "n_chars": F.col("n_chars").cast("long")}
    )


@query(
    "overwrite_one_dt",
    _EVENTS + " WHERE strftime(ts, '%Y-%m-%d') <> '2024-01-05' OR event_type = 'click'",
)
def overwrite_one(spark, sf_dir):
    target, events = _published(spark, sf_dir)
    publish_partitions(events.where("dt = '2024-01-05' AND event_type = 'click'"), target)
    return scan_table(spark, target.path, events.schema)


@query(
    "skip_existing",
    """
    SELECT event_id, user_id, event_type,
           CASE WHEN strftime(ts, '%Y-%m-%d') <= '2024-01-10' THEN value ELSE value + 100 END
             AS value,
           strftime(ts, '%Y-%m-%d') AS dt
    FROM events
    """,
)
def skip_existing(spark, sf_dir):
    target = fresh_table(spark, "events")
    events = dated_events(spark, sf_dir)
    publish_partitions(events.where("dt <= '2024-01-10'"), target)
    raised = events.withColumn("value", F.col("value") + 100)
    publish_partitions(raised, target, mode="skip_existing")
    return scan_table(spark, target.path, events.schema)


@query(
    "fail_if_exists_check",
    "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt FROM events "
    "WHERE strftime(ts, '%Y-%m-%d') <= '2024-01-10'",
)
def fail_if_exists(spark, sf_dir):
    """The colliding dates; the refused run leaves everything as it was."""
    target = fresh_table(spark, "events")
    events = dated_events(spark, sf_dir)
    publish_partitions(events.where("dt <= '2024-01-10'"), target)
    try:
        publish_partitions(events, target, mode="fail_if_exists")
    except PartitionExistsError:
        present = scan_table(spark, target.path, events.schema).select("dt").distinct()
        return present.join(target.completed(spark), "dt", "left_semi")
    raise AssertionError("fail_if_exists accepted existing partitions")


@query("clear_empty_dates", _EVENTS + " WHERE strftime(ts, '%Y-%m-%d') <> '2024-01-07'")
def clear_empty(spark, sf_dir):
    """A requested date without rows loses its old data."""
    target, events = _published(spark, sf_dir)
    quiet = events.where("dt <> '2024-01-07'")
    publish_partitions(quiet, target, requested=["2024-01-06", "2024-01-07"])
    return scan_table(spark, target.path, events.schema)


@query(
    "completed_after_clear",
    "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt FROM events "
    "WHERE strftime(ts, '%Y-%m-%d') NOT IN ('2024-01-07', '2024-01-09')",
)
def completed(spark, sf_dir):
    target, _ = _published(spark, sf_dir)
    clear_partitions(spark, target, ["2024-01-07", "2024-01-09", "1999-12-31"])
    return target.completed(spark)


@query("snapshot_publish", "SELECT * FROM customer")
def snapshot(spark, sf_dir):
    target = fresh_table(spark, "customer")
    customer = table(spark, sf_dir, "customer")
    publish_snapshot(customer.where("c_acctbal > 0"), target)
    publish_snapshot(customer, target)
    return scan_snapshot(spark, target.path)


@query("snapshot_csv", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def snapshot_csv(spark, sf_dir):
    path = scratch_path(spark, "suppliers")
    write_snapshot(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), path, "csv")
    return scan_snapshot(spark, path, "csv")


@query(
    "manifest_latest",
    """
    SELECT 'ods.events' AS dest, strftime(ts, '%Y-%m-%d') AS partition_date, count(*) AS row_count,
           CAST(1 AS BIGINT) AS file_count, 'success' AS status
    FROM events
    WHERE strftime(ts, '%Y-%m-%d') <> '2024-01-05' OR event_type = 'click' GROUP BY 1, 2
    """,
)
def manifest(spark, sf_dir):
    """One state per partition although one date was published twice."""
    target, events = _published(spark, sf_dir)
    publish_partitions(events.where("dt = '2024-01-05' AND event_type = 'click'"), target)
    return latest_manifest(target.manifest(spark)).select(
        "dest", "partition_date", "row_count", "file_count", "status"
    )


@query(
    "partition_files",
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS row_count, CAST(1 AS BIGINT) AS file_count, "
    "true AS has_bytes FROM events GROUP BY 1",
)
def file_metrics(spark, sf_dir):
    target, events = _published(spark, sf_dir)
    files = partition_files(scan_table(spark, target.path, events.schema))
    return files.select("dt", "row_count", "file_count", (F.col("byte_count") > 0).alias("has_bytes"))


@query(
    "single_file_per_partition",
    "SELECT event_type, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS row_count "
    "FROM events GROUP BY 1, 2",
)
def single_file(spark, sf_dir):
    path = scratch_path(spark, "single")
    write_single_file(dated_events(spark, sf_dir), path)
    return scan_table(spark, path).groupBy("event_type", "dt").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query("scan_partition", _EVENTS + " WHERE strftime(ts, '%Y-%m-%d') = '2024-01-05'")
def one_partition(spark, sf_dir):
    target, events = _published(spark, sf_dir)
    return scan_partition(spark, target.path, "2024-01-05", events.schema)


def _database(spark, target):
    """A database of its own beside the lake, and its name."""
    name = f"ods_{target.root.rsplit('-', 1)[-1]}"
    create_databases(spark, [name], f"{target.root}/databases")
    return name


@query("scan_partition_function", _EVENTS + " WHERE strftime(ts, '%Y-%m-%d') = '2024-01-05'")
def one_by_function(spark, sf_dir):
    """Database, catalog table and table function over a published table."""
    target, events = _published(spark, sf_dir)
    database = _database(spark, target)
    register(spark, database, Entry(target, events.schema))
    return spark.sql(f"SELECT * FROM {database}_events_dt('2024-01-05')")


@query(
    "partition_function_two_layers",
    "SELECT 'ods' AS layer, count(*) AS row_count FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-05' "
    "UNION ALL SELECT 'dwd', count(*) FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-05' AND event_type = 'click'",
)
def two_layers(spark, sf_dir):
    """Two layers with a table of the same name: each function reads its own."""
    target, events = _published(spark, sf_dir)
    other = LakeTable(target.root, "dwd", "events")
    publish_partitions(events.where("event_type = 'click'"), other)
    names = {layer: f"{layer}_{target.root.rsplit('-', 1)[-1]}" for layer in ("ods", "dwd")}
    entries = {names["ods"]: [Entry(target, events.schema)], names["dwd"]: [Entry(other, events.schema)]}
    register_all(spark, entries, f"{target.root}/databases")
    counts = [f"SELECT '{k}' AS layer, count(*) AS row_count FROM {v}_events_dt('2024-01-05')" for k, v in names.items()]
    return spark.sql(" UNION ALL ".join(counts))


@query(
    "layer_view",
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type, count(*) AS row_count FROM events "
    "GROUP BY 1, 2",
)
def layer_view(spark, sf_dir):
    target, events = _published(spark, sf_dir)
    database = _database(spark, target)
    register(spark, database, Entry(target, events.schema))
    return spark.sql(f"SELECT dt, event_type, count(*) AS row_count FROM {database}.events GROUP BY ALL")


@query("view_nested", _EVENTS)
def doubled_view(spark, sf_dir):
    """A view over the layout dt=X/dt=X/file, and its partition function."""
    events = dated_events(spark, sf_dir)
    target = fresh_table(spark, "events")
    path = scratch_path(spark, "doubled")
    write_partitioned(events.withColumn("outer", F.col("dt")), path, ("outer", "dt"))
    for found in files.glob(spark, f"{path}/outer=*"):
        files.move(spark, found, f"{target.path}/dt={found.rsplit('=', 1)[1]}")
    database = _database(spark, target)
    return register(spark, database, Entry(target, events.schema, doubled=True)).select(*EVENT_COLUMNS)


@query("scan_table_nested", _EVENTS)
def nested(spark, sf_dir):
    """The layout dt=X/dt=X/file, as left by writing a dated table into a dated directory."""
    events = dated_events(spark, sf_dir)
    path = scratch_path(spark, "nested")
    twice = events.withColumn("dt_inner", F.col("dt"))
    write_partitioned(twice, path, ("dt", "dt_inner"))
    schema = T.StructType([f for f in events.schema.fields if f.name != "dt"])
    return scan_table_nested(spark, path, schema).select(*EVENT_COLUMNS)


@query(
    "scan_evolved_table",
    """
    SELECT event_id, value, CASE WHEN strftime(ts, '%Y-%m-%d') <= '2024-01-10' THEN 'none'
           ELSE props END AS props, strftime(ts, '%Y-%m-%d') AS dt FROM events
    """,
)
def evolved(spark, sf_dir):
    """Older partitions lack a column; it reads as NULL there."""
    target = fresh_table(spark, "events")
    events = table(spark, sf_dir, "events").select(
        "event_id", "value", "props", F.date_format("ts", "yyyy-MM-dd").alias("dt")
    )
    publish_partitions(events.where("dt <= '2024-01-10'").drop("props"), target)
    publish_partitions(events.where("dt > '2024-01-10'"), target)
    rows = scan_table(spark, target.path)
    return rows.select("event_id", "value", F.coalesce("props", F.lit("none")).alias("props"), "dt")


@query(
    "scan_raw_csv_evolved",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
           CASE WHEN strftime(ts, '%Y-%m-%d') > '2024-01-20' THEN CAST(user_id AS VARCHAR) ELSE 'none' END AS user_id,
           strftime(ts, '%Y-%m-%d') AS dt FROM events
    """,
)
def raw_evolved(spark, sf_dir):
    """A raw source whose header gains a column and changes its order; each date is read by its own."""
    target = fresh_table(spark, "events", "csv")
    events = dated_events(spark, sf_dir)
    publish_partitions(events.where("dt <= '2024-01-10'").select("event_id", "event_type", "dt"), target)
    publish_partitions(events.where("dt BETWEEN '2024-01-11' AND '2024-01-20'").select("event_type", "event_id", "dt"), target)
    publish_partitions(events.where("dt > '2024-01-20'").select("user_id", "event_type", "event_id", "dt"), target)
    rows = scan_raw_csv(spark, target.path, ["event_id", "event_type", "user_id"], expose_dt=True)
    return rows.withColumn("user_id", F.coalesce("user_id", F.lit("none")))


@query(
    "scan_raw_csv",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, strftime(ts, '%Y-%m-%d') AS dt
    FROM events WHERE strftime(ts, '%Y-%m-%d') IN ('2024-01-02', '2024-01-29')
    """,
)
def raw_dates(spark, sf_dir):
    """Only the directories of the wanted dates are read; absent ones do no harm."""
    target, _ = _published(spark, sf_dir, "csv")
    wanted = ["2024-01-02", "2024-01-29", "2031-01-01"]
    columns = ["event_id", "user_id", "event_type", "value"]
    rows = scan_raw_csv(spark, target.path, columns, wanted, expose_dt=True)
    return rows.select("event_id", "event_type", "dt")


@query(
    "quarantine_invalid_dt",
    """
    SELECT CASE WHEN event_type = 'error' THEN 'missing' ELSE 'invalid' END AS reason,
           count(*) AS row_count FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1
    """,
)
def quarantined(spark, sf_dir):
    """Rows without a usable key are kept apart and counted, the others published."""
    target = fresh_table(spark, "events")
    key = (
        F.when(F.col("event_type") == "error", "")
        .when(F.col("event_type") == "signup", "not a date")
        .otherwise(F.date_format("ts", "yyyyMMdd"))
    )
    events = table(spark, sf_dir, "events").select("event_id", key.alias("trade_date"))
    compact(events, target, keys=["event_id"], partition_column="trade_date")
    kept = read_quarantine(spark, target, events.schema)
    return (
        kept.select(key_problem(kept, "trade_date").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "ods_history",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS trade_date,
           l_extendedprice AS open, l_extendedprice AS high, l_tax AS low, l_extendedprice AS close,
           l_quantity AS volume, l_extendedprice AS amount, l_discount AS amplitude,
           l_discount AS change_percent, l_tax AS change_amount, l_tax AS turnover_rate,
           '2024-01-31' AS dt
    FROM lineitem
    """,
)
def typed_history(spark, sf_dir):
    """Raw CSV to the typed price history: text symbol, compact date, doubles."""
    target = fresh_table(spark, "fund_etf_history", "csv")
    c = F.col
    raw = table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").cast("string").alias("symbol"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("trade_date"),
        c("l_extendedprice").alias("open"),
        c("l_extendedprice").alias("close"),
        c("l_extendedprice").alias("high"),
        c("l_tax").alias("low"),
        c("l_quantity").alias("volume"),
        c("l_extendedprice").alias("amount"),
        c("l_discount").alias("amplitude"),
        c("l_discount").alias("change_percent"),
        c("l_tax").alias("change_amount"),
        c("l_tax").alias("turnover_rate"),
        F.lit("2024-01-31").alias("dt"),
    )
    publish_partitions(raw, target)
    # The files order their columns differently from the declared schema, and numbers
    # and dates hold no line breaks, so Spark may split the files.
    declared = SCHEMAS["ods_fund_etf_history"]
    scan_raw_csv(
        spark, target.path, declared, ["2024-01-31"], multiline=False, view="tmp_history"
    )
    return landing_model(spark.table("tmp_history"), "ods_fund_etf_history", "2024-01-31")


@query(
    "ods_trade_dates",
    """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date,
           strftime(o_orderdate, '%Y') || '-12-31' AS dt FROM orders
    """,
)
def typed_trade_dates(spark, sf_dir):
    """A range of raw partitions typed in one job, dt taken from the directories."""
    target = fresh_table(spark, "trade_date_hist", "csv")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, sf_dir, "orders").select(
        day.alias("trade_date"), F.date_format("o_orderdate", "yyyy-12-31").alias("dt")
    )
    publish_partitions(orders.distinct(), target)
    rows = scan_raw_csv(spark, target.path, ["trade_date"], expose_dt=True)
    return landing_model(rows, "ods_trade_date_hist")


@query(
    "ods_spot",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS symbol, p_name AS name, p_retailprice AS amount,
           DATE '2024-01-05' AS trade_date, '2024-01-05' AS dt FROM part
    """,
)
def typed_spot(spark, sf_dir):
    """Digit-only symbols stay text, amounts become doubles."""
    target = fresh_table(spark, "fund_etf_spot", "csv")
    raw = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("amount"),
        F.lit("20240105").alias("trade_date"),
    )
    compact(raw, target, keys=["symbol", "trade_date"], partition_column="trade_date")
    rows = scan_raw_csv(spark, target.path, raw.columns, ["2024-01-05"])
    return landing_model(rows, "ods_fund_etf_spot", "2024-01-05")


@query(
    "ods_whitelist",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS name,
           CAST(s_acctbal > 0 AS INTEGER) AS enabled, DATE '2024-01-05' AS trade_date,
           '2024-01-06' AS dt FROM supplier
    """,
)
def typed_whitelist(spark, sf_dir):
    """A list stored under its run date, one row per symbol."""
    target = fresh_table(spark, "etf_universe_whitelist", "csv")
    listed = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("symbol"),
        F.col("s_name").alias("name"),
        (F.col("s_acctbal") > 0).cast("int").alias("enabled"),
        F.lit("20240105").alias("trade_date"),
    )
    compact(listed, target, keys=["symbol"], run_date="2024-01-06")
    rows = scan_raw_csv(spark, target.path, listed.columns, ["2024-01-06"])
    return landing_model(rows, "ods_etf_universe_whitelist", "2024-01-06")


@query(
    "declared_table",
    "SELECT event_type, max(value) AS max_value, strftime(ts, '%Y-%m-%d') AS dt FROM events "
    "GROUP BY 1, 3",
)
def declared_table(spark, sf_dir):
    """A catalog table with declared columns; new dates are added to it."""
    target = fresh_table(spark, "events")
    events = dated_events(spark, sf_dir)
    publish_partitions(events.where("dt <= '2024-01-10'"), target)
    database = _database(spark, target)
    register(spark, database, Entry(target, events.schema))
    later = publish_partitions(events.where("dt > '2024-01-10'"), target)
    add_partitions(spark, database, "events", [p["dt"] for p in later.partitions])
    return spark.sql(f"SELECT event_type, max(value) AS max_value, dt FROM {database}.events GROUP BY ALL")


@query(
    "reference_list",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS name, '1' AS enabled,
           '20240105' AS trade_date FROM supplier
    """,
)
def reference_list(spark, sf_dir):
    path = scratch_path(spark, "list")
    listed = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("symbol"), F.col("s_name").alias("name"), F.lit(1).alias("enabled")
    )
    write_snapshot(listed, path, "csv")
    return scan_reference_list(spark, path, "20240105")


@query(
    "scan_type_drift",
    """
    SELECT event_id,
           CASE WHEN strftime(ts, '%Y-%m-%d') <= '2024-01-10' THEN CAST(user_id AS VARCHAR)
                WHEN strftime(ts, '%Y-%m-%d') <= '2024-01-20' THEN CAST(user_id AS VARCHAR) || '.5'
                ELSE 'u' || CAST(user_id AS VARCHAR) END AS user_id,
           CASE WHEN strftime(ts, '%Y-%m-%d') <= '2024-01-10' THEN value
                ELSE floor(value) END AS value,
           strftime(ts, '%Y-%m-%d') AS dt
    FROM events WHERE strftime(ts, '%Y-%m-%d') <> '2024-01-15'
    """,
)
def type_drift(spark, sf_dir):
    """One column as BIGINT, DOUBLE and VARCHAR in three thirds of the dates, another as DOUBLE and BIGINT."""
    target = fresh_table(spark, "events")
    events, user = dated_events(spark, sf_dir), F.col("user_id")
    thirds = [
        ("dt <= '2024-01-10'", user.cast("long"), F.col("value")),
        ("dt BETWEEN '2024-01-11' AND '2024-01-20'", user + F.lit(0.5), F.floor("value")),
        ("dt > '2024-01-20'", F.concat(F.lit("u"), user.cast("string")), F.floor("value").cast("int")),
    ]
    for some, as_stored, value in thirds:
        publish_partitions(events.where(some).select("event_id", as_stored.alias("user_id"), value.alias("value"), "dt"), target)
    return scan_table(spark, target.path).where("dt <> '2024-01-15'")


@query(
    "parts_type_drift",
    """
    SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN floor(value) + 1
                                   WHEN event_type = 'error' THEN floor(value) + 0.25 ELSE value END AS value,
           strftime(ts, '%Y-%m-%d') AS dt FROM events
    """,
)
def part_type_drift(spark, sf_dir):
    """Parts of one run that store a column as DOUBLE, BIGINT and VARCHAR, compacted in its declared type."""
    base = scratch_path(spark, "parts")
    events = dated_events(spark, sf_dir).select("event_id", "user_id", "value", "dt", "event_type")
    whole = F.floor("value")
    parts = [
        events,
        events.where("event_type = 'click'").withColumn("value", whole + 1),
        events.where("event_type = 'error'").withColumn("value", F.concat(whole.cast("string"), F.lit(".25"))),
    ]
    for number, part in enumerate(parts):
        part.drop("event_type").write.parquet(f"{base}/part_{number:06d}.parquet")
    target = fresh_table(spark, "events")
    declared = events.drop("event_type").schema
    report = compact(scan_parts(spark, base, schema=declared, mixed_types=True), target, keys=["event_id"], partition_column="dt")
    return scan_table(spark, target.path, report.schema)


@query(
    "scan_raw_csv_mixed_headers",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
           CASE WHEN event_type IN ('view', 'error') THEN CAST(user_id AS VARCHAR) ELSE 'none' END AS user_id,
           strftime(ts, '%Y-%m-%d') AS dt FROM events
    """,
)
def raw_mixed_headers(spark, sf_dir):
    """Each date holds files with three headers, as several writers left them; each file is read by its own."""
    events = dated_events(spark, sf_dir)
    target = fresh_table(spark, "events", "csv")
    writers = [
        ("event_type = 'view'", ["event_id", "user_id", "event_type"]),
        ("event_type = 'error'", ["event_type", "user_id", "event_id"]),
        ("event_type NOT IN ('view', 'error')", ["event_type", "event_id"]),
    ]
    for some, columns in writers:
        rows = events.where(some).select(*columns, "dt")
        rows.write.mode("append").option("header", "true").partitionBy("dt").csv(target.path)
    rows = scan_raw_csv(spark, target.path, ["event_id", "event_type", "user_id"], expose_dt=True)
    return rows.withColumn("user_id", F.coalesce("user_id", F.lit("none")))


@query(
    "reconcile_partitions",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS dt,
           CASE strftime(ts, '%Y-%m-%d') WHEN '2024-01-03' THEN 'files_missing' WHEN '2024-01-05' THEN 'file_count_differs'
                WHEN '2024-01-07' THEN 'unrecorded' ELSE 'ok' END AS state
    FROM events GROUP BY 1
    """,
)
def reconciled(spark, sf_dir):
    """A date whose files vanished, one with a foreign file, one that was written past the manifest."""
    target = fresh_table(spark, "events")
    events = dated_events(spark, sf_dir)
    publish_partitions(events.where("dt <> '2024-01-07'"), target)
    files.delete(spark, target.partition_path("2024-01-03"))
    events.where("dt IN ('2024-01-05', '2024-01-07')").coalesce(1).write.mode("append").partitionBy("dt").parquet(target.path)
    return reconcile(spark, target).select("dt", "state")


@query(
    "skip_existing_lost_files",
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, max(CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-03' THEN value + 100 ELSE value END) "
    "AS max_value FROM events GROUP BY 1",
)
def lost_files(spark, sf_dir):
    """A date that is recorded as complete but whose files are gone is published again."""
    target, events = _published(spark, sf_dir)
    files.delete(spark, target.partition_path("2024-01-03"))
    publish_partitions(events.withColumn("value", F.col("value") + 100), target, mode="skip_existing")
    return scan_table(spark, target.path, events.schema).groupBy("dt").agg(F.max("value").alias("max_value"))


@query(
    "snapshot_emptied",
    "SELECT 'kept' AS name, count(*) AS row_count, true AS has_files FROM customer UNION ALL SELECT 'emptied', CAST(0 AS BIGINT), false",
)
def emptied(spark, sf_dir):
    """Two snapshots of which one loses all its rows: the manifest names the other alone."""
    customer = table(spark, sf_dir, "customer")
    kept, gone = fresh_table(spark, "kept"), fresh_table(spark, "emptied")
    for target in (kept, gone):
        publish_snapshot(customer, target, run_date="2024-01-05")
    publish_snapshot(customer.where("c_custkey < 0"), gone, run_date="2024-01-06")
    rows = [
        latest_manifest(t.manifest(spark)).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
        .select(F.lit(t.name).alias("name"), "row_count", F.lit(files.exists(spark, t.path)).alias("has_files"))
        for t in (kept, gone)
    ]
    return rows[0].unionByName(rows[1])


@query(
    "compact_skip_existing",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS row_count,
           max(CASE WHEN strftime(ts, '%Y-%m-%d') <= '2024-01-10' THEN value
                    WHEN event_type = 'click' THEN value + 101 ELSE value + 100 END) AS max_value
    FROM events GROUP BY 1
    """,
)
def compact_skipping(spark, sf_dir):
    """Overlapping parts over a table that has some of the dates; the key holds the date, so the dedup never sees those."""
    target = fresh_table(spark, "events")
    events = table(spark, sf_dir, "events").drop("props")
    compact(events.where("ts < '2024-01-11'"), target, keys=["event_id", "ts"], partition_column="ts")
    base = scratch_path(spark, "parts")
    raised = events.withColumn("value", F.col("value") + 100)
    raised.write.parquet(f"{base}/part_000000.parquet")
    raised.where("event_type = 'click'").withColumn("value", F.col("value") + 1).write.parquet(f"{base}/part_000001.parquet")
    parts = scan_parts(spark, f"{base}/part_*", schema=events.schema)
    report = compact(parts, target, keys=["event_id", "ts"], partition_column="ts", mode="skip_existing")
    return scan_table(spark, target.path, report.schema).groupBy("dt").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("value").alias("max_value")
    )
