"""Jobs whose tasks fail once and are run again, in a session that allows retries."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from pyspark.sql import types as T
from lakeops.operators.publish import LakeTable, publish_partitions
from lakeops.operators.units import item_units
from lakeops.plans.ingest import IngestSource, ingest
from lakeops.session import local_session
from lakeops.sources.scan import scan_table
from lakeops.sources.schemas import struct_of

spark = local_session("retries", "4,3")
spark.sparkContext.setLogLevel("OFF")


def fail_first(batches):
    from pyspark import TaskContext

    for batch in batches:
        yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("executor lost")


rows = spark.range(0, 4000, 1, 4).selectExpr("id", "concat('2024-01-0', id % 3 + 1) AS dt")
for rebalance in (True, False):
    flaky = rows.mapInPandas(fail_first, rows.schema)
    table = LakeTable({lake!r}, "ods", f"t{{rebalance}}")
    report = publish_partitions(flaky, table, rebalance=rebalance)
    assert report.row_count == 4000, report
    read = scan_table(spark, table.path, rows.schema)
    assert read.agg(F.count_distinct("id"), F.count("id")).first()[:] == (4000, 4000)


def flaky_fetch(symbol):
    import pandas as pd
    from pyspark import TaskContext

    if TaskContext.get().attemptNumber() == 0 and symbol.endswith("3"):
        raise RuntimeError("source unreachable")
    return pd.DataFrame({{"symbol": [symbol], "trade_date": ["20240105"]}})


source = IngestSource(
    "flaky",
    lambda s, a, b: item_units(s.range(40).select(F.col("id").alias("symbol"))),
    flaky_fetch,
    struct_of(symbol=T.StringType(), trade_date=T.StringType()),
    ["symbol"],
    "trade_date",
    "parquet",
)
result = ingest(spark, source, {lake!r}, run_date="2024-01-06")
assert (result.status, result.fetched_rows, result.report.row_count) == ("ok", 40, 40), result
print("all rows once")
"""


def test_retried_tasks_count_once(tmp_path):
    repo = str(Path(__file__).resolve().parents[1])
    script = SCRIPT.format(repo=repo, lake=str(tmp_path / "lake"))
    done = subprocess.run(
        [sys.executable, "-c", script], capture_output=True, text=True, timeout=300, cwd=tmp_path
    )
    assert "all rows once" in done.stdout, done.stdout[-2000:] + done.stderr[-4000:]
