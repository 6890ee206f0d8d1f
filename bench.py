"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is timed to full materialisation (``noop`` sink, so no rows pass through the
driver); the best of three runs counts, of two for the backfill as one job and as a loop.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeops.plans.backfill import backfill  # noqa: E402
from lakeops.plans.models import Model  # noqa: E402
from lakeops.session import local_session  # noqa: E402
from lakeops.sources.scan import scan_table  # noqa: E402
from workload import QUERIES  # noqa: E402
from workload.common import fresh_table  # noqa: E402
from workload.jobs import DAILY_SQL, _events_input, daily_model  # noqa: E402

HEADLINE = [
    "dedup_latest",
    "dedup_hot_key",
    "compact_partitions",
    "publish_readback",
    "publish_csv_readback",
    "skip_existing",
    "ods_history",
    "normalize_dt",
    "calendar_dim",
    "partition_counts",
    "csv_payload_explode",
    "chunk_ranges_month_end",
    "work_unit_product",
    "fetch_units",
    "ingest_flow",
    "backfill_summary",
    "model_sql_params",
    "model_over_raw_csv",
    "publish_by_copy",
    "layer_view",
    "declared_table",
]

FIRST, LAST = "2024-01-01", "2024-01-30"


def backfill_set_based(spark, sf_dir):
    """Thirty dates in one job."""
    target = fresh_table(spark, "daily_events")
    backfill(spark, daily_model(sf_dir), target, FIRST, LAST)
    return scan_table(spark, target.path)


def backfill_per_date(spark, sf_dir):
    """The same thirty dates as a loop, one job per date."""
    sql = DAILY_SQL.replace("BETWEEN :start_date AND :end_date", "= :partition_date")
    target = fresh_table(spark, "daily_events")
    model = Model("daily_events", sql, inputs={"tmp_events": _events_input(sf_dir)})
    backfill(spark, model, target, FIRST, LAST)
    return scan_table(spark, target.path)


def timed(run) -> float:
    began = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    jobs = {name: QUERIES[name] for name in HEADLINE}
    jobs["backfill_30_dates_one_job"] = backfill_set_based
    jobs["backfill_30_dates_loop"] = backfill_per_date
    seconds = {}
    for name, job in jobs.items():
        # The loop gets the same treatment as the job it is compared with.
        repeats = 2 if name.startswith("backfill_30_dates") else 3
        runs = [timed(lambda job=job: job(spark, sf_dir)) for _ in range(repeats)]
        seconds[name] = round(min(runs), 3)
        print(f"{name:28} {seconds[name]:8.3f}s", file=sys.stderr)
    total = sum(s for name, s in seconds.items() if name != "backfill_30_dates_loop")
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
