"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_scratch: list[str] = []

#: Settings the jobs in this package assume. All of them are Spark defaults or
#: safe to set on a shared cluster; none depends on the size of the data.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.shuffle.accurateBlockSkewedFactor": "5.0",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(app: str = "lakeops", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, read from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: every executor
    has to see what another one wrote.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="lakeops-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, never used twice, removed at exit."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    if not _scratch:
        atexit.register(_remove_scratch, spark._jvm)
    _scratch.append(path)
    return path


def _remove_scratch(jvm) -> None:
    """Delete this process's scratch paths; the session may be stopped already."""
    conf = None
    for path in _scratch:
        with contextlib.suppress(Exception):
            conf = conf or jvm.org.apache.hadoop.conf.Configuration()
            location = jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(conf).delete(location, True)
