"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import scratch_path

#: Rows in one Arrow batch. Bounds a Python worker's memory together with the longest text.
BATCH_ROWS = 1000
_sent: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The whole text; NULL counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def carried(df: DataFrame, outputs: Iterable[str]) -> list[str]:
    """Input columns to keep: those that do not clash with a result column, whatever the case."""
    taken = {name.lower() for name in outputs}
    return [name for name in df.columns if name.lower() not in taken]


def fresh(df: DataFrame, stem: str) -> str:
    """A name like ``stem`` that no column of the frame has, whatever the case."""
    taken = {name.lower() for name in df.columns}
    return next(name for name in (f"{stem}{k}" for k in range(len(taken) + 1)) if name.lower() not in taken)


def keeps_inner_names_apart(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators whose inner columns begin with an underscore: the caller's columns so called go through under other
    names and have their own again in the result. Arguments may name them.
    """

    @wraps(operator)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        own = [name for name in df.columns if name.startswith("_")]
        stem = fresh(df, "carried")
        others = {name: f"{stem}_{k}" for k, name in enumerate(own)}
        if not own:
            return operator(df, *args, **kwargs)
        told = {name.lower(): other for name, other in others.items()}

        def renamed(value):
            return told.get(value.lower(), value) if isinstance(value, str) else value

        done = operator(df.withColumnsRenamed(others), *map(renamed, args), **{k: renamed(v) for k, v in kwargs.items()})
        return done.withColumnsRenamed({other: name for name, other in others.items()})

    return run


def prepare_workers(spark: SparkSession) -> None:
    """Send this package to the workers, once for each application, and keep Arrow batches small: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="lakeops-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)


def slices(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges ``first, last`` (exclusive) of consecutive texts with at most so many characters together, or of one text."""
    return spans(map(len, texts), most)


def spans(lengths: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """The same from the lengths of the texts."""
    first = held = at = 0
    for at, length in enumerate(lengths, 1):
        if at - 1 > first and held + length > most:
            yield first, at - 1
            first, held = at - 1, 0
        held += length
    if at:
        yield first, at


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: recomputed by no later job."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the files behind a frame made by :func:`written`, once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        location = jvm.org.apache.hadoop.fs.Path(folder)
        location.getFileSystem(conf).delete(location, True)


def fold(column: str, remainder: int, modulus: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; a NULL key never does."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
