"""A look at the head or the footer of every file of a source, as one Spark job.

Spark lists the files and deals them out; a task opens its files and reads a few kilobytes of each. Tasks can open what
pyarrow knows. For any other store the callers have a way that uses Spark's own readers alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Location schemes that tasks can open themselves (fixed values).
OPENED_BY_TASKS = ("file", "hdfs", "s3", "s3a", "s3n", "gs", "abfs", "abfss")


def data_files(spark: SparkSession, paths: Sequence[str], fmt: str) -> DataFrame:
    """``path`` of every file of the format below the paths; only listed, nothing is read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{fmt}")
        .option("recursiveFileLookup", "true")
        .load(list(paths))
        .select("path")
    )


def opened_by_tasks(paths: Sequence[str]) -> bool:
    schemes = {p.split(":", 1)[0].lower() if ":" in p.split("/", 1)[0] else "file" for p in paths}
    return schemes <= set(OPENED_BY_TASKS)


def seen_in_files(listing: DataFrame, look: Callable[[object, str], str]) -> DataFrame:
    """``path, seen``: what ``look(filesystem, path)`` says about each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import quote

        import pyarrow as arrow
        from pyarrow import fs

        stores: dict[str, object] = {}
        for batch in batches:
            paths, seen = batch.column("path").to_pylist(), []
            for path in paths:
                scheme, _, rest = path.partition(":")
                if not rest or "/" in scheme:
                    scheme, rest = "file", path
                if scheme == "file":
                    store, place = stores.setdefault("file", fs.LocalFileSystem()), "/" + rest.lstrip("/")
                else:
                    root = rest.lstrip("/").split("/", 1)[0]
                    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
                    if f"{known}://{root}" not in stores:
                        stores[f"{known}://{root}"] = fs.FileSystem.from_uri(f"{known}://{root}")[0]
                    store = stores[f"{known}://{root}"]
                    place = fs.FileSystem.from_uri(f"{known}://" + quote(rest.lstrip("/"), safe="/=@:"))[1]
                seen.append(look(store, place))
            yield arrow.RecordBatch.from_arrays([arrow.array(paths), arrow.array(seen, arrow.string())], names=["path", "seen"])

    return listing.mapInArrow(run, "path string, seen string")
