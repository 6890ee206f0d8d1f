"""Path-level helpers on Hadoop's file system API (listing and renames only).

Every call names an exact directory, never a string prefix, so clearing
``lake/dim/t`` cannot touch ``lake/dim/t_full``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, location: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    fs, path = _handle(spark, location)
    return fs.exists(path)


def delete(spark: SparkSession, location: str) -> None:
    fs, path = _handle(spark, location)
    fs.delete(path, True)


def make_dir(spark: SparkSession, location: str) -> None:
    fs, path = _handle(spark, location)
    fs.mkdirs(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a directory; the target must not exist."""
    fs, source_path = _handle(spark, source)
    target_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(target_path):
        raise FileExistsError(target)
    fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path):
        raise OSError(f"Could not move {source} to {target}")


def replace_dirs(
    spark: SparkSession,
    moves: list[tuple[str, str]],
    aside_root: str,
    on_moved: Callable[[str], None] = lambda target: None,
) -> None:
    """Put each source directory in the place of its target.

    An existing target steps aside below ``aside_root``, under its own name, first. If a
    move fails, the partition in hand gets its old content back and the error goes up; what
    was replaced before stays replaced, and ``on_moved`` was called for it.
    """
    if not moves:
        return
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    fs, aside = _handle(spark, aside_root)
    fs.mkdirs(aside)
    present: dict[str, set[str]] = {}
    for source, target in moves:
        parent, name = target.rsplit("/", 1)
        if parent not in present:
            fs.mkdirs(jvm_path(parent))
            present[parent] = {status.getPath().getName() for status in fs.listStatus(jvm_path(parent))}
        new, place, old = jvm_path(source), jvm_path(target), jvm_path(aside, name)
        had_old = name in present[parent]
        if had_old and not fs.rename(place, old):
            raise OSError(f"Could not move {target} aside")
        moved = False
        try:
            moved = fs.rename(new, place)
        finally:
            if not moved and had_old and not fs.exists(place):
                fs.rename(old, place)
        if not moved:
            raise OSError(f"Could not move {source} to {target}")
        on_moved(target)
    fs.delete(aside, True)


def put_back(spark: SparkSession, parent: str, aside_root: str) -> None:
    """Return what stepped aside and was not replaced to ``parent``; then drop the rest."""
    fs, aside = _handle(spark, aside_root)
    if not fs.exists(aside):
        return
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.listStatus(aside):
        place = jvm_path(parent, status.getPath().getName())
        if not fs.exists(place) and not fs.rename(status.getPath(), place):
            raise OSError(f"Could not put {place} back")
    fs.delete(aside, True)


def delete_all(spark: SparkSession, locations: Iterable[str]) -> None:
    """Delete exactly these locations."""
    for location in locations:
        delete(spark, location)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Locations matching a glob, as text."""
    fs, path = _handle(spark, pattern)
    found = fs.globStatus(path)
    return [] if found is None else [status.getPath().toString() for status in found]


def partition_values(spark: SparkSession, table_path: str, column: str = "dt") -> list[str]:
    """Partition values present on disk, from directory names alone."""
    marker = f"/{column}="
    return sorted(
        location.rsplit(marker, 1)[1] for location in glob(spark, f"{table_path}/{column}=*")
    )


def file_system_handles_renames(spark: SparkSession, location: str) -> bool:
    """False for object stores, where a rename copies every byte."""
    scheme = location.split("://", 1)[0].lower() if "://" in location else "file"
    return scheme not in {"s3", "s3a", "s3n", "gs", "oss", "cosn", "obs"}
