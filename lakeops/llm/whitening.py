"""Embedding whitening from exact variances alone.

Polarisation: for centred values a and b, 2ab = (a + b)^2 - a^2 - b^2. So the sum of squares of every dimension, and of
the sum of every two dimensions, gives all cross-covariances. Components are whole numbers, and so are these sums: tasks
add them up exactly, Spark adds up what the tasks found, and the covariance matrix is rounded once, at the end.

Values are centred at the whole number nearest to the mean, which keeps squares small; what is left of the mean is a
fraction of exactly known size and is taken out of the sums exactly.

Vectors of one length are one space; each length is fitted and whitened by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import carried, prepare_workers, written

#: Whole numbers from components: floor(SCALE * x) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Larger scaled components count as this.
PEAK = float(2**53)
#: Rows of a step of numpy work.
STEP = 2_048
#: Largest whole number that decimal(38, 0) holds.
WIDE = 10**38 - 1

SUMS = "size int, place int, total decimal(38,0)"
_SUMS = pa.schema([("size", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0))])


@dataclass
class Space:
    """What was learnt about vectors of one length."""

    rows: int
    centre: list[int]  # whole numbers nearest to the means
    rest: list[int]  # sums of what lies beyond the centre
    values: np.ndarray  # eigenvalues, falling
    axes: np.ndarray  # unit eigenvectors as columns
    trace: float


def whole_numbers(df: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is sound, with the vector as whole numbers in ``_x`` and its length in ``_size``."""
    sound = F.forall(column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    held = lambda x: F.greatest(F.least(x.cast("double") * SCALE, F.lit(PEAK)), F.lit(-PEAK))
    x = F.transform(column, lambda x: F.floor(held(x)).cast("long") + F.lit(OFFSET).cast("long"))
    return df.where(F.col(column).isNotNull()).where(sound).withColumn("_x", x).withColumn("_size", F.size("_x"))


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of a batch by length: length, their places in the batch, and a matrix."""
    column = batch.column("_x")
    sizes = np.asarray(batch.column("_size"))
    flat, ends = np.asarray(column.flatten()), np.cumsum(sizes)
    for size in np.unique(sizes):
        where = np.flatnonzero(sizes == size)
        for at in range(0, len(where), STEP):
            some = where[at : at + STEP]
            yield int(size), some, flat[(ends[some] - size)[:, None] + np.arange(size)].reshape(len(some), size)


def _fits(bound: int) -> bool:
    return bound < 2**62


def pair_squares(x: np.ndarray) -> np.ndarray:
    """Sums of squares of each dimension and of each sum of two, as the upper triangle row by row; exact."""
    size = x.shape[1]
    peak = int(np.abs(x).max(initial=0))
    if not _fits(4 * peak * peak * max(1, len(x))):
        x = x.astype(object)
    rows = [np.square(x).sum(axis=0)]
    for i in range(size - 1):
        rows.append(np.square(x[:, i + 1 :] + x[:, i, None]).sum(axis=0))
    # the squares of single dimensions come first, then those of the pairs
    return np.concatenate(rows)


def _summed(rows: DataFrame, terms: Callable[[int, np.ndarray], np.ndarray]) -> DataFrame:
    """``size, place, total``: exact sums over all rows of a list of terms for each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in _blocks(batch):
                part = terms(size, x).astype(object)
                totals[size] = totals[size] + part if size in totals else part
        for size, total in totals.items():
            columns = [np.full(len(total), size, np.int32), np.arange(len(total), dtype=np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(list(total), pa.decimal128(38, 0))], schema=_SUMS)

    parts = rows.select("_x", "_size").where(F.col("_size") > 0).mapInArrow(run, SUMS)
    return parts.groupBy("size", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total"))


def _by_size(sums: DataFrame) -> dict[int, list[int]]:
    """The sums of each length; their number is set by the length, not by the rows."""
    found: dict[int, list[int]] = {}
    for row in sums.orderBy("size", "place").toLocalIterator():
        found.setdefault(row["size"], []).append(int(row["total"]))
    return found


def covariance(rows: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """The covariance matrix, each entry rounded once.

    squares: sums of squares about the whole-numbered centre, single dimensions and then pairs; rest: sums about it.
    """
    size = len(rest)
    out = np.empty((size, size))
    single, pairs = squares[:size], iter(squares[size:])
    for i in range(size):
        out[i, i] = (rows * single[i] - rest[i] * rest[i]) / (rows * rows)
        for j in range(i + 1, size):
            double = next(pairs) - single[i] - single[j]
            out[i, j] = out[j, i] = (rows * double - 2 * rest[i] * rest[j]) / (2 * rows * rows)
    return out


def fit(distinct: DataFrame) -> dict[int, Space]:
    """Learn each length's space from rows with ``_x`` and ``_size``, each vector once."""
    prepare_workers(distinct.sparkSession)
    counted = {r["_size"]: r["n"] for r in distinct.groupBy("_size").agg(F.count("*").alias("n")).toLocalIterator()}
    sums = _by_size(_summed(distinct, lambda _, x: x.astype(object).sum(axis=0) if np.abs(x).max() >= 2**40 else x.sum(axis=0)))
    centres = {size: [(2 * s + counted[size]) // (2 * counted[size]) for s in total] for size, total in sums.items()}
    squares = _by_size(_summed(distinct, lambda size, x: pair_squares(x - np.array(centres[size], dtype=np.int64))))
    spaces = {}
    for size, total in sums.items():
        n, centre = counted[size], centres[size]
        rest = [s - n * c for s, c in zip(total, centre, strict=True)]
        matrix = covariance(n, rest, squares[size])
        values, axes = np.linalg.eigh(matrix)
        spaces[size] = Space(n, centre, rest, values[::-1].copy(), axes[:, ::-1].copy(), float(np.trace(matrix)))
    return spaces


def _kept(space: Space, components: int) -> int:
    """Components to return: those asked for that carry any variance beyond rounding."""
    least = space.trace * len(space.centre) * np.finfo(float).eps
    return int((space.values[:components] > max(least, 0.0)).sum())


def _projection(space: Space, components: int) -> np.ndarray:
    kept = _kept(space, components)
    return space.axes[:, :kept] / np.sqrt(space.values[:kept])


def _whitened(space: Space, x: np.ndarray, projection: np.ndarray) -> np.ndarray:
    centred = (x - np.array(space.centre, dtype=np.int64)).astype(float) - np.array([r / space.rows for r in space.rest])
    return centred @ projection


def _deviations(space: Space, x: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None where it does not fit into 38 digits."""
    n, centred = space.rows, x - np.array(space.centre, dtype=np.int64)
    peak, far = int(np.abs(centred).max(initial=0)), max((abs(r) for r in space.rest), default=0)
    if not _fits(max(peak, far) * max(peak, 1) * max(1, x.shape[1])):
        centred = centred.astype(object)
    squares, products = np.square(centred).sum(axis=1), (centred * np.array(space.rest, dtype=centred.dtype)).sum(axis=1)
    constant = sum(r * r for r in space.rest)
    exact = (n * n * int(s) - 2 * n * int(p) + constant for s, p in zip(squares, products, strict=True))
    return [d if d <= WIDE else None for d in exact]


def identity_error(distinct: DataFrame, spaces: dict[int, Space], components: int) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity, over all lengths."""
    shared = distinct.sparkSession.sparkContext.broadcast({s: (space, _projection(space, components)) for s, space in spaces.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in _blocks(batch):
                white = _whitened(shared.value[size][0], x, shared.value[size][1])
                part = np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])
                totals[size] = totals.get(size, 0.0) + part
        for size, total in totals.items():
            columns = [np.full(len(total), size, np.int32), np.arange(len(total), dtype=np.int32), total]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["size", "place", "total"])

    parts = distinct.select("_x", "_size").where(F.col("_size") > 0).mapInArrow(run, "size int, place int, total double")
    worst, found = 0.0, {}
    for row in parts.groupBy("size", "place").agg(F.sum("total").alias("total")).orderBy("size", "place").toLocalIterator():
        found.setdefault(row["size"], []).append(row["total"])
    for size, total in found.items():
        n, kept = spaces[size].rows, _kept(spaces[size], components)
        means, products = np.array(total[:kept]) / n, np.array(total[kept:]).reshape(kept, kept) / n
        worst = max(worst, float(np.abs(products - np.outer(means, means) - np.eye(kept)).max(initial=0.0)))
    return worst


def whiten(df: DataFrame, column: str = "embedding", components: int = 16) -> DataFrame:
    """One row for each sound row and component: the input's other columns, ``component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is NULL or holds NULL or non-finite entries are left out, an empty vector has no components. The
    space is fitted on each distinct vector once, so repeated rows weigh nothing and each gets its own rows; NULLs in
    other columns stay. Components are numbered from 1 by falling eigenvalue; those without variance (vectors that all lie
    in a plane, a single vector) have no rows. ``deviation`` is decimal(38,0), NULL beyond 38 digits. Scaled entries
    beyond 2^53 count as 2^53. Input columns named like a result column give way to it. No rows give no rows.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    results = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    others = carried(df, [*results, column])
    inner = [f"c{i}" for i in range(len(others))]
    plain = df.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(others, inner, strict=True)], F.col(f"`{column}`").alias("_vector"))
    rows = whole_numbers(plain, "_vector").drop("_vector")
    distinct = written(rows.select("_x", "_size").distinct(), "distinct-vectors")
    spaces = fit(distinct)
    error = identity_error(distinct, spaces, components)
    models = {size: (space, _projection(space, components)) for size, space in spaces.items()}
    shared = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, where, x in _blocks(batch):
                if size not in shared.value:
                    continue
                space, projection = shared.value[size]
                white = _whitened(space, x, projection)
                kept = white.shape[1]
                own = batch.select(inner).take(pa.array(np.repeat(where, kept)))
                explained = space.values[:kept] / space.trace if kept else np.empty(0)
                deviations = pa.array(_deviations(space, x), pa.decimal128(38, 0))
                columns = [
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(where))),
                    pa.array(np.full(len(where) * kept, space.rows, np.int64)),
                    deviations.take(pa.array(np.repeat(np.arange(len(where)), kept))),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(where))),
                    pa.array(np.full(len(where) * kept, error)),
                ]
                yield pa.RecordBatch.from_arrays([*own.columns, *columns], names=[*inner, *results])

    kinds = ["component integer", "n long", "deviation decimal(38,0)", "whitened double", "explained double", "identity_error double"]
    schema = rows.select(*inner).schema
    for kind in kinds:
        schema = schema.add(*kind.split(" "))
    done = rows.mapInArrow(run, schema)
    return done.select(*[F.col(i).alias(c) for i, c in zip(inner, others, strict=True)], *results)
