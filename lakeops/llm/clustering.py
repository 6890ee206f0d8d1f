"""Centroid clustering of whole-numbered vectors by a tournament of bisectors.

The points nearer to centroid b than to centroid a are those on one side of a plane: 2(b - a) . x > |b|^2 - |a|^2. Normals
and thresholds of all pairs are worked out once a round, in whole numbers. A vector meets the centroids in the order of
their numbers; each sign test eliminates one, so k - 1 tests leave the nearest, and a zero keeps the smaller number. Only
the distance to the winner is worked out, exactly.

Rows stay where they are: a round is one pass that leaves a count and sums for each cluster and task, which Spark adds up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import carried, prepare_workers, written

SCALE = 64
#: Larger scaled components count as this.
PEAK = float(2**53)
_WIDE = "decimal(38,0)"


@dataclass
class Bisectors:
    """Normals and thresholds of all pairs of centroids, as whole numbers."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: list[list[int]]) -> Bisectors:
        points = np.array(centroids, dtype=object)
        squares = np.square(points).sum(axis=1)
        normals = 2 * (points[None, :, :] - points[:, None, :])
        return cls(points, normals, squares[None, :] - squares[:, None])

    def safe(self, peak: int) -> bool:
        """Whether all work on vectors up to this size stays within 64 bits."""
        own = max(peak, int(np.abs(self.centroids).max()))
        return 8 * own * own * self.centroids.shape[1] < 2**62

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance to it, for each row."""
        kind = np.int64 if self.safe(int(np.abs(x).max(initial=0))) else object
        x, points = x.astype(kind), self.centroids.astype(kind)
        normals, thresholds = self.normals.astype(kind), self.thresholds.astype(kind)
        winner = np.zeros(len(x), dtype=np.int64)
        for rival in range(1, len(points)):
            sign = (x * normals[winner, rival]).sum(axis=1) - thresholds[winner, rival]
            winner[sign > 0] = rival
        return winner, np.square(x - points[winner]).sum(axis=1)


def whole_numbers(df: DataFrame, column: str, size: int) -> DataFrame:
    """Rows whose vector has ``size`` components, all finite, with floor(SCALE * x) in ``_x``."""
    sound = F.forall(column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    held = lambda x: F.greatest(F.least(x.cast("double") * SCALE, F.lit(PEAK)), F.lit(-PEAK))
    return df.where(F.size(column) == size).where(sound).withColumn("_x", F.transform(column, lambda x: F.floor(held(x)).cast("long")))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return np.asarray(batch.column("_x").flatten(), dtype=np.int64).reshape(batch.num_rows, size)


def seeds(rows: DataFrame, k: int) -> list[list[int]]:
    """The k vectors with the smallest hashed ids (``_key``), ties by the vector itself; fewer if there are fewer rows."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("_key").cast("string")).cast("binary"), 256)
    first = rows.select(digest.alias("h"), "_x").orderBy(F.col("h").asc_nulls_last(), "_x").limit(k)
    return [list(r["_x"]) for r in first.collect()]


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: exact floors of their vectors' means; one without vectors stays."""
    size = len(centroids[0])
    shared = rows.sparkSession.sparkContext.broadcast(Bisectors.of(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # place -1 holds the number of vectors of a cluster, place d the sum of component d
        totals = np.zeros((len(centroids), size + 1), dtype=object)
        for batch in batches:
            x = _matrix(batch, size)
            winner, _ = shared.value.nearest(x)
            for cluster in np.unique(winner):
                own = x[winner == cluster]
                exact = own if int(np.abs(own).max()) * len(own) < 2**62 else own.astype(object)
                totals[cluster] += np.concatenate([[len(own)], exact.sum(axis=0)]).astype(object)
        taken = np.flatnonzero(totals[:, 0] > 0)
        columns = [
            pa.array(np.repeat(taken, size + 1).astype(np.int32)),
            pa.array(np.tile(np.arange(-1, size, dtype=np.int32), len(taken))),
            pa.array(list(totals[taken].ravel()), pa.decimal128(38, 0)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "place", "total"])

    parts = rows.select("_x").mapInArrow(run, f"cluster int, place int, total {_WIDE}")
    sums: dict[tuple[int, int], int] = {}
    # k times (size + 1) numbers, whatever the number of rows
    for row in parts.groupBy("cluster", "place").agg(F.sum("total").cast(_WIDE).alias("total")).collect():
        sums[row["cluster"], row["place"]] = int(row["total"])
    return [
        [sums[c, d] // sums[c, -1] for d in range(size)] if (c, -1) in sums else old for c, old in enumerate(centroids)
    ]


def cluster(
    df: DataFrame, key: str = "vec_id", column: str = "embedding", *, k: int = 16, rounds: int = 3, size: int = 64
) -> DataFrame:
    """The input's rows with their ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid`` (array).

    Left out are rows whose vector is NULL, has another number of components, or holds NULL or non-finite ones. NULL keys
    are clustered like any other and come last among the seeds; repeated rows count each; rows with one key and
    different vectors are ordered by vector as seeds. With fewer rows than ``k`` there are as many clusters as rows; no
    rows give no rows. Distances and their sums are decimal(38,0). Scaled components beyond 2^53 count as 2^53. Input
    columns named like a result column give way to it.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    results = ["cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    others = carried(df, [*results, column])
    inner = [f"c{i}" for i in range(len(others))]
    plain = df.select(
        *[F.col(f"`{c}`").alias(i) for c, i in zip(others, inner, strict=True)],
        F.col(f"`{key}`").alias("_key"),
        F.col(f"`{column}`").alias("_vector"),
    )
    rows = whole_numbers(plain, "_vector", size).drop("_vector")
    centroids = seeds(rows, k)
    for _ in range(rounds if centroids else 0):
        centroids = moved(rows, centroids)
    shared = spark.sparkContext.broadcast(Bisectors.of(centroids) if centroids else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared.value is None or not batch.num_rows:
                continue
            winner, distance = shared.value.nearest(_matrix(batch, size))
            columns = [pa.array(winner.astype(np.int32)), pa.array([int(d) for d in distance], pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays([*batch.select(inner).columns, *columns], names=[*inner, "cluster", "distance"])

    schema = rows.select(*inner).schema.add("cluster", "integer").add("distance", _WIDE)
    assigned = written(rows.drop("_key").mapInArrow(run, schema), "assigned-vectors")
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum("distance").cast(_WIDE).alias("s")).collect()}
    # one row for each centroid
    facts = spark.createDataFrame(
        [(c, Decimal(sums.get(c, 0)), Decimal(sum(sums.values())), point) for c, point in enumerate(centroids)],
        f"cluster int, cluster_inertia {_WIDE}, inertia {_WIDE}, centroid array<long>",
    )
    done = assigned.join(F.broadcast(facts), "cluster")
    return done.select(*[F.col(i).alias(c) for i, c in zip(inner, others, strict=True)], *results)
