"""Exact top-k search by inner product, with a pivot table.

Distances of every vector to a set of pivots are worked out once. By the triangle inequality the largest
difference of two vectors' pivot distances is a lower bound on their distance, and with their norms that bounds their
inner product from above. Candidates are evaluated in the order of this bound, until the k-th best score found so far is
above the next bound: no candidate behind it can enter the result.

Queries and candidates are dealt into blocks of bounded size, and a task looks at one block of either kind. What a task
keeps is k rows for each query; these are merged by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import prepare_workers, written

PIVOTS = 32
#: Vectors from which pivots are chosen, at most.
PIVOT_SAMPLE = 2_048
#: Queries and candidates of one task.
QUERY_BLOCK, CANDIDATE_BLOCK = 1_024, 16_384
#: Candidates evaluated between two looks at the stopping rule.
STEP = 128


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = np.asarray(column.flatten(), dtype=np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def spread_out(sample: np.ndarray, n: int) -> np.ndarray:
    """Pivots: the origin, then each time the vector that is farthest from the pivots so far."""
    pivots = [np.zeros(sample.shape[1])]
    near = np.linalg.norm(sample, axis=1)
    while len(pivots) <= n and len(sample) and near.max() > 0:
        pivots.append(sample[int(near.argmax())])
        near = np.minimum(near, np.linalg.norm(sample - pivots[-1], axis=1))
    return np.array(pivots)


def with_pivot_distances(vectors: DataFrame, sample_size: int = PIVOT_SAMPLE) -> DataFrame:
    """``id, row, vector, to_pivots`` from ``id, row, vector``; vectors shorter or longer than the pivots have the origin alone."""
    spark = vectors.sparkSession
    prepare_workers(spark)
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(sample_size).toArrow()["vector"].to_pylist()
    size = max((len(v) for v in sample), key=[len(v) for v in sample].count, default=0)
    rows = np.array([v for v in sample if len(v) == size], dtype=np.float64).reshape(sum(len(v) == size for v in sample), size)
    sent = spark.sparkContext.broadcast(spread_out(rows, PIVOTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = sent.value
        for batch in batches:
            found: list[np.ndarray] = []
            for v in batch.column("vector").to_pylist():
                v = np.array(v, dtype=np.float64)
                found.append(np.linalg.norm(pivots - v, axis=1) if len(v) == size else np.array([np.linalg.norm(v)]))
            kept = [batch.column(name) for name in ("id", "row", "vector")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.list_(pa.float64()))], names=["id", "row", "vector", "to_pivots"])

    return vectors.mapInArrow(run, "id long, row long, vector array<double>, to_pivots array<double>")


def _scores(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    peak = (np.abs(query).max(initial=0) or 1) * (np.abs(candidates).max(initial=0) or 1) * max(1, len(query))
    if peak < 2**53:
        return (candidates @ query).astype(np.int64)
    whole = [int(x) for x in query]
    return np.array([sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in candidates], dtype=np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores of different ids, ties to the smaller id."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, first = np.unique(ids, return_index=True)
    first.sort()
    return ids[first[:k]], scores[first[:k]]


def block_top_k(
    query_ids: np.ndarray, queries: np.ndarray, query_pivots: np.ndarray, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """For each query of a block: its id, the best ids and scores among the candidates, and how many were evaluated."""
    squares, own = (vectors**2).sum(axis=1), (queries**2).sum(axis=1)
    for at in range(0, len(queries), 64):
        part = slice(at, at + 64)
        apart = np.zeros((len(query_pivots[part]), len(ids)))
        for p in range(pivots.shape[1]):
            np.maximum(apart, np.abs(query_pivots[part, p, None] - pivots[None, :, p]), out=apart)
        total = own[part, None] + squares[None, :]
        # Rounding must not cut off a candidate: the bound is raised a little.
        bounds = (total - apart**2) / 2 + 1e-9 * total + 1e-6
        for q, bound in zip(range(at, at + len(bounds)), bounds, strict=True):
            bound[ids == query_ids[q]] = -np.inf
            first = min(len(ids), 4 * k + 16)
            seen = np.argpartition(-bound, first - 1)[:first] if first < len(ids) else np.arange(len(ids))
            seen = seen[bound[seen] > -np.inf]
            best_ids, best = _best(ids[seen], _scores(queries[q], vectors[seen]), k)
            evaluated = len(seen)
            rest = bound.copy()
            rest[seen] = -np.inf
            open_to = np.flatnonzero(rest >= best[-1]) if len(best) == k else np.flatnonzero(rest > -np.inf)
            open_to = open_to[np.argsort(-rest[open_to], kind="stable")]
            for begin in range(0, len(open_to), STEP):
                some = open_to[begin : begin + STEP]
                if len(best) == k and rest[some[0]] < best[-1]:
                    break
                evaluated += len(some)
                found = _scores(queries[q], vectors[some])
                if len(best) == k:
                    worth = found >= best[-1]
                    some, found = some[worth], found[worth]
                if len(some):
                    best_ids, best = _best(np.concatenate([best_ids, ids[some]]), np.concatenate([best, found]), k)
            yield int(query_ids[q]), best_ids, best, evaluated


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query id the k ids with the highest inner product.

    vectors: ``id`` (long), ``vector`` (array of whole numbers as double). is_query: over these columns. Rows whose id,
    vector or any component is NULL or not finite take no part; vectors meet only those of their own length, empty ones too.
    Every row but the query's own is a candidate: rows that share an id are rows of their own, as queries (each with its own
    ranks) and as results. Ties go to the smaller id; with fewer than k candidates all are returned; no rows give no rows.
    Other columns are not looked at.
    """
    spark = vectors.sparkSession
    sound = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    taken = vectors.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(sound)
    # The written table fixes which row has which number.
    numbered = taken.select("id", F.monotonically_increasing_id().alias("row"), "vector")
    table = written(with_pivot_distances(numbered), "pivot-table")
    counts = table.agg(F.count("*").alias("rows"), F.count_if(is_query).alias("queries")).first()
    query_blocks = max(1, -(-counts["queries"] // QUERY_BLOCK))
    slices = max(1, -(-counts["rows"] // CANDIDATE_BLOCK))
    dealt = F.xxhash64("id", "row", F.lit("block"))

    def side(frame: DataFrame, own: str, own_n: int, other: str, other_n: int, flag: bool) -> DataFrame:
        return frame.select(
            F.size("vector").alias("size"),
            F.pmod(dealt, F.lit(own_n)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))).alias(other),
            F.lit(flag).alias("is_query"),
            "id",
            "row",
            "vector",
            "to_pivots",
        )

    both = side(table.where(is_query), "query_block", query_blocks, "slice", slices, True).unionByName(
        side(table, "slice", slices, "query_block", query_blocks, False)
    )

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("row", "ascending")])
        flags = np.asarray(group["is_query"].combine_chunks())
        ids, rows = (np.asarray(group[name].combine_chunks(), dtype=np.int64) for name in ("id", "row"))
        all_vectors, all_pivots = _matrix(group["vector"]), _matrix(group["to_pivots"])
        out: list[list] = [[] for _ in range(5)]
        if flags.any() and not flags.all():
            mine = ~flags
            # Candidates go by their place: by id, then by row. A query that is none of them has no place.
            places = {row: at for at, row in enumerate(rows[mine].tolist())}
            own = np.array([places.get(row, -1) for row in rows[flags].tolist()])
            best_of = block_top_k(own, all_vectors[flags], all_pivots[flags], np.arange(mine.sum()), all_vectors[mine], all_pivots[mine], k)
            for query, row, (_, best_places, best, _) in zip(ids[flags].tolist(), rows[flags].tolist(), best_of, strict=True):
                out[0] += [query] * len(best)
                out[1] += [row] * len(best)
                out[2] += ids[mine][best_places].tolist()
                out[3] += rows[mine][best_places].tolist()
                out[4] += best.tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["query_id", "query_row", "vec_id", "row", "score"])

    columns = "query_id long, query_row long, vec_id long, row long, score long"
    found = both.groupBy("size", "query_block", "slice").applyInArrow(run, columns)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
