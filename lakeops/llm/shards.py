"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows lie in partitions. How many rows of partition ``p`` go to shard ``s`` in a uniformly random permutation follows
the multivariate hypergeometric law; the whole matrix is drawn with its row sums (partition sizes) and column sums
(shard sizes) exact. Then each partition is permuted by itself and cut at the row's counts, the pieces are exchanged,
and each shard is permuted again. All of it is DataFrame expressions.

The matrix is drawn by halving: for a set of partitions the shards' counts are split between its two
halves, shard by shard, each a hypergeometric draw, and the halves go on independently. A level is one projection over
rows of bounded width, so drawing spreads over tasks. Draws come from hashes of a seed and the
place in the tree, so a task that is run again draws the same.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import carried, written

#: Tries of the rejection sampler; each succeeds with probability over a half, so none failing them all is ever seen,
#: and the mode stands in for one that would.
TRIES = 64
#: Rows of a shard that are put in order by one task, about.
BUCKET_ROWS = 200_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is worked out once however often it occurs there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _log_factorial(n: Column) -> Column:
    """log n!, by Stirling's series from 16 on and exactly below."""
    table = F.array(*(F.lit(math.lgamma(k + 1)) for k in range(16)))
    x = n + 1.0
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n < 16, F.get(table, n.cast("int"))).otherwise(series)


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(1 << 53)


def hypergeometric(good: Column, bad: Column, sample: Column, key: Column) -> Column:
    """Good ones among ``sample`` drawn from ``good + bad`` without replacement.

    Ratio of uniforms with a table-mountain hat (Stadlober 1990), over hash-derived uniforms. The support is
    mirrored first, so that at most half of the total is drawn and at most half of it is good.
    """
    g = F.struct(
        F.least(good, bad).cast("double").alias("few"),
        F.greatest(good, bad).cast("double").alias("many"),
        F.least(sample, good + bad - sample).cast("double").alias("m"),
        F.greatest(good + bad, F.lit(1)).cast("double").alias("total"),
        key.alias("key"),
    )

    def hat(g: Column) -> Column:
        share = g["few"] / g["total"]
        spread = F.sqrt((g["total"] - g["m"]) * g["m"] * share * (1 - share) / F.greatest(g["total"] - 1, F.lit(1.0)) + 0.5)
        mode = F.floor((g["m"] + 1) * (g["few"] + 1) / (g["total"] + 2)).cast("double")
        return F.struct(
            *(g[n].alias(n) for n in ("few", "many", "m", "key")),
            (g["m"] * share + 0.5).alias("centre"),
            (2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)).alias("width"),
            F.least(F.least(g["m"], g["few"]) + 1, F.floor(g["m"] * share + 0.5 + 16 * spread)).alias("beyond"),
            F.least(mode, g["m"], g["few"]).alias("mode"),
        )

    def weight(h: Column, z: Column) -> Column:
        return _log_factorial(z) + _log_factorial(h["few"] - z) + _log_factorial(h["m"] - z) + _log_factorial(h["many"] - h["m"] + z)

    def tried(h: Column, top: Column) -> Column:
        def attempt(found: Column, t: Column) -> Column:
            pair = F.struct(_uniform(h["key"], t, F.lit(1)).alias("x"), _uniform(h["key"], t, F.lit(2)).alias("y"))

            def place(u: Column) -> Column:
                at = h["centre"] + h["width"] * (u["y"] - 0.5) / u["x"]
                z = F.floor(at).cast("double")
                fits = (at >= 0) & (at < h["beyond"])
                return F.when(fits & F.coalesce(2 * F.log(u["x"]) <= top - weight(h, z), F.lit(False)), z)

            return F.when(found.isNotNull(), found).otherwise(let(pair, place))

        return F.coalesce(F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("double"), attempt), h["mode"])

    def drawn(h: Column) -> Column:
        return F.when((h["few"] == 0) | (h["m"] == 0), F.lit(0.0)).otherwise(let(weight(h, h["mode"]), lambda top: tried(h, top)))

    few = let(let(g, hat), drawn).cast("long")
    # few is about the smaller colour and the smaller of sample and rest: mirror back.
    half = F.when(sample <= good + bad - sample, few).otherwise(F.least(good, bad) - few)
    return F.when(good <= bad, half).otherwise(sample - half)


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Counts at most one apart; the first shards take one more."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """``partition, counts``: rows of each partition that go to each shard, drawn exactly.

    sizes: ``partition, n_rows``, one row for each partition. It is gathered into one array of numbers,
    as many as there are input partitions.
    """
    spark = sizes.sparkSession
    totals = sizes.agg(F.sum("n_rows").alias("rows"), F.count("*").alias("partitions")).first()
    rows, partitions = totals["rows"] or 0, totals["partitions"]
    if not rows:
        return spark.createDataFrame([], "partition int, counts array<long>")
    root = sizes.agg(F.sort_array(F.collect_list(F.struct("partition", "n_rows"))).alias("parts"))
    node = root.select(F.lit(1).cast("long").alias("node"), "parts", F.array(*(F.lit(n).cast("long") for n in shard_sizes(rows, shards))).alias("counts"))
    for _ in range(max(0, math.ceil(math.log2(partitions)))):
        node = node.select("node", "counts", _halves(seed).alias("half")).select(
            F.inline(
                F.array(
                    F.struct((2 * F.col("node")).alias("node"), F.col("half.first").alias("parts"), F.col("half.drawn").alias("counts")),
                    F.struct(
                        (2 * F.col("node") + 1).alias("node"),
                        F.col("half.second").alias("parts"),
                        F.zip_with("counts", "half.drawn", lambda a, b: a - b).alias("counts"),
                    ),
                )
            )
        )
        node = node.where(F.size("parts") > 0)
    return node.select(F.get("parts", F.lit(0))["partition"].alias("partition"), "counts")


def _rows_of(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a + p["n_rows"])


def _halves(seed: int) -> Column:
    """The two halves of a node's partitions, and each shard's share in the first one."""
    parts, counts, node = F.col("parts"), F.col("counts"), F.col("node")
    middle = F.ceil(F.size(parts) / 2).cast("int")
    begin = F.struct(
        _rows_of(F.slice(parts, 1, middle)).alias("wanted"),
        _rows_of(parts).alias("left"),
        F.array().cast("array<long>").alias("drawn"),
    )

    def shard(state: Column, count: Column) -> Column:
        key = F.xxhash64(F.lit(seed), node, F.size(state["drawn"]))
        draw = hypergeometric(count, state["left"] - count, state["wanted"], key)
        return let(
            draw,
            lambda x: F.struct(
                (state["wanted"] - x).alias("wanted"), (state["left"] - count).alias("left"), F.array_append(state["drawn"], x).alias("drawn")
            ),
        )

    drawn = F.aggregate(counts, begin, shard, lambda s: s["drawn"])
    return F.struct(
        F.slice(parts, 1, middle).alias("first"),
        F.slice(parts, middle + 1, F.size(parts)).alias("second"),
        drawn.alias("drawn"),
    )


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """All rows with ``shard`` (0 to ``shards - 1``) and ``slot`` (from 0, without gaps in a shard).

    Shard sizes are at most one apart. Which row goes where is uniformly random: identical rows, NULLs and
    rows with equal keys are moved like any others. The columns are kept; those called ``shard`` or ``slot`` are
    replaced. No rows give no rows.

    The rows are written once, permuted within the partitions they were read in, so that every later step sees the
    same partitions and ranks even if executors are lost.
    """
    keep = carried(df, ["shard", "slot"])
    inner = [f"_c{k}" for k in range(len(keep))]
    named = df.select(*(F.col(c).alias(i) for c, i in zip(keep, inner, strict=True)))
    # Row number within the partition, then a random order of it: equal rows get different places.
    numbered = named.withColumn("_row", F.monotonically_increasing_id())
    permuted = numbered.withColumn("_key", F.xxhash64(F.lit(seed), F.lit(1), "_row")).sortWithinPartitions("_key", "_row")
    placed = written(
        permuted.withColumn("_place", F.monotonically_increasing_id()).select(
            *inner, F.shiftright("_place", 33).cast("int").alias("_partition"), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)).alias("_rank")
        ),
        "permuted",
    )
    sizes = written(placed.groupBy(F.col("_partition").alias("partition")).agg(F.count("*").alias("n_rows")), "partition-sizes")
    matrix = written(communication_matrix(sizes, shards, seed), "communication-matrix")
    cuts = matrix.select(
        F.col("partition").alias("_partition"),
        F.aggregate(
            "counts",
            F.array(F.lit(0).cast("long")),
            lambda a, c: F.array_append(a, F.element_at(a, -1) + c),
        ).alias("_cuts"),
    )
    shard = F.size(F.filter("_cuts", lambda c: c <= F.col("_rank"))) - 1
    rows = placed.join(cuts, "_partition").select(*inner, "_partition", "_rank", shard.alias("shard"))
    # Each shard is permuted again, in buckets of its random keys.
    total = sizes.agg(F.sum("n_rows").alias("n")).first()["n"] or 0
    buckets = max(1, total // (shards * BUCKET_ROWS))
    key = F.xxhash64(F.lit(seed), F.lit(2), "_partition", "_rank")
    rows = rows.withColumn("_key", key).withColumn("_bucket", F.pmod(F.shiftright("_key", 20), F.lit(buckets)))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.groupBy("shard", "_bucket").agg(F.count("*").alias("n"))
    offsets = counted.select("shard", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("shard", "_bucket").orderBy("_key", "_partition", "_rank")
    ranked = rows.withColumn("_at", F.row_number().over(within) - 1)
    return ranked.join(offsets, ["shard", "_bucket"]).select(
        *(F.col(i).alias(c) for c, i in zip(keep, inner, strict=True)), "shard", (F.col("_offset") + F.col("_at")).alias("slot")
    )
