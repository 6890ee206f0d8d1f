"""Keyed deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Landing order of scanned or fetched parts, most significant first.
LANDING_ORDER = ("_ingest_order", "_ingest_file", "_row_index")


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = LANDING_ORDER
) -> DataFrame:
    """The newest row per key, newest meaning greatest in ``order``.

    Keys that do not exist are ignored, without any key the frame is unchanged,
    and NULL keys equal each other. Keeping rank 1 lets Catalyst prune within
    each task before the shuffle (WindowGroupLimit), so a key with a third of
    all rows sends one row per task, not all of them. Give an order that is
    total over distinct rows; rows equal in every order column may swap.
    """
    known = [k for k in keys if k in df.columns]
    if not known:
        return df
    newest_first = [F.col(f"`{c}`").desc_nulls_last() for c in order if c in df.columns]
    if not newest_first:
        newest_first = [
            F.col(f"`{c}`").desc_nulls_last() for c in df.columns if c not in known
        ] or [F.lit(1).desc()]
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in known]).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedup_last(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row per key in concatenation order (file order, then row order)."""
    return dedup_latest(df, keys, LANDING_ORDER)
