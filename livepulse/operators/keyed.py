"""Keyed selection helpers shared by several layers (skew-safe by construction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _cols(names):
    return [F.col(c) if isinstance(c, str) else c for c in names]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    Written as a hash aggregate rather than a window: each map task keeps only
    its running best row per key before the shuffle, so a key that holds a
    third of the table costs one row of shuffle per task instead of landing
    whole in one sort. Each column is its own ``max_by`` over the same ordering
    (all of them keep the same row: a value is replaced only on a strictly
    greater ordering, in the same row order), so columns a query does not use
    are pruned by the optimizer down to the scan. The order columns themselves
    are returned as the maximum ordering.
    """
    ordering = F.struct(*_cols(order))
    keep = [c for c in (columns or df.columns) if c not in keys]
    single = [c for c in order if isinstance(c, str)] if len(order) == 1 else []
    aggs = [(F.max(c) if c in single else F.max_by(F.col(c), ordering)).alias(c) for c in keep]
    return df.groupBy(*keys).agg(*aggs)


def scalar_broadcast(agg_row: DataFrame) -> DataFrame:
    """Mark a one-row aggregate for broadcast: its size is bounded by construction."""
    return F.broadcast(agg_row)
