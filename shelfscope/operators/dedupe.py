"""Keeping one row per key by aggregation.

A minimum or maximum is combined inside each task before the shuffle, so a key that holds a large
share of all rows sends one row per task; a ``row_number`` window would sort them all in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(F.struct(*order).alias("o"), F.struct(*rest).alias("r"))
    return (
        df.groupBy(*keys)
        .agg(pick(packed).alias("p"))
        .select(*keys, "p.r.*")
        .select(*df.columns)
    )


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the smallest ``order`` per key; equal orders fall back to the row's own values."""
    return _one_per_key(df, keys, order, F.min)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the largest ``order`` per key; equal orders fall back to the row's own values."""
    return _one_per_key(df, keys, order, F.max)
