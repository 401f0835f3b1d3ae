"""Consecutive numbers and running totals over any order, without a window that holds a whole table or group.

Rows are range-partitioned and sorted, each task numbers its own rows, and the rows of the tasks before it are
added as an offset: one number per task and group, however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.session import written

# Positions that one group of ``running_total`` spans.
BLOCK = 1024


def _fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for a, b in pairs:
        condition &= left[a].eqNullSafe(right[b])
    return condition


def numbered(
    df: DataFrame, order: Sequence[str | Column], pos: str = "pos", within: Sequence[str] = (), start: int = 0
) -> DataFrame:
    """``df`` with ``pos``: consecutive from ``start`` in the given order, anew in each group of ``within``.

    Rows that tie in the whole order keep the order of the input's partitions, and a long run of ties is dealt over
    several tasks. NULL is a group like any other. The sorted rows are written to the shared folder once, since the
    sampled bounds of a range partitioning may differ when it is computed again.
    """
    tie, place, task, first, before = _fresh(df, "_tie", "_place", "_task", "_first", "_before")
    keys = [*within, *order]
    # Without an order or groups, rows stay where they are.
    sorted_ = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie).drop(tie) if keys else df
    placed = sorted_.withColumn(place, F.monotonically_increasing_id())
    rows = written(placed, "numbered").withColumn(task, F.shiftrightunsigned(place, 33))
    counts = rows.groupBy(*within, task).agg(F.min(place).alias(first), F.count("*").alias(before))
    earlier = Window.partitionBy(*within).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *(F.col(c).alias(f"{c}{task}") for c in within),
        F.col(task).alias(task + task),
        first,
        F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before),
    )
    joined = rows.join(offsets, _same(rows, offsets, [*((c, f"{c}{task}") for c in within), (task, task + task)]))
    return joined.select(*df.columns, (F.col(place) - F.col(first) + F.col(before) + start).alias(pos))


def running_total(
    df: DataFrame, position: str, values: Sequence[str], within: Sequence[str] = (), block: int = BLOCK
) -> DataFrame:
    """``df`` with ``before_<value>`` for each value: its sum over the rows of smaller ``position`` in the group.

    Positions are whole numbers, each at most once in a group. Sums run inside blocks of positions and over the
    blocks, so a window sees ``block`` rows, or one row per block. ``df`` is read twice and must not change between.
    """
    (part,) = _fresh(df, "_block")
    rows = df.withColumn(part, F.floor(F.col(position) / block))
    inside = Window.partitionBy(*within, part).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*within, part).agg(*(F.sum(v).alias(v) for v in values))
    earlier = sums.select(
        *(F.col(c).alias(f"{c}{part}") for c in (*within, part)),
        *(F.coalesce(F.sum(v).over(over), F.lit(0)).alias(f"{v}{part}") for v in values),
    )
    here = rows.withColumns({f"before_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    joined = here.join(earlier, _same(here, earlier, [(c, f"{c}{part}") for c in (*within, part)]))
    return joined.select(*df.columns, *((F.col(f"before_{v}") + F.col(f"{v}{part}")).alias(f"before_{v}") for v in values))
