"""Naming an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    Without it each use repeats the whole expression, which multiplies when helpers nest.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(value: Column) -> Column:
    """A selected column that is computed once per row, whatever is filtered or selected above it.

    Catalyst pushes filters below a projection by repeating its expressions; it does not push them
    below a generator. For costly steps, such as parsing a payload, that is worth one generator. The
    outer form keeps Spark from adding a size filter that would compute the value again.
    """
    return F.explode_outer(F.array(value))
