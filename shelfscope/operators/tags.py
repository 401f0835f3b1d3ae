"""Run tags given as a value or as a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Tag = Column | str | None


def tag(value: Tag) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("string")
