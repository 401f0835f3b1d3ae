"""Reading of a stored table what a load touches, and nothing else."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def days_of(load: DataFrame, day: str) -> list[dt.date | None]:
    """The distinct days of a load, known to the driver: as many as the calendar has at most."""
    return [row[0] for row in load.select(day).distinct().collect()]


def on_days(column: Column, days: Sequence[dt.date | None]) -> Column:
    """``column`` is one of the days. They are literals, so the partitions of a stored table are cut while planning."""
    given = [d for d in days if d is not None]
    hit = column.isin(given) if given else F.lit(False)
    return hit | column.isNull() if len(given) < len(days) else hit


def stored_rows(spark: SparkSession, path: str, schema: StructType, day: str, days: Sequence[dt.date | None]) -> DataFrame | None:
    """The rows of a table partitioned by ``day`` on the given days; other days are not opened. None before the first load."""
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.where(on_days(F.col(day), days))
