"""The as-of date and look-back windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = dt.date | str | Column | None


def as_of_date(as_of: AsOf, df: DataFrame, column: str = "snapshot_date") -> Column:
    """The report's "today": the given date, or the newest date in ``df``.

    The default is a scalar subquery, so nothing runs while the plan is built, and over a table
    partitioned by date it still opens the footer of each file; pass the catalog's newest day to avoid that.
    """
    if as_of is None:
        return df.select(F.max(F.to_date(F.col(column)))).scalar()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def looks_back(df: DataFrame, column: str, as_of: Column, days: int) -> Column:
    """``column`` lies on or after ``as_of - days``, both ends included.

    The bound is cast to the column's type and the column is left bare, so the comparison prunes
    date partitions and is pushed into the scan for timestamps too.
    """
    return F.col(column) >= F.date_sub(as_of, days).cast(df.schema[column].dataType)


def recent_offers(offers: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """Offers extracted on the last ``days`` days before ``as_of`` or on that day.

    The day column, where there is one, prunes the partitions of a stored table; the bound on the
    timestamp reaches the scan of a table without it.
    """
    by_day = "snapshot_date" in offers.columns
    today = as_of_date(as_of, offers, "snapshot_date" if by_day else "extracted_at")
    rows = offers.where(looks_back(offers, "extracted_at", today, days))
    return rows.where(looks_back(offers, "snapshot_date", today, days)) if by_day else rows


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with microseconds and a numeric offset (``+00:00`` in a UTC session)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def run_stamp(ts: Column) -> Column:
    """File stamp of a run: ``YYYYmmdd_HHMMSS``."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")
