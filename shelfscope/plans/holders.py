"""Who held each product's buy box, as intervals: the daily snapshot folded to one row per unbroken holding.

The reports on changes and standing read a few intervals of a product instead of all its days. Intervals of two periods
merge into those of both, so the table is kept by folding in each new day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfscope.functions import predicates as P
from shelfscope.functions.dates import AsOf, as_of_date
from shelfscope.plans.portfolio import portfolio_asins
from shelfscope.plans.reports import HOLDER, at_least_a_day, capped, newest_and_dearest


def _in_order() -> WindowSpec:
    return Window.partitionBy("asin").orderBy("from_day")


def holder_intervals(gold: DataFrame) -> DataFrame:
    """One row per product and unbroken run of snapshots with one holder.

    Columns: asin, the holder, from_day and to_day (both with a snapshot), ``before_last`` (the snapshot before the last
    one, NULL for a single one), ``snapshots``, and the price on from_day. A day without a snapshot does not end an
    interval; no holder (NULL) is a holder like any other.
    """
    day = F.col("snapshot_date")
    return merged_intervals(
        gold.select(
            "asin",
            HOLDER,
            day.alias("from_day"),
            day.alias("to_day"),
            F.lit(None).cast("date").alias("before_last"),
            F.lit(1).cast("bigint").alias("snapshots"),
            F.col("pdp_total_price").alias("from_price"),
        )
    )


def merged_intervals(pieces: DataFrame) -> DataFrame:
    """Intervals that follow each other with one holder become one; pieces of a product must not overlap.

    A group is as long as a product's pieces, at most one per day of its history.
    """
    starts = ~F.coalesce(F.col(HOLDER).eqNullSafe(F.col("_holder")), F.lit(False)) | F.col("_to").isNull()
    linked = (
        pieces.withColumns({"_holder": F.lag(HOLDER).over(_in_order()), "_to": F.lag("to_day").over(_in_order())})
        .withColumn("_start", starts)
        .withColumn("_island", F.sum(F.col("_start").cast("int")).over(_in_order()))
        # The snapshot before a piece's last one lies in the piece before it where the piece has but one.
        .withColumn("before_last", F.coalesce("before_last", F.when(~F.col("_start"), F.col("_to"))))
    )
    return linked.groupBy("asin", "_island").agg(
        F.max(HOLDER).alias(HOLDER),
        F.min("from_day").alias("from_day"),
        F.max("to_day").alias("to_day"),
        F.max_by("before_last", "to_day").alias("before_last"),
        F.sum("snapshots").alias("snapshots"),
        F.min_by("from_price", "from_day").alias("from_price"),
    ).drop("_island")


def held_on(intervals: DataFrame, days: DataFrame, day: str = "day") -> DataFrame:
    """Rows ``(asin, day, ...)`` with the holder of the product's latest snapshot up to that day.

    Intervals of a product do not overlap in time, so each row meets its product's intervals and keeps one.
    """
    met = days.join(intervals.select("asin", HOLDER, "from_day", "to_day"), "asin").where(F.col("from_day") <= F.col(day))
    latest = met.groupBy(*days.columns).agg(F.max_by(F.struct(HOLDER), "from_day").alias("_held"))
    return latest.select(*days.columns, F.col(f"_held.{HOLDER}").alias(HOLDER))


def changes_of_intervals(
    intervals: DataFrame, seller: str, as_of: AsOf = None, days: int = 2, limit: int | None = None
) -> DataFrame:
    """As ``reports.buy_box_changes``: a change is where an interval starts after another one that reaches the window."""
    start = F.date_sub(as_of_date(as_of, intervals, "to_day"), at_least_a_day(days))
    rows = intervals.where(F.col("to_day") >= start)
    held = rows.where(P.same_seller(P.seller_key(rows, HOLDER), seller)).select("asin")
    changes = (
        rows.join(held, "asin", "left_semi")
        .withColumn("prev_day_buybox_seller", F.lag(HOLDER).over(_in_order()))
        .where(F.col("from_day") >= start)
        .where(P.took_or_lost(F.lower(HOLDER), F.lower("prev_day_buybox_seller"), seller))
        .select(F.col("from_day").alias("snapshot_date"), "asin", HOLDER, "prev_day_buybox_seller", F.col("from_price").alias("pdp_total_price"))
    )
    return capped(changes.orderBy(*newest_and_dearest()), limit)


def standing_of_intervals(
    intervals: DataFrame, offers: DataFrame, seller: str, as_of: AsOf = None, days: int = 14, offer_days: int = 30
) -> DataFrame:
    """As ``portfolio.latest_standing``, from each portfolio product's last intervals."""
    start = F.date_sub(as_of_date(as_of, intervals, "to_day"), days)
    now, before = F.lower(HOLDER), F.lower("_before")
    rows = (
        intervals.where(F.col("to_day") >= start)
        .join(portfolio_asins(offers, seller, as_of, offer_days), "asin", "left_semi")
        .withColumns({"_before": F.lag(HOLDER).over(_in_order()), "_next": F.lead("to_day").over(_in_order())})
        .where(F.col("_next").isNull())
    )
    previous = F.when(F.col("before_last") >= start, now).otherwise(before)
    return rows.select(
        "asin",
        P.wins(now, seller).alias("is_winning"),
        F.coalesce(P.just_lost(now, previous, seller), F.lit(False)).alias("just_lost"),
    )
