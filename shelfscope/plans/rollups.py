"""Buy-box days per holder and day, which add up over any window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions import predicates as P
from shelfscope.functions.dates import AsOf, as_of_date, looks_back
from shelfscope.operators.merge import on_days
from shelfscope.plans.reports import HOLDER, capped


def holder_days(gold: DataFrame) -> DataFrame:
    """(snapshot_date, holder, holder key, product_days, priced_days, price_sum): small beside the snapshot."""
    return gold.groupBy("snapshot_date", HOLDER, P.seller_key(gold, HOLDER).alias("buybox_seller_key")).agg(
        F.count("*").alias("product_days"),
        F.count("pdp_total_price").alias("priced_days"),
        F.sum(F.col("pdp_total_price").cast("decimal(20,6)")).alias("price_sum"),
    )


def refresh_holder_days(gold: DataFrame, path: str, days: Sequence[dt.date] | None = None) -> None:
    """Write the roll-up of the given days (default: all of ``gold``) anew; the other days' files stay as they are."""
    rows = gold if days is None else gold.where(on_days(F.col("snapshot_date"), days))
    (
        holder_days(rows)
        .hint("rebalance", "snapshot_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def _rivals(rollup: DataFrame, seller: str) -> DataFrame:
    return rollup.where(P.other_seller(F.col("buybox_seller_key"), seller))


def _totals(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(F.col(HOLDER).alias(name)).agg(
        F.sum("product_days").alias("product_days"), (F.sum("price_sum").cast("double") / F.sum("priced_days")).alias("avg_price")
    )


def competitor_history_of(rollup: DataFrame, seller: str, as_of: AsOf = None, days: int = 14, limit: int | None = None) -> DataFrame:
    """As ``reports.competitor_history`` over all products."""
    recent = rollup.where(looks_back(rollup, "snapshot_date", as_of_date(as_of, rollup), days))
    out = _totals(_rivals(recent, seller), "historical_competitor").select(
        "historical_competitor", F.col("product_days").alias("days_won_buybox"), F.col("avg_price").alias("avg_winning_price")
    )
    return capped(out.orderBy(F.col("days_won_buybox").desc(), "historical_competitor"), limit)


def current_owners_of(rollup: DataFrame, seller: str, latest: AsOf = None, limit: int | None = None) -> DataFrame:
    """As ``reports.current_owners`` over all products, each of which has one snapshot a day."""
    today = rollup.where(F.col("snapshot_date") == as_of_date(latest, rollup))
    out = _totals(_rivals(today, seller), "current_owner").select(
        "current_owner", F.col("product_days").alias("products_won_today"), F.col("avg_price").alias("current_avg_price")
    )
    return capped(out.orderBy(F.col("products_won_today").desc(), "current_owner"), limit)


def rivals_and_shadows_of(rollup: DataFrame, seller: str, as_of: AsOf = None, days: int = 14) -> DataFrame:
    """As ``market.rivals_and_shadows``."""
    now, past = current_owners_of(rollup, seller, as_of), competitor_history_of(rollup, seller, as_of, days)
    return past.join(now, F.col("historical_competitor") == F.col("current_owner"), "left").select(
        F.col("historical_competitor").alias("competitor"),
        F.when(F.col("current_owner").isNull(), "shadow").otherwise("active").alias("role"),
        "days_won_buybox",
        F.coalesce("products_won_today", F.lit(0).cast("bigint")).alias("products_won_today"),
        "avg_winning_price",
    )
