"""The engine's tables derived from the test tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.plans.gold import daily_snapshot
from shelfscope.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_offers(events: DataFrame) -> DataFrame:
    """Each event as an offer: user = product, event type = seller, value = price, props.k = stock."""
    return events.select(
        F.col("user_id").cast("string").alias("asin"),
        F.to_date("ts").alias("snapshot_date"),
        F.col("ts").alias("extracted_at"),
        F.col("event_type").alias("seller_name"),
        F.col("event_type").alias("seller_key"),
        F.col("event_type").alias("seller_id"),
        F.col("value").alias("total_price"),
        F.get_json_object("props", "$.k").cast("int").alias("stock"),
        F.concat(F.lit("cat"), F.col("user_id") % 5).alias("category_label"),
        F.col("event_id").alias("offer_position"),
    )


@dataclass(frozen=True)
class Market:
    offers: DataFrame
    gold: DataFrame
    as_of: Column


def event_market(spark: SparkSession, sf_dir: str, days: int | None = None) -> Market:
    """Offers and gold snapshot of the events.

    ``days`` is the longest look-back the report will ask for: the bound goes on the raw timestamp,
    where the scan can use it, since this gold table is computed rather than stored by date.
    """
    events = table(spark, sf_dir, "events")
    as_of = events.select(F.max("ts").cast("date")).scalar()
    if days is not None:
        events = events.where(F.col("ts") >= F.date_sub(as_of, days).cast("timestamp_ntz"))
    offers = event_offers(events)
    return Market(offers, daily_snapshot(offers, rank_by=("total_price", "offer_position"), house="view"), as_of)


def part_market(spark: SparkSession, sf_dir: str) -> Market:
    """Line items as offers of a part in a year: supplier = seller, part type = category."""
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    day = F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1))
    offers = (
        items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_partkey").cast("string").alias("asin"),
            day.alias("snapshot_date"),
            day.cast("timestamp_ntz").alias("extracted_at"),
            F.col("s_name").alias("seller_name"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").alias("total_price"),
            F.col("l_quantity").alias("stock"),
            F.col("p_type").alias("category_label"),
        )
    )
    as_of = items.select(F.make_date(F.year(F.max("l_shipdate")), F.lit(1), F.lit(1))).scalar()
    gold = daily_snapshot(offers, rank_by=("total_price", "seller_name", "stock"), house="supplier#00000000")
    return Market(offers, gold, as_of)
