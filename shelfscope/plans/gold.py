"""The daily snapshot: one row per product and day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.variants import get
from shelfscope.schemas import GOLD_SNAPSHOT, conform

# Fixed value: sellers whose name starts like this are the marketplace itself.
MARKETPLACE_SELLER = "amazon"
# Rank by the newest extraction first; an offer table may hold several of a day.
NEWEST = "newest"


def offers_by_day(offers: DataFrame, rank_by: Sequence[str]) -> DataFrame:
    """Per product and day: the best-ranked offer, the lowest price and the number of sellers.

    The rank ends with everything that is picked by it, so offers that tie agree in all picked columns, and
    reading one column gives the same offer as reading all.

    Everything is a plain aggregate, combined inside the tasks before the shuffle, so a product with
    a large share of all offers does not land in one task. One aggregate per column lets Catalyst
    drop those a report does not read.
    """
    ties = ("total_price", "seller_id", "seller_name", "condition", "stock")
    rest = [c for c in ties if c in offers.columns and c not in rank_by]
    best = F.struct(*[-F.unix_micros("extracted_at") if c == NEWEST else F.col(c) for c in (*rank_by, *rest)])
    stock = F.col("stock") if "stock" in offers.columns else F.lit(None).cast("string")
    return offers.groupBy("asin", "snapshot_date").agg(
        F.min("category_label").alias("category_label"),
        F.min_by("total_price", best).alias("best_price"),
        F.min_by("seller_name", best).alias("best_seller"),
        F.min_by(stock, best).alias("best_stock"),
        F.count_distinct("seller_id").alias("seller_id_count"),
        F.min("total_price").alias("min_total_price"),
    )


def details_by_day(details: DataFrame) -> DataFrame:
    """Per product and day: the latest detail row's price, stock and buy-box seller."""
    ts = F.col("extracted_at").try_cast("timestamp")
    price = F.coalesce("price_buybox", "price") + F.coalesce("price_shipping", F.lit(0.0))
    seller = F.coalesce(
        get(F.col("buybox"), "$.seller", "string"),
        get(F.col("buybox"), "$.seller_name", "string"),
        get(F.col("buybox"), "$[0].seller", "string"),
        get(F.col("buybox"), "$[0].seller_name", "string"),
    )
    rows = details.where("item_status = 'ok'").select(
        "asin",
        ts.cast("date").alias("snapshot_date"),
        F.struct(
            ts.alias("at"),
            price.cast("decimal(12,2)").alias("price"),
            F.trim(seller).alias("seller"),
            F.col("stock").alias("stock"),
            F.col("category_label").alias("category_label"),
        ).alias("d"),
    )
    return (
        rows.groupBy("asin", "snapshot_date")
        .agg(F.max("d").alias("d"))
        .select(
            "asin",
            "snapshot_date",
            F.col("d.price").alias("detail_price"),
            F.col("d.seller").alias("detail_seller"),
            F.col("d.stock").alias("detail_stock"),
            F.col("d.category_label").alias("detail_category"),
        )
    )


def _snapshot(df: DataFrame, price: Column, seller: Column, stock: Column, category: Column, house: str) -> DataFrame:
    return df.select(
        "snapshot_date",
        "asin",
        category.alias("category_label"),
        price.alias("pdp_total_price"),
        seller.alias("buybox_seller_name"),
        F.lower(seller).alias("buybox_seller_key"),
        F.lower(seller).startswith(house).alias("buybox_is_amazon"),
        stock.alias("buybox_stock"),
        "seller_id_count",
        "min_total_price",
    )


def daily_snapshot(
    offers: DataFrame,
    details: DataFrame | None = None,
    rank_by: Sequence[str] = (NEWEST, "offer_position", "total_price"),
    house: str = MARKETPLACE_SELLER,
) -> DataFrame:
    """The gold table.

    The buy-box holder is the detail page's, else the seller of the best-ranked offer; products seen
    only in one of the two inputs are kept. Both inputs are reduced to one row per product and day
    before they are joined, so the join cannot fan out.
    """
    o = offers_by_day(offers, rank_by)
    if details is None:
        return _snapshot(
            o, F.col("best_price"), F.col("best_seller"), F.col("best_stock"), F.col("category_label"), house
        )
    both = o.join(details_by_day(details), ["asin", "snapshot_date"], "full")
    return _snapshot(
        both,
        F.coalesce("detail_price", "best_price"),
        F.coalesce("detail_seller", "best_seller"),
        F.coalesce("detail_stock", "best_stock"),
        F.coalesce("detail_category", "category_label"),
        house,
    ).withColumn("seller_id_count", F.coalesce("seller_id_count", F.lit(0).cast("bigint")))


def changed_since(table: DataFrame, since: dt.date | str, column: str = "snapshot_date") -> DataFrame:
    """Rows of the days to rebuild. ISO text compares like its dates, so landed rows are cut bare too."""
    return table.where(F.col(column) >= F.lit(since).cast("date").cast(table.schema[column].dataType))


def write_snapshot(gold: DataFrame, path: str) -> None:
    """Write the gold table partitioned by day; only the days present in ``gold`` are replaced.

    The rebalance hint lets AQE size the files and split a day that is much larger than the others.
    Rows are sorted by product inside the files, so a report on one product skips most row groups.
    """
    (
        conform(gold, GOLD_SNAPSHOT)
        .hint("rebalance", "snapshot_date")
        .sortWithinPartitions("snapshot_date", "asin")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def refresh_snapshot(
    offers: DataFrame, details: DataFrame | None, path: str, since: dt.date | str, house: str = MARKETPLACE_SELLER
) -> None:
    """Rebuild the days from ``since`` on and leave older days as they are.

    A day depends on its own rows only, so the older input is not read.
    """
    recent_details = None if details is None else changed_since(details, since, "extracted_at")
    write_snapshot(daily_snapshot(changed_since(offers, since), recent_details, house=house), path)
