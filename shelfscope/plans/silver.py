"""Cleansed tables between the landed rows and the daily snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.variants import elements, get, members
from shelfscope.operators.dedupe import first_seen, latest
from shelfscope.operators.merge import days_of, stored_rows
from shelfscope.schemas import SELLER_STOCK, SILVER_LISTING, SILVER_OFFERS, conform


def _plain_label() -> Column:
    """Offer rows carry ``label-node``; the node is a column of its own here."""
    suffix = F.concat(F.lit("-"), F.col("node_label"))
    return F.when(
        F.col("category_label").endswith(suffix),
        F.expr("left(category_label, length(category_label) - length(node_label) - 1)"),
    ).otherwise(F.col("category_label"))


# One offer of one extraction.
OFFER_KEYS = ("asin", "extracted_at", "offer_position")


def flat_offers(offer_rows: DataFrame) -> DataFrame:
    """One row per offer and extraction, with its total price.

    An offer is landed once per delivery option, and again when a load is repeated; the copies agree
    in everything kept here, so the first one by value stands for them.
    """
    at = F.col("extracted_at").try_cast("timestamp")
    total = F.col("price") + F.coalesce("price_shipping", F.lit(0.0))
    seller = F.trim("seller")
    rows = conform(
        offer_rows.where("pricing_status = 'offer'").select(
            "asin",
            at.alias("extracted_at"),
            at.cast("date").alias("snapshot_date"),
            seller.alias("seller_name"),
            F.lower(seller).alias("seller_key"),
            "seller_id",
            "condition",
            "offer_position",
            total.cast("decimal(12,2)").alias("total_price"),
            _plain_label().alias("category_label"),
            F.col("node_label").alias("node"),
        ),
        SILVER_OFFERS,
    )
    return first_seen(rows, OFFER_KEYS, [F.col("total_price")])


def seller_stock(detail_rows: DataFrame) -> DataFrame:
    """Price and stock that product details state for each seller: the buy box's and the other sellers'.

    One row per product, seller and day, of the day's latest statement that has a stock, ties by the larger one. The
    lists arrive as arrays or as one object; entries without a seller, or whose stock is no whole number, state nothing.
    """

    def listed(column: str) -> Column:
        v = F.col(column)
        return F.coalesce(elements(v), F.when(members(v).isNotNull(), F.array(v)), F.array().cast("array<variant>"))

    at = F.col("extracted_at").try_cast("timestamp")
    entry = F.col("entry")
    seller = F.trim(F.coalesce(get(entry, "$.seller", "string"), get(entry, "$.seller_name", "string")))
    rows = (
        detail_rows.where("item_status = 'ok'")
        .select("asin", at.alias("at"), at.cast("date").alias("snapshot_date"), F.explode(F.concat(listed("buybox"), listed("other_sellers"))).alias("entry"))
        .select("asin", "at", "snapshot_date", seller.alias("seller_name"), get(entry, "$.price", "double").alias("price"), get(entry, "$.stock", "int").alias("stock"))
        .where("seller_name <> '' and stock is not null")
    )
    latest_first = F.struct("at", "stock", "price")
    return conform(
        rows.groupBy("asin", F.lower("seller_name").alias("seller_key"), "snapshot_date").agg(
            F.max("seller_name").alias("seller_name"), F.max_by("price", latest_first).alias("total_price"), F.max_by("stock", latest_first).alias("stock")
        ),
        SELLER_STOCK,
    )


def current_listing(listing_rows: DataFrame, scope: Sequence[str] = ("category_label", "node")) -> DataFrame:
    """Each product's newest listing row; active if seen in the newest extraction of its category.

    The newest extraction per category is one row per category, compared null-safely because a
    category may have no node.
    """
    rows = listing_rows.where("asin is not null").withColumn(
        "last_seen_at", F.col("extracted_at").try_cast("timestamp")
    )
    newest = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in scope]).agg(
        F.max("last_seen_at").alias("_newest")
    )
    kept = latest(
        rows.select(
            "asin", *scope, "title", "link", "position", "page_number", "rating", "reviews",
            "extracted_price", "last_seen_at",
        ),
        ["asin"],
        [F.col("last_seen_at"), -F.col("page_number"), -F.col("position")],
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in scope]
    return conform(
        kept.join(newest, same, "left").withColumn(
            "is_active", F.coalesce(F.col("last_seen_at") == F.col("_newest"), F.lit(False))
        ),
        SILVER_LISTING,
    )


def write_offers(offers: DataFrame, path: str) -> None:
    """Add silver offers to the table, partitioned by day and sorted by product.

    The days present are written anew with what they held before: a second load of a day adds to the first,
    and a load that is repeated changes nothing. The load's days are found first, by one small job, and are literals in
    the plan that reads the table, so no other day is opened.
    """
    stored = stored_rows(offers.sparkSession, path, offers.schema, "snapshot_date", days_of(offers, "snapshot_date"))
    whole = offers if stored is None else first_seen(stored.select(*offers.columns).unionByName(offers), OFFER_KEYS, [F.col("total_price")])
    (
        whole.hint("rebalance", "snapshot_date")
        .sortWithinPartitions("snapshot_date", "asin")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )
