"""Stored tables under configurable names."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableNames:
    """Catalog names; override those a deployment calls differently."""

    gold: str = "gold.snapshot_category_daily"
    offers: str = "silver.price_listing_flat"
    listing: str = "silver.product_listing_current"
    search_payloads: str = "landing.search_pages"
    offer_payloads: str = "landing.offer_payloads"
    detail_payloads: str = "landing.detail_payloads"
    pages: str = "landing.html_pages"


class Tables:
    """Lazy scans of the stored tables."""

    def __init__(self, spark: SparkSession, names: TableNames | None = None):
        self.spark = spark
        self.names = names or TableNames()

    def gold(self) -> DataFrame:
        return self.spark.table(self.names.gold)

    def newest_snapshot(self) -> dt.date | None:
        """Newest day of the stored gold table, read from the catalog's partitions without touching files.

        Passed as ``as_of`` it is a literal, so look-backs prune the days while the query is planned.
        """
        partitions = self.spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": self.names.gold})
        day = F.to_date(F.regexp_extract("partition", r"snapshot_date=([0-9-]+)", 1))
        return partitions.select(F.max(day)).first()[0]

    def offers(self) -> DataFrame:
        return self.spark.table(self.names.offers)

    def active_listing(self) -> DataFrame:
        return active(self.spark.table(self.names.listing))

    def register_views(self) -> None:
        """Temporary views ``gold``, ``offers`` and ``active_listing`` for parameterised SQL."""
        self.gold().createOrReplaceTempView("gold")
        self.offers().createOrReplaceTempView("offers")
        self.active_listing().createOrReplaceTempView("active_listing")

    def search_payloads(self) -> DataFrame:
        return self.spark.table(self.names.search_payloads)

    def offer_payloads(self) -> DataFrame:
        return self.spark.table(self.names.offer_payloads)

    def detail_payloads(self) -> DataFrame:
        return self.spark.table(self.names.detail_payloads)

    def pages(self) -> DataFrame:
        return self.spark.table(self.names.pages)


def write_bucketed(df: DataFrame, name: str, buckets: int, path: str | None = None, by: str = "asin", day: str = "snapshot_date") -> None:
    """Store a table by day and, within a day, in ``buckets`` by product.

    Tables stored with one number of buckets meet by product without a shuffle, and so do windows over a product's
    days. One row per task and bucket is avoided by dealing the rows out by bucket first.
    """
    writer = df.repartition(buckets, by).write.mode("overwrite").partitionBy(day).bucketBy(buckets, by).sortBy(by)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def active(listing: DataFrame) -> DataFrame:
    return listing.where("is_active")
