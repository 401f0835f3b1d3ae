"""All seller reports over one pair of tables, as rows or as text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.dates import AsOf
from shelfscope.plans import reports as R
from shelfscope.plans.diagnosis import diagnose, newest_performance, product_performance
from shelfscope.plans.portfolio import portfolio_health
from shelfscope.sources.tables import Tables


@dataclass(frozen=True)
class SellerDesk:
    """The reports of ``gold`` and ``offers`` on one day; each method returns a lazy DataFrame."""

    gold: DataFrame
    offers: DataFrame
    as_of: AsOf = None

    @classmethod
    def of_tables(cls, tables: Tables) -> SellerDesk:
        """The desk of the stored tables on their newest day.

        The day comes from the catalog's partitions and is a literal, so every report's look-back cuts the partitions
        while it is planned, and no file is opened to find the day.
        """
        return cls(tables.gold(), tables.offers(), tables.newest_snapshot())

    def daily_pulse(self, seller: str) -> DataFrame:
        return R.daily_pulse(self.gold, seller, self.as_of)

    def price_competitiveness(self, asin: str) -> DataFrame:
        return R.price_competitiveness(self.gold, asin, self.as_of)

    def stock_status(self, seller: str) -> DataFrame:
        return R.stock_status(self.gold, seller, self.as_of)

    def buy_box_changes(self, seller: str, days: int = 2, limit: int | None = None) -> DataFrame:
        return R.buy_box_changes(self.gold, seller, days, self.as_of, limit)

    def general_data(self, limit: int | None = None) -> DataFrame:
        return R.general_data(self.gold, self.as_of, limit=limit)

    def product_performance(self, asin: str, seller: str) -> DataFrame:
        return product_performance(self.gold, self.offers, seller, asin, self.as_of)

    def diagnosis(self, seller: str, asin: str | None = None) -> DataFrame:
        """Diagnosis of one product, or of every product of the snapshot."""
        return diagnose(newest_performance(self.gold, self.offers, seller, asin, self.as_of))

    def portfolio_health(self, seller: str) -> DataFrame:
        return portfolio_health(self.gold, self.offers, seller, self.as_of)

    def asin_raw_history(self, asin: str) -> DataFrame:
        return R.asin_raw_history(self.gold, asin, self.as_of)

    def current_owners(self, seller: str, asins: Sequence[str] | None = None) -> DataFrame:
        return R.current_owners(self.gold, seller, asins, self.as_of)

    def competitor_history(self, seller: str, asins: Sequence[str] | None = None) -> DataFrame:
        return R.competitor_history(self.gold, seller, asins, self.as_of)

    def competitor_landscape(self, seller: str, asins: Sequence[str] | None = None) -> DataFrame:
        """Both competitor tables as text lines under headings; sort by ``part, pos``."""
        spark = self.gold.sparkSession
        sections = (
            ("Holding the buy box now:", self.current_owners(seller, asins)),
            ("Holding it over the last 14 days:", self.competitor_history(seller, asins)),
        )
        lines = spark.createDataFrame(
            [(10 * i, 0, heading) for i, (heading, _) in enumerate(sections)], "part int, pos long, line string"
        )
        for i, (_, table) in enumerate(sections):
            lines = lines.unionByName(R.as_text(table).withColumn("part", F.col("part") + 10 * i + 1))
        return lines
