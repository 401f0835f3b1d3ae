"""Portfolio health: who holds the seller's products now."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions import predicates as P
from shelfscope.functions.dates import AsOf, recent_offers
from shelfscope.functions.text import percent
from shelfscope.plans.reports import HOLDER, recent

# The usual length of a short product list, and the win rate a healthy portfolio exceeds.
SHORT_LIST = 20
HEALTHY_ABOVE = 70


def portfolio_asins(offers: DataFrame, seller: str, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Products the seller offered in the window, each once."""
    return (
        recent_offers(offers, as_of, days)
        .where(P.same_seller(P.seller_key(offers, "seller_name"), seller))
        .select("asin")
        .distinct()
    )


def latest_standing(
    gold: DataFrame, offers: DataFrame, seller: str, as_of: AsOf = None, days: int = 14, offer_days: int = 30
) -> DataFrame:
    """Each portfolio product's newest row with ``is_winning`` and ``just_lost``.

    Previous holder and "is the newest row" are both read off one ordering, so there is one shuffle
    and one sort by product; a group is as long as the look-back at most.
    """
    rows = recent(gold, as_of, days)
    key = P.seller_key(rows, HOLDER)
    by_day = Window.partitionBy("asin").orderBy("snapshot_date")
    return (
        rows.select("asin", "snapshot_date", key.alias("now_key"))
        .join(portfolio_asins(offers, seller, as_of, offer_days), "asin", "left_semi")
        .withColumns(
            {
                "prev_key": F.lag("now_key").over(by_day),
                "next_date": F.lead("snapshot_date").over(by_day),
            }
        )
        .where(F.col("next_date").isNull())
        .select(
            "asin",
            P.wins(F.col("now_key"), seller).alias("is_winning"),
            F.coalesce(P.just_lost(F.col("now_key"), F.col("prev_key"), seller), F.lit(False)).alias("just_lost"),
        )
    )


def portfolio_health(
    gold: DataFrame,
    offers: DataFrame,
    seller: str,
    as_of: AsOf = None,
    days: int = 14,
    offer_days: int = 30,
    list_cap: int | None = None,
) -> DataFrame:
    """One row: product counts, win rate and the products of each side by name.

    With ``list_cap`` the lists hold the first names only: the rank filter cuts to the cap inside every task before the
    shuffle, so no side is collected whole. Without it one row holds all names; ``latest_standing`` has them as rows.
    """
    return health_of(latest_standing(gold, offers, seller, as_of, days, offer_days), seller, list_cap)


def health_of(standing: DataFrame, seller: str, list_cap: int | None = None) -> DataFrame:
    """The summary row of a standing, however it was found."""
    counts = standing.agg(
        F.count("asin").alias("total"),
        F.count_if("is_winning").alias("won"),
        F.count_if("just_lost").alias("lost_today"),
    ).select("total", "won", "lost_today", F.lit(None).cast("boolean").alias("side"), F.lit(None).cast("string").alias("name"))
    # just_lost in the order makes both branches read the same columns, so Spark runs the shared part once.
    by_name = Window.partitionBy("is_winning").orderBy("asin", "just_lost")
    listed_rows = standing if list_cap is None else standing.withColumn("rank", F.row_number().over(by_name)).where(F.col("rank") <= list_cap)
    names = listed_rows.select(
        *[F.lit(None).cast("bigint").alias(c) for c in ("total", "won", "lost_today")],
        F.col("is_winning").alias("side"),
        F.col("asin").alias("name"),
    )

    def listed(side: bool):
        hits = F.sort_array(F.collect_list(F.when(F.col("side") == side, F.col("name"))))
        return F.nullif(F.array_join(hits, ", "), F.lit(""))

    summary = counts.unionByName(names).agg(
        F.max("total").alias("total_products"),
        F.max("won").alias("winning_count"),
        F.max("lost_today").alias("at_risk_count"),
        listed(False).alias("losing_asins"),
        listed(True).alias("winning_asins"),
    )
    rate = F.when(
        F.col("total_products") > 0, F.col("winning_count") / F.col("total_products") * 100
    ).otherwise(F.lit(0.0))
    healthy = F.col("win_rate") > HEALTHY_ABOVE
    return (
        summary.withColumn("win_rate", rate)
        .withColumn("insight", F.when(healthy, "healthy").otherwise("revenue_at_risk"))
        .withColumn(
            "report_text",
            F.concat_ws(
                "\n",
                F.concat(F.lit(f"Portfolio of {seller}: "), F.col("total_products"), F.lit(" products")),
                F.concat(F.lit("Win rate: "), percent(F.col("win_rate")), F.lit(", lost today: "), F.col("at_risk_count")),
                F.concat(F.lit("Holding: "), F.coalesce("winning_asins", F.lit("None"))),
                F.concat(F.lit("Not holding: "), F.coalesce("losing_asins", F.lit("None"))),
                F.when(healthy, "The portfolio is in good shape.").otherwise(
                    "Revenue is at risk; look into the lost buy boxes first."
                ),
            ),
        )
    )
