"""Product performance and the rule table that explains it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions import predicates as P
from shelfscope.functions.dates import AsOf, recent_offers
from shelfscope.functions.text import money
from shelfscope.operators.dedupe import latest
from shelfscope.plans.reports import HOLDER, recent

# Thresholds in currency units.
OVERPRICED_ABOVE = 0.10
ALIGNED_WITHIN = 0.05
HEADROOM_FROM = 0.50


def _my_offers(offers: DataFrame, seller: str, as_of: AsOf, days: int, asin: str | None) -> DataFrame:
    rows = recent_offers(offers, as_of, days).where(P.same_seller(P.seller_key(offers, "seller_name"), seller))
    return rows if asin is None else rows.where(P.asin_is(asin))


def _against_mine(rows: DataFrame, seller: str) -> DataFrame:
    """Snapshot rows that carry ``my_price``, with price gap and headroom."""
    key = P.seller_key(rows, HOLDER)
    my_price, price = F.col("my_price"), F.col("pdp_total_price")
    return rows.select(
        "asin",
        "snapshot_date",
        HOLDER,
        price.alias("buybox_price"),
        "min_total_price",
        "buybox_is_amazon",
        "my_price",
        (my_price - price).alias("price_gap"),
        (my_price - F.col("min_total_price")).alias("headroom"),
        P.wins_or_unheld(key, seller).alias("am_i_buybox"),
    )


def product_performance(
    gold: DataFrame,
    offers: DataFrame,
    seller: str,
    asin: str | None = None,
    as_of: AsOf = None,
    days: int = 14,
    limit: int | None = None,
) -> DataFrame:
    """Snapshots against the seller's own lowest price at each extraction of the day.

    For one product the rows are sorted, newest first, and ``limit`` caps them where it is given.
    A day with several extractions gives several rows, a day without any gives one. The two cases
    are joined apart: an inner join can be split where one product and day has very many
    extractions, a left join from the snapshots cannot.
    """
    day = ["asin", "snapshot_date"]
    mine = (
        _my_offers(offers, seller, as_of, days, asin)
        .groupBy("asin", "extracted_at")
        .agg(F.min("total_price").alias("my_price"))
        .select("asin", F.to_date("extracted_at").alias("snapshot_date"), "my_price")
    )
    rows = recent(gold, as_of, days)
    rows = rows if asin is None else rows.where(P.asin_is(asin))
    no_price = F.lit(None).cast(mine.schema["my_price"].dataType)
    unoffered = rows.join(mine.select(*day).distinct(), day, "left_anti").withColumn("my_price", no_price)
    out = _against_mine(mine.join(rows, day).unionByName(unoffered), seller)
    if asin is None:
        return out
    out = out.orderBy(F.col("snapshot_date").desc_nulls_last(), F.col("my_price").asc_nulls_last())
    return out if limit is None else out.limit(limit)


def newest_performance(
    gold: DataFrame, offers: DataFrame, seller: str, asin: str | None = None, as_of: AsOf = None, days: int = 14
) -> DataFrame:
    """Each product's newest row; of several extractions that day the lowest own price counts.

    Both sides are reduced before the join: the snapshot to one row per product, the offers to one
    price per product and day.
    """
    rows = recent(gold, as_of, days)
    if asin is not None:
        rows = rows.where(P.asin_is(asin))
    key = P.seller_key(rows, HOLDER)
    newest = latest(
        rows.select(
            "asin", "snapshot_date", HOLDER, key.alias("buybox_seller_key"),
            "pdp_total_price", "min_total_price", "buybox_is_amazon",
        ),
        ["asin"],
        [F.col("snapshot_date")],
    )
    mine = (
        _my_offers(offers, seller, as_of, days, asin)
        .groupBy("asin", F.to_date("extracted_at").alias("snapshot_date"))
        .agg(F.min("total_price").alias("my_price"))
    )
    return _against_mine(newest.join(mine, ["asin", "snapshot_date"], "left"), seller)


def diagnose(performance: DataFrame) -> DataFrame:
    """Status, reason and action of each performance row.

    A gap above 0.05 and up to 0.10 has no rule: reason and action stay empty.
    """
    d = "double"
    winning = F.col("am_i_buybox")
    box = F.coalesce(F.col("buybox_price").cast(d), F.lit(0.0))
    floor = F.coalesce(F.col("min_total_price").cast(d), F.lit(0.0))
    own = F.nullif(F.col("my_price").cast(d), F.lit(0.0))
    mine = F.when(winning, F.coalesce(own, box)).otherwise(own)
    gap = F.when(winning, F.lit(0.0)).otherwise(F.col("price_gap").cast(d))
    headroom = F.when(winning, F.coalesce(F.col("headroom").cast(d), mine - floor)).otherwise(
        F.col("headroom").cast(d)
    )
    spare = F.col("headroom") >= HEADROOM_FROM
    rules = [
        # condition, reason, action, explanation, advice
        (winning & spare, "headroom", "test_small_increase",
         F.concat(F.lit("Holding the buy box with "), money(F.col("headroom")), F.lit(" room above the lowest offer.")),
         F.lit("Try a small price increase.")),
        (winning, "holding", "maintain",
         F.concat(F.lit("Holding the buy box at "), money(F.col("buybox_price")), F.lit(".")),
         F.lit("Keep the price.")),
        (F.col("price_gap").isNull(), "no_offer_data", "verify_listing",
         F.lit("No own offer was found for this day."),
         F.concat(F.lit("Check the listing; the buy box stands at "), money(F.col("buybox_price")), F.lit("."))),
        (F.col("price_gap") > OVERPRICED_ABOVE, "overpriced", "decrease_price",
         F.concat(F.lit("Priced "), money(F.col("price_gap")), F.lit(" above the buy box.")),
         F.concat(F.lit("Lower the price to "), money(F.col("buybox_price")), F.lit("."))),
        (F.abs(F.col("price_gap")) <= ALIGNED_WITHIN, "aligned", "non_price_factors",
         F.lit("The price matches the buy box, yet another seller holds it."),
         F.lit("Look at delivery speed and seller rating.")),
        (F.col("price_gap") < -ALIGNED_WITHIN, "cheaper", "do_not_lower",
         F.concat(F.lit("Cheaper than the buy box by "), money(F.abs(F.col("price_gap"))), F.lit(", yet not holding it.")),
         F.lit("Leave the price; improve delivery or account health.")),
    ]

    def chosen(index: int):
        out = None
        for rule in rules:
            value = F.lit(rule[index]) if isinstance(rule[index], str) else rule[index]
            out = F.when(rule[0], value) if out is None else out.when(rule[0], value)
        return out.otherwise(F.lit(""))

    note = ~winning & F.coalesce(F.col("buybox_is_amazon"), F.lit(False))
    typed = performance.select(
        "asin",
        "snapshot_date",
        "am_i_buybox",
        "buybox_is_amazon",
        F.when(winning, "WINNING").otherwise("LOSING").alias("status"),
        box.alias("buybox_price"),
        mine.alias("my_price"),
        gap.alias("price_gap"),
        headroom.alias("headroom"),
        note.alias("held_by_marketplace"),
    )
    remark = F.when(F.col("held_by_marketplace"), " (The marketplace itself holds the buy box.)").otherwise("")
    return typed.select(
        "asin",
        "snapshot_date",
        "status",
        chosen(1).alias("reason"),
        chosen(2).alias("action"),
        "buybox_price",
        "my_price",
        "price_gap",
        "headroom",
        "held_by_marketplace",
        F.concat_ws(
            "\n",
            F.concat(F.lit("Product "), F.col("asin"), F.lit(": "), F.col("status")),
            F.concat(F.lit("Diagnosis: "), chosen(3), remark),
            F.concat(F.lit("Action: "), chosen(4)),
            F.concat(
                F.lit("Buy box: "), money(F.col("buybox_price")),
                F.lit(", own price: "), F.coalesce(money(F.col("my_price")), F.lit("N/A")),
            ),
        ).alias("report_text"),
    )
