"""Market questions on small hand-made tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from checks import market_queries
from shelfscope.plans import market as M
from shelfscope.plans.silver import write_offers
from shelfscope.schemas import SILVER_OFFERS, conform

TODAY = dt.date(2024, 3, 31)


def day(n):
    return TODAY - dt.timedelta(days=n)


@pytest.fixture(scope="module")
def gold(spark):
    def build(*entries):
        """Entries ``(days ago, asin, holder, price, stock)``."""
        data = [(day(n), a, "c", p, h, str(s) if s is not None else None, p) for n, a, h, p, s in entries]
        return spark.createDataFrame(
            data,
            "snapshot_date date, asin string, category_label string, pdp_total_price double, buybox_seller_name string,"
            " buybox_stock string, min_total_price double",
        )

    return build


@pytest.fixture(scope="module")
def offers(spark):
    def build(*entries):
        """Entries ``(days ago, asin, seller, price, stock)``."""
        data = [(a, dt.datetime.combine(day(n), dt.time(8)), day(n), s, p, k, "c") for n, a, s, p, k in entries]
        return spark.createDataFrame(
            data,
            "asin string, extracted_at timestamp, snapshot_date date, seller_name string, total_price double, stock int,"
            " category_label string",
        )

    return build


def test_shadow_competitors_hold_nothing_now(gold, rows):
    g = gold((0, "A", "Rival", 1.0, 1), (3, "A", "Ghost", 2.0, 1), (4, "A", "Ghost", 4.0, 1), (3, "B", "me", 2.0, 1), (20, "A", "Old", 1.0, 1))
    assert [(r["competitor"], r["days_won_buybox"], r["avg_winning_price"]) for r in rows(M.shadow_competitors(g, "ME", TODAY))] == [("Ghost", 2, 3.0)]
    roles = {r["competitor"]: r["role"] for r in rows(M.rivals_and_shadows(g, "me", TODAY))}
    assert roles == {"Rival": "active", "Ghost": "shadow"}


def test_moves_skip_days_without_offers(offers, rows):
    o = offers(
        (5, "A", "x", 10.0, 3), (5, "A", "X", 9.0, 2), (3, "A", "x", 9.0, 2), (1, "A", "x", 8.0, 2), (0, "A", "x", 8.0, 0),
        (1, "A", "me", 1.0, 1), (0, "A", "me", 2.0, 1), (0, "B", "x", 1.0, 1),
    )
    out = sorted((r["snapshot_date"], r["price_change"], r["stock_change"]) for r in rows(M.competitor_moves(o, "Me", TODAY)))
    assert out == [(day(1), -1.0, 0), (day(0), 0.0, -2)]


def test_moves_of_stock_alone_with_silver_offers(gold, offers, rows):
    o = offers(*((n, "A", s, 9.0, 1) for n in (6, 5, 3, 2) for s in ("x", "y", "me")), (1, "A", "y", 8.0, 1)).drop("stock")
    g = gold((6, "A", "X", 9.0, 7), (5, "A", "Me", 9.0, 1), (3, "A", "x", 9.0, "many"), (2, "A", "X", 9.0, 4), (0, "A", "x", 9.0, 2))
    out = sorted((r["snapshot_date"], r["seller_key"], r["price_change"], r["stock_change"]) for r in rows(M.competitor_moves(o, "Me", TODAY, gold=g)))
    assert out == [(day(2), "x", 0.0, -3), (day(1), "y", -1.0, None), (day(0), "x", None, -2)]
    with pytest.raises(ValueError):
        M.competitor_moves(o, "Me", TODAY)


def test_gaps_stay_within_the_sellers_categories(gold, offers, rows):
    g = gold((0, "A", "x", 1.0, 1), (0, "B", "x", 2.0, 1)).unionByName(gold((0, "C", "x", 3.0, 1)).withColumn("category_label", F.lit("d")))
    assert [r["asin"] for r in rows(M.assortment_gaps(g, offers((0, "A", "me", 1.0, 1)), "me", TODAY))] == ["B"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables not mounted")
def test_gaps_of_a_month_reach_beyond_two_days(spark):
    out = market_queries.QUERIES["doc3_gaps_of_a_month"](spark, "/root/testdata/sf0.01").toPandas()
    assert len(out) > 1000 and (out["last_seen"].max() - out["last_seen"].min()).days > 20


def test_undercutting_gives_one_row_per_rival_and_day(offers, rows):
    o = offers((0, "A", "me", 10.0, 1), (0, "A", "ME", 11.0, 1), (0, "A", "x", 9.0, 1), (0, "A", "x", 8.5, 1), (0, "A", "y", 10.0, 1), (1, "A", "z", 1.0, 1))
    assert [(r["seller_key"], r["price"], r["my_price"], r["undercut_by"]) for r in rows(M.undercutting(o, "me", TODAY))] == [("x", 8.5, 10.0, 1.5)]


def test_price_drops(gold, rows):
    g = gold((2, "A", "x", 10.0, 1), (2, "B", "x", 20.0, 1), (1, "A", "x", 12.0, 1), (0, "A", "x", 13.0, 1))
    assert [(r["snapshot_date"], r["prev_avg_price"], r["drop_pct"]) for r in rows(M.category_price_drops(g, TODAY))] == [(day(1), 15.0, 20.0)]


def test_stock_questions(gold, offers, rows):
    g = gold((0, "A", "me", 1.0, 5), (0, "B", "me", 1.0, 6), (1, "A", "x", 1.0, 1), (0, "C", "me", 1.0, None), (1, "D", "me", 1.0, 9), (0, "D", "x", 1.0, 9), (1, "E", "me", 1.0, 9), (0, "E", "x", 1.0, 9), (1, "F", "me", 1.0, 9), (0, "F", "x", 1.0, 9))
    assert [r["asin"] for r in rows(M.low_stock(g, "ME", as_of=TODAY))] == ["A"]
    o = offers((0, "D", "me", 1.0, 0), (0, "E", "me", 1.0, 50), (1, "F", "me", 1.0, 50))
    assert sorted((r["asin"], r["my_stock"]) for r in rows(M.lost_out_of_stock(g, o, "me", as_of=TODAY))) == [("D", 0), ("F", None)]


def test_new_sellers_on_own_products(offers, rows):
    o = offers((30, "A", "me", 1.0, 1), (9, "A", "old", 1.0, 1), (0, "A", "old", 1.0, 1), (7, "A", "New", 1.0, 1), (0, "A", "NEW", 1.0, 1), (0, "B", "new", 1.0, 1))
    assert [(r["asin"], r["seller_key"], r["first_seen"]) for r in rows(M.new_sellers(o, "me", TODAY))] == [("A", "new", day(7))]


def test_main_competitor_ties_go_by_name(gold, rows):
    g = gold((0, "A", "y", 1.0, 1), (1, "A", "x", 3.0, 1), (2, "A", "me", 1.0, 1), (0, "B", "z", 1.0, 1), (1, "B", "z", 2.0, 1), (2, "B", "x", 2.0, 1))
    out = {r["asin"]: (r["competitor"], r["days_won"], r["avg_price"]) for r in rows(M.main_competitors(g, "ME", as_of=TODAY))}
    assert out == {"A": ("x", 1, 3.0), "B": ("z", 2, 1.5)}
    assert [r["asin"] for r in rows(M.main_competitors(g, "me", ["b"], TODAY))] == ["B"]


def test_top_risks_are_the_best_placed_losses(spark, gold, rows):
    lost = [e for a in "ABCDE" for e in ((1, a, "me", 1.0, 1), (0, a, "x", 1.0, 1))]
    placed = spark.createDataFrame([("A", 49), ("B", 50), ("C", 3), ("C", 9), ("D", 7), ("E", 8)], "asin string, position int")
    assert [(r["asin"], r["position"]) for r in rows(M.top_risks(gold(*lost), placed, "me", TODAY, limit=3))] == [("C", 3), ("D", 7), ("E", 8)]
    assert [r["asin"] for r in rows(M.top_risks(gold(*lost), placed, "me", TODAY))] == ["C", "D", "E", "A"]


def test_stored_offers_are_pruned_by_day_and_pushed_by_seller(spark, offers, tmp_path):
    o = conform(
        offers(*[(n, f"P{n}", "Me", 1.0, 1) for n in range(5)]).withColumn("seller_key", F.lower("seller_name")), SILVER_OFFERS
    )
    write_offers(o, str(tmp_path / "offers"))
    stored = spark.read.parquet(str(tmp_path / "offers"))
    assert stored.count() == 5
    from shelfscope.plans.portfolio import portfolio_asins

    mine = portfolio_asins(stored, "ME", TODAY, 2)
    assert mine.count() == 3
    scan = mine._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(seller_key,me)" in scan and "GreaterThanOrEqual(extracted_at" in scan
    assert "PartitionFilters: [isnotnull(snapshot_date" in scan


def test_out_of_stock_from_the_snapshots(gold, offers, rows):
    g = gold(
        (2, "A", "me", 1.0, "9"), (1, "A", "me", 1.0, "2"), (0, "A", "x", 1.0, "7"),
        (1, "B", "me", 1.0, "50"), (0, "B", "x", 1.0, "1"), (1, "C", "me", 1.0, None), (0, "C", "x", 1.0, "1"),
    )
    o = offers((0, "A", "me", 1.0, 1)).drop("stock")
    assert [(r["asin"], r["my_stock"]) for r in rows(M.lost_out_of_stock(g, o, "Me", as_of=TODAY))] == [("A", 2)]
