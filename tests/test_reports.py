"""Seller reports on small hand-made snapshots."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfscope.plans import reports as R
from shelfscope.plans.diagnosis import diagnose, newest_performance, product_performance
from shelfscope.plans.portfolio import portfolio_health

TODAY = dt.date(2024, 3, 31)
GOLD = (
    "snapshot_date date, asin string, category_label string, pdp_total_price double, buybox_seller_name string,"
    " buybox_is_amazon boolean, buybox_stock string, seller_id_count long, min_total_price double"
)
OFFERS = "asin string, extracted_at timestamp, seller_name string, total_price double"


def day(n):
    return TODAY - dt.timedelta(days=n)


def at(n, hour=8):
    return dt.datetime.combine(day(n), dt.time(hour))


def gold(spark, *entries):
    """Entries ``(days ago, asin, holder[, price[, lowest]])``."""
    data = []
    for e in entries:
        ago, asin, holder, price, lowest = (*e, 10.0, 9.0)[:5] if len(e) == 3 else (*e, 9.0)[:5]
        data.append((day(ago), asin, "c", price, holder, holder == "Amazon.de", "3", 1, lowest))
    return spark.createDataFrame(data, GOLD)


def offers(spark, *entries):
    return spark.createDataFrame([(asin, at(ago), seller, price) for ago, asin, seller, price in entries], OFFERS)


def test_daily_pulse_keeps_the_rows_the_seller_lost(spark, rows):
    g = gold(spark, (0, "A", "Other"), (1, "A", "ME"), (2, "A", "Other"), (3, "A", "me"), (0, "B", "Other"), (0, "C", None))
    out = rows(R.daily_pulse(g, "Me", TODAY))
    assert [(r["snapshot_date"], r["asin"]) for r in out] == [(day(0), "A"), (day(1), "A"), (day(2), "A")]


def test_default_as_of_is_the_newest_snapshot(spark, rows):
    g = gold(spark, (5, "A", "me"), (7, "A", "me"), (8, "A", "me"))
    assert len(rows(R.stock_status(g, "me"))) == 2


def test_asin_arguments_are_upper_cased_but_the_column_is_not(spark, rows):
    g = gold(spark, (0, "AB", "x"), (14, "AB", "x"), (15, "AB", "x"), (0, "ab", "x"))
    assert [r["snapshot_date"] for r in rows(R.price_competitiveness(g, "ab", TODAY))] == [day(0), day(14)]
    assert len(rows(R.asin_raw_history(g, "aB", TODAY))) == 2


def test_changes_compare_with_the_previous_row_of_the_window(spark, rows):
    g = gold(
        spark,
        (5, "A", "me"), (1, "A", "other"),  # a gap of days is skipped; a loss
        (2, "B", "other"), (0, "B", "ME"),  # a gain, case ignored
        (2, "C", "me"), (1, "C", None), (0, "C", "other"),  # an unheld day hides both sides
        (0, "D", "me"),  # the first row of the window has nothing before it
        (1, "E", "x"), (0, "E", "y"),
    )
    out = rows(R.buy_box_changes(g, "me", 10, TODAY))
    assert [(r["asin"], r["prev_day_buybox_seller"]) for r in out] == [("B", "other"), ("A", "me")]


def test_change_window_is_held_between_1_and_30_days(spark, rows):
    assert [R.at_least_a_day(n) for n in (-3, 0, 1, 14, 30, 31)] == [1, 1, 1, 14, 30, 31]
    g = gold(spark, (2, "A", "me"), (1, "A", "other"), (0, "A", "me"))
    assert len(rows(R.buy_box_changes(g, "me", 0, TODAY))) == 1


def test_top_rows_break_ties_by_product(spark, rows):
    g = gold(spark, *[(0, f"P{i:03}", "x") for i in range(120)])
    for limit, n in ((100, 100), (None, 120)):
        out = rows(R.general_data(g, TODAY, limit=limit))
        assert [r["asin"] for r in out] == [f"P{i:03}" for i in range(n)]


def test_owners_use_the_newest_date_of_the_whole_table(spark, rows):
    g = gold(spark, (0, "A", "Rival"), (0, "B", None), (0, "C", "ME"), (1, "D", "Rival"), (0, "E", "Rival", 20.0), (0, "F", "rival"))
    out = rows(R.current_owners(g, "me"))
    assert [(r["current_owner"], r["products_won_today"], r["current_avg_price"]) for r in out] == [
        ("Rival", 2, 15.0), ("rival", 1, 10.0),
    ]
    assert rows(R.current_owners(g, "me", ["d"])) == []  # D is not on the newest date
    past = rows(R.competitor_history(g, "me", ["a", "d"], TODAY))
    assert [(r["historical_competitor"], r["days_won_buybox"]) for r in past] == [("Rival", 2)]


def test_performance_counts_an_unheld_box_as_own_and_fans_out(spark, rows):
    g = gold(spark, (0, "A", None), (1, "A", "other", 10.0), (2, "A", "other"))
    o = spark.createDataFrame(
        [("A", at(1, 8), "ME", 12.0), ("A", at(1, 8), "me", 11.0), ("A", at(1, 9), "me", 13.0), ("A", at(0), "x", 1.0)], OFFERS
    )
    out = rows(product_performance(g, o, "me", "a", TODAY))
    assert [(r["snapshot_date"], r["my_price"], r["am_i_buybox"]) for r in out] == [
        (day(0), None, True), (day(1), 11.0, False), (day(1), 13.0, False), (day(2), None, False),
    ]
    assert out[1]["price_gap"] == 1.0 and out[1]["headroom"] == 2.0
    newest = rows(newest_performance(g, o, "me", as_of=TODAY))
    assert [(r["snapshot_date"], r["my_price"]) for r in newest] == [(day(0), None)]


def test_performance_matches_a_plain_left_join(spark):
    g = gold(spark, *[(n, f"P{p}", "x") for n in range(4) for p in range(5)])
    o = spark.createDataFrame(
        [(f"P{p}", at(n, 1 + h), "me", float(h)) for n in range(0, 4, 2) for p in range(0, 5, 2) for h in range(3)], OFFERS
    )
    mine = o.withColumn("snapshot_date", F.to_date("extracted_at")).select("asin", "snapshot_date", F.col("total_price").alias("my_price"))
    want = g.join(mine, ["asin", "snapshot_date"], "left").select("asin", "snapshot_date", "my_price")
    got = product_performance(g, o, "me", as_of=TODAY).select("asin", "snapshot_date", "my_price")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


PERFORMANCE = (
    "asin string, snapshot_date date, buybox_price double, min_total_price double, buybox_is_amazon boolean,"
    " my_price double, price_gap double, headroom double, am_i_buybox boolean"
)


@pytest.mark.parametrize(
    "gap, reason, action",
    [
        (None, "no_offer_data", "verify_listing"), (0.11, "overpriced", "decrease_price"), (0.10, "", ""), (0.07, "", ""),
        (0.05, "aligned", "non_price_factors"), (0.0, "aligned", "non_price_factors"),
        (-0.05, "aligned", "non_price_factors"), (-0.06, "cheaper", "do_not_lower"),
    ],
)
def test_losing_rules(spark, rows, gap, reason, action):
    data = [("A", TODAY, 10.0, 9.0, True, 10.0, gap, 1.0, False)]
    out = rows(diagnose(spark.createDataFrame(data, PERFORMANCE)))[0]
    assert (out["status"], out["reason"], out["action"]) == ("LOSING", reason, action)
    assert out["held_by_marketplace"] and "marketplace itself" in out["report_text"]


@pytest.mark.parametrize(
    "my_price, headroom, lowest, want",
    [
        (10.0, 0.5, 9.5, ("headroom", 0.5, 10.0)), (10.0, 0.49, 9.51, ("holding", 0.49, 10.0)),
        (10.0, 0.0, 10.0, ("holding", 0.0, 10.0)),
        (None, None, 9.0, ("headroom", 1.0, 10.0)),  # no own offer: the box price stands for it
        (0.0, -9.0, 9.0, ("holding", -9.0, 10.0)), (None, None, None, ("headroom", 10.0, 10.0)),
    ],
)
def test_winning_rules(spark, rows, my_price, headroom, lowest, want):
    data = [("A", TODAY, 10.0, lowest, True, my_price, None, headroom, True)]
    out = rows(diagnose(spark.createDataFrame(data, PERFORMANCE)))[0]
    assert (out["reason"], out["headroom"], out["my_price"]) == want
    assert out["price_gap"] == 0.0 and not out["held_by_marketplace"]


def test_portfolio_counts_unheld_as_not_winning(spark, rows):
    g = gold(
        spark,
        (0, "A", "ME"), (0, "B", None), (1, "B", "me"), (0, "C", "x"), (2, "C", "me"), (1, "D", "x"), (2, "D", "x"), (0, "Z", "me"),
    )
    o = offers(spark, *[(3, a, "Me", 1.0) for a in "ABCD"], (0, "A", "me", 1.0), (31, "Z", "me", 1.0), (0, "Z", "x", 1.0))
    out = rows(portfolio_health(g, o, "me", TODAY))[0]
    assert (out["total_products"], out["winning_count"], out["at_risk_count"]) == (4, 1, 1)
    assert (out["winning_asins"], out["losing_asins"], out["win_rate"]) == ("A", "B, C, D", 25.0)
    assert out["insight"] == "revenue_at_risk"


def test_portfolio_lists_are_capped_and_70_percent_is_not_healthy(spark, rows):
    names = [f"P{i:02}" for i in range(30)]
    g = gold(spark, *[(0, a, "me" if i < 21 else "x") for i, a in enumerate(names)])
    o = offers(spark, *[(0, a, "me", 1.0) for a in names])
    whole = rows(portfolio_health(g, o, "me", TODAY))[0]
    assert whole["winning_asins"] == ", ".join(names[:21]) and whole["losing_asins"] == ", ".join(names[21:])
    out = rows(portfolio_health(g, o, "me", TODAY, list_cap=20))[0]
    assert out["win_rate"] == pytest.approx(70.0) and out["insight"] == "revenue_at_risk"
    assert out["winning_asins"] == ", ".join(names[:20]) and out["losing_asins"] == ", ".join(names[21:])


def test_empty_portfolio_is_one_row_of_zeros(spark, rows):
    out = rows(portfolio_health(gold(spark, (0, "A", "x")), offers(spark, (0, "A", "x", 1.0)), "me", TODAY))
    assert len(out) == 1
    assert (out[0]["total_products"], out[0]["win_rate"], out[0]["losing_asins"]) == (0, 0.0, None)


def test_text_lines(spark):
    data = [(TODAY, 12.5, None, True, 12345678.25)]
    df = spark.createDataFrame(data, "d date, p double, s string, b boolean, big double")
    lines = [r["line"] for r in R.as_text(df).orderBy("part", "pos").collect()]
    numbers = [0.0005, 1e-05, 1.5e-07, 1e16, 1.5e17, 9999999.0, 1e7, -0.00012, 0.0, float("nan"), float("-inf")]
    cells = R.as_text(spark.createDataFrame([(x,) for x in numbers], "x double")).where("part = 1").orderBy("pos").collect()
    assert [(r["pos"], r["line"]) for r in cells] == list(enumerate(map(str, numbers)))
    assert lines == ["d,p,s,b,big", "2024-03-31,12.5,None,True,12345678.25"]
    empty = R.as_text(df.where("p > 100"), "nothing").collect()
    assert [r["line"] for r in empty] == ["nothing"]


def test_plans_prune_and_limit(spark, tmp_path):
    from shelfscope.plans.gold import write_snapshot

    g = gold(spark, *[(n, f"P{n}", "me") for n in range(20)]).withColumn("buybox_seller_key", F.lower("buybox_seller_name"))
    write_snapshot(g, str(tmp_path / "gold"))
    stored = spark.read.parquet(str(tmp_path / "gold"))
    plan = R.general_data(stored, TODAY, limit=100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "PartitionFilters: [isnotnull(snapshot_date" in plan
    plan = R.stock_status(stored, "ME", TODAY)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(buybox_seller_key,me)" in plan
    o = offers(spark, (0, "P1", "me", 1.0))
    plan = portfolio_health(stored, o, "me", TODAY, list_cap=20)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_desk_gives_every_report(spark):
    from shelfscope.plans.desk import SellerDesk

    g = gold(spark, (0, "A", "x"), (1, "A", "me"), (0, "B", None))
    desk = SellerDesk(g, offers(spark, (0, "A", "me", 11.0)), TODAY)
    counts = [
        df.count()
        for df in (
            desk.daily_pulse("ME"), desk.price_competitiveness("a"), desk.stock_status("me"), desk.buy_box_changes("me"),
            desk.general_data(), desk.product_performance("a", "me"), desk.diagnosis("me"), desk.portfolio_health("me"),
            desk.asin_raw_history("a"), desk.current_owners("me"), desk.competitor_history("me"),
        )
    ]
    assert counts == [2, 2, 1, 1, 3, 2, 2, 1, 2, 1, 1]
    lines = [r["line"] for r in desk.competitor_landscape("me", ["b"]).orderBy("part", "pos").collect()]
    assert lines[1] == lines[3] == "The report has no rows."
    lines = [r["line"] for r in desk.competitor_landscape("me").orderBy("part", "pos").collect()]
    assert lines[2] == "x,1,10.0" and lines[5] == "x,1,10.0"
