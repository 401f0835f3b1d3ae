"""Intervals, roll-ups, routing, stored tables and quantiles against plain loops and plans."""

import collections
import datetime as dt
import json
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from shelfscope.operators.detail_payloads import flatten_details
from shelfscope.plans import holders as H
from shelfscope.plans import reports as R
from shelfscope.plans import rollups as U
from shelfscope.plans.desk import SellerDesk
from shelfscope.plans.ingest import accepted, land, quarantined, routed
from shelfscope.plans.market import competitor_moves, price_dispersion, rivals_and_shadows
from shelfscope.plans.portfolio import latest_standing, portfolio_health
from shelfscope.plans.silver import seller_stock
from shelfscope.schemas import REGISTRY
from shelfscope.sources.tables import TableNames, Tables, write_bucketed

TODAY = dt.date(2024, 3, 31)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def history(spark, seed, days=40, products=12, gaps=0.25):
    """Random holders with gaps and days without a holder."""
    rng = random.Random(seed)
    rows, held = [], {}
    for n in range(days, -1, -1):
        for p in range(products):
            if rng.random() < 0.4 or p not in held:
                held[p] = rng.choice(["me", "ME", "x", "y", None])
            if rng.random() > gaps:
                rows.append((TODAY - dt.timedelta(n), f"P{p}", held[p], float(rng.randint(1, 9))))
    return spark.createDataFrame(rows, "snapshot_date date, asin string, buybox_seller_name string, pdp_total_price double"), rows


def offers(spark, products=12):
    return spark.createDataFrame([(f"P{p}", dt.datetime(2024, 3, 20), "Me", 1.0) for p in range(0, products, 2)], "asin string, extracted_at timestamp, seller_name string, total_price double")


@pytest.mark.parametrize("seed, days", [(1, 14), (2, 1), (3, 30), (4, 0)])
def test_reports_of_intervals_are_those_of_the_snapshots(spark, seed, days):
    gold, _ = history(spark, seed)
    intervals = H.holder_intervals(gold)
    order = lambda df: sorted(map(str, df.collect()))
    assert order(H.changes_of_intervals(intervals, "Me", TODAY, days)) == order(R.buy_box_changes(gold, "Me", days, TODAY))
    o = offers(spark)
    assert order(H.standing_of_intervals(intervals, o, "Me", TODAY, days)) == order(latest_standing(gold, o, "Me", TODAY, days))


def test_intervals_of_periods_merge(spark):
    gold, rows = history(spark, 7)
    cuts = [TODAY - dt.timedelta(n) for n in (60, 25, 24, 3, -1)]
    kept = None
    for a, b in zip(cuts, cuts[1:]):
        part = H.holder_intervals(gold.where((F.col("snapshot_date") >= a) & (F.col("snapshot_date") < b)))
        kept = part if kept is None else H.merged_intervals(kept.unionByName(part))
    got = sorted(map(str, kept.collect()))
    assert got == sorted(map(str, H.holder_intervals(gold).collect()))
    by_product = collections.defaultdict(list)
    for day, asin, holder, price in sorted(rows, key=lambda r: r[0]):
        runs = by_product[asin]
        if runs and runs[-1][0] == holder:
            runs[-1][2:5] = day, runs[-1][2], runs[-1][4] + 1
        else:
            runs.append([holder, day, day, None, 1, price])
    want = {(a, *run) for a, runs in by_product.items() for run in runs}
    assert {tuple(r) for r in kept.select("asin", R.HOLDER, "from_day", "to_day", "before_last", "snapshots", "from_price").collect()} == want


def test_holder_on_a_day_is_that_of_the_last_snapshot(spark):
    gold, rows = history(spark, 9, products=3)
    days = spark.createDataFrame([(f"P{p}", TODAY - dt.timedelta(n)) for p in range(3) for n in range(0, 45)], "asin string, day date")
    got = {(r["asin"], r["day"]): r[R.HOLDER] for r in H.held_on(H.holder_intervals(gold), days).collect()}
    for asin, day in ((r["asin"], r["day"]) for r in days.collect()):
        before = [r for r in rows if r[1] == asin and r[0] <= day]
        assert got.get((asin, day), "none yet") == (max(before)[2] if before else "none yet")


def test_rollup_answers_like_the_snapshots(spark, tmp_path):
    gold, _ = history(spark, 11)
    gold = gold.withColumn("pdp_total_price", F.col("pdp_total_price").cast("decimal(12,2)"))
    path = str(tmp_path / "rollup")
    U.refresh_holder_days(gold.where(F.col("snapshot_date") < TODAY), path)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "rollup").rglob("*.parquet")}
    U.refresh_holder_days(gold, path, [TODAY])
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    rollup = spark.read.parquet(path)

    def same(a, b):
        assert [r[:2] + (round(r[2], 6),) for r in a.collect()] == [r[:2] + (round(float(r[2]), 6),) for r in b.collect()]

    for days in (0, 3, 14, 60):
        same(U.competitor_history_of(rollup, "Me", TODAY, days), R.competitor_history(gold, "Me", as_of=TODAY, days=days))
    same(U.current_owners_of(rollup, "Me"), R.current_owners(gold, "Me"))
    pick = lambda df: sorted(df.select("competitor", "role", "days_won_buybox", "products_won_today").collect())
    assert pick(U.rivals_and_shadows_of(rollup, "Me", TODAY)) == pick(rivals_and_shadows(gold, "Me", TODAY))


def test_every_landed_payload_is_accepted_or_rejected(spark, tmp_path):
    registry = spark.createDataFrame([("a", "pricing", True, {}), ("off", "pricing", False, {}), ("b", "pricing", None, {"category_label": "c"})], REGISTRY)
    rows = [("a", "1", "{}"), ("a", "2", "{"), ("a", "3", None), ("off", "4", "{}"), ("nobody", "5", "{}"), (None, "6", "{}"), ("b", "7", "[]"), ("off", "8", "{")]
    payloads = spark.createDataFrame(rows, "source string, asin string, payload string")
    want = {"1": None, "2": "unreadable_payload", "3": "unreadable_payload", "4": "disabled_source", "5": "unknown_source", "6": "unknown_source", "7": None, "8": "disabled_source"}
    assert {r["asin"]: r["reject_reason"] for r in routed(payloads, registry).collect()} == want
    path = str(tmp_path / "landing")
    assert land(payloads, registry, path) == {"landed": 8, "accepted": 2, "rejected": 6}
    assert land(payloads.limit(1), registry, path) == {"landed": 1, "accepted": 1, "rejected": 0}
    assert sorted(r["asin"] for r in accepted(spark, path).collect()) == ["1", "1", "7"]
    assert {r["asin"]: r["reject_reason"] for r in quarantined(spark, path).collect()} == {k: v for k, v in want.items() if v}
    assert land(payloads.limit(0), registry, str(tmp_path / "none")) == {"landed": 0, "accepted": 0, "rejected": 0}


def test_default_report_of_stored_tables_lists_recent_days_only(spark, tmp_path):
    gold = history(spark, 13)[0].withColumn("buybox_stock", F.lit("1"))
    o = offers(spark).withColumn("snapshot_date", F.to_date("extracted_at"))
    for name, df in (("desk_gold", gold), ("desk_offers", o)):
        write_bucketed(df, name, 4, str(tmp_path / name))
    try:
        desk = SellerDesk.of_tables(Tables(spark, TableNames(gold="desk_gold", offers="desk_offers")))
        assert desk.as_of == TODAY
        report = desk.daily_pulse("me")
        text = plan(report)
        assert "Subquery" not in text
        assert re.search(r"PartitionFilters: \[isnotnull\(snapshot_date#\d+\), \(snapshot_date#\d+ >= 2024-03-29\)\]", text)
        rows = sorted(map(str, report.collect()))
        assert rows == sorted(map(str, R.daily_pulse(gold, "me").collect())) and rows
        # Bucketed by product with one number of buckets: neither the semi-join nor the windows shuffle by product.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(portfolio_health(desk.gold, desk.offers, "me", desk.as_of, list_cap=20))
        assert "hashpartitioning(asin" not in text and "Window" in text
        assert "hashpartitioning(asin" in plan(portfolio_health(gold, o, "me", TODAY, list_cap=20))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table desk_gold")
        spark.sql("drop table desk_offers")


def test_quantiles_are_exact_with_half_of_all_offers_in_one_category(spark):
    rng = random.Random(5)
    prices = [rng.choice([rng.random() * 10, rng.random() ** 9 * 1e6, 5.0, 1e-3 * rng.randint(1, 50)]) for _ in range(6000)]
    rows = [("hot" if i % 2 else (None if i % 7 == 0 else f"c{i % 90}"), p) for i, p in enumerate(prices)]
    rows += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("same", 4.0), ("same", 4.0)]
    df = spark.createDataFrame(rows, "category_label string, total_price double").withColumn("snapshot_date", F.lit(TODAY)).withColumn("extracted_at", F.lit(dt.datetime(2024, 3, 31)))
    out = price_dispersion(df, TODAY)
    # The windows run over cells, and over the prices of one cell, never over a category's prices.
    windows = re.findall(r"Window \[sum\(n#\d+L?\) windowspecdefinition\(([^)]*?) ASC", plan(out))
    assert windows and all("price" not in w or "k#" in w for w in windows)
    groups = collections.defaultdict(list)
    for c, p in rows:
        groups[c].append(p)
    got = {r["category_label"]: r for r in out.collect()}
    assert set(got) == set(groups)
    for c, values in groups.items():
        values.sort()

        def at(q):
            place = (len(values) - 1) * q
            low = int(place)
            high = min(low + (place > low), len(values) - 1)
            return values[low] + (values[high] - values[low]) * (place - low)

        r = got[c]
        assert (r["offers"], r["min_price"], r["max_price"]) == (len(values), values[0], values[-1])
        assert [r["p25_price"], r["median_price"], r["p75_price"]] == pytest.approx([at(0.25), at(0.5), at(0.75)], abs=1e-12)
        assert r["avg_price"] == pytest.approx(statistics.fmean(values), rel=1e-5)
        assert r["stddev_price"] == (pytest.approx(statistics.stdev(values), rel=1e-4) if len(values) > 1 else None)


def test_stock_of_every_seller_comes_from_the_details(spark):
    def page(day, asin, box, others):
        return asin, f"2024-03-{day}T10:00:00", json.dumps({"results": [{"content": {"title": "t", "buybox": box, "other_sellers": others}}]})

    pages = [
        page("28", "A", [{"seller": " Box ", "price": 5, "stock": "7"}], [{"seller": "X", "price": 6.5, "stock": 3}, {"seller_name": "Y", "stock": None}, {"price": 1, "stock": 1}, "odd"]),
        page("29", "A", {"seller": "BOX", "stock": 7}, [{"seller": "x", "price": 6.5, "stock": 1}]),
        page("29", "B", None, "none"),
        ("C", "2024-03-29T00:00:00", None),
    ]
    details = flatten_details(spark.createDataFrame(pages, "asin string, at string, payload string"), "c", None, F.col("at"))
    stated = seller_stock(details)
    got = {(r["asin"], r["seller_key"], r["snapshot_date"].day): (r["stock"], r["total_price"] and float(r["total_price"])) for r in stated.collect()}
    assert got == {("A", "box", 28): (7, 5.0), ("A", "x", 28): (3, 6.5), ("A", "box", 29): (7, None), ("A", "x", 29): (1, 6.5)}
    none = spark.createDataFrame([], "asin string, extracted_at timestamp, snapshot_date date, seller_name string, seller_key string, total_price decimal(12,2)")
    moves = competitor_moves(none, "me", TODAY, stock=stated).collect()
    assert [(r["asin"], r["seller_key"], r["snapshot_date"].day, r["stock_change"]) for r in moves] == [("A", "x", 29, -2)]
    with pytest.raises(ValueError):
        competitor_moves(none, "me", TODAY)
