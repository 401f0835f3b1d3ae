"""One product, link, seller or source holds a third of the rows: results stay whole, plans stay split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfscope.operators.dedupe import first_seen
from shelfscope.operators.page_window import PAGE_CAP, select_pages
from shelfscope.plans.gold import daily_snapshot
from shelfscope.plans.diagnosis import product_performance
from shelfscope.plans.market import new_sellers, price_dispersion

N = 30_000


@pytest.fixture(scope="module")
def offers(spark):
    hot = F.col("id") % 3 == 0
    return (
        spark.range(0, N, 1, 8)
        .select(
            F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("P"), F.col("id") % 1000)).alias("asin"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 20).alias("extracted_at"),
            F.concat(F.lit("s"), F.col("id") % 7).alias("seller_name"),
            F.concat(F.lit("s"), F.col("id") % 7).alias("seller_id"),
            (F.col("id") * 37 % 1009 / 100).alias("total_price"),
            F.col("id").alias("offer_position"),
            F.when(hot, F.lit("big")).otherwise(F.lit("small")).alias("category_label"),
        )
        .withColumn("snapshot_date", F.to_date("extracted_at"))
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_snapshot_combines_before_the_shuffle(offers):
    gold = daily_snapshot(offers, rank_by=("total_price", "offer_position"))
    shown = plan(gold.select("asin", "snapshot_date", "buybox_seller_name"))
    assert "partial_min_by" in shown and "Window" not in shown
    pdf = offers.select("asin", "snapshot_date", "seller_id", "total_price", "offer_position").toPandas()
    best = pdf.sort_values(["total_price", "offer_position"]).groupby(["asin", "snapshot_date"]).first()
    sellers = pdf.groupby(["asin", "snapshot_date"])["seller_id"].nunique()
    got = gold.toPandas().set_index(["asin", "snapshot_date"]).sort_index()
    assert (got["buybox_seller_name"] == best["seller_id"].sort_index()).all()
    assert (got["seller_id_count"] == sellers.sort_index()).all() and len(got) == len(best)


def test_hot_link_is_reduced_by_aggregation(spark, offers):
    once = first_seen(offers.select("asin", "offer_position", "seller_name"), ["asin"], [F.col("offer_position")])
    assert "Window" not in plan(once)
    assert once.where("asin = 'HOT'").first()["offer_position"] == 0


def test_no_window_holds_a_hot_source(spark):
    pages = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("source"),
        F.col("id").cast("int").alias("source_page"), F.lit(False).alias("failed"), F.lit(True).alias("has_next"),
    )
    out = select_pages(pages, ["source"], cap=PAGE_CAP)
    # Pages are counted per block of page numbers; a window holds one block, or a source's blocks.
    assert "_block" in plan(out) and out.groupBy("source").count().where("count <> 100").count() == 0
    assert select_pages(pages, ["source"]).count() == N - 1  # pages count from 1


def test_performance_joins_can_be_split(offers):
    gold = daily_snapshot(offers, rank_by=("total_price", "offer_position"))
    day = dt.date(2024, 1, 7)
    out = product_performance(gold, offers, "S3", as_of=day, days=14)
    shown = plan(out)
    assert "LeftOuter" not in shown
    mine = offers.where("seller_name = 's3'").groupBy("asin", "extracted_at").agg(F.min("total_price"))
    assert out.where("my_price is not null").count() == mine.count()
    days = offers.select("asin", "snapshot_date").distinct()
    assert out.select("asin", "snapshot_date").distinct().count() == days.count()


def test_dispersion_matches_brute_force(offers):
    got = price_dispersion(offers, dt.date(2024, 1, 7), 30).toPandas().set_index(["category_label", "snapshot_date"]).sort_index()
    pdf = offers.select("category_label", "snapshot_date", "total_price").toPandas()
    groups = pdf.groupby(["category_label", "snapshot_date"])["total_price"]
    for column, want in {
        "offers": groups.size(), "avg_price": groups.mean(), "stddev_price": groups.std(), "p25_price": groups.quantile(0.25),
        "median_price": groups.median(), "p75_price": groups.quantile(0.75),
    }.items():
        assert ((got[column] - want.sort_index()).abs() < 1e-9).all(), column


def test_new_sellers_keep_one_row_per_seller(offers):
    out = new_sellers(offers, "s3", dt.date(2024, 1, 7), 30)
    assert out.where("asin = 'HOT'").count() == 6
