"""Loads open the days they touch, and no others."""

import datetime as dt
import re

from pyspark.sql import functions as F

from shelfscope.operators.merge import days_of, on_days, stored_rows
from shelfscope.plans.silver import write_offers
from shelfscope.schemas import SILVER_OFFERS, conform

DAY = dt.date(2024, 3, 1)


def offers(spark, *days, price=1.0):
    rows = [(f"P{i}", DAY + dt.timedelta(d), i, price) for d in days for i in range(3)]
    df = spark.createDataFrame(rows, "asin string, snapshot_date date, offer_position int, total_price double")
    return conform(df.withColumn("extracted_at", F.col("snapshot_date").cast("timestamp")), SILVER_OFFERS)


def files_read(df):
    return {re.search(r"snapshot_date=([^/]+)", r[0])[1] for r in df.select("_metadata.file_path").distinct().collect()}


def test_only_touched_days_are_opened(spark, tmp_path):
    path = str(tmp_path / "offers")
    write_offers(offers(spark, *range(10)), path)
    load = offers(spark, 3, 4, price=2.0)
    days = days_of(load, "snapshot_date")
    stored = stored_rows(spark, path, load.schema, "snapshot_date", days)
    plan = stored._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date#\d+ IN \(", plan) and "dynamicpruning" not in plan
    assert files_read(stored.select("*", "_metadata")) == {"2024-03-04", "2024-03-05"}
    # A load that touches two days writes their files and leaves the others' as they were.
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "offers").rglob("*.parquet")}
    write_offers(load, path)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "offers").rglob("*.parquet")}
    changed = {re.search(r"snapshot_date=([^/]+)", str(p))[1] for p in before.keys() ^ after.keys()}
    assert changed == {"2024-03-04", "2024-03-05"} and all(before[p] == after[p] for p in before.keys() & after.keys())
    assert spark.read.parquet(path).count() == 30


def test_days_that_are_null(spark):
    df = spark.createDataFrame([(DAY,), (None,)], "d date")
    assert df.where(on_days(F.col("d"), days_of(df, "d"))).count() == 2
    assert df.where(on_days(F.col("d"), [None])).count() == 1 and df.where(on_days(F.col("d"), [])).count() == 0
    assert stored_rows(df.sparkSession, "/nowhere/at/all", df.schema, "d", [DAY]) is None
