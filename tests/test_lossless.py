"""Loads, caps and ranks that must not lose or shuffle rows."""

import json

from pyspark.sql import functions as F

from shelfscope.operators.links import list_links
from shelfscope.operators.worklist import read_lines
from shelfscope.plans.gold import daily_snapshot
from shelfscope.plans.silver import write_offers
from shelfscope.schemas import SILVER_OFFERS
from shelfscope.sources.registry import read_registry
from shelfscope.streaming.bronze_stream import load_new


def offer(at, position, seller="s", price=1.0):
    return ("a", at, at.split(" ")[0], seller, seller, seller, "new", position, price, "c", "n")


def offers(spark, *rows):
    names = SILVER_OFFERS.fieldNames()
    frame = spark.createDataFrame(rows, names)
    return frame.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER_OFFERS))


def test_second_load_of_a_day_keeps_the_first(spark, tmp_path):
    path = str(tmp_path / "silver")
    morning, evening = offers(spark, offer("2024-01-31 07:00:00", 1)), offers(spark, offer("2024-01-31 19:00:00", 1))
    for load in (morning, evening, evening):
        write_offers(load, path)
    assert spark.read.parquet(path).count() == 2


def test_backfilled_days_are_loaded_once(spark, tmp_path):
    landed, table = str(tmp_path / "landed"), str(tmp_path / "table")
    schema = "k string, day date"
    for days in (["2024-01-31"], ["2024-01-10", "2024-01-31"]):
        spark.createDataFrame([("x", d) for d in days], "k string, day string").selectExpr("k", "cast(day as date) day").write.mode("append").parquet(landed)
        load_new(spark.readStream.schema(schema).parquet(landed), table, str(tmp_path / "c"), ["k"], "day").awaitTermination()
    assert sorted(str(r["day"]) for r in spark.read.parquet(table).collect()) == ["2024-01-10", "2024-01-31"]


def test_registry_reads_every_form(spark, tmp_path):
    entries = [{"name": f"s{i}", "type": "t", "parameters": {"domain": "de"}} for i in range(3)]
    for name, text in (("array", json.dumps(entries, indent=1)), ("lines", "\n".join(map(json.dumps, entries)) + "\n"), ("one", json.dumps(entries[0], indent=1))):
        path = tmp_path / f"{name}.json"
        path.write_text(text)
        got = [r["name"] for r in read_registry(spark, str(path)).orderBy("name").collect()]
        assert got == (["s0"] if name == "one" else ["s0", "s1", "s2"])


def test_link_cap_holds_for_every_crawl(spark):
    html = "".join(f'<a href="/p/{i}">t{i}</a>' for i in range(5))
    pages = spark.createDataFrame([(c, 1, html) for c in "abc"], "crawl string, page_number int, html string")
    links = list_links(pages, "https://x.example", F.col("crawl"), "t", keys=["crawl"], max_products=2)
    assert sorted((r["category_label"], r["n"]) for r in links.groupBy("category_label").agg(F.count("*").alias("n")).collect()) == [("a", 2), ("b", 2), ("c", 2)]


def test_lines_keep_file_order_and_cap(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a0\n\na1\n")
    (tmp_path / "b.txt").write_text("".join(f"b{i}\n" for i in range(2000)))
    assert [r["value"] for r in read_lines(spark, str(tmp_path), 3).orderBy("pos").collect()] == ["a0", "a1", "b0"]
    every = [r["value"] for r in read_lines(spark, str(tmp_path)).orderBy("pos").collect()]
    assert every == ["a0", "a1", *(f"b{i}" for i in range(2000))]


def test_equal_offers_give_one_holder_in_any_plan(spark):
    rows = [offer("2024-01-31 07:00:00", 1, f"s{i}") for i in range(8)] + [offer("2024-01-31 06:00:00", 1, "early", 0.5)]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        gold = daily_snapshot(offers(spark, *order).repartition(3, "seller_name"))
        assert gold.first()["buybox_seller_name"] == "s0" and gold.select("buybox_seller_name").first()[0] == "s0"
