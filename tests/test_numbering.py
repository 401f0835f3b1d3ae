"""Consecutive numbers and running totals against plain loops."""

import collections

from pyspark.sql import functions as F

from shelfscope.operators.numbering import numbered, running_total


def test_numbers_follow_the_order_and_keep_ties_in_input_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 11).alias("k"), "id")
    out = sorted((r["pos"], r["k"], r["id"]) for r in numbered(df, [F.col("k").desc()]).collect())
    assert [p for p, _, _ in out] == list(range(5000))
    assert [(k, i) for _, k, i in out] == sorted(((i * 37 % 11, i) for i in range(5000)), key=lambda x: (-x[0], x[1]))


def test_numbers_without_an_order_are_those_of_the_input(spark):
    df = spark.range(0, 1000, 1, 6).where("id % 3 <> 1")
    out = sorted((r["n"], r["id"]) for r in numbered(df, [], "n", start=5).collect())
    assert out == list(enumerate([i for i in range(1000) if i % 3 != 1], 5))


def test_numbers_start_anew_in_each_group_and_a_hot_group_is_dealt_out(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 50))
    df = spark.range(0, 9000, 1, 5).select(hot.alias("g"), "id", F.lit("x").alias("_tie"))
    out = numbered(df, [F.col("id").desc()], within=["g"], start=1)
    groups = collections.defaultdict(list)
    for r in out.collect():
        groups[r["g"]].append((r["pos"], r["id"]))
        assert r["_tie"] == "x"
    for rows in groups.values():
        rows.sort()
        assert [p for p, _ in rows] == list(range(1, len(rows) + 1)) and [i for _, i in rows] == sorted((i for _, i in rows), reverse=True)
    assert len(groups) == 52 and sum(map(len, groups.values())) == 9000


def test_empty_table_has_no_numbers(spark):
    assert numbered(spark.range(0), ["id"]).count() == 0 and running_total(spark.range(0).withColumn("v", F.lit(1)), "id", ["v"]).count() == 0


def test_running_totals(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.floor(F.col("id") / 3).alias("p"), (F.col("id") * 31 % 17).alias("v"), F.lit(2).alias("w"))
    totals = collections.Counter()
    got = {(r["g"], r["p"]): (r["before_v"], r["before_w"]) for r in running_total(df, "p", ["v", "w"], ["g"], block=64).collect()}
    for i in range(3000):
        g = i % 3
        assert got[g, i // 3] == (totals[g], 2 * (i // 3))
        totals[g] += i * 31 % 17
    assert len(got) == 3000
