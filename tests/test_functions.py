"""Column functions against the standard library."""

import urllib.parse as up

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfscope.functions import predicates as P
from shelfscope.functions import text as T
from shelfscope.functions import urls as U
from shelfscope.functions.dates import as_of_date, iso_text, looks_back

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
words = st.text(st.characters(codec="utf-8", exclude_categories=["Cs", "Cc"]), max_size=8)
query = st.lists(st.tuples(st.sampled_from(["o", "l", "a", "b", "ü x"]), words), max_size=5)


def evaluated(spark, values, schema, *columns):
    """Columns over one row per value, in the values' order."""
    data = [(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, f"i int, {schema}")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


@SETTINGS
@given(st.lists(words, min_size=5, max_size=20))
def test_lookup_url(spark, texts):
    urls = [f"https://{t}" for t in texts] + list(texts)
    got = evaluated(spark, urls, "u string", U.lookup_url(F.col("u")))
    want = [
        u.split("://", 1)[0] + ":%2F%2F" + up.quote(u.split("://", 1)[1], safe="=") if "://" in u else None for u in urls
    ]
    assert [g[0] for g in got] == want


@SETTINGS
@given(st.lists(st.tuples(query, st.integers(0, 999), st.sampled_from([None, "", "gq", "ä b"]), st.sampled_from(["", "#top"])), min_size=5, max_size=20))
def test_page_url(spark, cases):
    data, want = [], []
    for pairs, offset, hint, fragment in cases:
        q = up.urlencode(pairs)
        data.append(("https://s.example.com/c/" + ("?" + q if q else "") + fragment, offset, hint))
        params = dict(up.parse_qsl(q, keep_blank_values=True))
        params["o"] = str(offset)
        if hint and "l" not in params:
            params["l"] = hint
        want.append("https://s.example.com/c/?" + up.urlencode(params) + fragment)
    got = evaluated(spark, data, "u string, o int, h string", U.page_url(F.col("u"), F.col("o"), F.col("h")))
    assert [g[0] for g in got] == want


@SETTINGS
@given(st.lists(query, min_size=5, max_size=20))
def test_query_params(spark, cases):
    urls = ["https://s.example.com/c/?" + up.urlencode(q) for q in cases]
    got = evaluated(spark, urls, "u string", U.query_params(F.col("u")), U.query_param(F.col("u"), "a"))
    parsed = [up.parse_qs(up.urlsplit(u).query) for u in urls]
    assert [g[0] for g in got] == parsed
    assert [g[1] for g in got] == [p["a"][0] if len(p.get("a", [])) == 1 else None for p in parsed]


def test_text_helpers(spark):
    u = F.col("u")
    cases = ["https://x.example.com/p/red_widget-7//", "a\\/b", "&lt;&#228;&#x20AC;&amp;lt; &auml;&#00065;", "  7 ", "12x", ""]
    got = evaluated(spark, cases, "u string", T.slug_title(u), T.unescaped_slashes(u), T.decoded_entities(u), T.whole_number(T.stripped(u)), T.page_number_or_next(u, F.lit(4)))
    assert got[0][0] == "red widget 7" and got[1][1] == "a/b" and got[2][2] == "<ä€&lt; äA"
    assert [g[3] for g in got] == [None, None, None, 7, None, None]
    assert [g[4] for g in got] == [5, 5, 5, 7, 5, 5]


def test_labels_and_numbers(spark):
    got = evaluated(
        spark, [("cat", "n"), ("cat", None), ("cat", "")], "c string, n string",
        T.label_with_node(F.col("c"), F.col("n")), T.money(F.lit(3.456)), T.percent(F.lit(12.34)), U.absolute(F.lit("https://h.example.com:80/a?b"), F.lit("/p/x")),
    )
    assert [g[0] for g in got] == ["cat-n", "cat", "cat"]
    assert got[0][1:] == ("€3.46", "12.3%", "https://h.example.com:80/p/x")


def test_transition_truth_table(spark):
    names = ["me", "x", None]
    cases = [(now, before) for now in names for before in names]
    got = evaluated(
        spark, cases, "n string, b string",
        P.took_or_lost(F.col("n"), F.col("b"), "ME"), P.wins(F.col("n"), "Me"), P.wins_or_unheld(F.col("n"), "me"), P.just_lost(F.col("n"), F.col("b"), "me"),
    )
    truth = {c: g for c, g in zip(cases, got)}
    assert {c for c, g in truth.items() if g[0]} == {("me", "x"), ("x", "me")}
    assert [truth[(n, "x")][1] for n in names] == [True, False, False]
    assert [truth[(n, "x")][2] for n in names] == [True, False, True]
    assert {c for c, g in truth.items() if g[3]} == {("x", "me")}


def test_look_back_is_inclusive_and_bare(spark):
    df = spark.sql("select explode(sequence(timestamp'2024-01-01', timestamp'2024-01-10', interval 12 hours)) as ts")
    today = as_of_date(None, df, "ts")
    kept = df.where(looks_back(df, "ts", today, 2))
    assert kept.agg(F.min("ts").cast("string")).first()[0] == "2024-01-08 00:00:00"
    assert df.select(iso_text(F.max("ts"))).first()[0] == "2024-01-10T00:00:00.000000+00:00"


def test_report_cells(spark):
    got = evaluated(spark, [1.0, 1e7, 123456789.125, 0.5, None], "v double", T.report_cell(F.col("v"), "double"))
    assert [g[0] for g in got] == [str(v) for v in (1.0, 1e7, 123456789.125, 0.5, None)]
