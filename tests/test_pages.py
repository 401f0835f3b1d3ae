"""Landed pages: links, product facts, pager, page windows."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfscope.functions.html import visible
from shelfscope.operators.dedupe import first_seen, latest
from shelfscope.operators.links import list_links, page_links, until_first_failure
from shelfscope.operators.page_window import PAGE_CAP, all_pages, page_flags, select_pages
from shelfscope.operators.pagination import absurd_total, detect_pagination, offset_step, page_plan
from shelfscope.operators.product_page import product_facts, product_pages
from shelfscope.operators.search_listing import flatten_search_pages

BASE = "https://shop.example.com/c/list?x=1"
LINKS = """<a href="/p/one-thing/"><b> One </b> <i>thing</i></a><!-- <a href="/p/hidden/">no</a> -->
<script>var s = '<a href="/p/script/">no</a>';</script><A class=x HREF='/p/two_things-2/'>  </A>
<a href=/p/three/>Three &amp; &#8364; &uuml;</a><a href="/q/other">Other</a><a name="x">none</a>
<a href="/p/open/">Open<a href="/p/one-thing/">again</a><a data-href="/p/data/">no</a>"""


def test_links_of_a_page(spark):
    pages = spark.createDataFrame([(1, LINKS)], "page_number int, html string")
    out = page_links(pages, BASE).orderBy("position").collect()
    host = "https://shop.example.com"
    assert [(r["link"], r["title"]) for r in out] == [
        (host + "/p/one-thing/", "Onething"), (host + "/p/two_things-2/", "two things 2"), (host + "/p/three/", "Three & € ü"),
        (host + "/p/open/", "Open"), (host + "/p/one-thing/", "again"),
    ]


def test_quoted_values_may_hold_markup(spark):
    html = """<a title="a > b" href="/p/gt/">1</a><a title=' href="/p/no/" ' href="/p/yes/">2</a>
    <a data-x href=/p/bare/ >3</a><a title="it"s" href="/p/stray/">4</a><a href = '/p/spaced/'>5</a><abbr href="/p/abbr/">6</abbr>"""
    out = page_links(spark.createDataFrame([(1, html)], "page_number int, html string"), BASE).orderBy("position").collect()
    assert [(r["link"].rsplit("/", 2)[1], r["title"]) for r in out] == [("gt", "1"), ("yes", "2"), ("bare", "3"), ("stray", "4"), ("spaced", "5")]


def test_long_tags_and_pages_are_read_whole(spark):
    long_tag = '<a ' + " ".join(f'data-{i}="{"v" * 50}"' for i in range(400)) + ' href="/p/long/">long</a>'
    many = "".join(f'<a href="/p/i{i}/">{i}</a>' for i in range(20000))
    df = spark.createDataFrame([(1, long_tag + "x" * 500000 + many)], "page_number int, html string")
    out = page_links(df, BASE)
    assert out.count() == 20001 and out.where("title = 'long'").count() == 1


def test_first_place_counts_across_pages(spark, rows):
    pages = spark.createDataFrame(
        [(2, '<a href="/p/a/">A2</a><a href="/p/c/">C</a>'), (1, '<a href="/p/b/">B</a><a href="/p/a/">A1</a>')], "page_number int, html string"
    )
    out = list_links(pages, BASE, "cat", "t").orderBy("page_number", "link")
    assert out.columns == ["title", "price_raw", "link", "page_number", "extracted_at", "category_label"]
    assert [(r["title"], r["page_number"], r["price_raw"]) for r in rows(out)] == [("A1", 1, None), ("B", 1, None), ("C", 2, None)]
    assert [r["title"] for r in rows(list_links(pages, BASE, "cat", "t", max_products=2))] == ["B", "A1"]


def test_a_failed_page_ends_its_crawl(spark, rows):
    pages = spark.createDataFrame(
        [("x", 1, None), ("x", 2, "503"), ("x", 3, None), ("y", 1, None), ("y", 2, None), ("z", 1, "404")], "crawl string, page_number int, fetch_error string"
    )
    out = {(r["crawl"], r["page_number"]) for r in rows(until_first_failure(pages, ["crawl"]))}
    assert out == {("x", 1), ("y", 1), ("y", 2)}
    assert [r["page_number"] for r in rows(until_first_failure(pages.where("crawl = 'x'"), []))] == [1]


def test_markup_is_hidden_left_to_right(spark):
    df = spark.createDataFrame([("a<!-- <script> -->b<script>x = '<!--';</script>c<style>d</style>e",)], "html string")
    assert df.select(visible(F.col("html"))).first()[0] == "abce"


def ld(doc):
    return f'<script type="application/ld+json">{json.dumps(doc)}</script>'


DEEP = {"@type": "Product", "name": "deep", "offers": {"highPrice": 3}}
for _ in range(40):
    DEEP = {"x": [DEEP]}

PRODUCT_PAGES = {
    "plain": (ld({"@type": "Product", "name": "N", "offers": {"price": "9.99"}}), ("N", "9.99")),
    "low": (ld({"@type": ["Thing", "Product"], "name": "N", "offers": [{"priceCurrency": "EUR"}, {"lowPrice": 5, "price": 0}]}), ("N", "5")),
    "order": (ld({"z": {"@type": "Product", "name": "first"}, "a": {"@type": "Product", "name": "second", "offers": {"price": 1}}}), ("first", "1")),
    "deep": (ld(DEEP), ("deep", "3")),
    "blocks": ('<script type="application/ld+json">{bad</script>' + ld({"@type": "Thing", "name": "no"}) + ld([{"@type": "Product", "name": "yes"}]), ("yes", None)),
    "mixed": (ld({"@type": "Product", "name": "N"}) + '<meta itemprop="price" content="1,50">', ("N", "1,50")),
    "meta": ('<meta content="M &amp; M" itemprop="name"><meta property="og:title" content="O">', ("M & M", None)),
    "blank_meta": ('<meta itemprop="name" content=""><meta itemprop="name" content="late"><meta property="og:title" content="O">', ("O", None)),
    "span": ('<span class="p">no</span><span data-automation-id="x-price"> 7 <b>&euro;</b></span><meta property="product:price:amount" content="8">', ("slug of page", "7€")),
    "amount": ('<meta property="product:price:amount" content="8">', ("slug of page", "8")),
    "commented": ("<!--" + ld({"@type": "Product", "name": "hidden"}) + "-->", ("slug of page", None)),
    "loose": ('<div data="{"price": "12,99"}"></div>', ("slug of page", None)),
}


@pytest.fixture(scope="module")
def product_results(spark):
    df = spark.createDataFrame([(f"https://s.example.com/{k}/slug-of_page/", v[0]) for k, v in PRODUCT_PAGES.items()], "url string, html string")
    return {
        lenient: {r["link"].split("/")[3]: (r["title"], r["price_raw"]) for r in product_pages(df, lenient=lenient).collect()}
        for lenient in (False, True)
    }


@pytest.mark.parametrize("case", PRODUCT_PAGES)
def test_product_page(product_results, case):
    assert product_results[False][case] == PRODUCT_PAGES[case][1]


def test_lenient_reads_commented_scripts_and_loose_prices(product_results):
    assert product_results[True]["commented"] == ("hidden", None)
    assert product_results[True]["loose"] == ("slug of page", "12,99")


def test_facts_without_blocks():
    assert product_facts(None) == (None, None) and product_facts(["", "[" * 100000]) == (None, None)


@pytest.mark.parametrize(
    "offsets, items, step", [([], 5, 5), ([], 0, 1), ([72], 5, 72), ([72, 144], 5, 72), ([144, 72, 72], 5, 72), ([10, 15, 40], 5, 5), ([-3, 0], 4, 4), ([100, 130], 2, 30)]
)
def test_offset_step(spark, offsets, items, step):
    df = spark.createDataFrame([(offsets, items)], "o array<int>, n int")
    assert df.select(offset_step(F.col("o"), F.col("n"))).first()[0] == step


def test_page_plan(spark, rows):
    def item(body, attrs=""):
        return f'<li class="reptile_paging__item"{attrs}>{body}</li>'

    pager = "<ul class='reptile_paging'>" + item("<button data-page='{\"o\":72,\"l\":\"gq\"}'> 2 </button>") + item(
        '<span class="reptile_paging__dots">…</span><button>99</button>'
    ) + item("<button data-page=\"{&quot;o&quot;:216}\">4</button>") + item("<button>50</button>", ' id="reptile-bottom-next"') + "</ul>"
    df = spark.createDataFrame([("https://s.example.com/c/?a=1&o=7#top", pager), ("https://s.example.com/d/", '<a href="/p/x/">x</a>')], "url string, html string")
    out = rows(page_plan(detect_pagination(df)).orderBy("url", "page_number"))
    assert [(r["page_number"], r["offset"], r["page_url"]) for r in out] == [
        (1, 0, "https://s.example.com/c/?a=1&o=7#top"), (2, 72, "https://s.example.com/c/?a=1&o=72&l=gq#top"),
        (3, 144, "https://s.example.com/c/?a=1&o=144&l=gq#top"), (4, 216, "https://s.example.com/c/?a=1&o=216&l=gq#top"), (1, 0, "https://s.example.com/d/"),
    ]


def window(spark, pages, max_pages=None, start=1, cap=PAGE_CAP):
    df = spark.createDataFrame([("s", *p) for p in pages], "source string, source_page int, failed boolean, has_next boolean")
    out = select_pages(df, ["source"], max_pages, start, cap).orderBy("source_page").collect()
    return [(r["source_page"], r["page_number"]) for r in out]


def test_page_window(spark):
    pages = [(1, False, True), (2, True, False), (3, False, True), (4, False, False), (5, False, True)]
    assert window(spark, pages) == [(1, 1), (3, 2), (4, 3)]  # stops after the first good page without next
    assert window(spark, pages, 2) == [(1, 1)]  # the failed page uses up the budget
    assert window(spark, pages, 0) == [(1, 1), (3, 2), (4, 3)]
    assert window(spark, pages, 101, 3) == [(3, 1), (4, 2)]
    assert window(spark, pages, None, -2) == [(1, 1), (3, 2), (4, 3)]
    many = [(i, False, True) for i in range(1, 151)]
    assert len(window(spark, many, 500)) == 100
    assert len(window(spark, many, 120, cap=None)) == 120 and len(window(spark, many, cap=None)) == 150


def test_announced_total_is_planned_in_blocks(spark):
    df = spark.createDataFrame([("https://s.example.com/c/", 70_001, 72, None), ("https://s.example.com/d/", 2**31 - 1, 72, None), ("https://s.example.com/e/", None, 1, None)], "url string, total_pages int, offset_step int, layout_hint string")
    out = page_plan(df.where("total_pages < 100000"))
    assert out.agg(F.count("*"), F.count_distinct("page_number"), F.max("page_number"), F.max("offset")).first()[:] == (70_001, 70_001, 70_001, 70_000 * 72)
    assert sorted(r["url"][-2] for r in page_plan(df, most_pages=1000).collect()) == ["e"]
    assert [r["url"][-2] for r in df.where(absurd_total(1000)).orderBy("url").collect()] == ["c", "d"]
    # The largest total that a page can announce is never one array.
    assert page_plan(df.where("url like '%/d/'")).where("page_number > 2147483000").count() == 647


def test_all_pages_of_a_source(spark):
    def numbers(pages, *limits):
        df = spark.createDataFrame([(None, *p) for p in pages], "source string, source_page int, failed boolean, has_next boolean")
        return [(r["source_page"], r["page_number"]) for r in all_pages(df, ["source"], *limits).orderBy("source_page").collect()]

    pages = [(i, i % 10 == 0, True) for i in range(1, 2501)]
    good = [(p, n) for n, p in enumerate((i for i, failed, _ in pages if not failed), 1)]
    assert numbers(pages) == numbers(pages, 0) == numbers(pages, -5) == good
    assert numbers(pages, 1500) == [x for x in good if x[0] <= 1500]
    assert numbers(pages, 1500, 901) == [(p, n - 810) for p, n in good if 901 <= p <= 2400]
    ended = [(i, failed, i not in (1503, 2001)) for i, failed, _ in pages]
    assert numbers(ended) == [x for x in good if x[0] <= 1503]
    few = [(1, False, True), (2, True, False), (3, False, True), (4, False, False), (5, False, True)]
    assert numbers(few) == [(1, 1), (3, 2), (4, 3)] and numbers(few, 2) == [(1, 1)]


def test_flags_and_rows_of_search_pages(spark, rows):
    def product(**p):
        return p

    payloads = [
        ("s", 1, json.dumps({"search_parameters": {"node": "n1"}, "serpapi_pagination": {"next": "u"}, "organic_results": [
            product(asin="A", position=1, link="https:\\/\\/x\\/sspa\\/click", price={"raw": "1 €", "currency": "EUR"}, rating="4.5", delivery=["a"]),
            product(asin="B", link=None, price="1 €"), "stray",
        ]})),
        ("s", 2, json.dumps({"error": "nope"})),
        ("s", 3, json.dumps({"error": "", "organic_results": []})),
        ("s", 4, "not json"),
    ]
    df = page_flags(spark.createDataFrame(payloads, "source string, source_page int, payload string"))
    assert [(r["failed"], r["has_next"]) for r in df.orderBy("source_page").collect()] == [(False, True), (True, False), (False, False), (True, False)]
    out = rows(flatten_search_pages(df.withColumn("page_number", F.col("source_page")), "cat", "t").orderBy("asin"))
    assert [(r["asin"], r["node"], r["link"], r["is_sponsored"], r["price_raw"], r["rating"], r["delivery"]) for r in out] == [
        ("A", "n1", "https://x/sspa/click", False, "1 €", 4.5, '["a"]'), ("B", "n1", "", False, None, None, None),
    ]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9), st.text("ab", max_size=2)), min_size=1, max_size=40))
def test_one_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v string")
    first, last = {}, {}
    for k, o, v in data:
        first[k] = min(first.get(k, (o, v)), (o, v))
        last[k] = max(last.get(k, (o, v)), (o, v))
    assert {r["k"]: (r["o"], r["v"]) for r in first_seen(df, ["k"], [F.col("o")]).collect()} == first
    assert {r["k"]: (r["o"], r["v"]) for r in latest(df, ["k"], [F.col("o")]).collect()} == last
