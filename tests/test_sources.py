"""Work-lists, registry, newline-JSON runs and the incremental load."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from shelfscope.operators.lookups import lookup_status, request_urls, wrap_lookups
from shelfscope.operators.offer_payloads import flatten_offers
from shelfscope.operators.page_window import PAGE_CAP
from shelfscope.operators.worklist import column_scan, read_lines
from shelfscope.plans.ingest import details_of_sources, listings_of_sources, offers_of_sources, union_rows
from shelfscope.plans.silver import current_listing
from shelfscope.schemas import DETAILS, LINK_LISTING, LOOKUP, OFFERS, REGISTRY, SEARCH_LISTING, conform
from shelfscope.session import shared_folder
from shelfscope.sources.jsonl import json_lines, read_jsonl, without_nan, write_run, write_runs
from shelfscope.sources.registry import SourceDisabled, SourceNotFound, find_source, read_registry, read_yaml_registry, resolved
from shelfscope.sources.tables import TableNames, Tables, active
from shelfscope.streaming.bronze_stream import deduplicated, load_available, stream_jsonl, with_event_time

AT = "2024-01-31T07:00:00+00:00"


def test_lines_are_trimmed_and_capped_after_blanks(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("\n  \nB1 \n\t\n A2\r\nC3\n")
    read = lambda n: [r["value"] for r in read_lines(spark, str(path), n).orderBy("pos").collect()]
    assert read(None) == read(0) == ["B1", "A2", "C3"]
    assert read(2) == ["B1", "A2"]


def test_column_scan_caps_before_dropping_blanks(spark):
    df = spark.createDataFrame([("", 1), (None, 1), ("b", 1), ("b", 1), ("c", 0), ("0", 1)], "asin string, live int")
    values = lambda *a, **k: [r["val"] for r in column_scan(df, *a, **k).orderBy("val").collect()]
    assert values("asin") == ["0", "b", "b", "c"]
    assert values("asin", "live = 1", distinct=True) == ["0", "b"]
    assert values("asin", F.col("live") == 1, 3) == ["0"]  # NULL and '' come first and use up the cap
    assert values("live") == [1] * 5


REGISTERED = [
    {"name": "offers_a", "type": "pricing", "parameters": {"node": "7", "node_label": "N", "category_label": "mills", "max_items": "5"}},
    {"name": "details_a", "type": "x_product_details", "enabled": True, "parameters": {"node": "7", "node_label": "N", "domain": "fr", "max_pages": "500", "start_page": "-1"}},
    {"name": "off", "type": "pricing", "enabled": False, "parameters": {}},
    {"name": "bare", "type": "pricing", "parameters": {"category_label": "", "max_pages": "7", "start_page": "3"}},
]


@pytest.fixture(scope="module")
def registry(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("reg") / "sources.json"
    path.write_text(json.dumps(REGISTERED))
    return read_registry(spark, str(path))


def test_registry_defaults(registry):
    out = {r["source"]: r for r in resolved(registry, PAGE_CAP).collect()}
    assert set(out) == {"offers_a", "details_a", "bare"}
    assert (out["offers_a"]["run_label"], out["details_a"]["run_label"], out["bare"]["run_label"]) == ("mills-N", "details_a-7", "bare")
    assert (out["offers_a"]["max_items"], out["offers_a"]["key_column"], out["offers_a"]["domain"]) == (5, "asin", "de")
    assert [(out[s]["max_pages"], out[s]["start_page"]) for s in ("offers_a", "details_a", "bare")] == [(100, 1), (100, 1), (7, 3)]
    free = {r["source"]: r["max_pages"] for r in resolved(registry).collect()}
    assert free["bare"] == 7 and 100 not in free.values()
    assert find_source(registry, "bare", 5)["max_pages"] == 5


def test_registry_lookup(registry):
    assert find_source(registry, "bare")["category_label"] == "bare"
    with pytest.raises(SourceDisabled):
        find_source(registry, "off")
    with pytest.raises(SourceNotFound):
        find_source(registry, "missing")


def test_yaml_registry(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "s.yaml"
    path.write_text("sources:\n  - name: a\n    type: t\n    parameters: {bq_distinct: true, node: 12, empty: }\n")
    row = read_yaml_registry(spark, str(path)).first()
    assert row["parameters"] == {"bq_distinct": "true", "node": "12"} and row["enabled"]


def test_all_sources_in_one_plan(spark, registry):
    offer = json.dumps({"results": [{"content": {"asin": "A", "title": "t", "pricing": [{"seller": "s"}]}}]})
    feed = spark.createDataFrame(
        [("offers_a", "A", offer, AT), ("bare", "B", "{}", AT), ("off", "C", offer, AT), ("unknown", "D", offer, AT)],
        "source string, asin string, payload string, extracted_at string",
    )
    out = {r["asin"]: (r["category_label"], r["node_label"], r["pricing_status"]) for r in offers_of_sources(feed, registry).collect()}
    assert out == {"A": ("mills-N", "N", "offer"), "B": ("bare", None, "no_offers")}
    labels = {r["asin"]: (r["category_label"], r["node"]) for r in details_of_sources(feed, registry).collect()}
    assert labels == {"A": ("mills", "N"), "B": ("bare", None)}
    page = json.dumps({"organic_results": [{"asin": "P"}], "serpapi_pagination": {"next": "u"}})
    pages = spark.createDataFrame([("bare", i, page, AT) for i in range(1, 20)], "source string, source_page int, payload string, extracted_at string")
    got = [r["page_number"] for r in listings_of_sources(pages, registry).orderBy("page_number").collect()]
    assert got == list(range(1, 8))


def test_runs_keep_null_members_and_text(spark, tmp_path):
    rows = flatten_offers(
        spark.createDataFrame([("K", '{"results":[{"content":{"asin":"K","title":"Mühle €"}}]}')], "asin string, payload string"), "cat", "n", AT
    )
    path = write_run(rows, str(tmp_path), "cat", "20240131_070000", node="n")
    assert path == f"{tmp_path}/cat-n/20240131_070000"
    text = spark.read.text(path).first()[0]
    assert '"price":null' in text and "Mühle €" in text
    assert read_jsonl(spark, path, OFFERS).collect() == rows.collect()


def test_empty_runs(spark, tmp_path):
    none = spark.createDataFrame([], SEARCH_LISTING)
    assert write_run(none, str(tmp_path), "cat", "s") is None and not (tmp_path / "cat").exists()
    assert os.path.isdir(write_run(none, str(tmp_path), "cat", "s", write_empty=True))


def test_strict_json_has_no_nan(spark):
    df = spark.createDataFrame([(float("nan"), 1.5), (float("inf"), None)], "a double, b double")
    assert [r["value"] for r in json_lines(without_nan(df)).collect()] == ['{"a":null,"b":1.5}', '{"a":null,"b":null}']


def test_many_labels_in_one_write(spark, tmp_path):
    df = spark.createDataFrame([("x", "1", 1), ("y", None, 2), ("x", "1", 3)], "label string, node string, v int")
    at = F.lit(dt.datetime(2024, 1, 31, 7)).cast("timestamp")
    write_runs(df, str(tmp_path / "out"), F.col("label"), F.col("node"), at)
    got = spark.read.json(str(tmp_path / "out"))
    assert {(r["run_label"], r["v"]) for r in got.collect()} == {("x-1", 1), ("y", 2), ("x-1", 3)}
    assert {r["run_stamp"] for r in got.collect()} == {"20240131_070000"}


def test_details_survive_a_round_trip(spark, tmp_path):
    from shelfscope.operators.detail_payloads import flatten_details
    from shelfscope.schemas import variants_to_json

    df = flatten_details(
        spark.createDataFrame([("K", '{"results":[{"content":{"asin":"K","buybox":[{"seller":"S"}],"price":1.5}}]}')], "asin string, payload string"), "c", None, AT
    )
    path = write_run(df, str(tmp_path), "c", "s")
    back = read_jsonl(spark, path, DETAILS)
    assert variants_to_json(back).collect() == variants_to_json(df).collect()


def test_older_listing_files_lack_a_column(spark, tmp_path):
    old = {"title": "mill 9 kg", "price_raw": None, "link": "https:\\/\\/s.example.com\\/p\\/x\\/", "extracted_at": AT, "category_label": "c"}
    (tmp_path / "a.jsonl").write_text(json.dumps(old).replace("\\\\", "\\") + "\n")
    (tmp_path / "b.jsonl").write_text(json.dumps({**old, "link": "l", "page_number": 2}) + "\n")
    out = {r["link"]: r["page_number"] for r in read_jsonl(spark, str(tmp_path), LINK_LISTING).collect()}
    assert out == {"https://s.example.com/p/x/": None, "l": 2}


def test_lookup_answers(spark, tmp_path):
    answers = spark.createDataFrame(
        [("https://s.example.com/p/ä b=1/", '{"error":"406","status_code":406}'), ("https://s.example.com/q", '{"error":"Read timed out.","status_code":null}'), ("no url", None)],
        "value string, payload string",
    )
    wrapped = wrap_lookups(answers, "cat", AT)
    out = lookup_status(wrapped).orderBy(F.desc("status_code")).collect()
    assert [(r["error"], r["status_code"]) for r in out][0] == ("406", 406)
    assert {r["error"] for r in out} == {"406", "Read timed out.", "input is not a URL"}
    urls = {r["value"]: r["request_url"] for r in request_urls(answers, "https://api.example.com/x").collect()}
    assert urls["https://s.example.com/p/ä b=1/"] == "https://api.example.com/x?url=https:%2F%2Fs.example.com%2Fp%2F%C3%A4%20b=1%2F"
    assert urls["no url"] is None
    (tmp_path / "r.jsonl").write_text('{"input_value":"u","category_label":"c","extracted_at":"t","payload":{"error":"e","status_code":null}}\n')
    assert read_jsonl(spark, str(tmp_path / "r.jsonl"), LOOKUP).first()["payload"]["error"] == "e"


def test_union_fills_missing_columns(spark):
    a, b, c = (spark.createDataFrame([(1,)], f"{n} int") for n in "abc")
    assert [tuple(r) for r in union_rows(a, b, c).collect()] == [(1, None, None), (None, 1, None), (None, None, 1)]


def test_current_listing(spark, rows):
    def seen(asin, category, node, when, position, page=1):
        return (asin, category, node, f"2024-01-{when:02}T00:00:00+00:00", position, page)

    df = conform(
        spark.createDataFrame(
            [seen("A", "c", None, 1, 1), seen("A", "c", None, 2, 9), seen("A", "c", None, 2, 4), seen("B", "c", None, 1, 2), seen("C", "d", "n", 1, 3), seen(None, "d", "n", 5, 1)],
            "asin string, category_label string, node string, extracted_at string, position int, page_number int",
        ),
        SEARCH_LISTING,
    )
    out = {r["asin"]: (r["position"], r["is_active"]) for r in rows(current_listing(df))}
    assert out == {"A": (4, True), "B": (2, False), "C": (3, True)}
    assert {r["asin"] for r in rows(active(current_listing(df)))} == {"A", "C"}


def test_stored_tables(spark):
    spark.range(3).selectExpr("cast(id as string) as asin", "id > 0 as is_active").createOrReplaceTempView("listing_now")
    spark.range(2).createOrReplaceTempView("gold_now")
    tables = Tables(spark, TableNames(gold="gold_now", listing="listing_now"))
    assert tables.gold().count() == 2 and tables.active_listing().count() == 2
    Tables(spark, TableNames(gold="gold_now", listing="listing_now", offers="gold_now")).register_views()
    assert spark.sql("select count(*) as n from gold where id >= :low", args={"low": 1}).first()["n"] == 1


def test_incremental_load_skips_what_it_has_seen(spark, tmp_path):
    landed, table, checkpoint = (str(tmp_path / d) for d in ("landed", "table", "checkpoint"))
    os.makedirs(landed)

    def land(name, *asins):
        with open(f"{landed}/{name}.jsonl", "w") as f:
            f.writelines(json.dumps({"asin": a, "offer_position": 1, "extracted_at": AT}) + "\n" for a in asins)

    def load():
        stream = with_event_time(stream_jsonl(spark, landed, OFFERS))
        once = deduplicated(stream, ["asin", "extracted_ts", "offer_position"], "extracted_ts")
        load_available(once, table, checkpoint).awaitTermination()
        return sorted(r["asin"] for r in spark.read.parquet(table).collect())

    land("one", "A", "A", "B")
    assert load() == ["A", "B"]
    assert load() == ["A", "B"]  # nothing new
    land("two", "B", "C")
    assert load() == ["A", "B", "C"]


def test_shared_folder_is_the_clusters(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert folder is None or shared_folder(spark) == folder.rstrip("/")
    assert REGISTRY.fieldNames() == ["name", "type", "enabled", "parameters"]


def test_newest_snapshot_comes_from_the_catalog(spark, tmp_path):
    days = spark.sql("select explode(sequence(date'2024-01-30', date'2024-02-02')) as snapshot_date").withColumn("asin", F.lit("A"))
    days.write.partitionBy("snapshot_date").option("path", str(tmp_path / "gold")).saveAsTable("gold_days")
    try:
        assert Tables(spark, TableNames(gold="gold_days")).newest_snapshot() == dt.date(2024, 2, 2)
    finally:
        spark.sql("drop table gold_days")


def test_listings_beyond_a_hundred_pages(spark):
    entries = [("free", "listing", True, {}), ("set", "listing", True, {"max_pages": "250"})]
    registry = spark.createDataFrame(entries, REGISTRY)
    payload = json.dumps({"serpapi_pagination": {"next": "u"}, "organic_results": [{"asin": "A", "position": 1}]})
    pages = spark.createDataFrame([(s, i, payload, "t") for s in ("free", "set") for i in range(1, 601)], "source string, source_page int, payload string, extracted_at string")

    def counts(*cap):
        return {r["category_label"]: r["count"] for r in listings_of_sources(pages, registry, *cap).groupBy("category_label").count().collect()}

    assert counts() == {"free": 600, "set": 250} and counts(100) == {"free": 100, "set": 100}
