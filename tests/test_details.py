"""Product detail payloads."""

import json

from shelfscope.operators.detail_payloads import flatten_details
from shelfscope.plans.gold import daily_snapshot
from shelfscope.plans.silver import flat_offers
from shelfscope.operators.offer_payloads import flatten_offers
from shelfscope.operators.worklist import attach_payloads, numbered, status_counts
from shelfscope.schemas import DETAILS, variants_to_json

AT = "2024-01-31T07:00:00+00:00"


def details(spark, payloads):
    df = spark.createDataFrame(payloads, "asin string, payload string")
    out = flatten_details(df, "cat", "n", AT)
    assert out.columns == [f.name for f in DETAILS.fields] and len(out.columns) == 50
    return {r["asin"]: r.asDict(recursive=True) for r in variants_to_json(out).collect()}


def content(**c):
    return json.dumps({"status_code": 200, "results": [{"content": c}]})


def test_status_routing(spark):
    out = details(
        spark,
        [
            ("a", '{"error":"boom","status_code":406}'), ("b", '{"error":"boom","results":[]}'), ("c", '{"results":[{"content":{}}]}'),
            ("d", content(title="t")), ("e", "not json"), ("f", '{"results":[{"content":"text"}]}'),
        ],
    )
    assert {k: r["item_status"] for k, r in out.items()} == {
        "a": "error", "b": "no_content", "c": "no_content", "d": "ok", "e": "error", "f": "no_content",
    }
    assert out["a"]["error_message"] == "boom" and out["a"]["status_code"] == 406 and out["b"]["error_message"] is None
    assert out["a"]["payload_raw"] == '{"error":"boom","status_code":406}'


def test_fallbacks_between_fields(spark):
    out = details(
        spark,
        [
            ("k", content(asin="", asin_in_url="U", review_count=0, reviews_count=7, category="")),
            ("l", content(asin=None, review_count=2, reviews_count=7, category='["x"]')),
            ("m", content(asin="M", asin_in_url="V", category=["y"], review_count=0)),
        ],
    )
    assert set(out) == {"U", "l", "M"}
    assert [out[k]["review_count"] for k in ("U", "l", "M")] == [7, 2, None]
    assert [out[k]["category"] for k in ("U", "l", "M")] == ['"cat"', '["x"]', '["y"]']


def test_json_in_text_lists_and_first_choices(spark):
    variation = [{"asin": "V1", "selected": False}, {"asin": "V2", "selected": True, "dimensions": '{"c":"red"}'}, {"asin": "V3", "selected": True}]
    out = details(
        spark,
        [
            ("a", content(asin="a", description=' {"k": 1} ', buybox="{broken}", images='["", "i1"]', bullet_points=["x", "", None, "y"], variation=variation)),
            ("b", content(asin="b", description="plain", images="none", bullet_points="one", variation="not json")),
            ("c", content(asin="c", images=[], variation=json.dumps(variation[:1]), other_sellers='[{"s":1}]')),
        ],
    )
    a, b, c = out["a"], out["b"], out["c"]
    assert (a["description"], a["buybox"], a["main_image"], a["bullet_points"]) == ('{"k":1}', '"{broken}"', "i1", "x\ny")
    assert (a["variation_selected_asin"], a["variation_selected_dimensions"]) == ("V2", '{"c":"red"}')
    assert (b["description"], b["main_image"], b["bullet_points"], b["variation_selected_asin"]) == ('"plain"', None, "one", None)
    assert (c["images"], c["main_image"], c["variation_selected_asin"], c["other_sellers"]) == ("[]", None, None, '[{"s":1}]')
    assert c["variation_all"] == '[{"asin":"V1","selected":false}]'


def test_repeated_object_keys_keep_the_last(spark):
    out = details(spark, [("a", '{"results":[{"content":{"asin":"a","title":"x","title":"y"}}]}')])
    assert out["a"]["title"] == "y"


def test_worklist_keeps_duplicates_order_and_defaults(spark):
    worklist = numbered(spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("d",)], "asin string").coalesce(1), "asin")
    landed = spark.createDataFrame(
        [("a", "old", 1), ("a", "new", 2), ("b", "one", 1), ("d", "x", 1), ("d", None, 2)], "asin string, payload string, landed_at int"
    )
    out = attach_payloads(worklist, landed).orderBy("input_pos").collect()
    assert [(r["asin"], r["payload"]) for r in out] == [
        ("b", "one"), ("a", "new"), ("b", "one"), ("c", '{"error":"Missing result"}'), ("d", '{"error":"Empty payload"}'),
    ]


def test_status_counts(spark, rows):
    df = spark.createDataFrame([("ok",), ("ok",), ("error",)], "s string")
    assert {r["s"]: r["n_rows"] for r in rows(status_counts(df, "s"))} == {"ok": 2, "error": 1}


def test_snapshot_prefers_the_detail_page(spark, rows):
    offers = flat_offers(
        flatten_offers(
            spark.createDataFrame(
                [("A", content(asin="A", pricing=[{"seller": " Two ", "price": 12, "seller_id": "2"}, {"seller": "One", "price": 11, "price_shipping": 0.5, "seller_id": "1"}])),
                 ("B", content(asin="B", pricing=[{"seller": "Amazon.de", "price": 5, "seller_id": "9"}]))],
                "asin string, payload string",
            ), "cat", None, AT,
        )
    )
    page = flatten_details(
        spark.createDataFrame(
            [("A", content(asin="A", price=20, price_buybox=13, price_shipping=1, stock="In stock", buybox=[{"seller": "Three"}])), ("C", content(asin="C", price=7))],
            "asin string, payload string",
        ), "cat", None, AT,
    )
    out = {r["asin"]: r for r in rows(daily_snapshot(offers, page))}
    a, b, c = out["A"], out["B"], out["C"]
    assert (float(a["pdp_total_price"]), a["buybox_seller_name"], a["buybox_stock"]) == (14.0, "Three", "In stock")
    assert (a["seller_id_count"], float(a["min_total_price"])) == (2, 11.5)
    assert (b["buybox_seller_name"], b["buybox_is_amazon"], float(b["pdp_total_price"])) == ("Amazon.de", True, 5.0)
    assert (float(c["pdp_total_price"]), c["buybox_seller_name"], c["seller_id_count"], c["min_total_price"]) == (7.0, None, 0, None)
    only_offers = {r["asin"]: r for r in rows(daily_snapshot(offers))}
    assert only_offers["A"]["buybox_seller_name"] == "Two"  # first by offer position


def test_refresh_replaces_recent_days_only(spark, tmp_path):
    import datetime as dt

    from shelfscope.plans.gold import refresh_snapshot, write_snapshot
    from shelfscope.schemas import GOLD_SNAPSHOT, SILVER_OFFERS, conform

    def offers(*entries):
        df = spark.createDataFrame([(a, dt.date(2024, 1, d), s, p, 1) for a, d, s, p in entries],
                                   "asin string, snapshot_date date, seller_name string, total_price double, offer_position int")
        return conform(df.selectExpr("*", "cast(snapshot_date as timestamp) as extracted_at", "seller_name as seller_id"), SILVER_OFFERS)

    path = str(tmp_path / "gold")
    write_snapshot(daily_snapshot(offers(("A", 1, "x", 1.0), ("A", 2, "x", 2.0), ("B", 2, "x", 2.0))), path)
    late = flatten_details(spark.createDataFrame([("A", content(asin="A", price=7))], "asin string, payload string"), "c", None, "2024-01-03T08:00:00+00:00")
    refresh_snapshot(offers(("A", 1, "y", 9.0), ("A", 2, "y", 9.0)), late, path, "2024-01-02")
    gold = spark.read.parquet(path)
    assert {f.name: f.dataType for f in gold.schema} == {f.name: f.dataType for f in GOLD_SNAPSHOT}
    got = {(r["snapshot_date"].day, r["asin"], r["buybox_seller_name"], float(r["pdp_total_price"])) for r in gold.collect()}
    assert got == {(1, "A", "x", 1.0), (2, "A", "y", 9.0), (3, "A", None, 7.0)}
