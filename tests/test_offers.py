"""Offer payloads: missing, null, empty and malformed parts are all told apart."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfscope.operators.offer_payloads import MALFORMED, flatten_offers
from shelfscope.plans.silver import flat_offers
from shelfscope.schemas import OFFERS

MISSING = object()


def answer(**content):
    return json.dumps({"results": [{"content": content}]})


def offer(options=MISSING, **more):
    o = {"seller": "S", "price": 9.5, **more}
    if options is not MISSING:
        o["delivery_options"] = options
    return answer(asin="C", title="t", url="u", review_count=3, pricing=[o])


def flat(spark, **payloads):
    df = spark.createDataFrame(list(payloads.items()), "asin string, payload string")
    out = flatten_offers(df, "cat-n", "n", "2024-01-01T00:00:00+00:00")
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in OFFERS.fields]
    return out


# input, then the expected (status, number of rows, asin)
CASES = {
    "no_option_key": (offer(), "offer", 1, "C"),
    "no_options": (offer([]), "no_offers", 1, "C"),
    "null_option": (offer([None]), "offer", 1, "C"),
    "empty_option": (offer([{}]), "offer", 1, "C"),
    "false_option": (offer([False, 0, "", []]), "offer", 4, "C"),
    "null_options": (offer(None), "error", 1, "null_options"),
    "text_options": (offer("x"), "error", 1, "text_options"),
    "blank_options": (offer(""), "no_offers", 1, "C"),
    "object_options": (offer({"type": "x"}), "error", 1, "object_options"),
    "empty_object_options": (offer({}), "no_offers", 1, "C"),
    "stray_option": (offer([{"type": "a"}, "x"]), "error", 1, "stray_option"),
    "null_date": (offer([{"type": "a", "date": None}]), "error", 1, "null_date"),
    "text_date": (offer([{"type": "a", "date": "soon"}]), "error", 1, "text_date"),
    "empty_date": (offer([{"type": "a", "date": {}}]), "offer", 1, "C"),
    "no_pricing": (answer(asin="C", title="t"), "no_offers", 1, "C"),
    "empty_pricing": (answer(asin="C", pricing=[]), "no_offers", 1, "C"),
    "null_pricing": (answer(asin="C", pricing=None), "error", 1, "null_pricing"),
    "null_offer": (answer(asin="C", pricing=[{"seller": "S"}, None]), "error", 1, "null_offer"),
    "blank_asin": (answer(asin="", pricing=[]), "no_offers", 1, "blank_asin"),
    "empty_content": (answer(), "no_offers", 1, "empty_content"),
    "text_content": ('{"results":[{"content":"oops"}]}', "error", 1, "text_content"),
    "null_content": ('{"results":[{"content":null}]}', "no_offers", 1, "null_content"),
    "no_results": ('{"results":[]}', "no_offers", 1, "no_results"),
    "null_results": ('{"results":null}', "no_offers", 1, "null_results"),
    "error_only": ('{"error":"HTTP 500","status_code":500}', "error", 1, "error_only"),
    "null_error": ('{"error":null}', "error", 1, "null_error"),
    "error_and_results": ('{"error":"x","results":[]}', "no_offers", 1, "error_and_results"),
    "not_json": ("{oops", "error", 1, "not_json"),
}


@pytest.fixture(scope="module")
def flattened(spark):
    """Rows per case, found by the input key carried as the label."""
    df = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "asin string, payload string")
    out = {}
    for row in flatten_offers(df, df["asin"], None, "t").collect():
        out.setdefault(row["category_label"], []).append(row)
    return out


@pytest.mark.parametrize("case", CASES)
def test_status_and_row_count(flattened, case):
    _, status, count, asin = CASES[case]
    got = flattened[case]
    assert (len(got), {r["pricing_status"] for r in got}, {r["asin"] for r in got}) == (count, {status}, {asin})


def test_positions_and_messages(flattened):
    def positions(case):
        return [(r["offer_position"], r["delivery_option_position"]) for r in flattened[case]]

    assert positions("no_option_key") == [(1, None)]
    assert positions("false_option") == [(1, None)] * 4
    assert positions("empty_date") == [(1, 1)]
    assert flattened["error_only"][0]["error_message"] == "HTTP 500"
    assert flattened["null_error"][0]["error_message"] is None
    assert flattened["null_date"][0]["error_message"] == MALFORMED
    assert flattened["empty_pricing"][0]["error_message"] is None


def test_several_offers_and_options(spark, rows):
    payload = answer(
        asin="C",
        pricing=[
            {"seller": "a", "price": 1, "delivery_options": [None, {"type": "x", "date": {"by": "Mon"}}]},
            {"seller": "b", "price": "2.5", "price_shipping": 1, "delivery_options": []},
            {"seller": "c", "price": "n/a"},
        ],
    )
    out = rows(flat(spark, K=payload))
    got = [(r["seller"], r["price"], r["offer_position"], r["delivery_option_position"], r["delivery_date"]) for r in out]
    assert got == [("a", 1.0, 1, None, None), ("a", 1.0, 1, 2, "Mon"), ("c", None, 3, None, None)]


def test_silver_keeps_one_row_per_offer(spark, rows):
    payload = offer([{"type": "a"}, {"type": "b"}], price_shipping=0.5, seller_id="1")
    df = flat(spark, K=payload, L="{}")
    out = rows(flat_offers(df.unionByName(df)))
    assert [(str(r["total_price"]), r["category_label"], r["node"], r["seller_key"]) for r in out] == [("10.00", "cat", "n", "s")]


scalars = st.one_of(st.none(), st.booleans(), st.integers(-3, 3), st.text("ab", max_size=2))
options = st.one_of(scalars, st.lists(st.one_of(scalars, st.fixed_dictionaries({}, optional={"type": scalars, "date": st.one_of(scalars, st.just({"by": "d"}))})), max_size=3))
offers_ = st.one_of(scalars, st.fixed_dictionaries({"seller": st.just("s")}, optional={"delivery_options": options}))
payloads = st.one_of(
    st.fixed_dictionaries({}, optional={"error": scalars, "results": st.lists(st.fixed_dictionaries({}, optional={"content": st.one_of(scalars, st.fixed_dictionaries({}, optional={"asin": scalars, "pricing": st.one_of(scalars, st.lists(offers_, max_size=3))}))}), max_size=2)}),
)


def expected_rows(payload):
    """How many rows a payload gives, and their status, told from the payload alone."""

    def countable(options):
        if isinstance(options, (list, str, dict)):
            return list(options)
        raise ValueError

    if "error" in payload and "results" not in payload:
        return 1, "error"
    results = payload.get("results")
    content = results[0].get("content") if results else None
    if not content:
        return 1, "no_offers"
    try:
        if not isinstance(content, dict):
            raise ValueError
        n = 0
        for o in countable(content.get("pricing", [])):
            if not isinstance(o, dict):
                raise ValueError
            for d in countable(o.get("delivery_options", [None])):
                if d and not (isinstance(d, dict) and isinstance(d.get("date", {}), dict)):
                    raise ValueError
                n += 1
        return (n, "offer") if n else (1, "no_offers")
    except ValueError:
        return 1, "error"


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(payloads, min_size=30, max_size=60))
def test_every_key_appears_with_the_expected_rows(spark, batch):
    df = spark.createDataFrame([(f"K{i}", json.dumps(p)) for i, p in enumerate(batch)], "asin string, payload string")
    got = {}
    for r in flatten_offers(df, df["asin"], None, "t").groupBy("category_label", "pricing_status").count().collect():
        assert r["category_label"] not in got
        got[r["category_label"]] = (r["count"], r["pricing_status"])
    assert got == {f"K{i}": expected_rows(p) for i, p in enumerate(batch)}
