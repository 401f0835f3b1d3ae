"""Product detail payloads to one wide row per work-list entry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.bind import once
from shelfscope.functions.variants import (
    first_item, first_selected, first_truthy, get, joined_lines, jsonish, members, parsed,
    present, text_or,
)
from shelfscope.operators.tags import Tag, tag
from shelfscope.schemas import DETAILS, conform

# Payload fields copied under their own name, by type.
_TEXT = (
    "title brand url page_type stock currency sales_volume parent_asin product_name coupon store_url"
    " pricing_url pricing_str manufacturer"
).split()
_NUMBER = "price price_upper price_initial price_shipping price_buybox price_sns rating".split()
_FLAG = "is_prime_eligible has_videos".split()
_NESTED = (
    "description images sales_rank delivery buybox rating_stars_distribution product_details"
    " product_overview technical_details other_sellers sns_discounts"
).split()


_MIXED = "asin asin_in_url review_count reviews_count category bullet_points variation".split()
_CONTENT = "struct<" + ",".join(
    f"{name}:{kind}"
    for names, kind in (
        (_TEXT, "string"), (_NUMBER, "double"), (_FLAG, "boolean"), (["answered_questions_count"], "bigint"),
        (_NESTED + _MIXED, "variant"),
    )
    for name in names
) + ">"


def flatten_details(
    payloads: DataFrame,
    category_label: Tag,
    node_label: Tag,
    extracted_at: Tag,
    key: str = "asin",
    payload: str = "payload",
) -> DataFrame:
    """Status, scalar and nested fields of each payload; nested fields stay VARIANT.

    The payload is parsed once, its fields come out of one typed read, and nothing is shuffled.
    """
    v, c, answer = F.col("v"), F.col("c"), F.col("answer")
    rows = (
        payloads.select(
            F.col(key).alias("input_key"),
            tag(category_label).alias("category_label"),
            tag(node_label).alias("node"),
            tag(extracted_at).alias("extracted_at"),
            F.col(payload).alias("payload_raw"),
            once(parsed(F.col(payload))).alias("v"),
        )
        .withColumns(
            {
                "failed": v.isNull() | (present(get(v, "$.error")) & ~present(get(v, "$.results"))),
                "answer": get(v, "$.results[0].content"),
            }
        )
        .withColumn("c", get(answer, "$", _CONTENT))
        # Only an object with members counts as content.
        .withColumn(
            "found",
            c.isNotNull()
            & (present(c["asin"]) | c["title"].isNotNull() | (F.cardinality(members(answer)) > 0)),
        )
        .withColumn("images", jsonish(c["images"]))
        .withColumn(
            "variation_all", F.coalesce(jsonish(first_truthy(c["variation"])), F.parse_json(F.lit("[]")))
        )
        .withColumn("selected", first_selected(F.col("variation_all")))
    )
    reviews = first_truthy(c["review_count"], c["reviews_count"])
    return conform(
        rows.select(
            F.coalesce(
                text_or(c["asin"], F.lit(None)), text_or(c["asin_in_url"], F.lit(None)), F.col("input_key")
            ).alias("asin"),
            "category_label",
            "node",
            "extracted_at",
            *[c[name].alias(name) for name in (*_TEXT, *_NUMBER, *_FLAG, "answered_questions_count")],
            get(reviews, "$", "bigint").alias("review_count"),
            jsonish(F.coalesce(first_truthy(c["category"]), F.col("category_label").cast("variant"))).alias("category"),
            *[jsonish(c[name]).alias(name) for name in _NESTED if name != "images"],
            "images",
            first_item(F.col("images")).alias("main_image"),
            joined_lines(c["bullet_points"]).alias("bullet_points"),
            get(F.col("selected"), "$.asin", "string").alias("variation_selected_asin"),
            jsonish(get(F.col("selected"), "$.dimensions")).alias("variation_selected_dimensions"),
            "variation_all",
            F.when(F.col("failed"), "error").when(F.col("found"), "ok").otherwise("no_content").alias("item_status"),
            F.when(v.isNull(), F.lit("unreadable payload"))
            .when(F.col("failed"), get(v, "$.error", "string"))
            .alias("error_message"),
            get(v, "$.status_code", "bigint").alias("status_code"),
            "payload_raw",
        ),
        DETAILS,
    )
