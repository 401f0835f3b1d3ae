"""Search result pages to listing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.bind import once
from shelfscope.functions.predicates import sponsored
from shelfscope.functions.text import unescaped_slashes
from shelfscope.functions.variants import get, parsed
from shelfscope.operators.tags import Tag, tag
from shelfscope.schemas import SEARCH_LISTING, conform

# Fields of a search result.
_RESULT = (
    "struct<position:int,asin:string,title:string,link:string,rating:double,reviews:bigint,"
    "bought_last_month:string,price:variant,extracted_price:double,delivery:string>"
)


def flatten_search_pages(
    pages: DataFrame, category_label: Tag, extracted_at: Tag, payload: str = "payload"
) -> DataFrame:
    """One row per organic result of each page; a page without results gives none.

    ``pages`` holds ``page_number`` (the index among fetched pages) and the payload text. Expansion
    stays within a row, so there is no shuffle.
    """
    site_page = F.col("source_page") if "source_page" in pages.columns else F.lit(None).cast("int")
    rows = (
        pages.select(
            "page_number",
            site_page.alias("source_page"),
            tag(category_label).alias("category_label"),
            tag(extracted_at).alias("extracted_at"),
            once(parsed(F.col(payload))).alias("v"),
        )
        .select(
            "page_number",
            "source_page",
            "category_label",
            "extracted_at",
            get(F.col("v"), "$.search_parameters.node", "string").alias("node"),
            # Results that are no objects come out NULL and are dropped, as is the row of an empty page.
            F.explode_outer(get(F.col("v"), "$.organic_results", f"array<{_RESULT}>")).alias("p"),
        )
        .where("p is not null")
        .select("*", "p.*")
        .withColumn("link", F.coalesce("link", F.lit("")))
    )
    return conform(
        rows.withColumns(
            {
                # A path into something that is not an object is NULL: a price given as text has no parts.
                "price_raw": get(F.col("price"), "$.raw", "string"),
                "currency": get(F.col("price"), "$.currency", "string"),
                "is_sponsored": sponsored(F.col("link")),
                "link": unescaped_slashes(F.col("link")),
            }
        ),
        SEARCH_LISTING,
    )
