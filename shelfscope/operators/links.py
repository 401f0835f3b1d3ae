"""Product links of landed category pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions.html import anchors, visible
from shelfscope.functions.urls import absolute
from shelfscope.operators.dedupe import first_seen
from shelfscope.operators.tags import Tag, tag
from shelfscope.schemas import LINK_LISTING, conform

PRODUCT_PREFIX = "/p/"


def page_links(
    pages: DataFrame, base_url: Tag, keys: Sequence[str] = (), prefix: str = PRODUCT_PREFIX
) -> DataFrame:
    """``(keys, page_number, position, link, title)`` of every product link of every page."""
    return pages.select(
        *keys,
        "page_number",
        tag(base_url).alias("base_url"),
        # The outer form spares a size filter, which would read the page a second time.
        F.posexplode_outer(anchors(visible(F.col("html")), prefix)).alias("position", "a"),
    ).where("a is not null").select(
        *keys,
        "page_number",
        "position",
        absolute(F.col("base_url"), F.col("a.href")).alias("link"),
        F.col("a.title").alias("title"),
    )


def until_first_failure(pages: DataFrame, keys: Sequence[str], error: str = "fetch_error") -> DataFrame:
    """Pages before the first failed one of their crawl; a failed page ends the crawl.

    Only the error column is read to find the failures, and there is at most one row per crawl.
    """
    failed = pages.where(F.col(error).isNotNull())
    if not keys:
        first = failed.select(F.min("page_number")).scalar()
        return pages.where(first.isNull() | (F.col("page_number") < first))
    first = failed.groupBy(*keys).agg(F.min("page_number").alias("first_failed"))
    return (
        pages.join(first, list(keys), "left")
        .where(F.col("first_failed").isNull() | (F.col("page_number") < F.col("first_failed")))
        .drop("first_failed")
    )


def list_links(
    pages: DataFrame,
    base_url: Tag,
    category_label: Tag,
    extracted_at: Tag,
    keys: Sequence[str] = (),
    prefix: str = PRODUCT_PREFIX,
    max_products: int | None = None,
) -> DataFrame:
    """Each crawl's product links, each once at its first place, as listing rows.

    A link present on every page is reduced inside the tasks first. The cap takes the first links of every
    crawl in page order; the rank filter cuts crawls inside the tasks before they are shuffled.
    """
    links = page_links(pages, base_url, keys, prefix)
    once = first_seen(links, [*keys, "link"], [F.col("page_number"), F.col("position")])
    if max_products:
        if keys:
            place = F.row_number().over(Window.partitionBy(*keys).orderBy("page_number", "position"))
            once = once.withColumn("_place", place).where(F.col("_place") <= max_products).drop("_place")
        else:
            once = once.orderBy("page_number", "position").limit(max_products)
    return conform(
        once.select(
            "title",
            "link",
            "page_number",
            tag(category_label).alias("category_label"),
            tag(extracted_at).alias("extracted_at"),
        ),
        LINK_LISTING,
    )
