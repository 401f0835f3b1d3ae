"""Page plan of a category, read off its first page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.html import attribute, link_targets, raw_attribute, raw_text, visible
from shelfscope.functions.text import whole_number
from shelfscope.functions.urls import page_url
from shelfscope.functions.variants import falsy, get, members, parsed
from shelfscope.operators.links import PRODUCT_PREFIX

# Class names and ids of the pager markup.
PAGER_LIST = "reptile_paging"
PAGER_ITEM = "reptile_paging__item"
PAGER_DOTS = "reptile_paging__dots"
PAGER_NEXT = "bottom-next"


def _has_class(tag: Column, name: str) -> Column:
    return F.array_contains(F.split(raw_attribute(tag, "class"), r"\s+"), name)


def _pager_buttons(shown: Column) -> Column:
    """The first button of each numbered pager item."""
    lists = F.filter(
        F.regexp_extract_all(shown, F.lit(r"(?is)<ul\b[^>]*>.*?</ul\s*>"), 0),
        lambda t: _has_class(t, PAGER_LIST),
    )
    items = F.flatten(
        F.transform(lists, lambda t: F.regexp_extract_all(t, F.lit(r"(?is)<li\b[^>]*>.*?(?=</li\s*>|<li\b|$)"), 0))
    )

    def dots(item: Column) -> Column:
        spans = F.regexp_extract_all(item, F.lit(r"(?is)<span\b[^>]*>"), 0)
        return F.exists(spans, lambda s: _has_class(s, PAGER_DOTS))

    numbered = F.filter(
        items,
        lambda i: _has_class(i, PAGER_ITEM) & ~F.contains(raw_attribute(i, "id"), F.lit(PAGER_NEXT)) & ~dots(i),
    )
    buttons = F.transform(numbered, lambda i: F.regexp_extract(i, r"(?is)<button\b[^>]*>.*?(?=</button\s*>|$)", 0))
    return F.filter(buttons, lambda b: b != "")


def offset_step(offsets: Column, first_page_items: Column) -> Column:
    """Smallest gap between the distinct positive offsets, the first measured from 0.

    Without offsets the step is the number of items on the first page, at least 1. The offsets are
    one page's own markup, so the array is short and the work stays within the row.
    """
    ordered = F.array_sort(F.array_distinct(F.filter(offsets, lambda o: o > 0)))
    gaps = F.transform(ordered, lambda o, i: o - F.when(i > 0, F.get(ordered, i - 1)).otherwise(F.lit(0)))
    return F.coalesce(F.array_min(gaps), F.greatest(F.lit(1), first_page_items))


def detect_pagination(pages: DataFrame, prefix: str = PRODUCT_PREFIX) -> DataFrame:
    """Adds ``total_pages``, ``offset_step`` and ``layout_hint`` to first pages ``(url, html, ...)``."""
    hints = F.transform("buttons", lambda b: parsed(F.nullif(attribute(b, "data-page"), F.lit(""))))
    return (
        pages.withColumn("shown", visible(F.col("html")))
        .withColumn("buttons", _pager_buttons(F.col("shown")))
        .withColumn("hints", F.filter(hints, lambda h: members(h).isNotNull()))
        .withColumn(
            "numbers",
            F.transform(
                "buttons", lambda b: whole_number(raw_text(F.regexp_replace(b, r"(?s)^<[^>]*>", "")))
            ),
        )
        .withColumn("offsets", F.transform("hints", lambda h: get(h, "$.o", "int")))
        .withColumn("first_page_items", F.size(link_targets(F.col("shown"), prefix)))
        .withColumns(
            {
                "total_pages": F.coalesce(F.array_max("numbers"), F.lit(1)),
                "offset_step": offset_step(F.col("offsets"), F.col("first_page_items")),
                "layout_hint": get(
                    F.get(F.filter(F.transform("hints", lambda h: get(h, "$.l")), lambda x: ~falsy(x)), F.lit(0)),
                    "$",
                    "string",
                ),
            }
        )
        .drop("shown", "buttons", "hints", "numbers", "offsets", "first_page_items")
    )


# Pages that one generated array holds: whatever total a page announces, no row is larger than this.
PAGES_AT_ONCE = 1 << 15


def absurd_total(most_pages: int) -> Column:
    """A page announces more pages than any category has."""
    return F.coalesce(F.col("total_pages") > most_pages, F.lit(False))


def page_plan(detected: DataFrame, url: str = "url", most_pages: int | None = None) -> DataFrame:
    """One row per page to visit: the category page itself, then ``offset``-addressed pages.

    Pages are generated in blocks of PAGES_AT_ONCE and then one by one, so a total read off a button never becomes one
    array. Categories that announce more than ``most_pages`` are left out where it is given; ``absurd_total`` finds them.
    """
    if most_pages is not None:
        detected = detected.where(~absurd_total(most_pages))
    last = F.greatest(F.coalesce("total_pages", F.lit(1)), F.lit(1))
    offset = (F.col("page_number") - 1).cast("bigint") * F.col("offset_step")
    return (
        detected.withColumn("_from", F.explode(F.sequence(F.lit(0), F.expr(f"(greatest(coalesce(total_pages, 1), 1) - 1) div {PAGES_AT_ONCE}").cast("int"))))
        .withColumn("_from", F.col("_from") * PAGES_AT_ONCE + 1)
        # The smaller end first: the sum may pass the largest whole number.
        .withColumn("page_number", F.explode(F.sequence("_from", F.col("_from") + F.least(last - F.col("_from"), F.lit(PAGES_AT_ONCE - 1)))))
        .drop("_from")
        .withColumn("offset", offset)
        .withColumn(
            "page_url",
            F.when(F.col("page_number") == 1, F.col(url)).otherwise(
                page_url(F.col(url), F.col("offset"), F.col("layout_hint"))
            ),
        )
    )
