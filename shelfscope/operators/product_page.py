"""Title and price of landed product pages."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.bind import once
from shelfscope.functions.html import ld_json_blocks, loose_price, meta_content, meta_tags, price_span, visible
from shelfscope.functions.text import decoded_entities, slug_title

# Offer fields that may hold the price, in order of trust. The currency code is not one.
PRICE_FIELDS = ("price", "lowPrice", "highPrice")


def _objects(document) -> Iterator[dict]:
    """All objects of a JSON document, parents first, in document order."""
    pending = [document]
    while pending:
        node = pending.pop()
        if isinstance(node, dict):
            yield node
            pending.extend(reversed(node.values()))
        elif isinstance(node, list):
            pending.extend(reversed(node))


def _is_product(node: dict) -> bool:
    kind = node.get("@type")
    return "Product" in kind if isinstance(kind, list) else kind == "Product"


def _offer_price(offers):
    listed = offers if isinstance(offers, list) else [offers]
    prices = (o.get(f) for o in listed if isinstance(o, dict) for f in PRICE_FIELDS)
    return next((p for p in prices if p), None)


def product_facts(blocks) -> tuple[str | None, str | None]:
    """First name and first price among the products described in a page's script blocks."""
    title = price = None
    for block in blocks if blocks is not None else ():
        try:
            document = json.loads(block)
        except (ValueError, TypeError, RecursionError):
            continue
        for product in filter(_is_product, _objects(document)):
            title = title or product.get("name")
            price = price or _offer_price(product.get("offers"))
    return title and str(title), price and str(price)


def ld_json_facts():
    """Column function ``array<string> -> struct<title, price>``.

    Documents nest to any depth and the first product in document order counts. VARIANT sorts object
    members by name, which loses that order, so this one step reads the JSON in Python, in Arrow
    batches and only over the script blocks cut out by the scan.
    """

    @F.pandas_udf("struct<title: string, price: string>")
    def facts(blocks: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([product_facts(b) for b in blocks], columns=["title", "price"], dtype=object)

    return facts


def product_pages(pages: DataFrame, url: str = "url", html: str = "html", lenient: bool = False) -> DataFrame:
    """``(title, price_raw, link)`` of each page that has a title.

    Script data comes first, then meta tags and the visible price, then the words of the link. With
    ``lenient`` commented scripts and bare price values in the source count too.
    """
    page, metas = F.col("html"), F.col("metas")
    facts = (
        pages.select(F.col(url).alias("link"), F.col(html).alias("html"))
        .select(
            "link",
            ld_json_facts()(ld_json_blocks(page, keep_commented=lenient)).alias("ld"),
            visible(page).alias("shown"),
            (loose_price(page) if lenient else F.lit(None).cast("string")).alias("loose"),
        )
        .withColumn("metas", meta_tags(F.col("shown")))
    )
    # Script data is JSON; only what was read off the markup carries character references.
    title = F.coalesce(meta_content(metas, "itemprop", "name"), meta_content(metas, "property", "og:title"))
    price = F.coalesce(
        meta_content(metas, "itemprop", "price"),
        price_span(F.col("shown")),
        meta_content(metas, "property", "product:price:amount"),
    )
    return facts.select(
        once(F.coalesce(F.nullif(F.col("ld.title"), F.lit("")), decoded_entities(title), slug_title(F.col("link")))).alias("title"),
        F.coalesce(F.nullif(F.col("ld.price"), F.lit("")), decoded_entities(price), F.col("loose")).alias("price_raw"),
        "link",
    ).where("title <> ''")
