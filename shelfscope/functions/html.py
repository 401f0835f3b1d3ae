"""Links, tags and script blocks of an HTML page by pattern.

Comments, scripts and styles are recognised left to right in one pattern, so markup quoted inside a
script or a comment is not taken for markup.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscope.functions.text import decoded_entities, slug_title, stripped

# The rest of a start tag: quoted values may hold ">"; a tag with a stray quote ends at its first ">".
_REST = r"""(?:[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+|[^>]*)>"""

_ATTRIBUTE = r"""[^\s=>]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+"""


def start_tag(name: str) -> str:
    """Pattern of a start tag, to be used with the flags ``(?is)``."""
    return rf"<{name}(?=[\s/>]){_REST}"


_SCRIPT = r"<script\b[^>]*>.*?</script\s*>"
_HIDDEN = rf"(?is)<!--.*?-->|{_SCRIPT}|<style\b[^>]*>.*?</style\s*>"


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, _HIDDEN, "")


def raw_attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in a start tag as written, '' where it is absent or blank.

    Attributes are skipped one by one, so a name inside another attribute's value is not found. A tag
    that cannot be read that way, for a stray quote, is searched as plain text.
    """
    value = rf"""\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    other = rf"\s++(?!{name}\s*=){_ATTRIBUTE}"
    read = F.regexp_extract(tag, rf"(?is)^<[a-z][^\s>]*+(?:{other})*+\s*?{value}", 1)
    well_formed = tag.rlike(rf"(?is)^<[a-z][^\s>]*+(?:\s++{_ATTRIBUTE})*+\s*+/?>")
    found = F.when((read != "") | well_formed, read).otherwise(
        F.regexp_extract(tag, rf"(?is)^<[a-z][^>]*?{value}", 1)
    )
    return F.regexp_replace(found, r"""^["']|["']$""", "")


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute with its character references decoded."""
    return decoded_entities(raw_attribute(tag, name))


def raw_text(markup: Column) -> Column:
    """Text of a fragment as written: each piece between tags trimmed, then run together."""
    return stripped(F.regexp_replace(markup, r"(?s)\s*<[^>]*>\s*", ""))


def inner_text(markup: Column) -> Column:
    return decoded_entities(raw_text(markup))


def _anchor_tags(shown: Column) -> Column:
    return F.regexp_extract_all(shown, F.lit(rf"(?is){start_tag('a')}.*?(?=</a\s*>|<a\s|$)"), 0)


def link_targets(shown: Column, prefix: str) -> Column:
    """Distinct link targets below ``prefix`` on a visible page."""
    targets = F.transform(_anchor_tags(shown), lambda t: attribute(t, "href"))
    return F.array_distinct(F.filter(targets, lambda h: h.startswith(prefix)))


def anchors(shown: Column, prefix: str) -> Column:
    """``array<struct<href, title>>`` of the links below ``prefix`` on a visible page, in page order.

    The title is the anchor text, or the words of the link's last part where there is no text.
    """
    links = F.transform(
        _anchor_tags(shown),
        lambda t: F.struct(
            attribute(t, "href").alias("href"),
            inner_text(F.regexp_replace(t, "(?is)^" + start_tag("a"), "")).alias("text"),
        ),
    )
    return F.transform(
        F.filter(links, lambda a: a["href"].startswith(prefix)),
        lambda a: F.struct(
            a["href"].alias("href"),
            F.when(a["text"] != "", a["text"]).otherwise(slug_title(a["href"])).alias("title"),
        ),
    )


def ld_json_blocks(page: Column, keep_commented: bool = False) -> Column:
    """Texts of the ``application/ld+json`` scripts in page order.

    With ``keep_commented`` scripts inside comments count too.
    """
    pattern = rf"(?is){_SCRIPT}" if keep_commented else rf"(?is)<!--.*?-->|{_SCRIPT}"
    tokens = F.regexp_extract_all(page, F.lit(pattern), 0)
    scripts = F.filter(
        tokens,
        lambda t: t.rlike(r"(?i)^<script\b") & (raw_attribute(t, "type") == "application/ld+json"),
    )
    return F.transform(scripts, lambda t: F.regexp_extract(t, r"(?is)^<[^>]*>(.*)</script\s*>$", 1))


def meta_tags(shown: Column) -> Column:
    """``array<struct<itemprop, property, content>>`` of the ``meta`` tags of a visible page."""
    tags = F.regexp_extract_all(shown, F.lit("(?is)" + start_tag("meta")), 0)
    return F.transform(
        tags, lambda t: F.struct(*[raw_attribute(t, a).alias(a) for a in ("itemprop", "property", "content")])
    )


def meta_content(metas: Column, attr: str, value: str) -> Column:
    """``content`` of the first tag whose ``attr`` is ``value``, NULL where blank or absent."""
    first = F.get(F.filter(metas, lambda m: m[attr] == value), F.lit(0))
    return F.nullif(first["content"], F.lit(""))


def price_span(shown: Column) -> Column:
    """Text of the first ``span`` of a visible page whose ``data-automation-id`` mentions a price."""
    spans = F.regexp_extract_all(shown, F.lit(rf"(?is){start_tag('span')}.*?</span\s*>"), 0)
    first = F.get(
        F.filter(spans, lambda t: F.contains(raw_attribute(t, "data-automation-id"), F.lit("price"))),
        F.lit(0),
    )
    return F.nullif(raw_text(first), F.lit(""))


def loose_price(page: Column) -> Column:
    """First ``"price": 12.99``-like value anywhere in the page source."""
    return F.nullif(
        F.regexp_extract(page, r'"price"\s*:\s*"?([0-9]+[.,][0-9]+)"?', 1), F.lit("")
    )
