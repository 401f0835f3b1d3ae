"""URL expressions. Query strings are handled as ordered pairs, so key order is kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscope.functions.bind import bind

_QUERY = r"^[^?#]*\?([^#]*)"


def absolute(base: Column, href: Column) -> Column:
    """A root-relative link on the scheme and host of ``base``."""
    return F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1), href)


def _decoded(c: Column) -> Column:
    """Percent- and plus-decoded text; text that cannot be decoded stays as it is."""
    return F.coalesce(F.try_url_decode(c), c)


def _encoded(c: Column) -> Column:
    """Form encoding that leaves ``_ . - ~`` alone."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_pairs(url: Column) -> Column:
    """Ordered ``array<struct<k, v>>`` of the query string, blank values kept."""
    parts = F.filter(F.split(F.regexp_extract(url, _QUERY, 1), "&"), lambda p: p != "")

    def pair(p: Column) -> Column:
        return F.struct(
            _decoded(F.substring_index(p, "=", 1)).alias("k"),
            _decoded(F.regexp_extract(p, "^[^=]*=(?s)(.*)$", 1)).alias("v"),
        )

    return F.transform(parts, pair)


def _keys(pairs: Column) -> Column:
    return F.array_distinct(F.transform(pairs, lambda p: p["k"]))


def query_params(url: Column) -> Column:
    """``map<key, array<value>>`` of the query string without blank values."""

    def grouped(pairs: Column) -> Column:
        def values(k: Column) -> Column:
            return F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"])

        return F.map_from_entries(F.transform(_keys(pairs), lambda k: F.struct(k, values(k))))

    return bind(F.filter(query_pairs(url), lambda p: p["v"] != ""), grouped)


def query_param(url: Column, key: str) -> Column:
    """The value of ``key`` where it occurs exactly once."""
    values = F.transform(
        F.filter(query_pairs(url), lambda p: (p["k"] == key) & (p["v"] != "")), lambda p: p["v"]
    )
    return bind(values, lambda v: F.when(F.size(v) == 1, F.get(v, F.lit(0))))


def page_url(base: Column, offset: Column, layout: Column) -> Column:
    """``base`` with ``o`` set to the offset, and ``l`` to the layout hint unless it has one.

    A key keeps the place of its first occurrence and the value of its last.
    """
    offset_text = offset.cast("string")

    def pair(key: Column, value: Column) -> Column:
        return F.struct(key.alias("k"), value.alias("v"))

    def rewritten(pairs: Column) -> Column:
        def last(k: Column) -> Column:
            return F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]

        kept = F.transform(_keys(pairs), lambda k: pair(k, F.when(k == "o", offset_text).otherwise(last(k))))
        added = F.filter(
            F.array(pair(F.lit("o"), offset_text), pair(F.lit("l"), F.nullif(layout, F.lit("")))),
            lambda a: a["v"].isNotNull() & ~F.exists(pairs, lambda p: p["k"] == a["k"]),
        )
        return F.concat(kept, added)

    query = F.array_join(
        F.transform(
            bind(query_pairs(base), rewritten),
            lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"])),
        ),
        "&",
    )
    fragment = F.regexp_extract(base, r"(#.+)$", 1)
    return F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), F.lit("?"), query, fragment)


def lookup_url(url: Column) -> Column:
    """The form a lookup service takes: scheme kept, ``:%2F%2F``, the rest percent-encoded but ``=``.

    NULL where the text has no ``://``.
    """
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    encoded = F.replace(F.replace(_encoded(rest), F.lit("+"), F.lit("%20")), F.lit("%3D"), F.lit("="))
    return F.when(
        F.contains(url, F.lit("://")),
        F.concat(F.substring_index(url, "://", 1), F.lit(":%2F%2F"), encoded),
    )
