"""Reading schemaless payloads held as VARIANT.

A path that is missing gives SQL NULL, a JSON ``null`` gives a non-NULL variant; the tests below
keep the two apart, which a typed ``from_json`` cannot.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscope.functions.bind import bind


def parsed(text: Column) -> Column:
    """JSON text as VARIANT, NULL where it is not JSON."""
    return F.try_parse_json(text)


def get(v: Column, path: str, type_: str = "variant") -> Column:
    return F.try_variant_get(v, path, type_)


def present(v: Column) -> Column:
    """The path exists, whatever its value."""
    return v.isNotNull()


def elements(v: Column) -> Column:
    """The elements of a JSON array, NULL for anything else."""
    return get(v, "$", "array<variant>")


def members(v: Column) -> Column:
    """The members of a JSON object, NULL for anything else."""
    return get(v, "$", "map<string,variant>")


# JSON spellings that count as "nothing there".
EMPTY_JSON = r'^(null|false|""|\[\]|\{\}|-?0(\.0*)?([eE][+-]?[0-9]+)?)$'


def falsy(v: Column) -> Column:
    """Missing, null, false, zero, empty text, empty array or empty object.

    Objects are told by their members; only other values are printed to be compared.
    """

    def empty(x: Column) -> Column:
        return F.when(x.isNull() | F.is_variant_null(x), F.lit(True)).otherwise(
            F.coalesce(F.size(F.map_keys(members(x))) == 0, F.to_json(x).rlike(EMPTY_JSON))
        )

    return bind(v, empty)


def first_truthy(*candidates: Column) -> Column:
    """The first candidate variant that is not falsy."""
    return F.coalesce(*[bind(c, lambda v: F.when(~falsy(v), v)) for c in candidates])


def text_or(v: Column, fallback: Column) -> Column:
    """Text of ``v`` unless it is falsy."""
    return F.coalesce(bind(v, lambda x: F.when(~falsy(x), get(x, "$", "string"))), fallback)


def _parsed_text(v: Column) -> Column:
    # A variant string prints as quoted JSON; anything else is no text.
    text = F.when(
        F.to_json(v).startswith('"'), F.btrim(get(v, "$", "string"), F.lit(" \t\r\n\f\x0b"))
    )
    return bind(text, lambda t: F.when(t.rlike(r"(?s)^[\[{].*[\]}]$"), F.try_parse_json(t)))


def jsonish(v: Column) -> Column:
    """A JSON document that arrived as text is parsed; everything else passes unchanged."""
    return bind(v, lambda x: F.coalesce(_parsed_text(x), x))


def joined_lines(v: Column) -> Column:
    """An array's non-empty texts, one per line; a scalar as its text."""

    def lines(items: Column) -> Column:
        kept = F.filter(items, lambda x: ~falsy(x))
        return F.array_join(F.transform(kept, lambda x: get(x, "$", "string")), "\n")

    return bind(
        v,
        lambda x: F.coalesce(bind(elements(x), lambda items: F.when(items.isNotNull(), lines(items))), get(x, "$", "string")),
    )


def first_item(v: Column) -> Column:
    """Text of the first non-empty element of an array."""
    return get(F.get(F.filter(elements(v), lambda x: ~falsy(x)), F.lit(0)), "$", "string")


def first_selected(v: Column) -> Column:
    """The first array element whose ``selected`` is set."""
    return F.get(F.filter(elements(v), lambda x: ~falsy(get(x, "$.selected"))), F.lit(0))
