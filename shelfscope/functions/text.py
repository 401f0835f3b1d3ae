"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscope.functions.bind import bind

WHITESPACE = " \t\r\n\f\x0b\x1c\x1d\x1e\x1f\x85\xa0"

# Named character references met in shop pages (the ampersand is handled last).
NAMED_ENTITIES = {
    "&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">", "&nbsp;": "\xa0",
    "&auml;": "ä", "&ouml;": "ö", "&uuml;": "ü", "&Auml;": "Ä", "&Ouml;": "Ö", "&Uuml;": "Ü",
    "&szlig;": "ß", "&eacute;": "é", "&egrave;": "è", "&agrave;": "à", "&euro;": "€", "&deg;": "°",
    "&reg;": "®", "&copy;": "©", "&trade;": "™", "&ndash;": "–", "&mdash;": "—", "&hellip;": "…",
}


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def unescaped_slashes(c: Column) -> Column:
    return F.replace(c, F.lit("\\/"), F.lit("/"))


def _named_references(text: Column) -> Column:
    # One literal array, folded into the plan as a constant.
    pairs = ", ".join(
        f"""struct('{name}' as name, '{char.replace("'", chr(92) + "'")}' as char)"""
        for name, char in NAMED_ENTITIES.items()
    )
    return F.aggregate(F.expr(f"array({pairs})"), text, lambda acc, e: F.replace(acc, e["name"], e["char"]))


def _numeric_references(text: Column) -> Column:
    codes = F.array_distinct(F.regexp_extract_all(text, F.lit("&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"), 1))

    def replaced(acc: Column, code: Column) -> Column:
        number = F.when(code.rlike("^[xX]"), F.conv(F.substr(code, F.lit(2)), 16, 10)).otherwise(code)
        char = F.decode(F.unhex(F.lpad(F.hex(number.cast("bigint")), 8, "0")), "UTF-32")
        return F.replace(acc, F.concat(F.lit("&#"), code, F.lit(";")), char)

    return F.aggregate(codes, text, replaced)


def _decoded(text: Column) -> Column:
    numbered = bind(_named_references(text), _numeric_references)
    return F.replace(numbered, F.lit("&amp;"), F.lit("&"))


def decoded_entities(c: Column) -> Column:
    """Character references replaced by their characters; text without ``&`` is left alone at once."""
    return bind(c, lambda x: F.when(F.contains(x, F.lit("&")), _decoded(x)).otherwise(x))


def slug_title(url: Column) -> Column:
    """Last path part as words: trailing slashes dropped, ``-`` and ``_`` become spaces."""
    last = F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)
    return F.translate(last, "-_", "  ")


def label_with_node(label: Column, node: Column) -> Column:
    """``label-node``, or the label alone where no node is set."""
    return F.concat_ws("-", label, F.nullif(node, F.lit("")))


def money(c: Column) -> Column:
    return F.format_string("€%.2f", c.cast("double"))


def percent(c: Column) -> Column:
    return F.format_string("%.1f%%", c.cast("double"))


def whole_number(c: Column) -> Column:
    """Text of digits only as a number, NULL for any other text."""
    return F.when(c.rlike(r"^[0-9]+$"), c.try_cast("int"))


def page_number_or_next(text: Column, current: Column) -> Column:
    return F.coalesce(stripped(text).try_cast("int"), current + 1)


def report_cell(c: Column, type_name: str) -> Column:
    """A value as the text reports print it: ``None``, ``True``, ``12.5``, ``10000000.0``, ``0.0005``, ``1e-05``, ``1e+16``."""
    text = c.cast("string")
    if type_name == "boolean":
        text = F.initcap(text)
    elif type_name in ("double", "float"):
        plain = F.rtrim(c.cast("decimal(38,15)").cast("string"), F.lit("0"))
        plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
        size = F.abs(c)
        sign = F.when(text.startswith("-"), "-").otherwise("")
        digits = F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)", 1), r"\.0$", "")
        power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
        small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), F.replace(digits, F.lit("."), F.lit("")))
        exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.when(F.abs(power) < 10, "0").otherwise(""), F.abs(power))
        text = (
            F.when(F.isnan(c), "nan")
            .when(size == float("inf"), F.concat(sign, F.lit("inf")))
            .when((size >= 1e7) & (size < 1e16), plain)
            .when((size < 1e-3) & (size >= 1e-4), small)
            .when((size >= 1e16) | ((size < 1e-4) & (size > 0)), F.concat(sign, digits, F.lit("e"), exponent))
            .otherwise(text)
        )
    return F.coalesce(text, F.lit("None"))
