"""Offer payloads to offer rows, or to one status row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.bind import bind, once
from shelfscope.functions.variants import elements, falsy, get, members, parsed, present, text_or
from shelfscope.operators.tags import Tag, tag
from shelfscope.schemas import OFFERS, conform

MALFORMED = "malformed offer payload"

# Fields of an offer, and of the page it is on.
_OFFER_FIELDS = {
    "seller": "string",
    "price": "double",
    "currency": "string",
    "price_shipping": "double",
    "condition": "string",
    "rating_count": "bigint",
    "seller_id": "string",
    "seller_link": "string",
    "delivery": "string",
}


_OPTION = "struct<type:string,date:variant>"
_CONTENT = "struct<asin:variant,title:string,url:string,review_count:bigint,pricing:variant>"
_OFFER = "struct<" + ",".join(f"{k}:{t}" for k, t in _OFFER_FIELDS.items()) + ",delivery_options:variant>"


def _sequence(v: Column, element: str) -> Column:
    """An array's elements, each NULL where it is not an object; none for an empty object or text.

    NULL where ``v`` cannot be walked over at all. One typed read per array is much cheaper than a
    path lookup per field.
    """
    none = F.array().cast(f"array<{element}>")
    return bind(
        v,
        lambda x: F.coalesce(get(x, "$", f"array<{element}>"), F.when(F.to_json(x).isin("{}", '""'), none)),
    )


def _options(raw: Column) -> Column:
    """Delivery options; a missing list stands for one unknown option, an empty one for none."""
    unknown = F.array(F.lit(None).cast(_OPTION))
    return F.when(present(raw), _sequence(raw, _OPTION)).otherwise(unknown)


def _option(raw: Column, d: Column, index: Column) -> Column:
    """An option's parts, whether it holds anything, and whether its date is no object."""
    # An object without type and date may still hold something else; only then it is looked at again.
    other = F.cardinality(members(F.get(elements(raw), index))) > 0
    known = F.when(d["type"].isNotNull() | present(d["date"]), F.lit(True)).when(d.isNotNull(), other)
    return bind(
        get(d["date"], "$", "struct<by:string>"),
        lambda day: F.struct(
            d["type"].alias("type"),
            day["by"].alias("by"),
            known.alias("known"),
            (present(d["date"]) & day.isNull()).alias("broken"),
        ),
    )


def _stray(raw: Column, options: Column) -> Column:
    """Some option is neither an object nor empty."""
    suspect = F.exists(options, lambda d: d.isNull())
    return F.coalesce(
        suspect & F.exists(elements(raw), lambda x: members(x).isNull() & ~falsy(x)), F.lit(False)
    )


def _offer(o: Column) -> Column:
    raw = o["delivery_options"]
    return bind(
        _options(raw),
        lambda options: F.struct(
            (o.isNull() | options.isNull() | _stray(raw, options)).alias("broken"),
            *[o[name].alias(name) for name in _OFFER_FIELDS],
            F.transform(options, lambda d, j: _option(raw, d, j)).alias("options"),
        ),
    )


def _broken_offer(o: Column) -> Column:
    return o["broken"] | F.exists(o["options"], lambda d: d["broken"])


def _line(o: Column, offer_index: Column, d: Column, option_index: Column) -> Column:
    return F.struct(
        *[o[name].alias(name) for name in _OFFER_FIELDS],
        d["type"].alias("delivery_type"),
        d["by"].alias("delivery_date"),
        (offer_index + 1).alias("offer_position"),
        F.when(d["known"], option_index + 1).alias("delivery_option_position"),
        F.lit("offer").alias("pricing_status"),
        F.lit(None).cast("string").alias("error_message"),
    )


def _status_line(status: str, message: Column) -> Column:
    """The one line of a key without offers."""
    fields = {**_OFFER_FIELDS, **dict.fromkeys(("delivery_type", "delivery_date"), "string")}
    fields |= dict.fromkeys(("offer_position", "delivery_option_position"), "int")
    return F.array(
        F.struct(
            *[F.lit(None).cast(type_).alias(name) for name, type_ in fields.items()],
            F.lit(status).alias("pricing_status"),
            message.alias("error_message"),
        )
    )


def flatten_offers(
    payloads: DataFrame,
    category_label: Tag,
    node_label: Tag,
    extracted_at: Tag,
    key: str = "asin",
    payload: str = "payload",
) -> DataFrame:
    """Each key's offers times delivery options, or one ``no_offers`` or ``error`` row.

    One malformed offer turns the whole key into an error row. The status is decided on the key's own
    payload and the rows come from one generator, so every key yields at least one row without a
    join or a shuffle.
    """
    v, answer, content, lines = F.col("v"), F.col("answer"), F.col("content"), F.col("lines")
    failed = v.isNull() | (present(get(v, "$.error")) & ~present(get(v, "$.results")))
    tags = ["category_label", "node_label", "extracted_at"]
    answered = (
        payloads.select(
            F.col(key).alias("input_key"),
            tag(category_label).alias("category_label"),
            tag(node_label).alias("node_label"),
            tag(extracted_at).alias("extracted_at"),
            once(parsed(F.col(payload))).alias("v"),
        )
        .select(
            "input_key",
            *tags,
            failed.alias("failed"),
            F.when(v.isNull(), F.lit("unreadable payload")).otherwise(get(v, "$.error", "string")).alias("message"),
            get(v, "$.results[0].content").alias("answer"),
        )
        .withColumn("content", get(answer, "$", _CONTENT))  # NULL where it is no object
        .withColumn("offers", F.transform(_sequence(content["pricing"], _OFFER), _offer))
        .withColumn(
            "malformed",
            F.when(content.isNull(), ~falsy(answer)).otherwise(
                (F.col("offers").isNull() & present(content["pricing"]))
                | F.coalesce(F.exists("offers", _broken_offer), F.lit(False))
            ),
        )
        .withColumn(
            "lines",
            F.when(
                ~F.col("failed") & ~F.col("malformed"),
                F.flatten(
                    F.transform("offers", lambda o, i: F.transform(o["options"], lambda d, j: _line(o, i, d, j)))
                ),
            ),
        )
    )
    known = ~F.col("failed") & ~F.col("malformed")
    sold = F.size(lines) > 0
    asin = content["asin"]
    # Product fields are read before the rows are multiplied, so the payload itself is not copied. The
    # status travels in the line: a filter on it then stays above the generator, where it costs nothing.
    rows = answered.select(
        F.when(known & sold, get(asin, "$", "string"))
        .when(known, text_or(asin, F.col("input_key")))
        .otherwise(F.col("input_key"))
        .alias("asin"),
        F.when(known, content["title"]).alias("title"),
        F.when(known, content["url"]).alias("url"),
        F.when(known, content["review_count"]).alias("review_count"),
        *tags,
        F.explode_outer(
            F.when(F.col("failed"), _status_line("error", F.col("message")))
            .when(F.col("malformed"), _status_line("error", F.lit(MALFORMED)))
            .when(sold, lines)
            .otherwise(_status_line("no_offers", F.lit(None).cast("string")))
        ).alias("line"),
    )
    return conform(rows.select("*", "line.*"), OFFERS)
