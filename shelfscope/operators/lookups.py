"""Lookup answers wrapped with their input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.urls import lookup_url
from shelfscope.functions.variants import get, parsed
from shelfscope.operators.tags import Tag, tag

NOT_A_URL = '{"error":"input is not a URL","status_code":null}'


def request_urls(worklist: DataFrame, endpoint: str, column: str = "value") -> DataFrame:
    """Each input with the request URL the lookup service takes; NULL for an input that is no URL."""
    return worklist.withColumn(
        "request_url", F.concat(F.lit(f"{endpoint}?url="), lookup_url(F.col(column)))
    )


def wrap_lookups(
    answers: DataFrame, category_label: Tag, extracted_at: Tag, column: str = "value", payload: str = "payload"
) -> DataFrame:
    """``(input_value, category_label, extracted_at, payload)``; the payload stays a VARIANT.

    An input that is no URL could not be asked and gets an error payload.
    """
    text = F.when(F.contains(F.col(column), F.lit("://")), F.col(payload)).otherwise(F.lit(NOT_A_URL))
    return answers.select(
        F.col(column).alias("input_value"),
        tag(category_label).alias("category_label"),
        tag(extracted_at).alias("extracted_at"),
        parsed(text).alias("payload"),
    )


def lookup_status(lookups: DataFrame) -> DataFrame:
    """The lookup rows with the payload's error and status code as columns."""
    return lookups.withColumns(
        {
            "error": get(F.col("payload"), "$.error", "string"),
            "status_code": get(F.col("payload"), "$.status_code", "bigint"),
        }
    )
