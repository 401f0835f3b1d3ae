"""Landed payloads of all registered sources flattened in one plan each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfscope.operators.detail_payloads import flatten_details
from shelfscope.operators.offer_payloads import flatten_offers
from shelfscope.operators.page_window import all_pages, page_flags
from shelfscope.operators.search_listing import flatten_search_pages
from shelfscope.sources.registry import resolved


def tagged(payloads: DataFrame, registry: DataFrame, page_cap: int | None = None) -> DataFrame:
    """Payload rows of the enabled sources with the source's labels and limits.

    The registry is read from a config file, so its size is known to Spark, which decides by that
    size whether to broadcast it.
    """
    limits = resolved(registry, page_cap).select(
        "source", "category_label", "node_label", "run_label", "max_pages", "start_page"
    )
    return payloads.join(limits, "source")


def routed(payloads: DataFrame, registry: DataFrame, page_cap: int | None = None, payload: str | None = "payload") -> DataFrame:
    """All payload rows with their source's labels and ``reject_reason``, NULL for those that a run would take.

    Reasons: ``unknown_source``, ``disabled_source``, and ``unreadable_payload`` for text that is not JSON (None as
    ``payload`` skips that test). Every landed row is there once, so accepted and rejected rows add up to the landed ones.
    """
    listed = registry.select(F.col("name").alias("source"), F.coalesce("enabled", F.lit(True)).alias("_on"))
    labels = ["category_label", "node_label", "run_label", "max_pages", "start_page"]
    known = listed.join(resolved(registry, page_cap).select("source", *labels), "source", "left")
    rows = payloads.join(known, "source", "left")
    reason = F.when(F.col("_on").isNull(), "unknown_source").when(~F.col("_on"), "disabled_source")
    if payload:
        reason = reason.when(F.try_parse_json(payload).isNull(), "unreadable_payload")
    return rows.withColumn("reject_reason", reason).drop("_on")


def land(payloads: DataFrame, registry: DataFrame, path: str, page_cap: int | None = None) -> dict[str, int]:
    """Append routed payloads to ``path``, a folder per reject reason, and return how many landed, passed and failed.

    The counts are observed while the rows are written, so counting costs no second pass. ``accepted`` and
    ``quarantined`` read the two sides back, each from its own folders.
    """
    seen = Observation("landing")
    rows = routed(payloads, registry, page_cap).observe(
        seen,
        F.count("*").alias("landed"),
        F.count_if(F.col("reject_reason").isNull()).alias("accepted"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
    )
    rows.write.mode("append").partitionBy("reject_reason").parquet(path)
    return seen.get


def accepted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("reject_reason is null").drop("reject_reason")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """Rejected rows as they landed, with their reason, to be looked at or landed again."""
    return spark.read.parquet(path).where("reject_reason is not null")


def offers_of_sources(payloads: DataFrame, registry: DataFrame) -> DataFrame:
    """``payloads(source, asin, payload, extracted_at)`` as offer rows; the label includes the node."""
    return flatten_offers(
        tagged(payloads, registry), F.col("run_label"), F.col("node_label"), F.col("extracted_at")
    )


def details_of_sources(payloads: DataFrame, registry: DataFrame) -> DataFrame:
    """``payloads(source, asin, payload, extracted_at)`` as detail rows; the label is the plain one."""
    return flatten_details(
        tagged(payloads, registry), F.col("category_label"), F.col("node_label"), F.col("extracted_at")
    )


def listings_of_sources(pages: DataFrame, registry: DataFrame, page_cap: int | None = None) -> DataFrame:
    """``pages(source, source_page, payload, extracted_at)`` as listing rows within each source's limits.

    All landed pages count unless the source sets ``max_pages`` or the caller a ``page_cap``.
    """
    rows = page_flags(tagged(pages, registry, page_cap))
    kept = all_pages(rows, ["source", "extracted_at"], F.col("max_pages"), F.col("start_page"))
    return flatten_search_pages(kept, F.col("category_label"), F.col("extracted_at"))


def union_rows(*frames: DataFrame) -> DataFrame:
    """All rows of frames whose columns differ; a column a frame lacks is NULL in its rows."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
