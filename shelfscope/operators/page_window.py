"""Which landed search pages belong to a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions.bind import once
from shelfscope.functions.variants import falsy, get, parsed, present

# The crawler's own limit of pages per source and run, for callers that pass it.
PAGE_CAP = 100
# Page numbers per block when pages are counted without a limit.
BLOCK = 1000


def page_budget(max_pages: Column, cap: int | None = None) -> Column:
    """Unset, zero, negative or too large budgets mean the cap; without a cap any positive budget counts, else NULL."""
    if cap is None:
        return F.when(max_pages >= 1, max_pages)
    return F.when(max_pages.between(1, cap), max_pages).otherwise(F.lit(cap))


def first_page(start_page: Column) -> Column:
    return F.greatest(F.coalesce(start_page.try_cast("int"), F.lit(1)), F.lit(1))


def page_flags(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds ``failed`` (an error was reported) and ``has_next``."""
    v = F.col("_v")
    return (
        pages.select("*", once(parsed(F.col(payload))).alias("_v"))
        .withColumns(
            {
                "failed": v.isNull() | ~falsy(get(v, "$.error")),
                "has_next": present(get(v, "$.serpapi_pagination.next")),
            }
        )
        .drop("_v")
    )


def all_pages(
    pages: DataFrame,
    keys: Sequence[str],
    max_pages: Column | int | None = None,
    start_page: Column | int | None = 1,
) -> DataFrame:
    """The pages a run would keep, with ``page_number`` counting the good ones; no budget, zero or less means all pages.

    ``pages`` holds ``source_page``, ``failed`` and ``has_next``. Failed pages use up the budget but are left out; reading
    ends after the first good page without a next page.

    Pages are counted per block of BLOCK page numbers by an aggregate, which also finds each source's first good page
    without a next one. Places within a source are those of its blocks before plus the place within the block, so a
    window holds the pages of one block or the blocks of one source, and no source reaches a task whole.
    """
    budget = page_budget(max_pages if isinstance(max_pages, Column) else F.lit(max_pages).cast("int"), None)
    start = start_page if isinstance(start_page, Column) else F.lit(start_page).cast("int")
    good = ~F.col("failed")
    rows = pages.where(F.col("source_page") >= first_page(start)).withColumn(
        "_block", F.floor(F.col("source_page") / BLOCK)
    )
    joined = [*keys, "_block"]
    counts = rows.groupBy(*[F.col(k).alias(f"_of_{k}") for k in joined]).agg(
        F.count("*").alias("_n"),
        F.count_if(good).alias("_good"),
        F.min(F.when(good & ~F.col("has_next"), F.col("source_page"))).alias("_end"),
    )
    source = Window.partitionBy(*[f"_of_{k}" for k in keys])
    before = source.orderBy("_of__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.withColumns(
        {
            "_n": F.coalesce(F.sum("_n").over(before), F.lit(0)),
            "_good": F.coalesce(F.sum("_good").over(before), F.lit(0)),
            "_end": F.min("_end").over(source),
        }
    )
    in_block = Window.partitionBy(*joined).orderBy("source_page").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(blocks, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in joined])
        .where(F.col("_end").isNull() | (F.col("source_page") <= F.col("_end")))
        .withColumns(
            {
                "_attempt": F.col("_n") + F.count("*").over(in_block),
                "page_number": (F.col("_good") + F.count_if(good).over(in_block)).cast("int"),
            }
        )
        .where(good & (budget.isNull() | (F.col("_attempt") <= budget)))
        .drop("_block", "_n", "_good", "_end", "_attempt", *[f"_of_{k}" for k in joined])
    )


def select_pages(
    pages: DataFrame,
    keys: Sequence[str],
    max_pages: Column | int | None = None,
    start_page: Column | int | None = 1,
    cap: int | None = None,
) -> DataFrame:
    """The pages a run would keep, with ``page_number`` counting the good ones: ``all_pages`` with the budget under ``cap``.

    ``PAGE_CAP`` as the cap gives the crawler's own behaviour; without a cap every budget is kept to.
    """
    budget = max_pages if isinstance(max_pages, Column) else F.lit(max_pages).cast("int")
    return all_pages(pages, keys, page_budget(budget, cap), start_page)
