"""Filters of the seller reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seller_key(df: DataFrame, column: str) -> Column:
    """Lower-cased seller of ``column``; a stored ``*_key`` column is used where there is one.

    ``lower(col) = literal`` is not pushed into Parquet, plain equality on the stored key is.
    """
    stored = column.removesuffix("_name") + "_key"
    return F.col(stored) if stored in df.columns else F.lower(F.col(column))


def _lowered(seller: str) -> Column:
    # Folded to a literal before the scan is planned, and lowered by the same rules as the column.
    return F.lower(F.lit(seller))


def same_seller(key: Column, seller: str) -> Column:
    return key == _lowered(seller)


def other_seller(key: Column, seller: str) -> Column:
    """Another seller; an unknown seller (NULL) is not another seller."""
    return key != _lowered(seller)


def asin_is(asin: str) -> Column:
    """Equality with the argument in upper case; the column is compared as stored."""
    return F.col("asin") == F.lit(asin.upper())


def asin_in(asins: Sequence[str] | None) -> Column | None:
    """Membership in the upper-cased list, or None where no list is given."""
    return F.col("asin").isin([a.upper() for a in asins]) if asins else None


def took_or_lost(now: Column, before: Column, seller: str) -> Column:
    """The seller gained or gave up the buy box between two rows; NULL on either side never matches."""
    return (same_seller(now, seller) & other_seller(before, seller)) | (
        other_seller(now, seller) & same_seller(before, seller)
    )


def wins_or_unheld(key: Column, seller: str) -> Column:
    """Winning, with an unheld buy box counted as winning (product diagnosis)."""
    return same_seller(key, seller) | key.isNull()


def wins(key: Column, seller: str) -> Column:
    """Winning, with an unheld buy box counted as not winning (portfolio)."""
    return F.coalesce(same_seller(key, seller), F.lit(False))


def just_lost(now: Column, before: Column, seller: str) -> Column:
    return same_seller(before, seller) & other_seller(now, seller)


def truthy_key(df: DataFrame, column: str) -> Column:
    """A usable work-list value: not NULL, and not empty text, zero or false by its type."""
    empty = {"string": F.lit(""), "boolean": F.lit(False)}.get(dict(df.dtypes)[column], F.lit(0))
    return F.col(column).isNotNull() & (F.col(column) != empty)


# Fixed value: part of the links of paid placements.
SPONSORED_LINK = "sspa/click"


def sponsored(link: Column) -> Column:
    """A paid placement; a missing link is not one."""
    return F.coalesce(F.contains(link, F.lit(SPONSORED_LINK)), F.lit(False))
