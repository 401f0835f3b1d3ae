"""Table contracts, and conforming a DataFrame to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, MapType, StringType, StructField,
    StructType, TimestampType, VariantType,
)

_TYPES = {
    "INT": IntegerType(), "BIGINT": LongType(), "DOUBLE": DoubleType(), "STRING": StringType(),
    "BOOLEAN": BooleanType(), "DATE": DateType(), "TIMESTAMP": TimestampType(), "VARIANT": VariantType(),
    "MONEY": DecimalType(12, 2), "PARAMETERS": MapType(StringType(), StringType()),
    "ANSWER": StructType([StructField("error", StringType()), StructField("status_code", LongType())]),
}


def _table(columns: str) -> StructType:
    """A schema from ``name TYPE`` pairs; unlike a DDL string it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])

# Marketplace-1 search results, one row per listed product. page_number counts the pages a run kept,
# source_page is the site's own number.
SEARCH_LISTING = _table(
    "page_number INT, category_label STRING, node STRING, position INT, asin STRING, title STRING,"
    " link STRING, rating DOUBLE, reviews BIGINT, bought_last_month STRING, price_raw STRING,"
    " currency STRING, extracted_price DOUBLE, delivery STRING, is_sponsored BOOLEAN, extracted_at STRING,"
    " source_page INT"
)

# Marketplace-1 offers, one row per offer and delivery option, or one status row per key.
OFFERS = _table(
    "asin STRING, title STRING, url STRING, review_count BIGINT, seller STRING, price DOUBLE,"
    " currency STRING, price_shipping DOUBLE, condition STRING, rating_count BIGINT, seller_id STRING,"
    " seller_link STRING, delivery STRING, delivery_type STRING, delivery_date STRING,"
    " offer_position INT, delivery_option_position INT, category_label STRING, node_label STRING,"
    " extracted_at STRING, pricing_status STRING, error_message STRING"
)

# Marketplace-1 product details; nested parts are VARIANT in memory and JSON text on disk.
DETAILS = _table(
    "asin STRING, category_label STRING, extracted_at STRING, node STRING, title STRING, brand STRING,"
    " url STRING, page_type STRING, stock STRING, price DOUBLE, price_upper DOUBLE,"
    " price_initial DOUBLE, price_shipping DOUBLE, price_buybox DOUBLE, price_sns DOUBLE,"
    " currency STRING, rating DOUBLE, review_count BIGINT, sales_volume STRING, parent_asin STRING,"
    " product_name STRING, description VARIANT, coupon STRING, store_url STRING, pricing_url STRING,"
    " pricing_str STRING, manufacturer STRING, category VARIANT, is_prime_eligible BOOLEAN,"
    " has_videos BOOLEAN, images VARIANT, main_image STRING, bullet_points STRING,"
    " variation_selected_asin STRING, variation_selected_dimensions VARIANT, variation_all VARIANT,"
    " sales_rank VARIANT, delivery VARIANT, buybox VARIANT, rating_stars_distribution VARIANT,"
    " product_details VARIANT, product_overview VARIANT, technical_details VARIANT,"
    " other_sellers VARIANT, sns_discounts VARIANT, answered_questions_count BIGINT,"
    " item_status STRING, error_message STRING, status_code BIGINT, payload_raw STRING"
)

# Marketplace-2 category listing.
LINK_LISTING = _table(
    "title STRING, price_raw STRING, link STRING, page_number INT, extracted_at STRING, category_label STRING"
)

# Marketplace-2 lookup answers.
LOOKUP = _table(
    "input_value STRING, category_label STRING, extracted_at STRING,"
    " payload ANSWER"
)

SILVER_OFFERS = _table(
    "asin STRING, extracted_at TIMESTAMP, snapshot_date DATE, seller_name STRING, seller_key STRING,"
    " seller_id STRING, condition STRING, offer_position INT, total_price MONEY,"
    " category_label STRING, node STRING"
)

# What product details state of each seller.
SELLER_STOCK = _table(
    "asin STRING, snapshot_date DATE, seller_name STRING, seller_key STRING, total_price MONEY, stock INT"
)

SILVER_LISTING = _table(
    "asin STRING, category_label STRING, node STRING, title STRING, link STRING, position INT,"
    " page_number INT, rating DOUBLE, reviews BIGINT, extracted_price DOUBLE, last_seen_at TIMESTAMP,"
    " is_active BOOLEAN"
)

GOLD_SNAPSHOT = _table(
    "snapshot_date DATE, asin STRING, category_label STRING, pdp_total_price MONEY,"
    " buybox_seller_name STRING, buybox_seller_key STRING, buybox_is_amazon BOOLEAN,"
    " buybox_stock STRING, seller_id_count BIGINT, min_total_price MONEY"
)

REGISTRY = _table(
    "name STRING, type STRING, enabled BOOLEAN, parameters PARAMETERS"
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; a column ``df`` lacks becomes NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def variants_to_json(df: DataFrame) -> DataFrame:
    """VARIANT columns as JSON text: they can be neither shuffle keys nor written to JSON files."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, VariantType)]
    return df.withColumns({name: F.to_json(F.col(name)) for name in nested})
