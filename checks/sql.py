"""Shared parts of the SQL counterparts."""

from __future__ import annotations

AS_OF = "(select max(cast(ts as date)) from events)"

OFFERS = """offers as (
  select cast(user_id as varchar) asin, cast(ts as date) snapshot_date, ts extracted_at,
         event_type seller_name, value total_price,
         cast(json_extract_string(props, '$.k') as integer) stock,
         'cat' || cast(user_id % 5 as varchar) category_label, event_id offer_position
  from events)"""

GOLD = (
    OFFERS
    + """,
gold_ranked as (
  select o.*, row_number() over (partition by asin, snapshot_date order by total_price, offer_position) rn
  from offers o),
gold_stats as (
  select asin, snapshot_date, count(distinct seller_name) seller_id_count, min(total_price) min_total_price
  from offers group by asin, snapshot_date),
gold as (
  select r.snapshot_date, r.asin, r.category_label, r.total_price pdp_total_price,
         r.seller_name buybox_seller_name, r.seller_name = 'view' buybox_is_amazon,
         r.stock buybox_stock, s.seller_id_count, s.min_total_price
  from gold_ranked r join gold_stats s on r.asin = s.asin and r.snapshot_date = s.snapshot_date
  where r.rn = 1)"""
)

PART_AS_OF = "(select make_date(cast(year(max(l_shipdate)) as integer), 1, 1) from lineitem)"

PART_OFFERS = """offers as (
  select cast(l_partkey as varchar) asin, make_date(cast(year(l_shipdate) as integer), 1, 1) snapshot_date,
         make_date(cast(year(l_shipdate) as integer), 1, 1) extracted_at, s_name seller_name, l_suppkey seller_id, l_extendedprice total_price,
         l_quantity stock, p_type category_label
  from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey)"""

PART_GOLD = (
    PART_OFFERS
    + """,
gold_ranked as (
  select o.*, row_number() over (partition by asin, snapshot_date order by total_price, seller_name, stock) rn
  from offers o),
gold_stats as (
  select asin, snapshot_date, count(distinct seller_id) seller_id_count, min(total_price) min_total_price
  from offers group by asin, snapshot_date),
gold as (
  select r.snapshot_date, r.asin, r.category_label, r.total_price pdp_total_price,
         r.seller_name buybox_seller_name, r.seller_name like 'Supplier#00000000%' buybox_is_amazon,
         r.stock buybox_stock, s.seller_id_count, s.min_total_price
  from gold_ranked r join gold_stats s on r.asin = s.asin and r.snapshot_date = s.snapshot_date
  where r.rn = 1)"""
)


def since(days: int, as_of: str = AS_OF) -> str:
    return f"snapshot_date >= {as_of} - {days}"
