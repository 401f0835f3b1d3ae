"""Market questions over the event market."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import payloads as L
from checks.adapters import event_market
from checks.sql import AS_OF, GOLD, OFFERS, since
from shelfscope.operators.detail_payloads import flatten_details
from shelfscope.plans import market as M
from shelfscope.plans.gold import daily_snapshot
from shelfscope.plans.silver import flat_offers

SELLER = "Purchase"
ME = "lower('Purchase')"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def doc1(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir, 30)
    out = M.price_dispersion(m.offers, m.as_of)
    return rounded(out, "avg_price", "stddev_price", "p25_price", "median_price", "p75_price")


def doc2(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir, 14)
    return rounded(M.competitor_moves(m.offers, SELLER, m.as_of), "price_change")


def doc2_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events landed as offer rows; their stock is stated by the snapshots only."""
    m = event_market(spark, sf_dir, 14)
    landed = m.offers.select(
        "asin", "seller_id", "offer_position", "category_label",
        F.date_format("extracted_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("extracted_at"),
        F.col("seller_name").alias("seller"), F.col("total_price").alias("price"),
        F.lit(None).cast("double").alias("price_shipping"), F.lit("new").alias("condition"),
        F.lit(None).cast("string").alias("node_label"), F.lit("offer").alias("pricing_status"),
    )
    moves = M.competitor_moves(flat_offers(landed), SELLER, m.as_of, gold=m.gold)
    return moves.withColumns({c: F.col(c).cast("double") for c in ("price", "prev_price", "price_change")})


def doc3(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir, 2)
    return M.assortment_gaps(m.gold, m.offers, SELLER, m.as_of, 2)


def doc3_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's own 30 days; a product is a user and a stock figure, else every one is offered within them."""
    m = event_market(spark, sf_dir, 30)
    offers = m.offers.withColumn("asin", F.concat("asin", F.lit("-"), F.col("stock").cast("string")))
    gold = daily_snapshot(offers, rank_by=("total_price", "offer_position"), house="view")
    return M.assortment_gaps(gold, offers, SELLER, m.as_of)


def doc4(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir, 14)
    return rounded(M.undercutting(m.offers, SELLER, m.as_of), "undercut_by")


def doc5(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir, 14)
    return rounded(M.category_price_drops(m.gold, m.as_of), "avg_price", "prev_avg_price", "drop_pct")


def doc6_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir, 14)
    return M.low_stock(m.gold, SELLER, 20, m.as_of, 14)


def doc6_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir, 14)
    return M.lost_out_of_stock(m.gold, m.offers, SELLER, 20, m.as_of)


def doc6_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers as the silver table has them, without stock."""
    m = event_market(spark, sf_dir, 14)
    return M.lost_out_of_stock(m.gold, m.offers.drop("stock"), SELLER, 20, m.as_of)


def doc7(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir)
    return M.new_sellers(m.offers, SELLER, m.as_of, 25)


def doc8(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir, 14)
    return rounded(M.main_competitors(m.gold, SELLER, as_of=m.as_of), "avg_price")


def doc9(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir, 14)
    return rounded(M.rivals_and_shadows(m.gold, SELLER, m.as_of), "avg_winning_price")


def doc10(spark: SparkSession, sf_dir: str, limit: int | None = 3) -> DataFrame:
    m = event_market(spark, sf_dir, 14)
    placed = L.search_pages(spark, sf_dir).select(
        (F.col("source_page") % 150).cast("string").alias("asin"), (F.col("source_page") % 97).alias("position")
    )
    return M.top_risks(m.gold, placed, SELLER, m.as_of, 14, limit=limit)


def doc10_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc10(spark, sf_dir, None)


def doc11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.lit("cat"), (F.col("p_partkey") % 5).cast("string"))
    details = flatten_details(L.detail_payloads(spark, sf_dir), label, None, "2024-01-31")
    return rounded(M.review_summary(details), "avg_rating", "weighted_rating")


QUERIES = {
    "doc1_price_dispersion": doc1,
    "doc2_competitor_moves": doc2,
    "doc2_moves_of_flat_offers": doc2_flat,
    "doc3_assortment_gaps": doc3,
    "doc3_gaps_of_a_month": doc3_month,
    "doc4_undercutting": doc4,
    "doc5_category_price_drops": doc5,
    "doc6_low_stock": doc6_low,
    "doc6_lost_out_of_stock": doc6_lost,
    "doc6_lost_after_low_stock": doc6_held,
    "doc7_new_sellers": doc7,
    "doc8_main_competitors": doc8,
    "doc9_rivals_and_shadows": doc9,
    "doc10_top_risks": doc10,
    "doc10_top_risks_all": doc10_all,
    "doc11_review_summary": doc11,
}

_DAILY = """daily as (select asin, lower(seller_name) seller_key, snapshot_date, min(total_price) price,
    arg_min(stock, {'p': total_price, 's': stock}) stock from offers where """ + since(14) + """ group by 1, 2, 3)"""

_FINE_ASIN = "cast(user_id as varchar) || '-' || json_extract_string(props, '$.k') asin"

_LOSSES = f"""w as (select *, lag(buybox_seller_name) over (partition by asin order by snapshot_date) prev_day_buybox_seller
    from gold where {since(14)}),
losses as (select snapshot_date, asin, buybox_seller_name, pdp_total_price, prev_day_buybox_seller from w
  where lower(buybox_seller_name) <> {ME} and lower(prev_day_buybox_seller) = {ME})"""

SQL = {
    "doc1_price_dispersion": f"""with {OFFERS}
select category_label, snapshot_date, count(*) offers, min(total_price) min_price, max(total_price) max_price,
  round(avg(total_price), 6) avg_price, round(stddev_samp(total_price), 6) stddev_price,
  round(quantile_cont(total_price, 0.25), 6) p25_price, round(quantile_cont(total_price, 0.5), 6) median_price,
  round(quantile_cont(total_price, 0.75), 6) p75_price
from offers where {since(30)} group by 1, 2""",
    "doc2_competitor_moves": f"""with {OFFERS}, {_DAILY},
l as (select *, lag(price) over p prev_price, lag(stock) over p prev_stock from daily where seller_key <> {ME}
  window p as (partition by asin, seller_key order by snapshot_date))
select *, round(price - prev_price, 6) price_change, stock - prev_stock stock_change from l
where price <> prev_price or stock <> prev_stock""",
    "doc2_moves_of_flat_offers": f"""with {GOLD},
p as (select asin, lower(seller_name) seller_key, snapshot_date, min(cast(total_price as decimal(12, 2))) price
  from offers where {since(14)} and lower(seller_name) <> {ME} group by 1, 2, 3),
s as (select asin, lower(buybox_seller_name) seller_key, snapshot_date, buybox_stock stock from gold where {since(14)}),
l as (select p.*, stock, last_value(price ignore nulls) over w prev_price, last_value(stock ignore nulls) over w prev_stock
  from p left join s using (asin, seller_key, snapshot_date)
  window w as (partition by asin, seller_key order by snapshot_date rows between unbounded preceding and 1 preceding))
select asin, seller_key, snapshot_date, cast(price as double) price, stock, cast(prev_price as double) prev_price, prev_stock,
  cast(price - prev_price as double) price_change, stock - prev_stock stock_change
from l where price <> prev_price or stock <> prev_stock""",
    "doc3_assortment_gaps": f"""with {GOLD},
mine as (select * from offers where {since(2)} and lower(seller_name) = {ME})
select category_label, asin, max(snapshot_date) last_seen, min(min_total_price) lowest_price from gold
where {since(2)} and category_label in (select category_label from mine) and asin not in (select asin from mine)
group by 1, 2""",
    "doc3_gaps_of_a_month": f"""with {GOLD.replace("cast(user_id as varchar) asin", _FINE_ASIN)},
mine as (select * from offers where {since(30)} and lower(seller_name) = {ME})
select category_label, asin, max(snapshot_date) last_seen, min(min_total_price) lowest_price from gold
where {since(30)} and category_label in (select category_label from mine) and asin not in (select asin from mine)
group by 1, 2""",
    "doc4_undercutting": f"""with {OFFERS}, {_DAILY}
select r.asin, r.snapshot_date, r.seller_key, r.price, m.price my_price, round(m.price - r.price, 6) undercut_by
from daily r join daily m on r.asin = m.asin and r.snapshot_date = m.snapshot_date and m.seller_key = {ME}
where r.seller_key <> {ME} and r.price < m.price""",
    "doc5_category_price_drops": f"""with {GOLD},
d as (select category_label, snapshot_date, avg(pdp_total_price) a, count(*) products from gold where {since(14)} group by 1, 2),
l as (select *, lag(a) over (partition by category_label order by snapshot_date) p from d)
select category_label, snapshot_date, round(a, 6) avg_price, products, round(p, 6) prev_avg_price,
  round((p - a) / p * 100, 6) drop_pct from l where a < p""",
    "doc6_low_stock": f"""with {GOLD} select snapshot_date, asin, buybox_seller_name, buybox_stock from gold
where {since(14)} and lower(buybox_seller_name) = {ME} and buybox_stock <= 20""",
    "doc6_lost_after_low_stock": f"""with {GOLD}, {_LOSSES},
s as (select l.asin, l.snapshot_date, arg_max(try_cast(g.buybox_stock as integer), g.snapshot_date) my_stock
  from losses l join gold g on g.asin = l.asin and g.snapshot_date < l.snapshot_date
  where g.{since(14)} and lower(g.buybox_seller_name) = {ME} and g.buybox_stock is not null group by all)
select l.*, my_stock from losses l join s on l.asin = s.asin and l.snapshot_date = s.snapshot_date where my_stock <= 20""",
    "doc6_lost_out_of_stock": f"""with {GOLD}, {_LOSSES},
s as (select asin, snapshot_date, max(stock) my_stock from offers where {since(14)} and lower(seller_name) = {ME} group by 1, 2)
select l.*, my_stock from losses l left join s on l.asin = s.asin and l.snapshot_date = s.snapshot_date
where coalesce(my_stock, 0) <= 20""",
    "doc7_new_sellers": f"""with {OFFERS},
f as (select asin, lower(seller_name) seller_key, min(snapshot_date) first_seen from offers group by 1, 2)
select * from f where seller_key <> {ME} and first_seen >= {AS_OF} - 25
and asin in (select asin from offers where lower(seller_name) = {ME})""",
    "doc8_main_competitors": f"""with {GOLD},
h as (select asin, buybox_seller_name competitor, count(*) days_won, avg(pdp_total_price) a from gold
  where {since(14)} and lower(buybox_seller_name) <> {ME} group by 1, 2),
r as (select *, row_number() over (partition by asin order by days_won desc, competitor) rn from h)
select asin, competitor, days_won, round(a, 6) avg_price from r where rn = 1""",
    "doc9_rivals_and_shadows": f"""with {GOLD},
now as (select buybox_seller_name s, count(distinct asin) n from gold
  where snapshot_date = (select max(snapshot_date) from gold) and lower(buybox_seller_name) <> {ME} group by 1),
past as (select buybox_seller_name s, count(*) d, avg(pdp_total_price) a from gold
  where {since(14)} and lower(buybox_seller_name) <> {ME} group by 1)
select p.s competitor, case when n.s is null then 'shadow' else 'active' end "role", d days_won_buybox,
  coalesce(n, 0) products_won_today, round(a, 6) avg_winning_price from past p left join now n on p.s = n.s""",
    "doc10_top_risks": f"""with {GOLD}, {_LOSSES},
placed as (select cast(c_custkey % 150 as varchar) asin, min(cast(c_custkey % 97 as integer)) "position" from customer
  where c_custkey % 97 < 50 group by 1)
select l.*, "position" from losses l join placed p on l.asin = p.asin order by "position", snapshot_date desc, l.asin limit 3""",
    "doc11_review_summary": """with d as (select 'cat' || (p_partkey % 5) category_label, p_size / 10.0 rating,
    case when p_partkey % 8 = 2 then 7 when p_size <> 0 then p_size end reviews from part where p_partkey % 8 >= 2)
select category_label, count(*) products, round(avg(rating), 6) avg_rating, cast(sum(reviews) as bigint) review_count,
  round(sum(rating * reviews) / sum(reviews), 6) weighted_rating from d group by 1""",
}
SQL["doc10_top_risks_all"] = SQL["doc10_top_risks"].rsplit(" limit ", 1)[0]
