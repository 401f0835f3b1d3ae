"""Flatteners, crawls, sources and sinks over payloads derived from the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import payloads as L
from checks.adapters import table
from shelfscope.functions.html import anchors, visible
from shelfscope.operators.dedupe import first_seen
from shelfscope.operators.detail_payloads import flatten_details
from shelfscope.operators.links import list_links, page_links, until_first_failure
from shelfscope.operators.lookups import lookup_status, request_urls, wrap_lookups
from shelfscope.operators.offer_payloads import flatten_offers
from shelfscope.operators.page_window import PAGE_CAP, all_pages, select_pages
from shelfscope.operators.pagination import detect_pagination, page_plan
from shelfscope.operators.product_page import product_pages
from shelfscope.operators.search_listing import flatten_search_pages
from shelfscope.operators.worklist import attach_payloads, column_scan, status_counts, usable_lines
from shelfscope.plans.gold import daily_snapshot
from shelfscope.plans.ingest import listings_of_sources, offers_of_sources, union_rows
from shelfscope.plans.silver import current_listing, flat_offers
from shelfscope.schemas import OFFERS, variants_to_json
from shelfscope.session import shared_folder
from shelfscope.sources.jsonl import json_lines, read_jsonl, write_runs
from shelfscope.sources.registry import resolved
from shelfscope.sources.tables import active
from shelfscope.streaming.bronze_stream import deduplicated, load_available, load_new

RUN_AT = "2024-01-31T07:00:00.000000+00:00"
SHOP = "https://shop.example.com/list/"


def ing1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = L.search_pages(spark, sf_dir).withColumn("page_number", F.col("source_page"))
    return flatten_search_pages(pages, "cat", RUN_AT)


def ing2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_offers(L.offer_payloads(spark, sf_dir), "cat-n1", "n1", RUN_AT)


def ing3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = variants_to_json(flatten_details(L.detail_payloads(spark, sf_dir), "parts", "n1", RUN_AT))
    return rows.select(
        "asin", "category_label", "node", "extracted_at", "title", "brand", "stock", "price", "price_buybox",
        "price_shipping", "currency", "rating", "review_count", "description", "category", "is_prime_eligible",
        "has_videos", "images", "main_image", "bullet_points", "variation_selected_asin",
        "variation_selected_dimensions", "variation_all", "buybox", "sales_rank", "item_status", "error_message",
        "status_code",
    )


def ing4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").selectExpr("cast(page_id + 1 as int) as page_number", "html")
    return list_links(pages, SHOP, "cat", RUN_AT, prefix="/")


def ing4_crawls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").selectExpr(
        "cast(page_id % 6 as int) as crawl",
        "cast(page_id div 6 + 1 as int) as page_number",
        "html",
        "case when page_id % 29 = 28 then 'HTTP 503' end as fetch_error",
    )
    kept = until_first_failure(pages, ["crawl"])
    links = page_links(kept, SHOP, ["crawl"], "/")
    return first_seen(links, ["crawl", "link"], [F.col("page_number"), F.col("position")]).drop("position")


def gen9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "pages")
        .select("page_id", F.posexplode_outer(anchors(visible(F.col("html")), "/")).alias("position", "a"))
        .where("a is not null")
        .select("page_id", "position", "a.href", "a.title")
    )


def ing5(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = table(spark, sf_dir, "pages").selectExpr(
        "if(page_id % 9 = 8, replace(url, '://', ':'), url) as value",
        """if(page_id % 2 = 0, '{"error":"406 Not Acceptable","status_code":406}',
              '{"error":"Read timed out.","status_code":null}') as payload""",
    )
    rows = lookup_status(wrap_lookups(answers, "cat", RUN_AT)).drop("payload")
    return request_urls(rows, "https://lookup.example.com/product", "input_value")


def ing6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_pages(L.product_pages_table(spark, sf_dir))


def ing6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_pages(table(spark, sf_dir, "pages").select("url", "html"))


def ing7(spark: SparkSession, sf_dir: str) -> DataFrame:
    detected = detect_pagination(L.category_pages(spark, sf_dir))
    return page_plan(detected).drop("html", "url")


def ing8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = L.search_pages(spark, sf_dir).drop("payload")
    return select_pages(pages, ["source"], 40, 3).select("source", "source_page", "page_number")


def ing8_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of three large sources, up to the first good one without a next page."""
    pages = L.search_pages(spark, sf_dir).drop("payload").withColumns(
        {"source": F.concat(F.lit("S"), F.col("source_page") % 3), "has_next": F.col("source_page") % 5003 != 1304}
    )
    return all_pages(pages, ["source"]).select("source", "source_page", "page_number")


def ing9_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = L.offer_payloads(spark, sf_dir).withColumn("extracted_at", F.lit(RUN_AT))
    rows = offers_of_sources(payloads, L.registry(spark, sf_dir))
    return status_counts(rows, "pricing_status", "category_label", "node_label")


def ing9_listings(spark: SparkSession, sf_dir: str, page_cap: int | None = PAGE_CAP) -> DataFrame:
    pages = L.search_pages(spark, sf_dir).drop("failed", "has_next").withColumn("extracted_at", F.lit(RUN_AT))
    rows = listings_of_sources(pages, L.registry(spark, sf_dir), page_cap)
    return rows.select("category_label", "node", "page_number", "position", "asin", "is_sponsored")


def ing9_all_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ing9_listings(spark, sf_dir, None)


def _offer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ssXXX")
    payloads = L.offer_payloads(spark, sf_dir).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp")
    )
    return flatten_offers(payloads, "cat-n1", "n1", day)


def silver_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _offer_rows(spark, sf_dir)
    out = flat_offers(rows.unionByName(rows))  # a load repeated in full must not double the offers
    return out.withColumns(
        {"total_price": F.col("total_price").cast("double"), "extracted_at": F.col("extracted_at").cast("timestamp_ntz")}
    )


def silver_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = L.search_pages(spark, sf_dir).withColumnRenamed("source_page", "page_number")
    seen = F.concat(F.lit("2024-01-"), F.lpad((1 + F.col("page_number") % 28).cast("string"), 2, "0"))
    out = active(current_listing(flatten_search_pages(pages, "cat", seen)))
    return out.select("asin", "node", "position", "page_number", F.to_date("last_seen_at").alias("last_seen"))


def gold_with_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers = flat_offers(_offer_rows(spark, sf_dir))
    details = flatten_details(
        L.detail_payloads(spark, sf_dir).withColumn("asin", F.concat(F.lit("P"), F.col("p_partkey"))),
        "parts", None, "2024-01-31T07:00:00.000000+00:00",
    )
    gold = daily_snapshot(offers, details)
    return gold.select(
        "snapshot_date", "asin", "category_label", F.col("pdp_total_price").cast("double").alias("pdp_total_price"),
        "buybox_seller_name", "buybox_stock", "seller_id_count",
        F.col("min_total_price").cast("double").alias("min_total_price"),
    )


def agg16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(ing2(spark, sf_dir), "pricing_status", "error_message")


def src1(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = usable_lines(F.split("text", "\r\n|\r|\n"))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode_outer(lines).alias("value")).where("value is not null")


def src4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_scan(table(spark, sf_dir, "part"), "p_brand", "p_size > 10", 12, distinct=True)


def src4_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_scan(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity > 5", distinct=True)


def src5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_scan(table(spark, sf_dir, "pages"), "url", "url like 'https:%'")


def src7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(L.supplier_registry(spark, sf_dir), PAGE_CAP).select(
        "source", "category_label", "node_label", "run_label", "domain", "max_pages", "start_page"
    )


def jn6(spark: SparkSession, sf_dir: str) -> DataFrame:
    worklist = table(spark, sf_dir, "orders").selectExpr("o_orderkey as input_pos", "o_custkey as asin")
    landed = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'").selectExpr(
        "c_custkey as asin", "c_name", "explode(array(1, 2, 3)) as landed_at"
    ).selectExpr(
        "asin", "landed_at",
        """case when asin % 5 = 0 and landed_at = 3 then null
                else concat('{"name":"', c_name, '","try":', landed_at, '}') end as payload""",
    )
    return attach_payloads(worklist, landed)


def set1(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey as key", "p_name as name")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as key", "s_acctbal as balance")
    return union_rows(parts, suppliers)


def snk1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_lines(
        table(spark, sf_dir, "customer").selectExpr(
            "c_custkey", "c_name", "c_acctbal", "nullif(c_mktsegment, 'MACHINERY') as segment"
        )
    )


def snk3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer rows written as runs of several labels and read back."""
    base = f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}"
    rows = flatten_offers(L.offer_payloads(spark, sf_dir), F.concat(F.lit("cat"), F.length("source")), "n1", RUN_AT)
    write_runs(rows, base, F.col("category_label"), F.col("node_label"), F.col("extracted_at").cast("timestamp"))
    return read_jsonl(spark, base, OFFERS)


def str1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed once through the deduplicating load."""
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .selectExpr(
            "cast(user_id as string) as asin", "event_type as seller_name",
            "cast(date_trunc('DAY', ts) as timestamp) as extracted_ts",
        )
    )
    once = deduplicated(stream, ["asin", "seller_name", "extracted_ts"], "extracted_ts", "2 days")
    load_available(once, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").selectExpr(
        "asin", "seller_name", "cast(extracted_ts as date) as seen_on"
    )


def str1_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in two loads: the days of even number first, then all days again, so older rows arrive late."""
    base = f"{shared_folder(spark)}/backfill-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) as asin", "event_type as seller_name", "cast(ts as date) as seen_on"
    )
    for part in (rows.where("day(seen_on) % 2 = 0"), rows):
        part.write.mode("append").parquet(f"{base}/landed")
        load_new(
            spark.readStream.schema(rows.schema).parquet(f"{base}/landed"), f"{base}/table", f"{base}/checkpoint", ["asin", "seller_name"], "seen_on"
        ).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/table").select("asin", "seller_name", "seen_on")


QUERIES = {
    "str1_backfill": str1_backfill,
    "ing1_search_listing": ing1,
    "ing2_flatten_offers": ing2,
    "ing3_product_details": ing3,
    "ing4_category_links": ing4,
    "ing4_links_until_failure": ing4_crawls,
    "gen9_anchors": gen9,
    "ing5_lookup_envelope": ing5,
    "ing6_product_page": ing6,
    "ing6_page_fallback": ing6_pages,
    "ing7_pagination_plan": ing7,
    "ing8_page_window": ing8,
    "ing8_all_pages": ing8_all,
    "ing9_offers_of_sources": ing9_offers,
    "ing9_listings_of_sources": ing9_listings,
    "ing9_all_listings": ing9_all_listings,
    "ing10_silver_offers": silver_offers,
    "ing10_active_listing": silver_listing,
    "ing10_snapshot_with_details": gold_with_details,
    "agg16_run_counters": agg16,
    "src1_line_list": src1,
    "src4_column_scan": src4,
    "src4_distinct_keys": src4_all,
    "src5_column_scan_all": src5,
    "src7_source_registry": src7,
    "jn6_payload_lookup": jn6,
    "set1_union_missing": set1,
    "snk1_json_lines": snk1,
    "snk3_runs_round_trip": snk3,
    "str1_incremental_load": str1,
}

_ING2 = f"""base as (select *, 'P' || o_orderkey asin0, o_orderkey % 16 c, 1 + (o_orderkey // 16) % 3 n,
    concat('NATION_', o_custkey % 25) source from orders),
offer_lines as (
  select b.*, i, j from base b, unnest(range(1, n + 1)) as t(i), unnest(range(1, greatest(c - 11, 1) + 1)) as u(j)
  where c = 8 or c = 9 or c >= 11),
flat as (
  select asin0 asin, o_orderpriority title, 'https://shop.example.com/' || asin0 url, o_custkey review_count,
    'Seller ' || i seller, o_totalprice price, 'EUR' currency, cast(i * 0.5 as double) price_shipping,
    o_orderstatus "condition", o_custkey rating_count, 'S' || ((o_custkey + i) % 7) seller_id, '/s/' || i seller_link,
    o_orderpriority delivery, case when c >= 12 then 'T' || j end delivery_type,
    case when c >= 12 then 'day ' || j end delivery_date, cast(i as integer) offer_position,
    cast(case when c >= 12 then j end as integer) delivery_option_position,
    'offer' pricing_status, cast(null as varchar) error_message, source, o_orderdate
  from offer_lines
  union all
  select asin0, case when c = 3 then 'no price' when c in (4, 6) then o_orderpriority end,
    case when c in (4, 6) then 'https://shop.example.com/' || asin0 end,
    case when c = 3 then 3 when c in (4, 6) then o_custkey end,
    null, null, null, null, null, null, null, null, null, null, null, null, null,
    case when c in (0, 5, 7, 10) then 'error' else 'no_offers' end,
    case when c = 0 then 'timeout' when c in (5, 7, 10) then 'malformed offer payload' end, source, o_orderdate
  from base where c in (0, 1, 2, 3, 4, 5, 6, 7, 10))"""

_ING2_COLUMNS = """asin, title, url, review_count, seller, price, currency, price_shipping, "condition", rating_count,
  seller_id, seller_link, delivery, delivery_type, delivery_date, offer_position, delivery_option_position"""

_REGISTRY = """reg0 as (select *, case when n_nationkey % 3 = 0 then n_name else 'cat' || n_regionkey end category_label,
    case when n_nationkey % 2 = 0 then cast(n_nationkey as varchar) end node,
    case when n_nationkey % 4 = 0 then 'N' end node_label0, n_nationkey * 10 - 20 mp,
    case when n_nationkey % 6 = 0 then null else n_nationkey - 3 end sp from nation where n_nationkey % 5 <> 4),
reg as (select n_name source, category_label,
    case when n_regionkey = 1 then coalesce(node, node_label0) else coalesce(node_label0, node) end node_label, 'de' "domain",
    cast(case when mp between 1 and 100 then mp else 100 end as integer) max_pages,
    cast(greatest(coalesce(sp, 1), 1) as integer) start_page from reg0),
registry as (select *, concat_ws('-', category_label, node_label) run_label from reg)"""

_SEARCH = """pages0 as (select 'NATION_' || c_nationkey source, cast(c_custkey as integer) source_page, c_custkey % 7 = 3 failed,
    c_custkey % 211 <> 5 has_next, c_nationkey, c_name, c_acctbal, 1 + c_custkey % 4 n from customer)"""

_WINDOW = """attempts as (select p.*, row_number() over (partition by source order by source_page) attempt
    from {pages} p where source_page >= {start}),
flagged as (select *, coalesce(max(case when not failed and not has_next then 1 else 0 end)
      over (partition by source order by source_page rows between unbounded preceding and 1 preceding), 0) ended
    from attempts where attempt <= {cap}),
kept as (select *, cast(row_number() over (partition by source order by source_page) as integer) page_number
    from flagged where ended = 0 and not failed)"""

_ANCHORS = """tags as (select {page} page, regexp_extract_all(html, '<a href="(/[^"]*)">[^<]*</a>', 1) hrefs,
    regexp_extract_all(html, '<a href="/[^"]*">([^<]*)</a>', 1) titles, page_id from pages),
links as (select t.*, unnest(range(1, len(hrefs) + 1)) k from tags t),
found as (select page, page_id, cast(k - 1 as integer) position, hrefs[k] href, titles[k] title from links)"""

_SILVER = f"""{_ING2},
silver as (select distinct asin, o_orderdate extracted_at, cast(o_orderdate as date) snapshot_date, seller seller_name,
    lower(seller) seller_key, seller_id, "condition", offer_position, round(price + price_shipping, 2) total_price,
    'cat' category_label, 'n1' node from flat where pricing_status = 'offer')"""

SQL = {
    "ing1_search_listing": f"""with {_SEARCH}
select source_page page_number, 'cat' category_label, cast(c_nationkey as varchar) node, cast(i as integer) "position",
  'B' || source_page || '_' || (i % 2) asin, c_name title,
  'https://shop.example.com' || case when i = 2 then '/sspa/click' else '' end || '/' || source_page link,
  cast(4.5 as double) rating, i * 10 reviews, cast(null as varchar) bought_last_month,
  case when i <> 3 then 'EUR ' || c_acctbal end price_raw, case when i <> 3 then 'EUR' end currency,
  c_acctbal extracted_price, '["a","b"]' delivery, i = 2 is_sponsored, '{RUN_AT}' extracted_at, source_page
from pages0, unnest(range(1, n + 1)) as t(i)""",
    "ing2_flatten_offers": f"""with {_ING2}
select {_ING2_COLUMNS}, 'cat-n1' category_label, 'n1' node_label, '{RUN_AT}' extracted_at, pricing_status, error_message
from flat""",
    "ing3_product_details": f"""with p as (select *, p_partkey % 8 c, p_partkey % 8 >= 2 ok from part)
select case when c = 3 then 'U' || p_partkey when ok then 'A' || p_partkey else 'K' || p_partkey end asin,
  'parts' category_label, 'n1' node, '{RUN_AT}' extracted_at, case when ok then p_name end title,
  case when ok then p_brand end brand, case when ok then cast(p_size as varchar) end stock,
  case when ok then p_retailprice end price, case when ok then p_retailprice end price_buybox,
  cast(null as double) price_shipping, case when ok then 'EUR' end currency,
  case when ok then p_size / 10.0 end rating, cast(case when c = 2 then 7 when ok then p_size end as bigint) review_count,
  case when c = 4 then '{{"a":1}}' when c = 5 then '"{{\\"a\\":"' when ok then '"' || p_type || '"' end description,
  case when c > 2 then '["' || p_type || '"]' else '"parts"' end category,
  case when ok then p_size % 2 = 0 end is_prime_eligible, cast(null as boolean) has_videos,
  case when c = 7 then '["i1","i2"]' when ok then '["","img' || p_partkey || '"]' end images,
  case when c = 7 then 'i1' when ok then 'img' || p_partkey end main_image,
  case when c = 6 then 'plain text' when ok then 'x' || chr(10) || p_brand end bullet_points,
  case when ok and c not in (5, 6) then 'V' || p_partkey end variation_selected_asin,
  case when ok and c not in (5, 6) then '{{"size":' || p_size || '}}' end variation_selected_dimensions,
  case when c = 5 then '"not json"' when ok and c <> 6 then '[{{"asin":"V1","selected":false}},{{"asin":"V' || p_partkey
    || '","dimensions":{{"size":' || p_size || '}},"selected":true}}]' else '[]' end variation_all,
  case when ok then '[{{"price":1,"seller":"Shop ' || (p_size % 3) || '"}}]' end buybox, cast(null as varchar) sales_rank,
  case when c = 0 then 'error' when c = 1 then 'no_content' else 'ok' end item_status,
  case when c = 0 then 'HTTP 500' end error_message, cast(case when c = 0 then 500 else 200 end as bigint) status_code
from p""",
    "ing4_category_links": f"""with {_ANCHORS.format(page='cast(page_id + 1 as integer)')},
r as (select *, row_number() over (partition by href order by page, position) rn from found)
select replace(title, '&amp;', '&') title, cast(null as varchar) price_raw, 'https://shop.example.com' || replace(href, '&amp;', '&') link,
  page page_number, '{RUN_AT}' extracted_at, 'cat' category_label from r where rn = 1""",
    "ing4_links_until_failure": f"""with {_ANCHORS.format(page='cast(page_id // 6 + 1 as integer)')},
bad as (select page_id % 6 crawl, min(page_id // 6 + 1) first_failed from pages where page_id % 29 = 28 group by 1),
seen as (select cast(f.page_id % 6 as integer) crawl, f.* from found f),
r as (select s.*, row_number() over (partition by s.crawl, href order by page, position) rn
  from seen s left join bad b on s.crawl = b.crawl where first_failed is null or page < first_failed)
select crawl, page page_number, 'https://shop.example.com' || replace(href, '&amp;', '&') link, replace(title, '&amp;', '&') title
from r where rn = 1""",
    "gen9_anchors": f"""with {_ANCHORS.format(page='page_id')}
select page_id, "position", replace(href, '&amp;', '&') href, replace(title, '&amp;', '&') title from found""",
    "ing5_lookup_envelope": f"""with a as (select page_id, case when page_id % 9 = 8 then replace(url, '://', ':') else url end v from pages)
select v input_value, 'cat' category_label, '{RUN_AT}' extracted_at,
  case when v not like '%://%' then 'input is not a URL' when page_id % 2 = 0 then '406 Not Acceptable' else 'Read timed out.' end error,
  cast(case when v like '%://%' and page_id % 2 = 0 then 406 end as bigint) status_code,
  case when v like '%://%' then 'https://lookup.example.com/product?url=' || split_part(v, '://', 1) || ':%2F%2F'
    || replace(url_encode(substr(v, strpos(v, '://') + 3)), '%3D', '=') end request_url
from a""",
    "ing6_product_page": """with p as (select *, p_partkey % 7 c from part)
select case when c <= 2 or c = 4 then p_name when c = 3 then p_name || ' & more' else 'red widget ' || p_partkey end title,
  case c when 0 then cast(p_size as varchar) when 1 then p_size || '.50' when 2 then p_size || ',99'
    when 3 then cast(p_size as varchar) when 4 then p_size || ' €' end price_raw,
  'https://shop.example.com/p/red_widget-' || p_partkey || '/' link
from p""",
    "ing6_page_fallback": """select translate(list_last(string_split(rtrim(url, '/'), '/')), '-_', '  ') title,
  cast(null as varchar) price_raw, url link from pages""",
    "ing7_pagination_plan": """with p as (select *, p_partkey % 5 c, p_size % 2 = 0 q, 1 + p_size % 3 items from part),
d as (select p_partkey, c, q, case c when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 4 else 2 end total_pages,
  cast(case when c in (1, 2) then 72 else items end as integer) offset_step,
  case c when 1 then 'gq' when 2 then 'list' when 4 then 'gq' end layout_hint from p),
n as (select d.*, cast(unnest(range(1, total_pages + 1)) as integer) page_number from d)
select p_partkey, total_pages, offset_step, layout_hint, page_number,
  cast((page_number - 1) * offset_step as bigint) "offset",
  'https://shop.example.com/c/' || p_partkey || case
    when page_number = 1 then case when q then '?l=zz&sort=a%20b&o=5' else '' end
    when q then '?l=zz&sort=a+b&o=' || ((page_number - 1) * offset_step)
    else '?o=' || ((page_number - 1) * offset_step) || coalesce('&l=' || layout_hint, '') end page_url
from n""",
    "ing8_page_window": f"""with {_SEARCH}, {_WINDOW.format(pages='pages0', start=3, cap=40)}
select source, source_page, page_number from kept""",
    "ing8_all_pages": f"""with {_SEARCH},
large as (select 'S' || source_page % 3 source, source_page, failed, source_page % 5003 <> 1304 has_next from pages0),
{_WINDOW.format(pages='large', start=1, cap=2**31 - 1)}
select source, source_page, page_number from kept""",
    "ing9_offers_of_sources": f"""with {_ING2}, {_REGISTRY}
select run_label category_label, node_label, pricing_status, count(*) n_rows
from flat f join registry r on f.source = r.source group by 1, 2, 3""",
    "ing9_listings_of_sources": f"""with {_SEARCH}, {_REGISTRY},
tagged as (select p.*, r.category_label, r.max_pages, r.start_page from pages0 p join registry r on p.source = r.source),
{_WINDOW.format(pages='tagged', start='start_page', cap='least(max_pages, 100)')}
select category_label, cast(c_nationkey as varchar) node, page_number, cast(i as integer) "position",
  'B' || source_page || '_' || (i % 2) asin, i = 2 is_sponsored
from kept, unnest(range(1, n + 1)) as t(i)""",
    "ing9_all_listings": f"""with {_SEARCH}, {_REGISTRY},
tagged as (select p.*, r.category_label, case when mp >= 1 then mp end max_pages, r.start_page
  from pages0 p join registry r on p.source = r.source join reg0 on n_name = r.source),
{_WINDOW.format(pages='tagged', start='start_page', cap=f'coalesce(max_pages, {2**31 - 1})')}
select category_label, cast(c_nationkey as varchar) node, page_number, cast(i as integer) "position",
  'B' || source_page || '_' || (i % 2) asin, i = 2 is_sponsored
from kept, unnest(range(1, n + 1)) as t(i)""",
    "ing10_silver_offers": f"with {_SILVER} select * from silver",
    "ing10_active_listing": f"""with {_SEARCH},
rows0 as (select 'B' || source_page || '_' || (i % 2) asin, cast(c_nationkey as varchar) node, cast(i as integer) "position",
    source_page page_number, make_date(2024, 1, 1 + source_page % 28) last_seen from pages0, unnest(range(1, n + 1)) as t(i)),
r as (select *, row_number() over (partition by asin order by last_seen desc, page_number, "position") rn from rows0),
m as (select node, max(last_seen) newest from rows0 group by node)
select r.asin, r.node, r."position", r.page_number, r.last_seen from r join m on r.node = m.node
where rn = 1 and last_seen = newest""",
    "ing10_snapshot_with_details": f"""with {_SILVER},
o as (select asin, snapshot_date, min(category_label) category_label, arg_min(total_price, offer_position) best_price,
    arg_min(seller_name, offer_position) best_seller, count(distinct seller_id) seller_id_count,
    min(total_price) min_total_price from silver group by asin, snapshot_date),
d as (select case when p_partkey % 8 = 3 then 'U' else 'A' end || p_partkey asin, date '2024-01-31' snapshot_date,
    p_retailprice detail_price, 'Shop ' || (p_size % 3) detail_seller, cast(p_size as varchar) detail_stock
    from part where p_partkey % 8 >= 2)
select coalesce(o.snapshot_date, d.snapshot_date) snapshot_date, coalesce(o.asin, d.asin) asin,
  case when d.asin is not null then 'parts' else category_label end category_label,
  coalesce(detail_price, best_price) pdp_total_price, coalesce(detail_seller, best_seller) buybox_seller_name,
  detail_stock buybox_stock, coalesce(seller_id_count, 0) seller_id_count, min_total_price
from o full join d on o.asin = d.asin and o.snapshot_date = d.snapshot_date""",
    "agg16_run_counters": f"""with {_ING2} select pricing_status, error_message, count(*) n_rows from flat group by 1, 2""",
    "src1_line_list": r"""with l as (select doc_id, unnest(string_split_regex(text, '\r\n|\r|\n')) line from documents),
t as (select doc_id, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30)
  || chr(31) || chr(133) || chr(160)) "value" from l)
select * from t where "value" <> ''""",
    "src4_column_scan": """with v as (select distinct p_brand val from part where p_size > 10 order by 1 limit 12)
select val from v where val is not null and val <> ''""",
    "src4_distinct_keys": """select distinct l_partkey val from lineitem where l_quantity > 5 and l_partkey <> 0""",
    "src5_column_scan_all": "select url val from pages where url like 'https:%' and url <> ''",
    "src7_source_registry": f"""with suppliers as (select s_name n_name, s_suppkey n_nationkey, s_nationkey % 5 n_regionkey from supplier),
{_REGISTRY.replace("from nation ", "from suppliers ")}
select source, category_label, node_label, run_label, "domain", max_pages, start_page from registry""",
    "jn6_payload_lookup": """select o_orderkey input_pos, o_custkey asin,
  case when c_custkey is null or c_mktsegment = 'MACHINERY' then '{"error":"Missing result"}'
       when c_custkey % 5 = 0 then '{"error":"Empty payload"}'
       else '{"name":"' || c_name || '","try":3}' end payload
from orders left join customer on o_custkey = c_custkey""",
    "set1_union_missing": """select p_partkey "key", p_name "name", cast(null as double) balance from part
union all select s_suppkey, null, s_acctbal from supplier""",
    "snk1_json_lines": """select '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_acctbal":' || c_acctbal || ',"segment":'
  || coalesce('"' || nullif(c_mktsegment, 'MACHINERY') || '"', 'null') || '}' "value" from customer""",
    "snk3_runs_round_trip": f"""with {_ING2}
select {_ING2_COLUMNS}, 'cat' || length(source) category_label, 'n1' node_label, '{RUN_AT}' extracted_at, pricing_status, error_message
from flat""",
    "str1_backfill": """select distinct cast(user_id as varchar) asin, event_type seller_name, cast(ts as date) seen_on from events""",
    "str1_incremental_load": """select distinct cast(user_id as varchar) asin, event_type seller_name, cast(ts as date) seen_on from events""",
}
