"""Queries over tables that the engine itself wrote: loads, roll-ups, intervals, catalogs, landed files, run reports."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import payloads as L
from checks.adapters import event_market, table
from checks.ingest_queries import RUN_AT, SQL as INGEST_SQL
from checks.market_queries import SQL as MARKET_SQL, rounded
from checks.report_queries import ME, SELLER, SQL as REPORT_SQL, _portfolio
from checks.sql import AS_OF, GOLD, OFFERS, since
from shelfscope.operators.detail_payloads import flatten_details
from shelfscope.operators.pagination import absurd_total, detect_pagination, page_plan
from shelfscope.operators.worklist import numbered, read_lines
from shelfscope.plans import holders as H
from shelfscope.plans import rollups as U
from shelfscope.plans.desk import SellerDesk
from shelfscope.plans.ingest import accepted, land, quarantined
from shelfscope.plans.market import competitor_moves
from shelfscope.plans.portfolio import SHORT_LIST, health_of, latest_standing, portfolio_health
from shelfscope.plans.reports import as_text, asin_raw_history
from shelfscope.plans.silver import flat_offers, seller_stock, write_offers
from shelfscope.schemas import SILVER_OFFERS
from shelfscope.session import shared_folder, written
from shelfscope.sources.jsonl import json_lines, without_nan, write_run
from shelfscope.sources.tables import TableNames, Tables, write_bucketed
from shelfscope.streaming.bronze_stream import load_new


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), "shelfscope", f"{name}-{uuid.uuid4().hex}")


def _landed_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as offer rows of a flattened payload."""
    return event_market(spark, sf_dir).offers.select(
        "asin", "seller_id", "offer_position", "category_label",
        F.date_format("extracted_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("extracted_at"),
        F.col("seller_name").alias("seller"), F.col("total_price").alias("price"),
        F.lit(None).cast("double").alias("price_shipping"), F.lit("new").alias("condition"),
        F.lit(None).cast("string").alias("node_label"), F.lit("offer").alias("pricing_status"),
    )


def silver_three_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of even days, one of the first half of the month again, and a backfill of all days."""
    path, offers = _folder(spark, "silver"), flat_offers(_landed_offers(spark, sf_dir))
    for part in (offers.where("day(snapshot_date) % 2 = 0"), offers.where("day(snapshot_date) <= 15"), offers):
        write_offers(part, path)
    stored = spark.read.schema(SILVER_OFFERS).parquet(path)
    return stored.select("asin", "snapshot_date", "seller_key", "offer_position", F.col("total_price").cast("double").alias("total_price"))


def str1_three_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _folder(spark, "loads")
    rows = table(spark, sf_dir, "events").selectExpr("cast(user_id as string) as asin", "event_type as seller_name", "cast(ts as date) as seen_on")
    for part in (rows.where("day(seen_on) > 20"), rows.where("day(seen_on) % 3 = 1"), rows):
        part.write.mode("append").parquet(f"{base}/landed")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/landed")
        load_new(stream, f"{base}/table", f"{base}/checkpoint", ["asin", "seller_name"], "seen_on").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/table").select("asin", "seller_name", "seen_on")


def _intervals(spark: SparkSession, sf_dir: str) -> tuple:
    """Intervals of three periods, merged: what a table holds that takes in each new period."""
    m = event_market(spark, sf_dir)
    gold = written(m.gold, "gold")
    parts = [gold.where("day(snapshot_date) <= 9"), gold.where("day(snapshot_date) = 10"), gold.where("day(snapshot_date) > 10")]
    kept = H.holder_intervals(parts[0])
    for part in parts[1:]:
        kept = H.merged_intervals(kept.unionByName(H.holder_intervals(part)))
    return m, gold, written(kept, "intervals")


def holder_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _intervals(spark, sf_dir)[2]


def holders_on_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who held each product that was viewed, on the day it was viewed or last before."""
    _, _, intervals = _intervals(spark, sf_dir)
    days = table(spark, sf_dir, "events").where("event_type = 'click'").selectExpr("cast(user_id as string) as asin", "date_add(cast(ts as date), 1) as day").distinct()
    return H.held_on(intervals, days)


def changes_of_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, _, intervals = _intervals(spark, sf_dir)
    return H.changes_of_intervals(intervals, SELLER, m.as_of, 30)


def health_of_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, _, intervals = _intervals(spark, sf_dir)
    standing = H.standing_of_intervals(intervals, m.offers, SELLER, m.as_of)
    return health_of(standing, SELLER, SHORT_LIST).drop("report_text")


def whole_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health row with all names and with its text."""
    m = event_market(spark, sf_dir, 30)
    return portfolio_health(m.gold, m.offers, SELLER, m.as_of)


def standing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = event_market(spark, sf_dir, 30)
    return latest_standing(m.gold, m.offers, SELLER, m.as_of)


def _rollup(spark: SparkSession, sf_dir: str) -> tuple:
    """Written for all days, then refreshed for some of them."""
    m, path = event_market(spark, sf_dir), _folder(spark, "holder-days")
    U.refresh_holder_days(m.gold, path)
    some = m.gold.where("day(snapshot_date) % 7 = 3").select("snapshot_date").distinct()
    U.refresh_holder_days(m.gold, path, [r[0] for r in some.collect()])
    return m, spark.read.parquet(path)


def history_of_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, rollup = _rollup(spark, sf_dir)
    return rounded(U.competitor_history_of(rollup, SELLER, m.as_of), "avg_winning_price")


def rivals_of_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, rollup = _rollup(spark, sf_dir)
    return rounded(U.rivals_and_shadows_of(rollup, SELLER, m.as_of), "avg_winning_price")


def _catalog(spark: SparkSession, sf_dir: str, buckets: int) -> SellerDesk:
    """Snapshot and offers as bucketed tables of the catalog."""
    m, name = event_market(spark, sf_dir), f"t{uuid.uuid4().hex}"
    for kind, df in (("gold", m.gold), ("offers", m.offers)):
        write_bucketed(df, f"{name}_{kind}", buckets, _folder(spark, kind))
    return SellerDesk.of_tables(Tables(spark, TableNames(gold=f"{name}_gold", offers=f"{name}_offers")))


def pulse_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default report of stored tables: its day is read from the catalog."""
    return _catalog(spark, sf_dir, 4).daily_pulse(SELLER)


def newest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest day of the catalog, beside what a report in SQL finds on it through the registered views."""
    desk = _catalog(spark, sf_dir, 2)
    desk.gold.createOrReplaceTempView("stored_gold")
    sql = "select :day as newest, count(*) as snapshots, count(distinct buybox_seller_key) as holders from stored_gold where snapshot_date = :day"
    return spark.sql(sql, args={"day": desk.as_of})


def health_of_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    desk = _catalog(spark, sf_dir, 8)
    return portfolio_health(desk.gold, desk.offers, SELLER, desk.as_of, list_cap=SHORT_LIST).drop("report_text")


def _mixed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed search pages; some name no registered source, some are cut off."""
    return (
        L.search_pages(spark, sf_dir)
        .drop("failed", "has_next")
        .withColumn("source", F.when(F.col("source_page") % 13 == 0, "ELSEWHERE").otherwise(F.col("source")))
        .withColumn("payload", F.when(F.col("source_page") % 17 == 3, F.expr("left(payload, length(payload) - 1)")).otherwise(F.col("payload")))
    )


def _landed(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    path = _folder(spark, "landing")
    return path, land(_mixed_pages(spark, sf_dir), L.registry(spark, sf_dir), path)


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _landed(spark, sf_dir)
    return quarantined(spark, path).select("source", "source_page", "reject_reason", F.col("run_label").isNull().alias("unlabelled"))


def landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts observed while landing, and the rows that are there afterwards."""
    path, counts = _landed(spark, sf_dir)
    there = accepted(spark, path).agg(F.count("*").alias("accepted_rows")).join(quarantined(spark, path).agg(F.count("*").alias("rejected_rows")))
    return there.select(*(F.lit(counts[k]).cast("bigint").alias(k) for k in ("landed", "accepted", "rejected")), "accepted_rows", "rejected_rows")


def absurd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to visit of categories that may announce up to 50,000 each, and the categories left out."""
    pages = L.category_pages(spark, sf_dir).withColumn("html", F.when(F.col("p_partkey") % 400 == 3, F.replace("html", F.lit(">2</"), F.lit(">45000</"))).when(F.col("p_partkey") % 400 == 7, F.replace("html", F.lit(">3</"), F.lit(">50000000</"))).otherwise(F.col("html")))
    detected = detect_pagination(pages)
    planned = page_plan(detected, most_pages=50_000).groupBy("p_partkey").agg(F.count("*").alias("pages"), F.max("offset").alias("last_offset"))
    left_out = detected.where(absurd_total(50_000)).select("p_partkey", F.lit(0).cast("bigint").alias("pages"), F.lit(None).cast("bigint").alias("last_offset"))
    return planned.unionByName(left_out)


def stock_of_other_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves of all sellers, their stock as product details state it: one page of a product and day lists its sellers."""
    m = event_market(spark, sf_dir, 14)
    seller = F.concat(F.lit('{"seller":"'), "seller_name", F.lit('","price":'), "total_price", F.lit(',"stock":'), "stock", F.lit("}"))
    day = F.date_format("extracted_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    pages = m.offers.select("asin", "snapshot_date", day.alias("extracted_at"), seller.alias("seller"), "offer_position", "total_price", "stock", "seller_name")
    # A page names the cheapest offer of each seller of the product that day; one of the sellers holds the buy box.
    best = pages.groupBy("asin", "snapshot_date", "seller_name").agg(F.min_by("seller", F.struct("total_price", "stock")).alias("seller"))
    listed = best.groupBy("asin", "snapshot_date").agg(F.max(F.when(F.col("seller_name") == "click", F.col("seller"))).alias("box"), F.collect_list(F.when(F.col("seller_name") != "click", F.col("seller"))).alias("others"))
    payload = F.concat(F.lit('{"results":[{"content":{"title":"t"'), F.coalesce(F.concat(F.lit(',"buybox":'), "box"), F.lit("")), F.lit(',"other_sellers":['), F.array_join("others", ","), F.lit("]}}]}"))
    details = flatten_details(listed.select("asin", payload.alias("payload"), F.col("snapshot_date").cast("string").alias("at")), "cat", None, F.col("at"))
    moves = competitor_moves(flat_offers(_landed_offers(spark, sf_dir)), SELLER, m.as_of, stock=seller_stock(details))
    return moves.withColumns({c: F.col(c).cast("double") for c in ("price", "prev_price", "price_change")})


def lines_of_files(spark: SparkSession, sf_dir: str, max_items: int | None = None) -> DataFrame:
    """Customer names as work-list files: 5 files of lines with blanks and spaces, read back in order."""
    base = _folder(spark, "lines")
    names = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") % 5).alias("file"), "c_custkey",
        F.when(F.col("c_custkey") % 9 == 4, F.lit("   ")).otherwise(F.concat(F.lit("  "), "c_name", F.lit("\t"))).alias("value"),
    )
    # One file per folder, its lines in the order of their keys.
    names.repartitionByRange(5, "file").sortWithinPartitions("file", "c_custkey").select("file", "value").write.partitionBy("file").text(base)
    return read_lines(spark, f"{base}/file=*", max_items)


def capped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of_files(spark, sf_dir, 40)


def input_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders numbered by date and price, dearest last; the numbers restore that order."""
    return numbered(table(spark, sf_dir, "orders"), "o_orderkey", order=["o_orderdate", "o_totalprice", "o_orderkey"])


def numbers_without_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("c_custkey") % 3 == 0, F.lit(float("nan"))).when(F.col("c_custkey") % 7 == 0, F.lit(float("-inf"))).otherwise(F.col("c_acctbal"))
    return json_lines(without_nan(table(spark, sf_dir, "customer").select("c_custkey", odd.alias("balance"))))


def one_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of newline JSON in its own folder, read back with the folder's name."""
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 4 == 1, F.lit(float("nan"))).otherwise(F.col("s_acctbal")).alias("balance"))
    path = write_run(df, _folder(spark, "run"), "suppliers", "20240131_070000", "n1", strict=True)
    back = spark.read.schema("s_suppkey long, s_name string, balance double").json(path)
    return back.withColumn("run", F.lit("/".join(path.split("/")[-2:])))


def raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail rows keep their payload text as it landed."""
    payloads = table(spark, sf_dir, "part").selectExpr("concat('K', p_partkey) as asin", """case p_partkey % 3 when 0 then p_name
        when 1 then concat('{ "results" : [ {"content":{"asin":"A', p_partkey, '"}} ] }') end as payload""")
    rows = flatten_details(payloads, "parts", None, RUN_AT)
    return rows.select("asin", "payload_raw", "item_status")


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report's text lines with their places."""
    m = event_market(spark, sf_dir, 14)
    return as_text(asin_raw_history(m.gold, "7", m.as_of))


QUERIES = {
    "ing10_three_loads": silver_three_loads,
    "str1_three_loads": str1_three_loads,
    "win1_holder_intervals": holder_intervals,
    "win1_holders_on_days": holders_on_days,
    "rpt4_changes_of_intervals": changes_of_intervals,
    "rpt7_health_of_intervals": health_of_intervals,
    "rpt7_whole_portfolio": whole_portfolio,
    "rpt7_latest_standing": standing,
    "rpt7_health_of_buckets": health_of_buckets,
    "rpt9b_history_of_rollup": history_of_rollup,
    "doc9_rivals_of_rollup": rivals_of_rollup,
    "rpt1_pulse_of_tables": pulse_of_tables,
    "src11_newest_day": newest_day,
    "ing9_rejected_pages": rejected,
    "ing9_landing_counts": landing_counts,
    "ing7_absurd_totals": absurd_pages,
    "doc2_stock_of_other_sellers": stock_of_other_sellers,
    "src1_lines_of_files": lines_of_files,
    "src2_capped_lines": capped_lines,
    "top5_input_numbers": input_numbers,
    "snk2_without_nan": numbers_without_nan,
    "snk4_one_run": one_run,
    "sca10_raw_payloads": raw_payloads,
    "snk6_report_lines": report_lines,
}

_ISLANDS = f"""with {GOLD},
marked as (select *, row_number() over (partition by asin order by snapshot_date)
    - row_number() over (partition by asin, buybox_seller_name order by snapshot_date) run from gold),
days as (select *, lag(snapshot_date) over (partition by asin, buybox_seller_name, run order by snapshot_date) before from marked),
islands as (select asin, buybox_seller_name, min(snapshot_date) from_day, max(snapshot_date) to_day, max(before) before_last,
    count(*) snapshots, arg_min(pdp_total_price, snapshot_date) from_price from days group by asin, buybox_seller_name, run)"""

_REASONS = """pages0 as (select cast(c_custkey as integer) source_page, case when c_custkey % 13 = 0 then 'ELSEWHERE' else 'NATION_' || c_nationkey end source,
    c_custkey % 17 = 3 cut, c_nationkey from customer),
reasons as (select p.*, case when n_name is null then 'unknown_source' when n_nationkey % 5 = 4 then 'disabled_source'
    when cut then 'unreadable_payload' end reject_reason from pages0 p left join nation on n_name = source)"""

_LINES = """lines as (select c_custkey % 5 file, c_custkey, c_name from customer where c_custkey % 9 <> 4),
placed as (select row_number() over (order by file, c_custkey) - 1 pos, c_name "value" from lines)"""

_STANDING = f"""with {GOLD},
held as (select asin, snapshot_date, lower(buybox_seller_name) = {ME} mine from gold where {since(14)} and asin in (
    select asin from offers where lower(seller_name) = {ME} and {since(30)})),
ranked as (select *, row_number() over (partition by asin order by snapshot_date desc) r from held),
states as (select n.asin, n.mine, b.mine mine_before from ranked n left join ranked b on b.asin = n.asin and b.r = 2 where n.r = 1)"""

SQL = {
    "ing10_three_loads": f"""with {OFFERS}
select distinct asin, snapshot_date, lower(seller_name) seller_key, cast(offer_position as integer) offer_position, round(total_price, 2) total_price from offers""",
    "str1_three_loads": INGEST_SQL["str1_backfill"],
    "win1_holder_intervals": _ISLANDS + " select * from islands",
    "win1_holders_on_days": f"""{_ISLANDS},
seen as (select distinct cast(user_id as varchar) asin, cast(ts as date) + 1 "day" from events where event_type = 'click')
select s.asin, s."day", arg_max(g.buybox_seller_name, g.snapshot_date) buybox_seller_name
from seen s join gold g on g.asin = s.asin and g.snapshot_date <= s."day" group by all""",
    "rpt4_changes_of_intervals": REPORT_SQL["rpt4_buy_box_changes_all"],
    "rpt7_health_of_intervals": REPORT_SQL["rpt7_portfolio_health"],
    "rpt7_health_of_buckets": REPORT_SQL["rpt7_portfolio_health"],
    "rpt7_latest_standing": f"{_STANDING} select asin, coalesce(mine, false) is_winning, coalesce(mine_before and not mine, false) just_lost from states",
    "rpt7_whole_portfolio": f"""with health as ({_portfolio(GOLD, "Purchase", AS_OF, 14, 30).replace("min(asin, 20)", "list(asin order by asin)")})
select *, 'Portfolio of Purchase: ' || total_products || ' products' || chr(10)
  || 'Win rate: ' || printf('%.1f', win_rate) || '%, lost today: ' || at_risk_count || chr(10)
  || 'Holding: ' || coalesce(winning_asins, 'None') || chr(10) || 'Not holding: ' || coalesce(losing_asins, 'None') || chr(10)
  || if(insight = 'healthy', 'The portfolio is in good shape.', 'Revenue is at risk; look into the lost buy boxes first.') report_text
from health""",
    "rpt9b_history_of_rollup": REPORT_SQL["rpt9b_competitor_history_all"],
    "doc9_rivals_of_rollup": MARKET_SQL["doc9_rivals_and_shadows"],
    "rpt1_pulse_of_tables": REPORT_SQL["rpt1_daily_pulse"],
    "src11_newest_day": f"""with {GOLD} select snapshot_date newest, count(*) snapshots, count(distinct lower(buybox_seller_name)) holders
from gold where snapshot_date = {AS_OF} group by 1""",
    "ing9_rejected_pages": f"""with {_REASONS}
select source, source_page, reject_reason, reject_reason <> 'unreadable_payload' unlabelled from reasons where reject_reason is not null""",
    "ing9_landing_counts": f"""with {_REASONS}
select count(*) landed, count(*) - count(reject_reason) accepted, count(reject_reason) rejected,
  count(*) - count(reject_reason) accepted_rows, count(reject_reason) rejected_rows from reasons""",
    "ing7_absurd_totals": """with p as (select p_partkey, p_partkey % 5 c, 1 + p_size % 3 items from part),
d as (select p_partkey, case c when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 4 else 2 end usual,
  case when c in (1, 2) then 72 else items end step,
  case when p_partkey % 400 = 3 and c = 4 then 45000 when p_partkey % 400 = 7 and c = 2 then 50000000 end odd from p)
select p_partkey, cast(case when odd > 50000 then 0 else coalesce(odd, usual) end as bigint) pages,
  case when odd > 50000 then null else cast((coalesce(odd, usual) - 1) * step as bigint) end last_offset from d""",
    "doc2_stock_of_other_sellers": MARKET_SQL["doc2_competitor_moves"].replace("select *, round", "select asin, seller_key, snapshot_date, price, stock, prev_price, prev_stock, round"),
    "src1_lines_of_files": f"with {_LINES} select * from placed",
    "src2_capped_lines": f"with {_LINES} select * from placed where pos < 40",
    "top5_input_numbers": "select row_number() over (order by o_orderdate, o_totalprice, o_orderkey) - 1 input_pos, o_orderkey from orders",
    "snk2_without_nan": """select '{"c_custkey":' || c_custkey || ',"balance":' || case when c_custkey % 3 = 0 or c_custkey % 7 = 0 then 'null' else c_acctbal::varchar end || '}' "value" from customer""",
    "snk4_one_run": """select s_suppkey, s_name, case when s_suppkey % 4 = 1 then null else s_acctbal end balance, 'suppliers-n1/20240131_070000' run from supplier""",
    "sca10_raw_payloads": """select case when p_partkey % 3 = 1 then 'A' else 'K' end || p_partkey asin,
  case p_partkey % 3 when 0 then p_name when 1 then '{ "results" : [ {"content":{"asin":"A' || p_partkey || '"}} ] }' end payload_raw,
  case when p_partkey % 3 = 1 then 'ok' else 'error' end item_status from part""",
    "snk6_report_lines": f"""with {GOLD}
select 0 part, cast(0 as bigint) pos, 'snapshot_date,min_total_price,buybox_seller_name,buybox_is_amazon' line
union all
select 1, row_number() over (order by snapshot_date desc) - 1, concat_ws(',', coalesce(cast(snapshot_date as varchar), 'None'), coalesce(cast(min_total_price as varchar), 'None'),
  coalesce(buybox_seller_name, 'None'), case when buybox_is_amazon then 'True' when not buybox_is_amazon then 'False' else 'None' end)
from gold where {since(14)} and asin = '7'""",
}
