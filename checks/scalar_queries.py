"""Column functions over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapters import table
from shelfscope.functions import text as T
from shelfscope.functions import urls as U
from shelfscope.functions.dates import iso_text, run_stamp
from shelfscope.functions.variants import jsonish
from shelfscope.operators.dedupe import first_seen, latest


def sca7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        T.money(F.col("o_totalprice")).alias("price_text"),
        T.percent(F.col("o_custkey") / 2).alias("share_text"),
    )


def sca9(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(
        """case event_id % 4 when 0 then props when 1 then concat(' [', event_id, ',2] ')
           when 2 then concat('{"k":', event_id) else event_type end"""
    )
    value = jsonish(raw.cast("variant"))
    return table(spark, sf_dir, "events").select("event_id", F.to_json(value).alias("parsed"))


def sca12(spark: SparkSession, sf_dir: str) -> DataFrame:
    escaped = F.replace("url", F.lit("/"), F.lit("\\/"))
    return table(spark, sf_dir, "pages").select(
        "page_id", T.unescaped_slashes(escaped).alias("link"), T.slug_title(F.col("url")).alias("title")
    )


def sca20(spark: SparkSession, sf_dir: str) -> DataFrame:
    offset = (F.col("page_id") * 72).cast("int")
    hint = F.when(F.col("page_id") % 2 == 0, "gq")
    return table(spark, sf_dir, "pages").select(
        "page_id", U.page_url(F.col("url"), offset, hint).alias("page_url")
    )


def sca21(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = U.query_param(F.col("url"), "page")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        page.alias("page_text"),
        T.page_number_or_next(page, F.lit(1)).alias("next_page"),
        F.array_join(F.array_sort(F.map_keys(U.query_params(F.col("url")))), ",").alias("keys"),
    )


def sca23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", U.lookup_url(F.concat(F.lit("https://"), F.col("text"))).alias("encoded")
    )


def sca24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", iso_text(F.col("ts").cast("timestamp")).alias("iso"), run_stamp(F.col("ts")).alias("stamp")
    )


def win5(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return first_seen(events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])


def win3(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return latest(events, ["user_id"], [F.col("ts"), F.col("event_id")])


QUERIES = {
    "sca7_money_text": sca7,
    "sca9_jsonish": sca9,
    "sca12_unescape_and_slug": sca12,
    "sca20_page_url": sca20,
    "sca21_query_params": sca21,
    "sca23_lookup_url": sca23,
    "sca24_time_text": sca24,
    "win3_latest_per_key": win3,
    "win5_first_seen": win5,
}

SQL = {
    "sca7_money_text": """select o_orderkey, '€' || printf('%.2f', o_totalprice) price_text,
  printf('%.1f', o_custkey / 2) || '%' share_text from orders""",
    "sca9_jsonish": """select event_id, case event_id % 4 when 0 then replace(props, ' ', '') when 1 then '[' || event_id || ',2]'
  when 2 then '"{\\"k\\":' || event_id || '"' else '"' || event_type || '"' end parsed from events""",
    "sca12_unescape_and_slug": """select page_id, url link,
  translate(list_last(string_split(rtrim(url, '/'), '/')), '-_', '  ') title from pages""",
    "sca20_page_url": r"""with u as (select page_id, regexp_extract(url, '^([^?#]*)', 1) p, regexp_extract(url, '\?([^#]*)', 1) q,
    regexp_extract(url, '(#.+)$', 1) f from pages)
select page_id, p || '?' || case when q <> '' then q || '&' else '' end || 'o=' || (page_id * 72)
  || case when page_id % 2 = 0 then '&l=gq' else '' end || f page_url from u""",
    "sca21_query_params": r"""with u as (select page_id, regexp_extract(url, '\?([^#]*)', 1) q from pages)
select page_id, nullif(regexp_extract(q, '(?:^|&)page=([^&]*)', 1), '') page_text,
  coalesce(try_cast(nullif(regexp_extract(q, '(?:^|&)page=([^&]*)', 1), '') as integer), 2) next_page,
  array_to_string(list_sort(list_distinct(regexp_extract_all(q, '(?:^|&)([^=&]+)=[^&]+', 1))), ',') keys from u""",
    "sca23_lookup_url": """select doc_id, 'https:%2F%2F' || replace(url_encode(text), '%3D', '=') encoded from documents""",
    "sca24_time_text": """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' iso, strftime(ts, '%Y%m%d_%H%M%S') stamp from events""",
    "win3_latest_per_key": """select user_id, event_type, ts, event_id from (select *, row_number() over (partition by user_id
  order by ts desc, event_id desc) rn from events) x where rn = 1""",
    "win5_first_seen": """select user_id, event_type, ts, event_id from (select *, row_number() over (partition by user_id, event_type
  order by ts, event_id) rn from events) x where rn = 1""",
}
