"""Landed payloads and pages derived row by row from the test tables.

Each row's number picks one of the shapes the flatteners must tell apart, so every shape occurs all
over the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapters import table

# Delivery options by case: none, null, one unknown, one empty, a date that is no object, several.
_OPTIONS = """case c
  when 6 then ',"delivery_options":[]'
  when 7 then ',"delivery_options":null'
  when 8 then ',"delivery_options":[null]'
  when 9 then ',"delivery_options":[{}]'
  when 10 then ',"delivery_options":[{"type":"std","date":"soon"}]'
  when 11 then ''
  else concat(',"delivery_options":[', array_join(transform(sequence(1, greatest(c - 11, 1)),
       j -> concat('{"type":"T', j, '","date":{"by":"day ', j, '"}}')), ','), ']') end"""

_OFFERS = """concat('[', array_join(transform(sequence(1, n), i -> concat(
  '{"seller":"Seller ', i, '","price":', o_totalprice, ',"currency":"EUR","price_shipping":', i * 0.5D,
  ',"condition":"', o_orderstatus, '","rating_count":', o_custkey, ',"seller_id":"S', (o_custkey + i) % 7,
  '","seller_link":"/s/', i, '","delivery":"', o_orderpriority, '"', options, '}')), ','), ']')"""

_HEAD = """concat('"asin":"', asin, '","title":"', o_orderpriority, '","url":"https://shop.example.com/', asin,
  '","review_count":', o_custkey)"""

_OFFER_PAYLOAD = """case c
  when 0 then '{"error":"timeout","status_code":null}'
  when 1 then '{"error":"throttled","results":[]}'
  when 2 then '{"results":[{"content":{}}]}'
  when 3 then concat('{"results":[{"content":{"asin":"","title":"no price","url":null,"review_count":3}}]}')
  when 4 then concat('{"results":[{"content":{', head, ',"pricing":[]}}]}')
  when 5 then concat('{"results":[{"content":{', head, ',"pricing":null}}]}')
  else concat('{"results":[{"content":{', head, ',"pricing":', offers, '}}]}') end"""


def offer_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, asin, payload)``: one answer per order."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr(
            "*",
            "concat('P', o_orderkey) as asin",
            "cast(o_orderkey % 16 as int) as c",
            "cast(1 + (o_orderkey div 16) % 3 as int) as n",
        )
        .withColumn("options", F.expr(_OPTIONS))
        .withColumns({"offers": F.expr(_OFFERS), "head": F.expr(_HEAD)})
        .selectExpr(
            "concat('NATION_', o_custkey % 25) as source", "asin", f"{_OFFER_PAYLOAD} as payload", "o_orderdate"
        )
    )


_DETAIL_PAYLOAD = r"""case c
  when 0 then '{"error":"HTTP 500","status_code":500}'
  when 1 then '{"results":[],"status_code":200}'
  else concat('{"status_code":200,"results":[{"content":{',
    case when c = 3 then concat('"asin":"","asin_in_url":"U', p_partkey, '"') else concat('"asin":"A', p_partkey, '"') end,
    ',"title":"', p_name, '","brand":"', p_brand, '","stock":', p_size, ',"price":', p_retailprice,
    ',"price_buybox":"', p_retailprice, '","currency":"EUR","rating":', p_size / 10.0D,
    case when c = 2 then ',"review_count":0,"reviews_count":7' else concat(',"review_count":', p_size) end,
    ',"description":', case c when 4 then '"{\\"a\\":1}"' when 5 then '"{\\"a\\":"' else concat('"', p_type, '"') end,
    ',"bullet_points":', case c when 6 then '"plain text"' else concat('["x","",null,"', p_brand, '"]') end,
    ',"images":', case c when 7 then '" [\\"i1\\",\\"i2\\"] "' else concat('["","img', p_partkey, '"]') end,
    ',"variation":', case c when 5 then '"not json"' when 6 then '[]'
      else concat('[{"asin":"V1","selected":false},{"asin":"V', p_partkey, '","selected":true,"dimensions":{"size":', p_size, '}}]') end,
    case when c = 2 then '' else concat(',"category":["', p_type, '"]') end,
    ',"buybox":[{"seller":"Shop ', p_size % 3, '","price":1}],"is_prime_eligible":', case when p_size % 2 = 0 then 'true' else 'false' end,
    '}}]}') end"""


def detail_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(asin, payload)``: one answer per part."""
    return (
        table(spark, sf_dir, "part")
        .withColumn("c", F.expr("cast(p_partkey % 8 as int)"))
        .selectExpr("concat('K', p_partkey) as asin", f"{_DETAIL_PAYLOAD} as payload", "p_partkey")
    )


_SEARCH_PAYLOAD = r"""concat('{', case when failed then '"error":"throttled",' else '' end,
  '"search_parameters":{"node":"', c_nationkey, '"},"serpapi_pagination":{',
  case when has_next then '"next":"https://x.example.com/s?page=2"' else '' end, '},"organic_results":[',
  array_join(transform(sequence(1, n), i -> concat('{"position":', i, ',"asin":"B', c_custkey, '_', i % 2,
    '","title":"', c_name, '","link":"https:\\/\\/shop.example.com', if(i = 2, '/sspa/click', ''), '/', c_custkey,
    '","rating":4.5,"reviews":', i * 10,
    ',"price":', if(i = 3, '"12 EUR"', concat('{"raw":"EUR ', c_acctbal, '","currency":"EUR"}')),
    ',"extracted_price":', c_acctbal, ',"delivery":["a","b"]}')), ','), ']}')"""


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, source_page, failed, has_next, payload)``: one search page per customer."""
    return (
        table(spark, sf_dir, "customer")
        .selectExpr(
            "*",
            "c_custkey % 7 = 3 as failed",
            "c_custkey % 211 <> 5 as has_next",
            "cast(1 + c_custkey % 4 as int) as n",
        )
        .selectExpr(
            "concat('NATION_', c_nationkey) as source",
            "cast(c_custkey as int) as source_page",
            "failed",
            "has_next",
            f"{_SEARCH_PAYLOAD} as payload",
        )
    )


_PRODUCT_HTML = r"""concat('<html><head><!-- <meta itemprop="name" content="hidden"> --><title>x</title>', case c
  when 0 then concat('<script type="application/ld+json">{"@type":"Product","name":"', p_name, '","offers":{"price":', p_size, '}}</script>')
  when 1 then concat('<script type="application/ld+json">{"@graph":[{"@type":"Thing"},{"z":{"@type":["X","Product"],"name":"', p_name,
    '","offers":[{"priceCurrency":"EUR"},{"lowPrice":"', p_size, '.50"}]}}]}</script>')
  when 2 then concat('<script type="application/ld+json">{broken</script><meta content="', p_name, '" itemprop="name"><meta itemprop=price content="', p_size, ',99">')
  when 3 then concat('<meta property="og:title" content="', p_name, ' &amp; more"><meta property="product:price:amount" content="', p_size, '">')
  when 4 then concat('<script type=''application/ld+json''>[{"@type":"Product","name":""},{"@type":"Product","name":"', p_name, '"}]</script>',
    '<span class="a" data-automation-id="main-price-1"> ', p_size, ' &euro; </span>')
  when 5 then concat('<script>var s = "<meta itemprop=''name'' content=''wrong''>";</script><script type="application/ld+json">{"name":"no type"}</script>')
  else '' end, '</head><body>', p_type, '</body></html>')"""


def product_pages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(url, html)``: one product page per part."""
    return (
        table(spark, sf_dir, "part")
        .withColumn("c", F.expr("cast(p_partkey % 7 as int)"))
        .selectExpr("concat('https://shop.example.com/p/red_widget-', p_partkey, '/') as url", f"{_PRODUCT_HTML} as html")
    )


_PAGER_HTML = r"""concat('<html><body>', array_join(transform(sequence(1, 1 + p_size % 3), i -> concat('<a href="/p/item-', i, '/">Item ', i, '</a>')), ''),
  '<a href="/help">Help</a><ul class="nav reptile_paging">', case c
  when 0 then ''
  when 1 then '<li class="reptile_paging__item"><button data-page="{&quot;o&quot;:72,&quot;l&quot;:&quot;gq&quot;}"> 2 </button></li>'
  when 2 then concat('<li class="reptile_paging__item"><button data-page=''{"o":"144"}''>3</button></li><li class="x reptile_paging__item"><button data-page=''{"o":72,"l":""}''>2</button></li>',
    '<li class="reptile_paging__item"><button data-page=''{"o":72,"l":"list"}''>2</button></li>')
  when 3 then concat('<li class="reptile_paging__item"><span class="reptile_paging__dots">..</span><button>9</button></li>',
    '<li class="reptile_paging__item" id="reptile-bottom-next"><button data-page=''{"o":1}''>8</button></li>',
    '<li class="reptile_paging__item"><button data-page="{broken">4</button></li><li class="other"><button>7</button></li>')
  else concat('<li class="reptile_paging__item"><button data-page=''{"o":-5}''>next</button></li>',
    '<li class="reptile_paging__item"><button data-page=''{"o":0,"l":"gq"}''>2</button></li>') end, '</ul></body></html>')"""


def category_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(p_partkey, url, html)``: one category page with pager per part."""
    return (
        table(spark, sf_dir, "part")
        .withColumn("c", F.expr("cast(p_partkey % 5 as int)"))
        .selectExpr(
            "p_partkey",
            "concat('https://shop.example.com/c/', p_partkey, if(p_size % 2 = 0, '?l=zz&sort=a%20b&o=5', '')) as url",
            f"{_PAGER_HTML} as html",
        )
    )


def _registered(named: DataFrame) -> DataFrame:
    """Rows ``(n_name, n_nationkey, n_regionkey)`` as sources; some are off or lack a setting."""
    return named.selectExpr(
        "n_name as name",
        "case when n_regionkey = 1 then 'x_product_details' else 'x_pricing' end as type",
        "case when n_nationkey % 5 = 4 then false when n_nationkey % 5 = 3 then null else true end as enabled",
        """map_filter(map('category_label', if(n_nationkey % 3 = 0, null, concat('cat', n_regionkey)),
             'node', if(n_nationkey % 2 = 0, cast(n_nationkey as string), null),
             'node_label', if(n_nationkey % 4 = 0, 'N', null),
             'max_pages', cast(n_nationkey * 10 - 20 as string),
             'start_page', if(n_nationkey % 6 = 0, 'x', cast(n_nationkey - 3 as string))), (k, v) -> v is not null) as parameters""",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as registered sources of the payloads."""
    return _registered(table(spark, sf_dir, "nation"))


def supplier_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as registered sources."""
    return _registered(
        table(spark, sf_dir, "supplier").selectExpr(
            "s_name as n_name", "s_suppkey as n_nationkey", "s_nationkey % 5 as n_regionkey"
        )
    )
