"""Market questions beyond one seller's buy box: dispersion, repricing, gaps, rivals, priorities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.functions import predicates as P
from shelfscope.functions.dates import AsOf, as_of_date, recent_offers
from shelfscope.functions.text import stripped
from shelfscope.plans.reports import HOLDER, competitor_history, current_owners, holder_changes, recent


def _seller(offers: DataFrame) -> Column:
    return P.seller_key(offers, "seller_name")


# Cells that a range of prices is counted in; a window sees as many rows.
CELLS = 4096
_QUANTILES = (0.25, 0.5, 0.75)


def _cell(price: Column, low: Column, high: Column) -> Column:
    """The place of a price among CELLS equal parts of its range; rises with the price."""
    return F.when(high > low, F.least(F.floor((price - low) / (high - low) * CELLS), F.lit(CELLS - 1))).otherwise(F.lit(0)).cast("int")


def _ranked(counts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``counts`` with ``upto``: how many values lie in the row and in those before it."""
    return counts.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys).orderBy(order)))


def price_dispersion(offers: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Spread of offer prices per category and day, quartiles interpolated between neighbours.

    Prices are counted per distinct value, which the tasks start before the shuffle. The exact values at the quartiles'
    ranks are found without a window over a category's prices: the range is cut into CELLS, the counts of the cells tell
    which cell holds a rank, that cell is cut again, and only the prices of the last cell are put in order.
    """
    priced = recent_offers(offers, as_of, days).where(F.col("total_price").isNotNull())
    # One key, so that a NULL category is a group like any other in joins too.
    histogram = priced.groupBy(
        F.struct("category_label", "snapshot_date").alias("g"), F.col("total_price").cast("double").alias("price")
    ).agg(F.count("*").alias("n"))
    whole = histogram.groupBy("g").agg(
        F.sum("n").alias("total"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        # Summed as decimals, the mean is the same however the rows are dealt out.
        (F.sum(F.col("price").cast("decimal(20,6)") * F.col("n")).cast("double") / F.sum("n")).alias("mean"),
    )
    celled = histogram.join(whole, "g").withColumn("cell", _cell(F.col("price"), F.col("low"), F.col("high")))
    carried = ("total", "low", "high", "mean")
    counts = celled.groupBy("g", "cell").agg(
        F.sum("n").alias("n"),
        F.min("price").alias("low_in"),
        F.max("price").alias("high_in"),
        F.sum(F.col("n") * F.pow(F.col("price") - F.col("mean"), F.lit(2))).alias("square"),
        *(F.max(c).alias(c) for c in carried),
    )
    places = [(F.col("total") - 1) * q for q in _QUANTILES]
    ranks = F.array(
        *(F.struct(F.lit(2 * i + j).alias("k"), rank(p).cast("bigint").alias("rank")) for i, p in enumerate(places) for j, rank in enumerate((F.floor, F.ceil)))
    )
    before = F.col("upto") - F.col("n")
    hit = F.filter(ranks, lambda r: (r["rank"] >= before) & (r["rank"] < F.col("upto")))
    # At most one cell for each rank goes on, so a price is met by the ranks of its cell only.
    first = (
        _ranked(counts, ["g"], "cell")
        .select("g", "cell", "low_in", "high_in", before.alias("before"), F.explode(hit).alias("r"))
        .select("g", "cell", "low_in", "high_in", "r.k", (F.col("r.rank") - F.col("before")).alias("rank"))
    )
    inside = celled.select("g", "cell", "price", "n").join(first, ["g", "cell"])
    inside = inside.withColumn("fine", _cell(F.col("price"), F.col("low_in"), F.col("high_in")))
    chosen = (
        _ranked(inside.groupBy("g", "k", "rank", "fine").agg(F.sum("n").alias("n")), ["g", "k"], "fine")
        .where((F.col("rank") >= before) & (F.col("rank") < F.col("upto")))
        .select("g", "k", "fine", (F.col("rank") - before).alias("left"))
    )
    last = _ranked(inside.join(chosen, ["g", "k", "fine"]).select("g", "k", "price", "n", "left"), ["g", "k"], "price")
    values = last.where((F.col("left") >= before) & (F.col("left") < F.col("upto")))
    at = values.groupBy("g").agg(*(F.max(F.when(F.col("k") == k, F.col("price"))).alias(f"v{k}") for k in range(2 * len(_QUANTILES))))

    def quantile(i: int) -> Column:
        low, high = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        return low + (high - low) * (places[i] - F.floor(places[i]))

    spread = counts.groupBy("g").agg(F.sum("square").alias("square"), *(F.max(c).alias(c) for c in carried))
    return spread.join(at, "g").select(
        "g.category_label",
        "g.snapshot_date",
        F.col("total").alias("offers"),
        F.col("low").alias("min_price"),
        F.col("high").alias("max_price"),
        F.col("mean").alias("avg_price"),
        F.when(F.col("total") > 1, F.sqrt(F.col("square") / (F.col("total") - 1))).alias("stddev_price"),
        *(quantile(i).alias(n) for i, n in enumerate(("p25_price", "median_price", "p75_price"))),
    )


def daily_seller_prices(offers: DataFrame) -> DataFrame:
    """Lowest price, and stock at that price, per product, seller and day."""
    stock = F.col("stock") if "stock" in offers.columns else F.lit(None).cast("int")
    return offers.groupBy("asin", _seller(offers).alias("seller_key"), "snapshot_date").agg(
        F.min("total_price").alias("price"),
        F.min_by(stock, F.struct("total_price", stock.alias("s"))).alias("stock"),
    )


def _stated_stock(gold: DataFrame) -> DataFrame:
    """Stock that the snapshots state as a number, per product, buy-box holder and day."""
    return gold.select(
        "asin",
        P.seller_key(gold, HOLDER).alias("seller_key"),
        "snapshot_date",
        F.col("buybox_stock").try_cast("int").alias("stock"),
    ).where(F.col("stock").isNotNull())


def competitor_moves(
    offers: DataFrame,
    seller: str,
    as_of: AsOf = None,
    days: int = 14,
    gold: DataFrame | None = None,
    stock: DataFrame | None = None,
) -> DataFrame:
    """Days on which another seller changed price or stock, against the days before it on that product.

    The previous price and stock are the last known ones. Offers without a ``stock`` column, as in the silver table,
    have the stock that the snapshots (``gold``) state for the buy-box holder, and that product details state for any
    seller (``stock``, see ``silver.seller_stock``), also on days without an offer; a stock that details state counts
    before the snapshot's. Rows are reduced to one per product, seller and day first, so a window group is as long as the
    look-back at most.
    """
    rows = recent_offers(offers, as_of, days)
    daily = daily_seller_prices(rows.where(P.other_seller(_seller(rows), seller)))
    if "stock" not in offers.columns:
        if gold is None and stock is None:
            raise ValueError("offers have no stock column: pass the snapshots as gold, or the sellers' stock")
        today = as_of_date(as_of, offers)
        daily = daily.drop("stock")
        if gold is not None:
            stated = _stated_stock(recent(gold, today, days)).withColumnRenamed("stock", "_held")
            daily = daily.unionByName(stated.where(P.other_seller(F.col("seller_key"), seller)), allowMissingColumns=True)
        if stock is not None:
            stated = recent(stock, today, days).select("asin", "seller_key", "snapshot_date", F.col("stock").alias("_stated"))
            daily = daily.unionByName(stated.where(P.other_seller(F.col("seller_key"), seller)), allowMissingColumns=True)
        known = [F.max(c) for c in ("_stated", "_held") if c in daily.columns]
        daily = daily.groupBy("asin", "seller_key", "snapshot_date").agg(F.max("price").alias("price"), F.coalesce(*known).alias("stock"))
    before = (
        Window.partitionBy("asin", "seller_key").orderBy("snapshot_date").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        daily.withColumns({f"prev_{c}": F.last(c, ignorenulls=True).over(before) for c in ("price", "stock")})
        .where((F.col("price") != F.col("prev_price")) | (F.col("stock") != F.col("prev_stock")))
        .withColumns(
            {
                "price_change": F.col("price") - F.col("prev_price"),
                "stock_change": F.col("stock") - F.col("prev_stock"),
            }
        )
    )


def assortment_gaps(
    gold: DataFrame, offers: DataFrame, seller: str, as_of: AsOf = None, days: int = 30
) -> DataFrame:
    """Products of the categories the seller is active in that the seller does not offer."""
    rows = recent_offers(offers, as_of, days)
    mine = rows.where(P.same_seller(_seller(rows), seller))
    market = recent(gold, as_of, days).groupBy("category_label", "asin").agg(
        F.max("snapshot_date").alias("last_seen"), F.min("min_total_price").alias("lowest_price")
    )
    return market.join(mine.select("category_label").distinct(), "category_label", "left_semi").join(
        mine.select("asin").distinct(), "asin", "left_anti"
    )


def undercutting(offers: DataFrame, seller: str, as_of: AsOf = None, days: int = 14) -> DataFrame:
    """Rivals cheaper than the seller on a product and day.

    The seller's side is one price per product and day, so each rival row meets one row at most:
    the result grows with the rivals' rows, not with pairs of offers.
    """
    daily = daily_seller_prices(recent_offers(offers, as_of, days))
    mine = daily.where(P.same_seller(F.col("seller_key"), seller)).select(
        "asin", "snapshot_date", F.col("price").alias("my_price")
    )
    rivals = daily.where(P.other_seller(F.col("seller_key"), seller)).drop("stock")
    return (
        rivals.join(mine, ["asin", "snapshot_date"])
        .where(F.col("price") < F.col("my_price"))
        .withColumn("undercut_by", F.col("my_price") - F.col("price"))
    )


def category_price_drops(gold: DataFrame, as_of: AsOf = None, days: int = 14) -> DataFrame:
    """Days on which a category's average price fell against its previous day."""
    daily = recent(gold, as_of, days).groupBy("category_label", "snapshot_date").agg(
        F.avg("pdp_total_price").alias("avg_price"), F.count("*").alias("products")
    )
    by_day = Window.partitionBy("category_label").orderBy("snapshot_date")
    return (
        daily.withColumn("prev_avg_price", F.lag("avg_price").over(by_day))
        .where(F.col("avg_price") < F.col("prev_avg_price"))
        .withColumn("drop_pct", (F.col("prev_avg_price") - F.col("avg_price")) / F.col("prev_avg_price") * 100)
    )


def low_stock(gold: DataFrame, seller: str, threshold: int = 5, as_of: AsOf = None, days: int = 2) -> DataFrame:
    """Recent rows the seller holds with little stock."""
    rows = recent(gold, as_of, days)
    return rows.where(
        P.same_seller(P.seller_key(rows, HOLDER), seller)
        & (F.col("buybox_stock").try_cast("int") <= threshold)
    ).select("snapshot_date", "asin", HOLDER, "buybox_stock")


def losses(gold: DataFrame, seller: str, as_of: AsOf = None, days: int = 14) -> DataFrame:
    """Rows at which the seller gave up the buy box."""
    return holder_changes(gold, seller, as_of, days).where(
        P.same_seller(F.col("prev_key"), seller)
    ).drop("now_key", "prev_key")


def lost_out_of_stock(
    gold: DataFrame, offers: DataFrame, seller: str, threshold: int = 5, as_of: AsOf = None, days: int = 14
) -> DataFrame:
    """Buy boxes lost on a day the seller had little or no stock; no offer that day counts as none.

    Offers without a ``stock`` column, as in the silver table, leave the stock that the snapshots last stated while the
    seller held the product; a loss before which none was stated as a number is not reported.
    """
    if "stock" not in offers.columns:
        return _lost_after_low_stock(gold, seller, threshold, as_of, days)
    rows = recent_offers(offers, as_of, days)
    stock = (
        rows.where(P.same_seller(_seller(rows), seller))
        .groupBy("asin", "snapshot_date")
        .agg(F.max("stock").alias("my_stock"))
    )
    return (
        losses(gold, seller, as_of, days)
        .join(stock, ["asin", "snapshot_date"], "left")
        .where(F.coalesce("my_stock", F.lit(0)) <= threshold)
    )


def _lost_after_low_stock(gold: DataFrame, seller: str, threshold: int, as_of: AsOf, days: int) -> DataFrame:
    """A product has one snapshot a day, so a loss meets as many rows as the look-back has days at most."""
    rows = recent(gold, as_of, days)
    held = rows.where(P.same_seller(P.seller_key(rows, HOLDER), seller)).select(
        "asin", F.col("snapshot_date").alias("held_on"), F.col("buybox_stock").try_cast("int").alias("held_stock")
    )
    lost = losses(gold, seller, as_of, days)
    stock = (
        lost.select("asin", "snapshot_date")
        .join(held.where("held_stock is not null"), "asin")
        .where("held_on < snapshot_date")
        .groupBy("asin", "snapshot_date")
        .agg(F.max_by("held_stock", "held_on").alias("my_stock"))
    )
    return lost.join(stock.where(F.col("my_stock") <= threshold), ["asin", "snapshot_date"])


def new_sellers(offers: DataFrame, seller: str, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """Sellers first seen within the window on a product the seller offers."""
    today = as_of_date(as_of, offers)
    key = _seller(offers)
    mine = offers.where(P.same_seller(key, seller)).select("asin").distinct()
    # Products are cut before the history is grouped: the filter on first_seen would keep the join above it.
    theirs = offers.where(P.other_seller(key, seller)).join(mine, "asin", "left_semi")
    firsts = theirs.groupBy("asin", key.alias("seller_key")).agg(F.min("snapshot_date").alias("first_seen"))
    return firsts.where(F.col("first_seen") >= F.date_sub(today, days))


def main_competitors(
    gold: DataFrame, seller: str, asins: Sequence[str] | None = None, as_of: AsOf = None, days: int = 14
) -> DataFrame:
    """The other seller who held each product's buy box on most days, ties by name.

    Two aggregates instead of a rank: days per product and holder, then the largest count.
    """
    rows = recent(gold, as_of, days)
    rows = rows.where(P.other_seller(P.seller_key(rows, HOLDER), seller))
    listed = P.asin_in(asins)
    rows = rows if listed is None else rows.where(listed)
    held = rows.groupBy("asin", F.col(HOLDER).alias("competitor")).agg(
        F.count("*").alias("days_won"), F.avg("pdp_total_price").alias("avg_price")
    )
    # min over (-days, name): most days first, then the first name.
    return (
        held.groupBy("asin")
        .agg(F.min(F.struct((-F.col("days_won")).alias("d"), "competitor", "avg_price")).alias("top"))
        .select("asin", "top.competitor", (-F.col("top.d")).alias("days_won"), "top.avg_price")
    )


def rivals_and_shadows(gold: DataFrame, seller: str, as_of: AsOf = None, days: int = 14) -> DataFrame:
    """Other sellers of the window: ``active`` if they hold a buy box now, else ``shadow``."""
    now = current_owners(gold, seller, latest=as_of, limit=None)
    past = competitor_history(gold, seller, as_of=as_of, days=days, limit=None)
    return past.join(now, F.col("historical_competitor") == F.col("current_owner"), "left").select(
        F.col("historical_competitor").alias("competitor"),
        F.when(F.col("current_owner").isNull(), "shadow").otherwise("active").alias("role"),
        "days_won_buybox",
        F.coalesce("products_won_today", F.lit(0).cast("bigint")).alias("products_won_today"),
        "avg_winning_price",
    )


def shadow_competitors(gold: DataFrame, seller: str, as_of: AsOf = None, days: int = 14) -> DataFrame:
    """Holders of the window who hold nothing now."""
    return rivals_and_shadows(gold, seller, as_of, days).where("role = 'shadow'").drop("role", "products_won_today")


def top_risks(
    gold: DataFrame,
    listing: DataFrame,
    seller: str,
    as_of: AsOf = None,
    days: int = 2,
    position_below: int = 50,
    limit: int | None = None,
) -> DataFrame:
    """Buy boxes lost on well-placed products, best position first; ``limit`` keeps the first few."""
    placed = listing.where(F.col("position") < position_below).groupBy("asin").agg(
        F.min("position").alias("position")
    )
    risks = losses(gold, seller, as_of, days).join(placed, "asin").orderBy("position", F.col("snapshot_date").desc(), "asin")
    return risks if limit is None else risks.limit(limit)


def review_summary(details: DataFrame) -> DataFrame:
    """Ratings and review counts per category over each product's detail rows."""
    return (
        details.where("item_status = 'ok'")
        .groupBy(stripped(F.col("category_label")).alias("category_label"))
        .agg(
            F.count("*").alias("products"),
            F.avg("rating").alias("avg_rating"),
            F.sum("review_count").alias("review_count"),
            (F.sum(F.col("rating") * F.col("review_count")) / F.sum(F.when(F.col("rating").isNotNull(), F.col("review_count")))).alias("weighted_rating"),
        )
    )
