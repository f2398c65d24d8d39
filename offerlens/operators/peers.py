"""Peer groups: what comparable sellers buy, used to fill non-buyers.

One set of functions serves both groupings; ``keys`` is either region and
segment, or the external profile.  Sellers without a profile belong to no
profile group and keep their own values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_count, cycle_set
from offerlens.functions.frames import spread_join
from offerlens.functions.scoring import dbl, mean_of, ratio
from offerlens.params import HISTORY_CYCLES, NEVER_BOUGHT_RECENCY, RunParams

PRODUCT = ["offer_id", "product_id"]


def group_sizes(base: DataFrame, keys: list[str]) -> DataFrame:
    return base.groupBy(*keys).agg(F.count_distinct("seller_id").alias("group_sellers"))


# ---- potential sales ---------------------------------------------------------
def potential_sales(single_sales: DataFrame, geography: DataFrame, run: RunParams) -> DataFrame:
    """Sales per invoice; by region and segment the region is that of the sale's
    territory."""
    place = []
    if run.peer_grouping == 1:
        single_sales = spread_join(single_sales, geography.select("territory", "region_id"), ["territory"])
        place = ["region_id"]
    return (single_sales.groupBy(*place, "seller_id", *PRODUCT, "cycle", "invoice")
            .agg(F.sum("net").alias("potential")).where(F.col("potential") > 0))


def seller_traits(activity: DataFrame, base: DataFrame, run: RunParams) -> DataFrame:
    """Sellers active at the process cycle: web order flag and what places them
    in a group (present segment, or profile)."""
    active = (activity.where(F.col("active_now") == 1)
              .select("seller_id", "web_recent", F.col("segment_now").alias("segment")))
    if run.peer_grouping == 1:
        return active
    return (active.drop("segment")
            .join(base.select("seller_id", "peer_profile"), "seller_id"))


def active_potential(potential: DataFrame, traits: DataFrame, run: RunParams) -> DataFrame:
    """Potential sales of active sellers with their group (a report)."""
    return (potential.join(traits, "seller_id")
            .select(*run.peer_keys, "seller_id", *PRODUCT, "cycle", "invoice", "potential",
                    "web_recent"))


def peer_sellers(potential: DataFrame, traits: DataFrame, run: RunParams) -> DataFrame:
    """Per active seller and product, what the group averages need, in one pass:
    six-cycle minimum and order cycles, 24-cycle recency and order cycles (both
    for sellers with a web order only), and the repurchase cycle (all sellers).

    The seller's traits join after the reduction, where a seller has one row per
    product, so no invoice or line is ever shuffled by seller alone.
    """
    recent = F.col("cycle") >= run.recent_start
    rows = F.count("*")
    span = (F.lit(HISTORY_CYCLES - 1) - (F.min("cycle") - F.lit(run.start))
            - (F.lit(run.process_cycle) - F.max("cycle")))
    place = ["region_id"] if run.peer_grouping == 1 else []
    reduced = potential.groupBy(*place, "seller_id", *PRODUCT).agg(
        F.min(F.when(recent, F.col("potential"))).alias("min_sale"),
        cycle_count(cycle_set("cycle", run.start, recent)).alias("pure_6c"),
        (F.lit(run.process_cycle) - F.max("cycle")).alias("recency"),
        cycle_count(cycle_set("cycle", run.start)).alias("pure_24c"),
        F.when(rows > 1, ratio(span, rows - 1)).alias("repurchase_cycle"))
    web = F.col("web_recent") == 1
    return reduced.join(traits, "seller_id").select(
        *run.peer_keys, *PRODUCT, "seller_id",
        F.when(web, F.col("min_sale")).alias("min_sale"),
        F.when(web, F.col("pure_6c")).otherwise(0).alias("pure_6c"),
        F.when(web, F.col("recency")).alias("recency"),
        F.when(web, F.col("pure_24c")).otherwise(0).alias("pure_24c"), "repurchase_cycle")


# ---- group averages, single offers -------------------------------------------
def _with_digits(x: Column, run: RunParams) -> Column:
    """The group frequency is rounded to whole cycles by region and segment,
    and to one decimal by profile, before it is taken up to the next integer."""
    return F.ceil(F.round(x, 0 if run.peer_grouping == 1 else 1))


def recent_peers(sellers: DataFrame, sizes: DataFrame, run: RunParams) -> DataFrame:
    """Six-cycle figures per group and product.  The minimum sale is spread over
    the whole group, buyers or not."""
    keys = run.peer_keys
    return (sellers.where(F.col("pure_6c") > 0).groupBy(*keys, *PRODUCT).agg(
        mean_of("min_sale").alias("buyer_min_sale"),
        F.round(mean_of("pure_6c"), 1).alias("frequency_6c"),
        F.sum("min_sale").alias("total_min_sale"))
        .join(sizes, keys)
        .select(*keys, *PRODUCT, "buyer_min_sale", "frequency_6c",
                F.round(ratio("total_min_sale", "group_sellers"), 2).alias("min_sale")))


def history_peers(sellers: DataFrame, prices: DataFrame, min_prices: DataFrame,
                  sizes: DataFrame, run: RunParams) -> DataFrame:
    """24-cycle figures per group and product.

    Frequency, recency and price count every seller of the group: those who
    never bought weigh in with no order, recency 24 and the minimum price.
    Sales outside any group of the base (no profile) form no peer row.
    """
    keys = run.peer_keys
    buyer = F.col("pure_24c") > 0
    priced = buyer & F.col("optimal_price").isNotNull()
    recency = F.when(F.col("recency") == 0, NEVER_BOUGHT_RECENCY).otherwise(F.col("recency"))
    df = (sellers.join(prices, ["seller_id", *PRODUCT], "left")
          .groupBy(*keys, *PRODUCT).agg(
              F.count_if(buyer).alias("buyers"),
              mean_of(F.when(buyer, F.col("recency"))).alias("buyer_recency"),
              _with_digits(mean_of(F.when(buyer, F.col("pure_24c"))), run).alias("buyer_frequency"),
              F.ceil(mean_of("repurchase_cycle")).alias("repurchase_cycle"),
              F.sum(F.when(priced, F.col("pure_24c"))).alias("total_pure"),
              F.sum(F.when(priced, recency)).alias("total_recency"),
              F.sum(F.when(priced, F.col("optimal_price"))).alias("total_price"),
              F.count_if(priced).alias("priced_buyers"))
          .where(F.col("buyers") > 0)
          .join(sizes, keys).join(min_prices, PRODUCT, "left"))
    rest = F.col("group_sellers") - F.col("priced_buyers")
    known = (F.col("priced_buyers") > 0) & (F.col("group_sellers") > 0)
    return df.select(
        *keys, *PRODUCT, "buyer_recency", "buyer_frequency", "priced_buyers", "group_sellers",
        F.coalesce(F.col("repurchase_cycle"), F.lit(0)).alias("repurchase_cycle"),
        F.when(known, F.round(ratio("total_pure", "group_sellers"), 2))
        .otherwise(dbl("buyer_frequency")).alias("frequency"),
        F.when(known, ratio(F.col("total_recency") + F.lit(NEVER_BOUGHT_RECENCY) * rest,
                            "group_sellers"))
        .otherwise(F.col("buyer_recency")).alias("recency"),
        F.when(known, ratio(F.col("total_price") + F.col("min_price") * rest, "group_sellers"))
        .otherwise(F.lit(0.0)).alias("optimal_price"))


# ---- fill, single offers -----------------------------------------------------
def fill_single(grid: DataFrame, history: DataFrame, recent: DataFrame,
                run: RunParams) -> DataFrame:
    """Non-buyers take frequency, recency and price of their peers; everyone
    takes the group's repurchase cycle and minimum sale."""
    on = [*run.peer_keys, *PRODUCT]
    h = history.select(*on, F.col("repurchase_cycle").alias("_cycle"),
                       F.col("frequency").alias("_freq"), F.col("recency").alias("_rec"),
                       F.col("optimal_price").alias("_price"))
    r = recent.select(*on, F.col("min_sale").alias("_min"))
    absent = F.col("flag_bought") == 0

    def peer(own: str, theirs: str) -> Column:
        return F.when(absent, F.coalesce(F.col(theirs), F.col(own))).otherwise(F.col(own))

    # Two short frames of known size on one placement of the grid.
    filled = spread_join(spread_join(grid, h, on, "left"), r, on, "left")
    return (filled.withColumns({
        "repurchase_cycle": F.coalesce(dbl("_cycle"), F.col("repurchase_cycle")),
        "min_sale_6c": F.coalesce(F.col("_min"), F.col("min_sale_6c")),
        "frequency_24c": peer("frequency_24c", "_freq"),
        "recency_24c": peer("recency_24c", "_rec"),
        "optimal_price": peer("optimal_price", "_price"),
    }).select(*grid.columns))


def offer_averages(filled: DataFrame, run: RunParams) -> DataFrame:
    """Trigger rate and frequency per group and offer, over buyers and others."""
    return (filled.groupBy(*run.peer_keys, "offer_id")
            .agg(mean_of("trigger_rate").alias("trigger_rate"),
                 mean_of("frequency_24c").alias("frequency_24c")))


def fill_trigger(filled: DataFrame, averages: DataFrame, run: RunParams) -> DataFrame:
    on = [*run.peer_keys, "offer_id"]
    a = averages.select(*on, F.col("trigger_rate").alias("_trigger"))
    return (spread_join(filled, a, on, "left")
            .withColumn("trigger_rate",
                        F.when(F.col("flag_bought") == 0,
                               F.coalesce(F.col("_trigger"), F.col("trigger_rate")))
                        .otherwise(F.col("trigger_rate")))
            .select(*filled.columns))


def single_peer_table(history: DataFrame, recent: DataFrame, averages: DataFrame,
                      run: RunParams) -> DataFrame:
    """The peer-group table of single offers."""
    on = [*run.peer_keys, *PRODUCT]
    return (history.join(recent.select(*on, F.col("min_sale").alias("min_sale_6c")), on)
            .join(averages.select(*run.peer_keys, "offer_id", "trigger_rate"),
                  [*run.peer_keys, "offer_id"])
            .select(*on, F.col("frequency").alias("frequency_24c"),
                    F.col("recency").alias("recency_24c"), "optimal_price", "repurchase_cycle",
                    "min_sale_6c", "trigger_rate"))


# ---- bundles -----------------------------------------------------------------
def bundle_product_peers(grid: DataFrame, run: RunParams) -> DataFrame:
    """Repurchase cycle and minimum price per group and bundle product."""
    return (grid.groupBy(*run.peer_keys, *PRODUCT)
            .agg(F.ceil(mean_of("repurchase_cycle")).alias("repurchase_cycle"),
                 mean_of("min_price").alias("min_price")))


def fill_bundle(grid: DataFrame, peers: DataFrame, run: RunParams) -> DataFrame:
    on = [*run.peer_keys, *PRODUCT]
    p = peers.select(*on, dbl("repurchase_cycle").alias("_cycle"),
                     F.col("min_price").alias("_price"))
    return (spread_join(grid, p, on, "left").withColumns({
        "repurchase_cycle": F.coalesce(F.col("_cycle"), F.col("repurchase_cycle")),
        "optimal_price": F.when(F.col("optimal_price") == 0,
                                F.coalesce(F.col("_price"), F.col("optimal_price")))
        .otherwise(F.col("optimal_price"))}).select(*grid.columns))


def bundle_flags(grid: DataFrame) -> DataFrame:
    """Overdue repurchase; six-cycle sales not above last year's or the previous six."""
    return grid.withColumns({
        "flag_overdue": F.when(F.col("repurchase_gap") > 0, 1).otherwise(0),
        "flag_below_last_year":
            F.when(F.col("sales_6c") - F.col("sales_6c_ly") <= 0, 1).otherwise(0),
        "flag_below_previous":
            F.when(F.col("sales_6c") - F.col("sales_prev6") <= 0, 1).otherwise(0)})


def bundle_products_from_grid(grid: DataFrame, products: DataFrame) -> DataFrame:
    """Bundle products that appear in the grid with the prices found there."""
    described = (products.where(F.col("descr").isNotNull()).groupBy("product_id")
                 .agg(F.max("descr").alias("product_descr")))
    return (grid.groupBy("offer_id", "offer_type", "product_id", "units",
                         F.col("optimal_price").alias("price"), "flag_top")
            .agg(F.lit(1).alias("_one")).drop("_one").join(described, "product_id")
            .select("offer_id", "offer_type", "product_id", "units", "price", "flag_top",
                    "product_descr"))


def roll_up_bundle(grid: DataFrame, run: RunParams) -> DataFrame:
    """Bundle products -> bundle, per seller.  The price gap is the summed list
    price less the summed optimal price."""
    keys = ["seller_id", *_group_columns(run), "seniority", "offer_type", "offer_id"]
    mean = {c: mean_of(c).alias(c) for c in
            ("mean_24c", "frequency_24c", "recency_24c", "repurchase_cycle", "min_sale_6c",
             "trigger_rate")}
    total = {c: F.sum(c).alias(c) for c in
             ("sales_6c", "sales_prev6", "sales_6c_ly", "sales_24c", "repurchase_gap",
              "optimal_price", "flag_overdue", "flag_below_last_year", "flag_below_previous")}
    rec = mean_of("recency_24c")
    return (grid.groupBy(*keys).agg(
        *total.values(), *mean.values(),
        F.when(rec == 0, float(NEVER_BOUGHT_RECENCY)).otherwise(rec).alias("recency_or_24"),
        mean_of("flag_bought").alias("flag_bought"),
        mean_of("mean_24c").alias("sales_gap"),
        F.sum("list_price").alias("list_price"),
        F.max("flag_top").alias("flag_top"))
        .withColumn("gap", F.lit(0.0))
        .withColumn("price_gap", dbl("list_price") - F.col("optimal_price"))
        .drop("list_price"))


def _group_columns(run: RunParams) -> list[str]:
    return ["region_id", "segment"] + (["peer_profile"] if run.peer_grouping != 1 else [])


def bundle_offer_peers(rolled: DataFrame, run: RunParams) -> DataFrame:
    """Per group and bundle: averages over sellers; the price gap ignores zeros."""
    def per_seller(c):
        return ratio(F.sum(c), F.count_distinct("seller_id"))
    gap = F.when(F.col("price_gap") != 0, F.col("price_gap"))
    return (rolled.groupBy(*run.peer_keys, "offer_id", "seller_id")
            .agg(F.sum("min_sale_6c").alias("min_sale_6c"),
                 F.sum("frequency_24c").alias("frequency_24c"),
                 F.sum("trigger_rate").alias("trigger_rate"),
                 F.sum("recency_or_24").alias("recency_sum"), F.count("recency_or_24").alias("rows"),
                 F.sum(gap).alias("price_gap"))
            .groupBy(*run.peer_keys, "offer_id")
            .agg(mean_of("min_sale_6c").alias("min_sale_6c"),
                 mean_of("frequency_24c").alias("frequency_24c"),
                 ratio(F.sum("recency_sum"), F.sum("rows")).alias("recency_24c"),
                 mean_of("trigger_rate").alias("trigger_rate"),
                 mean_of("price_gap").alias("price_gap")))


def fill_bundle_offers(rolled: DataFrame, peers: DataFrame, run: RunParams) -> DataFrame:
    """Zero variables of a bundle take the peers' values.  Recency: by region
    and segment the seller's own with 0 read as 24; by profile the peers'."""
    on = [*run.peer_keys, "offer_id"]
    p = peers.select(*on, *[F.col(c).alias(f"_{c}") for c in
                            ("min_sale_6c", "frequency_24c", "recency_24c", "trigger_rate",
                             "price_gap")])

    def if_zero(test: str, own: str, theirs: str) -> Column:
        return F.when(F.col(test) == 0,
                      F.coalesce(F.col(theirs), F.col(own))).otherwise(F.col(own))

    recency = (F.col("recency_or_24") if run.peer_grouping == 1
               else if_zero("recency_24c", "recency_24c", "_recency_24c"))
    return spread_join(rolled, p, on, "left").withColumns({
        "sales_gap": if_zero("sales_gap", "sales_gap", "_min_sale_6c"),
        "frequency_24c": if_zero("frequency_24c", "frequency_24c", "_frequency_24c"),
        "trigger_rate": if_zero("trigger_rate", "trigger_rate", "_trigger_rate"),
        "price_gap": if_zero("optimal_price", "price_gap", "_price_gap"),
        "recency_24c": recency,
    }).select(*rolled.columns)


def bundle_peer_table(products: DataFrame, offers: DataFrame, run: RunParams) -> DataFrame:
    """The peer-group table of bundles: one row per group and bundle product."""
    return (products.join(offers, [*run.peer_keys, "offer_id"])
            .select(*run.peer_keys, *PRODUCT, "frequency_24c", "recency_24c",
                    F.col("min_price").alias("optimal_price"), "repurchase_cycle",
                    "min_sale_6c", "trigger_rate"))


def bundle_price_gap(rolled: DataFrame, products: DataFrame) -> DataFrame:
    """List price of a bundle less its optimal price, from the products of the
    run: the optimal price repeats on every product row and counts once."""
    return (spread_join(rolled.select("seller_id", "offer_id", "optimal_price"),
                        products.select("offer_id", "product_id", "list_price"), ["offer_id"])
            .groupBy("seller_id", "offer_id")
            .agg((F.sum("list_price").cast("double") - F.sum_distinct("optimal_price"))
                 .alias("price_gap")))
