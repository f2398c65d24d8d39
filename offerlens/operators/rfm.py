"""Recency, frequency and monetary variables of established sellers.

The 24-cycle history is reduced once to one row per seller, offer, product and
cycle (:func:`cycle_sales`); every window sum, frequency, recency and trigger
count is then a plain aggregate of that short frame, in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_count, cycle_set
from offerlens.functions.frames import seller_offer_grid, spread_join
from offerlens.functions.scoring import dbl, ratio
from offerlens.params import BUNDLE, HISTORY_CYCLES, SINGLE, RunParams

KEYS = ["seller_id", "offer_id", "product_id"]
GRID_MEASURES = ["sales_6c", "sales_prev6", "sales_6c_ly", "sales_24c", "mean_24c",
                 "frequency_24c", "recency_24c", "repurchase_cycle", "repurchase_gap",
                 "min_sale_6c", "optimal_price", "trigger_rate", "min_price"]


def of_type(df: DataFrame, offer_type: str) -> DataFrame:
    return df.where(F.col("offer_type") == offer_type)


# ---- products of the run -----------------------------------------------------
def grid_products(items: DataFrame, offer_type: str) -> DataFrame:
    """Products of the offers of one type, described."""
    return (of_type(items, offer_type).where(F.col("descr").isNotNull())
            .groupBy("offer_id", "offer_type", "product_id", "units",
                     F.col("price").alias("list_price"), "flag_top")
            .agg(F.max("descr").alias("descr")))


# ---- history -----------------------------------------------------------------
def cycle_sales(tagged: DataFrame) -> DataFrame:
    """Sales per seller, offer, product and cycle.  ``enough`` is 1 when a line
    of the cycle reached the units the offer asks for."""
    return (tagged.groupBy("offer_type", *KEYS, "cycle")
            .agg(F.sum("net").alias("net"), F.count("*").alias("lines"),
                 F.max(F.when(F.col("units") >= F.col("offer_units"), 1).otherwise(0))
                 .alias("enough")))


def _sum_between(lo: int, hi: int) -> Column:
    return F.coalesce(F.sum(F.when(F.col("cycle").between(lo, hi), F.col("net"))), F.lit(0))


def product_history(cycles: DataFrame, run: RunParams) -> DataFrame:
    """Window sums, frequency, recency and totals per seller, offer, product.

    The three six-cycle windows are the last six cycles, the six before them
    and the same six a year (18 cycles) earlier.
    """
    p = run.process_cycle
    return (cycles.groupBy("offer_type", *KEYS).agg(
        _sum_between(p - 5, p).alias("sales_6c"),
        _sum_between(p - 11, p - 6).alias("sales_prev6"),
        _sum_between(p - 23, p - 18).alias("sales_6c_ly"),
        F.sum("net").alias("sales_24c"),
        F.count("cycle").alias("frequency_24c"),
        (F.lit(p) - F.max("cycle")).alias("recency_24c"),
        F.min("cycle").alias("first_cycle"),
        F.sum("lines").alias("lines"),
        F.sum("enough").alias("enough_orders"))
        .where(F.col("sales_24c") > 0)
        .withColumn("mean_24c", ratio("sales_24c", "frequency_24c")))


def repurchase_cycle(history: DataFrame, run: RunParams) -> DataFrame:
    """Mean cycles between purchases: the span between the first and the last
    purchase over (lines - 1); products bought on one line have none."""
    span = (F.lit(HISTORY_CYCLES - 1) - (F.col("first_cycle") - F.lit(run.start))
            - F.col("recency_24c"))
    return history.withColumn(
        "repurchase_cycle",
        F.when(F.col("lines") > 1, ratio(span, F.col("lines") - 1)))


# ---- trigger rate ------------------------------------------------------------
def listed_rows(tagged: DataFrame, catalog: DataFrame) -> DataFrame:
    """(product, cycle) pairs where a sold item was in the price list."""
    return (tagged.select("product_id", "item_id", "cycle", "offer_kind", "sales_code").distinct()
            .join(catalog, ["item_id", "cycle", "offer_kind", "sales_code"], "left_semi")
            .select("product_id", "cycle"))


def listed_cycles(tagged: DataFrame, catalog: DataFrame, run: RunParams) -> DataFrame:
    """Set of listed cycles per product."""
    return (listed_rows(tagged, catalog).groupBy("product_id")
            .agg(cycle_set("cycle", run.start).alias("listed")))


def listed_and_ordered(history: DataFrame, listed: DataFrame, activity: DataFrame) -> DataFrame:
    """Cycles in which the product was listed and the seller ordered."""
    return (spread_join(history.select(*KEYS, "enough_orders"), listed, ["product_id"])
            .join(activity.select("seller_id", "order_cycles"), "seller_id")
            .select(*KEYS, "enough_orders",
                    cycle_count(F.col("listed").bitwiseAND(F.col("order_cycles")))
                    .alias("listed_cycles"))
            .where(F.col("listed_cycles") > 0))


def trigger_rates(listed: DataFrame) -> DataFrame:
    """Orders with enough units over listed-and-ordered cycles."""
    return (listed.where(F.col("enough_orders") > 0)
            .select(*[c for c in listed.columns if c not in ("enough_orders", "listed_cycles")],
                    ratio("enough_orders", "listed_cycles").alias("trigger_rate")))


# ---- optimal price -----------------------------------------------------------
def price_table(tagged: DataFrame, prices: DataFrame, activity: DataFrame,
                run: RunParams) -> DataFrame:
    """Per seller, offer product and price: in how many cycles the seller was
    exposed to the price (and ordered), and in how many it bought at it.

    Both counts are sets of cycles under the same keys, so they are stacked and
    reduced in a single aggregation instead of being joined afterwards.
    """
    keys = [*KEYS, "price"]
    listed = prices.select("item_id", "cycle", "offer_kind", "sales_code", "price").distinct()
    at_price = listed.groupBy("item_id", "price").agg(cycle_set("cycle", run.start).alias("shown"))
    zero = F.lit(0).cast("long")
    exposed = (tagged.select(*KEYS, "item_id").distinct()
               .join(at_price, "item_id")
               .join(activity.select("seller_id", "order_cycles"), "seller_id")
               .select(*keys, F.col("shown").bitwiseAND(F.col("order_cycles")).alias("exposed"),
                       zero.alias("pure")))
    pure = (tagged.join(listed, ["item_id", "cycle", "offer_kind", "sales_code"])
            .select(*keys, zero.alias("exposed"),
                    F.expr(f"shiftleft(1L, cycle - {run.start})").alias("pure")))
    return (exposed.unionByName(pure).groupBy(*keys)
            .agg(cycle_count(F.bit_or("exposed")).alias("exposures"),
                 cycle_count(F.bit_or("pure")).alias("pure_orders"))
            .where(F.col("exposures") > 0)
            .withColumn("probability", ratio("pure_orders", "exposures")))


def optimal_prices(table: DataFrame) -> DataFrame:
    """Best price: highest probability, then most pure orders, then cheapest.

    An aggregate, not a ranking window: it combines on the map side.
    """
    best = F.struct("probability", "pure_orders", (-F.col("price")).alias("cheap"))
    return table.groupBy(*KEYS).agg(F.max_by("price", best).alias("optimal_price"))


def minimum_prices(table: DataFrame) -> DataFrame:
    return table.groupBy("offer_id", "product_id").agg(F.min("price").alias("min_price"))


# ---- single-offer grid -------------------------------------------------------
def single_variables(history: DataFrame, rates: DataFrame, prices: DataFrame) -> DataFrame:
    """All variables of the products a seller bought."""
    return (history.join(rates, KEYS, "left").join(prices, KEYS, "left")
            .select(*KEYS, "sales_6c", "sales_prev6", "sales_6c_ly", "sales_24c", "mean_24c",
                    "frequency_24c", "recency_24c", "trigger_rate", "optimal_price",
                    F.lit(1).alias("flag_bought")))


def _fill(grid: DataFrame) -> DataFrame:
    """Grid contract: every measure a double, 0 where the seller has none."""
    have = set(grid.columns)
    return grid.withColumns({
        **{m: F.coalesce(dbl(m), F.lit(0.0)) if m in have else F.lit(0.0) for m in GRID_MEASURES},
        "flag_bought": F.coalesce(F.col("flag_bought"), F.lit(0)),
    })


def grid_columns(base: DataFrame) -> list[str]:
    return [*base.columns, "offer_id", "offer_type", "product_id", "descr", "flag_top",
            "units", "list_price", *GRID_MEASURES, "flag_bought"]


def _own_grid(base: DataFrame, offers: DataFrame, variables: DataFrame,
              parts: int | None) -> DataFrame:
    """The grid with the sellers' own variables, null where a seller has none.

    A seller has at most one row of variables per offer product.  They are packed per seller
    and joined before the grid is unfolded: sellers move, dealt over ``parts``, and of the
    grid itself, the larger side, no row does.
    """
    def dealt(df: DataFrame) -> DataFrame:
        return df if parts is None else df.repartition(parts, "seller_id")

    measures = [c for c in variables.columns if c not in KEYS]
    own = (dealt(variables).groupBy("seller_id")
           .agg(F.collect_list(F.struct("offer_id", "product_id", *measures)).alias("_own")))
    grid = seller_offer_grid(dealt(base).join(own, "seller_id", "left"), offers)
    mine = F.filter("_own", lambda v: (v["offer_id"] == F.col("offer_id"))
                    & (v["product_id"] == F.col("product_id")))
    return (grid.withColumn("_mine", F.get(mine, F.lit(0)))
            .select(*[c for c in grid.columns if c != "_own"],
                    *[F.col(f"_mine.{m}").alias(m) for m in measures]))


def single_grid(base: DataFrame, products: DataFrame, variables: DataFrame,
                parts: int | None = None) -> DataFrame:
    """Every seller with every single-offer product, 0 where nothing was bought."""
    return _fill(_own_grid(base, products, variables, parts)).select(*grid_columns(base))


# ---- bundles -----------------------------------------------------------------
def bundle_sizes(products: DataFrame) -> DataFrame:
    return (products.groupBy("offer_id", "offer_type")
            .agg(F.count("product_id").alias("n_products")))


def bundle_cycles(cycles: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per seller, bundle and cycle: total, whether every product was bought and
    whether every product was bought in enough units."""
    return (of_type(cycles, BUNDLE).groupBy("seller_id", "offer_id", "cycle")
            .agg(F.sum("net").alias("net"), F.count("product_id").alias("bought"),
                 F.sum("enough").alias("enough"))
            .where(F.col("net") > 0)
            .transform(spread_join, sizes.select("offer_id", "n_products"), ["offer_id"])
            .select("seller_id", "offer_id", "cycle", "net",
                    (F.col("bought") == F.col("n_products")).alias("complete"),
                    (F.col("enough") == F.col("n_products")).alias("enough_complete")))


def bundle_history(cycles: DataFrame, run: RunParams) -> DataFrame:
    """Totals over the cycles in which the whole bundle was bought."""
    done = cycles.where("complete")
    recent = F.col("cycle") >= run.recent_start
    return (done.groupBy("seller_id", "offer_id").agg(
        F.sum("net").alias("sales_24c"),
        (F.lit(run.process_cycle) - F.max("cycle")).alias("recency_24c"),
        F.count("cycle").alias("frequency_24c"),
        F.min(F.when(recent, F.col("net"))).alias("min_sale_6c"),
        F.sum(F.col("enough_complete").cast("int")).alias("enough_orders")))


def bundle_listed_cycles(items: DataFrame, sizes: DataFrame, catalog: DataFrame,
                         run: RunParams) -> DataFrame:
    """Cycles in which every product of the bundle was in the price list."""
    in_window = F.col("cycle").between(run.start, run.process_cycle)
    per_item = (catalog.where(in_window).groupBy("item_id")
                .agg(cycle_set("cycle", run.start).alias("listed")))
    per_product = (of_type(items, BUNDLE).select("offer_id", "product_id", "item_id")
                   .join(per_item, "item_id")
                   .groupBy("offer_id", "product_id").agg(F.bit_or("listed").alias("listed")))
    return (per_product.groupBy("offer_id")
            .agg(F.bit_and("listed").alias("listed"), F.count("product_id").alias("n"))
            .join(sizes.select("offer_id", "n_products"), "offer_id")
            .where(F.col("n") == F.col("n_products")).select("offer_id", "listed"))


def bundle_listed_and_ordered(history: DataFrame, listed: DataFrame,
                              activity: DataFrame) -> DataFrame:
    return (spread_join(history.select("seller_id", "offer_id", "enough_orders"), listed, ["offer_id"])
            .join(activity.select("seller_id", "order_cycles"), "seller_id")
            .select("seller_id", "offer_id", "enough_orders",
                    cycle_count(F.col("listed").bitwiseAND(F.col("order_cycles")))
                    .alias("listed_cycles"))
            .where(F.col("listed_cycles") > 0))


def bundle_offer_variables(history: DataFrame, rates: DataFrame) -> DataFrame:
    """Bundle-level variables: mean, trigger rate, recency, frequency."""
    return (history.join(rates, ["seller_id", "offer_id"], "left")
            .select("seller_id", "offer_id", "recency_24c", "frequency_24c", "trigger_rate",
                    "min_sale_6c", ratio("sales_24c", "frequency_24c").alias("mean_24c"),
                    F.lit(1).alias("flag_bought")))


def bundle_product_variables(history: DataFrame, prices: DataFrame) -> DataFrame:
    """Product-level variables of bundles: windows, totals, repurchase cycle."""
    cycle = F.coalesce(F.col("repurchase_cycle"), F.lit(0.0))
    return (history.join(prices, KEYS, "left")
            .select(*KEYS, "sales_6c", "sales_prev6", "sales_6c_ly", "sales_24c",
                    cycle.alias("repurchase_cycle"),
                    (cycle - F.col("recency_24c")).alias("repurchase_gap"), "optimal_price"))


def bundle_grid(base: DataFrame, products: DataFrame, product_variables: DataFrame,
                offer_variables: DataFrame, min_prices: DataFrame,
                parts: int | None = None) -> DataFrame:
    """Every seller with every bundle product and its minimum price.

    A bundle bought as a whole has a history row for each of its products, so
    both kinds of variables are put together before they meet the grid.
    """
    priced = products.join(min_prices, ["offer_id", "product_id"], "left")
    variables = product_variables.join(offer_variables, ["seller_id", "offer_id"], "left")
    return _fill(_own_grid(base, priced, variables, parts)).select(*grid_columns(base))
