"""Gaps of single offers, gifts, and the consolidated variable table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_count, cycle_set, cycle_text
from offerlens.functions.frames import spread_join
from offerlens.functions.scoring import dbl, mean_of, ratio
from offerlens.params import HISTORY_CYCLES, VALID_PROFIT_KIND, RunParams

# Columns of the variable table, in order
MEASURES = [
    "sales_6c", "sales_prev6", "sales_6c_ly", "sales_24c", "mean_24c", "frequency_24c",
    "recency_24c", "repurchase_cycle", "repurchase_gap", "min_sale_6c", "gap", "sales_gap",
    "sales_gap_mc", "flag_bought", "optimal_price", "price_gap", "gift_gap", "n_listings",
    "trigger_rate", "gift_trigger", "frequency_z", "recency_z", "sales_gap_z", "sales_gap_mc_z",
    "price_gap_z", "trigger_z", "opportunity", "opportunity_mc", "opportunity_z",
    "opportunity_mc_z", "score", "score_mc", "total_units", "score_units", "score_mc_units",
]
VARIABLE_COLUMNS = ["seller_id", "region_id", "segment", "seniority", "offer_type", "offer_id",
                    *MEASURES, "official_profile", "flag_recommended", "flag_top"]
RUN_COLUMNS = ["country", "process_cycle", "target_cycle", "kind", "personalisation", "profile"]


# ---- single offers -----------------------------------------------------------
def single_gaps(filled: DataFrame) -> DataFrame:
    """Repurchase, price and sales gaps.

    The gap compares the last six cycles with last year (sellers of more than
    24 cycles) or with the six before; without a repeated purchase it stays 0.
    """
    repeated = (F.col("sales_24c") > 0) & (F.col("frequency_24c") > 1)
    return filled.withColumns({
        "repurchase_gap": F.col("recency_24c") - F.col("repurchase_cycle"),
        "price_gap": F.round(dbl("list_price") - F.col("optimal_price"), 4),
        "gap": F.when(repeated & (F.col("seniority") > HISTORY_CYCLES),
                      F.col("sales_6c") - F.col("sales_6c_ly"))
        .when(repeated, F.col("sales_6c") - F.col("sales_prev6")).otherwise(F.lit(0.0)),
        "sales_gap": F.when(F.col("sales_24c") <= 0, F.col("min_sale_6c"))
        .when(F.col("frequency_24c") >= 1, F.col("mean_24c")).otherwise(F.lit(0.0)),
    })


def roll_up_single(gaps: DataFrame) -> DataFrame:
    """Single-offer products -> offer, per seller."""
    total = ("sales_6c", "sales_prev6", "sales_6c_ly", "sales_24c", "repurchase_gap",
             "optimal_price")
    mean = ("mean_24c", "frequency_24c", "recency_24c", "repurchase_cycle", "min_sale_6c", "gap",
            "sales_gap", "flag_bought", "price_gap", "trigger_rate")
    return (gaps.groupBy("seller_id", "region_id", "segment", "seniority", "offer_type", "offer_id")
            .agg(*[F.sum(c).alias(c) for c in total], *[mean_of(c).alias(c) for c in mean],
                 F.max("flag_top").alias("flag_top")))


# ---- gifts -------------------------------------------------------------------
def gift_items(gifts: DataFrame, products: DataFrame) -> DataFrame:
    return (gifts.join(products, "product_id")
            .select("offer_id", "offer_type", "product_id", "units", "descr", "price", "brand",
                    "item_id"))


def gift_values(gifts: DataFrame, prices: DataFrame, kinds: DataFrame,
                units: DataFrame) -> DataFrame:
    """Value of the gifts of an offer per unit sold: the highest normal price of
    each item, averaged per gift product, times its units."""
    per_item = (prices.where(F.col("normal_price") > 0)
                .join(kinds.select("offer_kind").distinct(), "offer_kind", "left_semi")
                .groupBy("item_id").agg(F.max("normal_price").alias("normal_price")))
    per_product = (gifts.select("offer_id", "product_id", "units", "item_id").distinct()
                   .join(per_item, "item_id")
                   .groupBy("offer_id", "product_id", "units")
                   .agg((F.col("units") * F.round(mean_of("normal_price"), 2)).alias("value")))
    return (per_product.join(units, "offer_id").groupBy("offer_id")
            .agg(ratio(F.sum("value"), F.sum("total_units")).alias("gift_gap")))


def gift_orders(sales: DataFrame, kinds: DataFrame, base: DataFrame, run: RunParams) -> DataFrame:
    """Cycles in which a base seller received a gift (net 0, at least one unit).

    Lines are reduced to one row per seller on the map side before sellers are
    matched with the base.
    """
    ok = kinds.where(F.col("profit_kind") == VALID_PROFIT_KIND)
    return (sales.where(F.col("cycle").between(run.start, run.process_cycle)
                        & (F.col("cycle") == F.col("ref_cycle"))
                        & (F.col("net") == 0) & (F.col("units") >= 1))
            .join(ok, "offer_kind", "left_semi")
            .groupBy("seller_id").agg(cycle_count(cycle_set("cycle", run.start)).alias("gift_cycles"))
            .join(base.select("seller_id"), "seller_id", "left_semi"))


def ordered_cycles(activity: DataFrame) -> DataFrame:
    return (activity.select("seller_id", cycle_count("order_cycles").alias("ordered_cycles"))
            .where(F.col("ordered_cycles") > 0))


def gift_triggers(orders_with_gift: DataFrame, ordered: DataFrame) -> DataFrame:
    """Share of a seller's order cycles that carried a gift."""
    return (orders_with_gift.join(ordered, "seller_id")
            .select("seller_id", ratio("gift_cycles", "ordered_cycles").alias("gift_rate")))


# ---- consolidated table ------------------------------------------------------
def offer_extras(values: DataFrame, gifts: DataFrame, units: DataFrame) -> DataFrame:
    """One row per offer that has units, a gift or a gift value: gift_gap, has_gift, total_units."""
    with_gift = gifts.select("offer_id").distinct().withColumn("has_gift", F.lit(1))
    return values.join(with_gift, "offer_id", "full").join(units, "offer_id", "full")


def consolidate(single: DataFrame, bundle: DataFrame, extras: DataFrame,
                triggers: DataFrame) -> DataFrame:
    """Both offer types in one table, gifts taken into account.

    Offers without gifts and sellers without gift orders stay, unchanged.
    """
    shared = ["seller_id", "region_id", "segment", "seniority", "offer_type", "offer_id",
              "sales_6c", "sales_prev6", "sales_6c_ly", "sales_24c", "mean_24c", "frequency_24c",
              "recency_24c", "repurchase_cycle", "repurchase_gap", "min_sale_6c", "gap",
              "sales_gap", "flag_bought", "optimal_price", "price_gap", "trigger_rate", "flag_top"]
    df = (spread_join(single.select(*shared).unionByName(bundle.select(*shared)), extras, ["offer_id"], "left")
          .join(triggers, "seller_id", "left"))
    gift_gap = F.coalesce(F.col("gift_gap"), F.lit(0.0))
    gift_trigger = F.when(F.col("has_gift") == 1,
                          F.coalesce(F.sqrt("gift_rate") / 10, F.lit(0.0))).otherwise(F.lit(0.0))
    return df.withColumns({
        "gift_gap": gift_gap,
        "gift_trigger": gift_trigger,
        "price_gap": F.col("price_gap") - gift_gap,
        "trigger_rate": F.col("trigger_rate") + gift_trigger,
        "total_units": F.coalesce(F.col("total_units").cast("int"), F.lit(0)),
    }).drop("has_gift", "gift_rate")


def variable_table(df: DataFrame, run: RunParams) -> DataFrame:
    """The 44 variables and 6 run keys; what later steps compute starts at 0."""
    have = set(df.columns)
    start = {m: F.lit(0.0) for m in MEASURES if m not in have}
    return df.withColumns({
        **start, "n_listings": F.lit(0), "official_profile": F.lit("A"),
        "flag_recommended": F.lit(0), "country": F.lit(run.country),
        "process_cycle": F.lit(cycle_text(run.process_cycle)),
        "target_cycle": F.lit(cycle_text(run.target_cycle)), "kind": F.lit(run.kind),
        "personalisation": F.lit(run.personalisation), "profile": F.lit(run.profile),
    }).select(*VARIABLE_COLUMNS, *RUN_COLUMNS)
