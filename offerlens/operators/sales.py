"""Offer products, valid sales, seller status history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_set
from offerlens.functions.frames import update_from
from offerlens.params import (BUNDLE, CATALOGUE_VEHICLES, EXCLUDED_OFFER_KINDS,
                              VALID_PROFIT_KIND, WEB_CHANNELS, RunParams)


# ---- offers x products -------------------------------------------------------
def offer_items(offers: DataFrame, products: DataFrame) -> DataFrame:
    """Every item that belongs to a product of an offer."""
    return (offers.join(products, "product_id")
            .select("offer_type", "offer_id", "product_id", "units", "descr", "price", "brand",
                    "item_id", "flag_top"))


def offer_products(offers: DataFrame, products: DataFrame) -> DataFrame:
    """One row per product of an offer with its descriptive columns.

    The descriptions are first reduced to one row per product, so the join is
    on two short frames however many items a product has.
    """
    described = (products.where(F.col("descr").isNotNull()).groupBy("product_id")
                 .agg(F.max("descr").alias("descr"), F.max("brand").alias("brand"),
                      F.max("category").alias("category")))
    return (offers.join(described, "product_id")
            .groupBy("product_id", "offer_type", "offer_id", "sales_code", "units", "price",
                     "parent", "flag_top")
            .agg(F.max("descr").alias("descr"), F.max("brand").alias("brand"),
                 F.max("category").alias("category"), F.max("limit_units").alias("limit_units"),
                 F.max("flag_last_minute").alias("flag_last_minute"),
                 F.lit("").alias("item_code")))


def with_item_code(products_of_offers: DataFrame, catalog: DataFrame, products: DataFrame,
                   run: RunParams) -> DataFrame:
    """Item code from the target-cycle price list, by sales code.

    Several items may share a sales code; the smallest is taken, so the update
    has one value per product.
    """
    listed = catalog.where(F.col("cycle") == run.target_cycle).select("sales_code", "item_id")
    known = products.select("item_id").distinct()
    codes = (listed.join(known, "item_id", "left_semi")
             .groupBy("sales_code").agg(F.min("item_id").alias("item_id"))
             .join(products_of_offers.select("sales_code", "product_id"), "sales_code")
             .groupBy("product_id").agg(F.min("item_id").cast("string").alias("item_code")))
    return update_from(products_of_offers, codes, ["product_id"], ["item_code"])


def offer_units(products_of_offers: DataFrame) -> DataFrame:
    return (products_of_offers.groupBy("offer_id")
            .agg(F.sum("units").alias("total_units")))


# ---- sales -------------------------------------------------------------------
def valid_kinds(kinds: DataFrame) -> DataFrame:
    return kinds.where((F.col("profit_kind") == VALID_PROFIT_KIND)
                       & ~F.col("offer_kind").isin(*EXCLUDED_OFFER_KINDS))


def valid_sales(sales: DataFrame, kinds: DataFrame, lo: int, hi: int,
                base: DataFrame | None = None, items: DataFrame | None = None) -> DataFrame:
    """Own-cycle sales of base sellers and offered items with a positive net.

    Everything that shrinks the fact table runs first; a line is never
    multiplied, however many offers hold its item.  ``base`` and ``items`` are
    left out where the source or the next join already restricts to them.
    """
    rows = (sales
            .where(F.col("cycle").between(lo, hi) & (F.col("cycle") == F.col("ref_cycle"))
                   & (F.col("net") > 0))
            .join(valid_kinds(kinds), "offer_kind", "left_semi"))
    if base is not None:
        rows = rows.join(base.select("seller_id"), "seller_id", "left_semi")
    if items is not None:
        rows = rows.join(items.select("item_id").distinct(), "item_id", "left_semi")
    return (rows
            .select("cycle", "seller_id", "item_id", "offer_kind", "territory", "invoice",
                    "sales_code", "ref_cycle", "units", "net"))


def tag_with_offers(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Sales lines with the offer and product their item belongs to."""
    tags = items.select("item_id", "offer_type", "offer_id", "product_id",
                        F.col("units").alias("offer_units"))
    return sales.join(tags, "item_id")


# ---- status ------------------------------------------------------------------
def status_history(status: DataFrame, lo: int, hi: int) -> DataFrame:
    return (status.where(F.col("cycle").between(lo, hi))
            .select("seller_id", "cycle", "flag_order", "flag_active", "segment", "channel"))


def base_status(base: DataFrame, history: DataFrame) -> DataFrame:
    return (base.select("seller_id").join(history, "seller_id")
            .select("seller_id", "cycle", "flag_order", "flag_active"))


def seller_activity(history: DataFrame, run: RunParams) -> DataFrame:
    """One row per seller: cycles ordered (as a set), web order in the last six
    cycles, and activity and segment at the process cycle."""
    now = F.col("cycle") == run.process_cycle
    recent = F.col("cycle").between(run.recent_start, run.process_cycle)
    return (history.groupBy("seller_id").agg(
        cycle_set("cycle", run.start, F.col("flag_order") == 1).alias("order_cycles"),
        F.max(F.when(recent & F.col("channel").isin(*WEB_CHANNELS), 1).otherwise(0)).alias("web_recent"),
        F.max(F.when(now, F.col("flag_active"))).alias("active_now"),
        F.max(F.when(now, F.col("segment"))).alias("segment_now")))


# ---- price list of the offers ------------------------------------------------
def price_catalog(catalog: DataFrame, kinds: DataFrame, items: DataFrame, run: RunParams,
                  offer_type: str) -> DataFrame:
    """Price-list rows of offered items in the window.  Bundles accept every
    sales vehicle, single offers only the printed catalogues."""
    rows = catalog.where(F.col("cycle").between(run.start, run.process_cycle)
                         & (F.col("price") > 0))
    if offer_type != BUNDLE:
        rows = rows.where(F.col("vehicle").isin(*CATALOGUE_VEHICLES))
    return (rows.join(valid_kinds(kinds), "offer_kind", "left_semi")
            .join(items.where(F.col("offer_type") == offer_type)
                  .select("item_id", "offer_id", "product_id"), "item_id")
            .select("offer_id", "product_id", "item_id", "cycle", "offer_kind", "sales_code",
                    "price"))
