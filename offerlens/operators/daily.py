"""Offer of the day: the best offers of a seller, one per start day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_text
from offerlens.operators.ranking import by_probability, ranked
from offerlens.params import (DAILY_OFFER, DEFAULT_START_DAY, ESTABLISHED, GENERIC_SELLER,
                              PORTAL_ZONE, RunParams)

# The 18 interface columns, in order
INTERFACE = ["country", "personalisation", "sale_cycle", "seller_id", "product_id", "item_code",
             "sales_code", "portal_zone", "start_day", "end_day", "order", "flag_manual", "kind",
             "link", "price_per_unit", "limit_units", "flag_last_minute", "profile"]


def daily_established(cands: DataFrame, plan: DataFrame) -> DataFrame:
    """The best k offers, put in order from the least probable up."""
    k = plan.select("slots").scalar()
    up = Window.partitionBy("seller_id").orderBy(F.col("probability").asc(), F.col("offer_id"))
    return (ranked(cands).where(F.col("position") <= k)
            .select("seller_id", "offer_id", "probability",
                    F.row_number().over(up).alias("order")))


def daily_new(cands: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per offer (its best product), the best k, best first."""
    k = plan.select("slots").scalar()
    best = cands.groupBy("seller_id", "offer_id").agg(F.max("probability").alias("probability"))
    return (best.withColumn("order", F.row_number().over(by_probability()))
            .where(F.col("order") <= k)
            .select("seller_id", "offer_id", "probability", "order"))


def generic_complement(complement: DataFrame) -> DataFrame:
    """The offers of a stand-in seller, least probable first.

    The input is one row per offer of the run, so the single ranking window
    only ever sees that list.
    """
    best = complement.groupBy("offer_id").agg(F.max("purchase_probability").alias("probability"))
    up = Window.orderBy(F.col("probability").asc(), F.col("offer_id"))
    return best.select(F.lit(GENERIC_SELLER).alias("seller_id"), "offer_id", "probability",
                       F.row_number().over(up).alias("order"))


def parent_products(products: DataFrame) -> DataFrame:
    return (products.where(F.col("parent") == 1)
            .select("offer_id", "product_id", "item_code", "sales_code", "limit_units",
                    "flag_last_minute"))


def interface_rows(daily: DataFrame, products: DataFrame, sellers: DataFrame | None) -> DataFrame:
    """Chosen offers with their parent product; ``sellers`` restricts to known ids."""
    rows = daily.select(F.col("seller_id").cast("string").alias("seller_id"), "offer_id", "order")
    if sellers is not None:
        rows = rows.join(sellers.select(F.col("seller_id").cast("string").alias("seller_id")),
                         "seller_id", "left_semi")
    return (rows.join(parent_products(products), "offer_id")
            .select("seller_id", "product_id", "item_code", "sales_code", "order", "limit_units",
                    "flag_last_minute").distinct())


def has_configuration(parameters: DataFrame, run: RunParams) -> bool:
    """Is there any daily-offer parameter row for profile 1 and the target cycle?"""
    return not parameters.where(
        (F.col("country") == run.country)
        & (F.col("target_cycle") == cycle_text(run.target_cycle))
        & (F.col("personalisation") == DAILY_OFFER) & (F.col("profile") == "1")).isEmpty()


def with_configured_days(rows: DataFrame, start_days: DataFrame, run: RunParams) -> DataFrame:
    active = (start_days.where(
        (F.col("state") == 1) & (F.col("country") == run.country) & (F.col("kind") == run.kind)
        & (F.col("personalisation") == DAILY_OFFER)
        & (F.col("target_cycle") == cycle_text(run.target_cycle)))
              .select("order", "start_day", "order_in_day"))
    return (rows.join(active, "order")
            .withColumn("order", F.col("order_in_day")).drop("order_in_day"))


def with_default_days(rows: DataFrame, run: RunParams) -> DataFrame:
    """Start days by order; new sellers' rows carry no order beside them."""
    day = F.create_map(*[F.lit(v) for kv in DEFAULT_START_DAY.items() for v in kv])
    dated = rows.withColumn("start_day", F.try_element_at(day, F.col("order")))
    return dated if run.kind == ESTABLISHED else dated.withColumn("order", F.lit(0))


def interface_table(rows: DataFrame, run: RunParams) -> DataFrame:
    return rows.withColumns({
        "country": F.lit(run.country), "personalisation": F.lit(DAILY_OFFER),
        "sale_cycle": F.lit(cycle_text(run.target_cycle)), "portal_zone": F.lit(PORTAL_ZONE),
        "end_day": F.lit(0), "flag_manual": F.lit(0), "kind": F.lit(run.kind),
        "link": F.lit(0), "price_per_unit": F.lit(0.0), "profile": F.lit(run.profile),
    }).select(*INTERFACE).distinct()


def daily_interface(cands: DataFrame, complement: DataFrame | None, plan: DataFrame,
                    products: DataFrame, sellers: DataFrame, parameters: DataFrame,
                    start_days: DataFrame, run: RunParams,
                    configured: bool | None = None) -> DataFrame:
    """The daily-offer interface of a run, configured start days when there are any."""
    if run.kind == ESTABLISHED:
        rows = interface_rows(daily_established(cands, plan), products, sellers)
    else:
        rows = interface_rows(daily_new(cands, plan), products, sellers).unionByName(
            interface_rows(generic_complement(complement), products, None))
    if configured is None:
        configured = has_configuration(parameters, run)
    rows = with_configured_days(rows, start_days, run) if configured else with_default_days(rows, run)
    return interface_table(rows, run)
