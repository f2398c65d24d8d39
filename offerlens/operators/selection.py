"""Parameter selection: the offer rows, gifts and slots of one run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_text
from offerlens.params import ESTIMATION, RunParams

OFFER_COLUMNS = ["offer_type", "offer_id", "product_id", "units", "price", "sales_code",
                 "parent", "flag_top", "limit_units", "flag_last_minute", "link"]
TOTAL_COLUMNS = OFFER_COLUMNS[:8]


def pick_source(run: RunParams, personalisation: DataFrame, estimation: DataFrame) -> DataFrame:
    """Estimation runs read their own parameter table."""
    return estimation if run.load == ESTIMATION else personalisation


def run_rows(parameters: DataFrame, run: RunParams, any_profile: bool = False,
             target: bool = False) -> DataFrame:
    """Parameter rows of the run.  Scores take those of every target cycle; checks and
    ranking rules those of the run's ``target`` alone."""
    cond = ((F.col("country") == run.country) & (F.col("kind") == run.kind)
            & (F.col("personalisation") == run.personalisation)
            & (F.col("process_cycle") == cycle_text(run.process_cycle)))
    if not any_profile:
        cond = cond & (F.col("profile") == run.profile)
    if target:
        cond = cond & (F.col("target_cycle") == cycle_text(run.target_cycle))
    return parameters.where(cond)


def product_list(rows: DataFrame) -> DataFrame:
    """Offer rows that are sold (price above 0)."""
    return rows.where(F.col("price") > 0).select(*OFFER_COLUMNS).distinct()


def gift_list(rows: DataFrame) -> DataFrame:
    """Offer rows that are given away (price 0)."""
    return (rows.where(F.col("price") == 0)
            .select("offer_type", "offer_id", "product_id", "units", "price", "country")
            .distinct())


def forced_slot_rows(slots: DataFrame, run: RunParams) -> DataFrame:
    return run_rows(slots, run, target=True).select("brand", "category", "forced_kind", "slot")


def slot_counts(rows: DataFrame) -> DataFrame:
    """Slots and top slots announced for the target cycle."""
    return rows.select("target_cycle", "slots", "top_slots").distinct()


def all_products(rows: DataFrame) -> DataFrame:
    """Offer rows including gifts, for estimates."""
    return rows.select(*TOTAL_COLUMNS).distinct()


def run_profiles(profiles: DataFrame, run: RunParams) -> DataFrame:
    """Peer profiles that hold for the run: those of its country and process cycle.  The
    rows of other runs go before any join, so that no seller is there twice."""
    return (profiles.where((F.col("country") == run.country)
                           & (F.col("process_cycle") == cycle_text(run.process_cycle)))
            .select("seller_id", "profile"))


def run_geography(geography: DataFrame, run: RunParams) -> DataFrame:
    """Zones and regions of the territories as they are in the process cycle."""
    return geography.where(F.col("cycle") == run.process_cycle).drop("cycle")
