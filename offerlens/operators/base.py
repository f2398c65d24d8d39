"""The seller base of a run: who is scored, and as what kind of seller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_distance, format_cycle
from offerlens.params import (DAILY_OFFER, ESTABLISHED, NEW, NO_PROFILE, SHOWROOM,
                              VALID_PROFIT_KIND, RunParams)


def enrolled_between(status: DataFrame, sellers: DataFrame, lo: int, hi: int) -> DataFrame:
    """Sellers with a status row who enrolled in ``lo..hi``."""
    return (sellers.where(F.col("enrol_cycle").between(lo, hi)).select("seller_id")
            .join(status.select("seller_id"), "seller_id", "left_semi").distinct())


def new_sellers(status: DataFrame, sellers: DataFrame, profiles: DataFrame,
                run: RunParams) -> DataFrame:
    """First to fourth order; profiled sellers leave in showroom and daily runs."""
    p = run.process_cycle
    found = enrolled_between(status, sellers, p - 3, p)
    if run.personalisation in (SHOWROOM, DAILY_OFFER):
        found = found.join(profiles.select("seller_id"), "seller_id", "left_anti")
    return found


def ordering_sellers(sales: DataFrame, kinds: DataFrame, run: RunParams) -> DataFrame:
    """Positive own-cycle net sales over the last three cycles."""
    p = run.process_cycle
    valid = kinds.where(F.col("profit_kind") == VALID_PROFIT_KIND)
    return (sales.where(F.col("cycle").between(p - 2, p) & (F.col("cycle") == F.col("ref_cycle")))
            .join(valid, "offer_kind", "left_semi")
            .groupBy("seller_id").agg(F.sum("net").alias("net_sales"))
            .where(F.col("net_sales") > 0))


def fifth_sixth_sellers(status: DataFrame, sellers: DataFrame, run: RunParams) -> DataFrame:
    p = run.process_cycle
    return enrolled_between(status, sellers, p - 5, p - 4)


def established_sellers(ordering: DataFrame, fifth_sixth: DataFrame, new: DataFrame) -> DataFrame:
    return (ordering.select("seller_id").unionByName(fifth_sixth.select("seller_id"))
            .join(new, "seller_id", "left_anti").distinct())


def base_with_kind(new: DataFrame, established: DataFrame) -> DataFrame:
    return (new.select("seller_id", F.lit(NEW).alias("kind"))
            .unionByName(established.select("seller_id", F.lit(ESTABLISHED).alias("kind"))))


def profiled_base(profiles: DataFrame, run: RunParams) -> DataFrame:
    """Sellers of the run's profile; all count as established."""
    return (profiles.where(F.col("profile") == int(run.profile))
            .select("seller_id", F.lit(ESTABLISHED).alias("kind")).distinct())


def with_attributes(base: DataFrame, sellers: DataFrame, status: DataFrame, geography: DataFrame,
                    run: RunParams) -> DataFrame:
    """Region, zone, segment and seniority at the process cycle."""
    p = run.process_cycle
    now = (status.where(F.col("cycle") == p)
           .select("seller_id", "territory", "segment"))
    return (base.join(sellers, "seller_id").join(now, "seller_id").join(geography, "territory")
            .select("seller_id", "region_id", "region", "zone", "segment",
                    format_cycle(F.lit(p)).alias("process_cycle"),
                    F.lit(run.profile).alias("profile"),
                    (cycle_distance(F.lit(p), "enrol_cycle") + 1).alias("seniority"),
                    "kind"))


def seller_base(sales: DataFrame, status: DataFrame, sellers: DataFrame, kinds: DataFrame,
                geography: DataFrame, profiles: DataFrame, run: RunParams) -> DataFrame:
    if run.profile != NO_PROFILE:
        base = profiled_base(profiles, run)
    else:
        new = new_sellers(status, sellers, profiles, run)
        old = established_sellers(ordering_sellers(sales, kinds, run),
                                  fifth_sixth_sellers(status, sellers, run), new)
        base = base_with_kind(new, old)
    return with_attributes(base, sellers, status, geography, run)


def filter_base(base: DataFrame, run: RunParams) -> DataFrame:
    """The run's own sellers."""
    return base.where((F.col("kind") == run.kind) & (F.col("profile") == run.profile))


def with_peer_profile(base: DataFrame, profiles: DataFrame) -> DataFrame:
    """Base with the external profile used as a peer group (null when none)."""
    return base.join(profiles.select("seller_id", F.col("profile").alias("peer_profile")),
                     "seller_id", "left")
