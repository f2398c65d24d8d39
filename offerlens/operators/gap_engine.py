"""Gap engine: cannibalisation gap, standardised variables, score per offer.

Statistics are one-row aggregates that enter as scalar subqueries, so no step
here shuffles the (seller, offer) table; rows are never split and united again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_text
from offerlens.functions.frames import spread_join
from offerlens.functions.scoring import deviation, exact_squares, exact_sum, dbl, logistic, ratio
from offerlens.operators.consolidate import RUN_COLUMNS, VARIABLE_COLUMNS
from offerlens.params import (BUNDLE, HISTORY_CYCLES, SCORE_EXPONENT_CAP, SINGLE, RunParams)

# Standardised column -> source variable
Z_COLUMNS = {"frequency_z": "frequency_24c", "recency_z": "recency_24c",
             "sales_gap_z": "sales_gap", "sales_gap_mc_z": "sales_gap_mc",
             "price_gap_z": "price_gap", "trigger_z": "trigger_rate"}


def of_run(variables: DataFrame, run: RunParams) -> DataFrame:
    return variables.where(
        (F.col("process_cycle") == cycle_text(run.process_cycle))
        & (F.col("target_cycle") == cycle_text(run.target_cycle))
        & (F.col("country") == run.country) & (F.col("kind") == run.kind)
        & (F.col("personalisation") == run.personalisation) & (F.col("profile") == run.profile))


def run_variables(variables: DataFrame, profiles: DataFrame, run: RunParams) -> DataFrame:
    """Variable rows of the run with the seller's peer profile."""
    return of_run(variables, run).join(
        profiles.select("seller_id", F.col("profile").alias("peer_profile")), "seller_id", "left")


def _gap_rule() -> Column:
    """The gap for sellers with sales; -1 marks "do not recommend".

    One purchase: the total, when the repurchase is overdue.  More, for sellers
    of more than 24 cycles: the total, when the last six cycles do not exceed
    last year's.  Younger sellers: the mean, when they do not exceed the six
    before.
    """
    declined_year = F.col("sales_6c") - F.col("sales_6c_ly") <= 0
    declined_six = F.col("sales_6c") - F.col("sales_prev6") <= 0
    none = F.lit(-1.0)
    return (F.when(F.col("frequency_24c") == 1,
                   F.when(F.col("repurchase_gap") > 0, F.col("sales_24c")).otherwise(none))
            .when((F.col("frequency_24c") > 1) & (F.col("seniority") > HISTORY_CYCLES),
                  F.when(declined_year, F.col("sales_24c")).otherwise(none))
            .when((F.col("seniority") <= HISTORY_CYCLES) & declined_six, F.col("mean_24c"))
            .otherwise(none))


def _single_rule() -> Column:
    """Single offers: sellers without sales take the potential minimum sale."""
    return F.when(F.col("sales_24c") <= 0, F.col("min_sale_6c")).otherwise(_gap_rule())


def single_gap(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("offer_type") == SINGLE).withColumn("sales_gap_mc", _single_rule())


def bundle_gap(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("offer_type") == BUNDLE).withColumn("sales_gap_mc", _gap_rule())


def bundle_potential(bundles: DataFrame, run: RunParams) -> DataFrame:
    """Mean potential minimum sale per peer group and bundle."""
    keys = [*run.peer_keys, "offer_id"]
    return (bundles.groupBy(*keys, "seller_id").agg(F.sum("min_sale_6c").alias("s"))
            .groupBy(*keys).agg(ratio(F.sum("s"), F.count("seller_id")).alias("potential")))


def bundle_gap_from_peers(bundles: DataFrame, potential: DataFrame, run: RunParams) -> DataFrame:
    return _gap_from_peers(bundles, potential, [*run.peer_keys, "offer_id"])


def _gap_from_peers(rows: DataFrame, potential: DataFrame, keys: list[str]) -> DataFrame:
    """A bundle gap of 0 takes the peers' mean potential minimum sale."""
    return (spread_join(rows, potential, keys, "left")
            .withColumn("sales_gap_mc",
                        F.when(F.col("sales_gap_mc") == 0,
                               F.coalesce(F.col("potential"), F.col("sales_gap_mc")))
                        .otherwise(F.col("sales_gap_mc")))
            .select(*rows.columns))


def all_gaps(rows: DataFrame, potential: DataFrame, run: RunParams) -> DataFrame:
    """Both offer types with their engine gap and 4-decimal copies, in one pass: only
    bundles find a potential."""
    both = rows.where(F.col("offer_type").isin(SINGLE, BUNDLE)).withColumn(
        "sales_gap_mc", F.when(F.col("offer_type") == SINGLE, _single_rule()).otherwise(_gap_rule()))
    both = _gap_from_peers(both, potential.withColumn("offer_type", F.lit(BUNDLE)),
                           [*run.peer_keys, "offer_id", "offer_type"])
    return both.withColumns({
        "sales_gap_round": F.round("sales_gap", 4),
        "optimal_price_round": F.round("optimal_price", 4),
        "sales_gap_mc_round": F.round("sales_gap_mc", 4)})


def seller_mean_stats(rows: DataFrame, valid: dict[str, Column]) -> DataFrame:
    """One row with mean_c and sd_c of each column over the rows where its condition holds.

    The mean divides by the number of distinct sellers, not of rows; both figures are
    rounded to 4 before use.  Rows are reduced to one per seller on the map side, in exact
    sums, and sellers to one row: one pass for all columns, with the same result in
    whatever order and partitions the rows come.
    """
    aggregates = {}
    for c, where in valid.items():
        x = F.when(where, F.col(c))
        aggregates |= {f"sum_{c}": exact_sum(x), f"squares_{c}": exact_squares(x), f"n_{c}": F.count(x),
                       f"here_{c}": F.count_if(where)}
    sellers = rows.groupBy("seller_id").agg(*[a.alias(k) for k, a in aggregates.items()])
    out = []
    for c in valid:
        total, squares, n = (F.sum(f"{k}_{c}") for k in ("sum", "squares", "n"))
        out += [F.round(ratio(total, F.count_if(F.col(f"here_{c}") > 0)), 4).alias(f"mean_{c}"),
                deviation(total, squares, n).alias(f"sd_{c}")]
    return sellers.agg(*out)


def _with_stats(rows: DataFrame, valid: dict[str, Column]) -> DataFrame:
    """The statistics as columns: one row by construction, so a scalar and not a join."""
    stats = seller_mean_stats(rows, valid)
    one = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    return (rows.withColumn("_stats", one)
            .withColumns({f"_{c}": F.col(f"_stats.{c}") for c in stats.columns}).drop("_stats"))


def _z(column: str, where: Column) -> Column:
    usable = where & (F.col(f"_sd_{column}") != 0)
    return (F.when(usable, F.round(F.try_divide(dbl(column) - F.col(f"_mean_{column}"),
                                                F.col(f"_sd_{column}")), 4))
            .otherwise(F.lit(0.0)))


def statistics(rows: DataFrame) -> DataFrame:
    """The run's means and deviations as one row (a report)."""
    return seller_mean_stats(rows, {c: F.col("sales_gap") >= 0 for c in Z_COLUMNS.values()})


def z_scores(rows: DataFrame) -> DataFrame:
    """Six standardised variables; 0 where the sales gap is negative."""
    valid = F.col("sales_gap") >= 0
    df = _with_stats(rows, {c: valid for c in Z_COLUMNS.values()})
    df = df.withColumns({z: _z(c, valid) for z, c in Z_COLUMNS.items()})
    return df.select(*[c for c in rows.columns if c not in Z_COLUMNS], *Z_COLUMNS)


def opportunity(rows: DataFrame) -> DataFrame:
    """z(frequency) - z(recency) + z(gap) - z(price gap) + z(trigger)."""
    def combine(gap):
        return F.round(F.col("frequency_z") - F.col("recency_z") + F.col(gap)
                       - F.col("price_gap_z") + F.col("trigger_z"), 4)
    return rows.withColumns({"opportunity": combine("sales_gap_z"),
                             "opportunity_mc": combine("sales_gap_mc_z")})


def normalised_opportunity(rows: DataFrame) -> DataFrame:
    """Each opportunity standardised over its own rows with a gap of 0 or more."""
    valid = {"opportunity": F.col("sales_gap") >= 0, "opportunity_mc": F.col("sales_gap_mc") >= 0}
    df = _with_stats(rows, valid).withColumns({f"{c}_z": _z(c, where) for c, where in valid.items()})
    return df.select(*[c for c in rows.columns if c not in ("opportunity_z", "opportunity_mc_z")],
                     "opportunity_z", "opportunity_mc_z")


def scores(rows: DataFrame) -> DataFrame:
    """Logistic scores, plain and times the units of the offer (exponent capped)."""
    def score(x: Column, gap: str) -> Column:
        return F.when(F.col(gap) >= 0, logistic(x)).otherwise(F.lit(0.0))

    def capped(z: str) -> Column:
        return F.least(F.col(z) * F.col("total_units"), F.lit(SCORE_EXPONENT_CAP))

    return rows.withColumns({
        "score": score(F.col("opportunity_z"), "sales_gap"),
        "score_mc": score(F.col("opportunity_mc_z"), "sales_gap_mc"),
        "score_units": score(capped("opportunity_z"), "sales_gap"),
        "score_mc_units": score(capped("opportunity_mc_z"), "sales_gap_mc")})


def scored_variables(scored: DataFrame) -> DataFrame:
    """The variable table with its scores, 50 columns."""
    return scored.select(*VARIABLE_COLUMNS, *RUN_COLUMNS)


def probability_table(scored: DataFrame, run: RunParams) -> DataFrame:
    """Probability per seller and offer: with or without the gap engine."""
    chosen = "score_mc_units" if run.engine == 1 else "score_units"
    return scored.select("country", "process_cycle", "target_cycle", "seller_id", "offer_id",
                         "flag_top", F.col(chosen).alias("probability"), "kind",
                         "personalisation", F.lit(run.engine).alias("engine"), "profile")
