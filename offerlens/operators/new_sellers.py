"""Purchase probability of new sellers: penetration, frequency and price.

Penetration compares what sellers bought right after their "new" period: those
who stayed constant against those who did not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_count, cycle_set, cycle_text
from offerlens.functions.frames import seller_offer_grid
from offerlens.functions.scoring import logistic, ratio, standardise
from offerlens.operators.sales import valid_kinds
from offerlens.params import (BEHAVIOUR_CONSTANT, BEHAVIOUR_INCONSTANT, BEHAVIOUR_NEW, RunParams)


def listed_purchases(sales: DataFrame, items: DataFrame, catalog: DataFrame, kinds: DataFrame,
                     run: RunParams) -> DataFrame:
    """Distinct (seller, offer, product, cycle) purchases of listed items."""
    own = (sales.where(F.col("cycle").between(run.new_start, run.process_cycle)
                       & (F.col("cycle") == F.col("ref_cycle")) & (F.col("net") > 0))
           .join(valid_kinds(kinds), "offer_kind", "left_semi")
           .select("cycle", "seller_id", "item_id").distinct())
    return (own.join(catalog.select("cycle", "item_id"), ["cycle", "item_id"], "left_semi")
            .join(items.select("item_id", "offer_id", "product_id"), "item_id")
            .select("cycle", "seller_id", "offer_id", "product_id").distinct())


def recent_entrants(status: DataFrame, sellers: DataFrame, run: RunParams) -> DataFrame:
    """Behaviour history of sellers enrolled in the last 18 cycles."""
    entrants = sellers.where(F.col("enrol_cycle").between(run.new_start, run.process_cycle))
    return (status.select("seller_id", "cycle", "behaviour")
            .join(entrants, "seller_id")
            .select("seller_id", "cycle", "behaviour", "enrol_cycle"))


def first_cycle_after_new(history: DataFrame) -> DataFrame:
    return (history.where(F.col("behaviour") == BEHAVIOUR_NEW).groupBy("seller_id")
            .agg((F.max("cycle") + 1).alias("next_cycle")))


def next_behaviour(history: DataFrame) -> DataFrame:
    """Constant or inconstant in the cycle after the last "new" cycle.

    The history of a seller is one short set (a row per cycle), so the cycle
    after the last new one is looked up inside it: history and maximum share
    one shuffle and nothing is joined back.
    """
    last_new = F.max(F.when(F.col("behaviour") == BEHAVIOUR_NEW, F.col("cycle")))
    packed = (history.groupBy("seller_id")
              .agg((last_new + 1).alias("next_cycle"),
                   F.collect_set(F.struct("cycle", "behaviour")).alias("h"))
              .where(F.col("next_cycle").isNotNull()))

    def showed(kinds):
        return F.exists("h", lambda x: (x.cycle == F.col("next_cycle")) & x.behaviour.isin(*kinds))

    labels = F.array_compact(F.array(
        F.when(showed(BEHAVIOUR_CONSTANT), "Constantes"),
        F.when(showed(BEHAVIOUR_INCONSTANT), "Inconstantes")))
    return packed.select("seller_id", F.col("next_cycle").alias("cycle"),
                         F.explode(labels).alias("behaviour"))


def behaviour_totals(next_ones: DataFrame) -> DataFrame:
    return (next_ones.groupBy("behaviour")
            .agg(F.count_distinct("seller_id").alias("total_sellers")))


def penetration(next_ones: DataFrame, purchases: DataFrame, keys: list[str]) -> DataFrame:
    """Share of constant and inconstant sellers who bought within three cycles.

    ``keys`` is the grain: offer and product for the report, offer alone where
    the share is applied to offers.
    """
    totals = next_ones.agg(F.struct(
        F.count_distinct(F.when(F.col("behaviour") == "Constantes", F.col("seller_id"))).alias("c"),
        F.count_distinct(F.when(F.col("behaviour") == "Inconstantes", F.col("seller_id"))).alias("i"))
        .alias("t")).scalar()
    entered = next_ones.withColumnRenamed("cycle", "from_cycle")
    buyers = (purchases.join(entered, "seller_id")
              .where(F.col("cycle").between(F.col("from_cycle"), F.col("from_cycle") + 2))
              .select(*keys, "behaviour", "seller_id").distinct()
              .groupBy(*keys).agg(
                  F.count_if(F.col("behaviour") == "Constantes").alias("n_const"),
                  F.count_if(F.col("behaviour") == "Inconstantes").alias("n_inconst"))
              .withColumn("_t", totals))
    return buyers.select(
        *keys, "n_const", "n_inconst",
        F.coalesce(ratio("n_const", F.col("_t.c")), F.lit(0.0)).alias("pen_const"),
        F.coalesce(ratio("n_inconst", F.col("_t.i")), F.lit(0.0)).alias("pen_inconst"))


def frequency(base: DataFrame, purchases: DataFrame, run: RunParams,
              keys: list[str]) -> DataFrame:
    """Distinct cycles with a purchase over the last four cycles."""
    lo = run.process_cycle - 3
    return (purchases.where(F.col("cycle").between(lo, run.process_cycle))
            .join(base.select("seller_id"), "seller_id", "left_semi")
            .groupBy("seller_id", *keys)
            .agg(cycle_count(cycle_set("cycle", lo)).alias("frequency")))


def penetration_formula(df: DataFrame) -> DataFrame:
    c, i = F.col("pen_const"), F.col("pen_inconst")
    lift = F.when(i == 0, F.lit(0.0)).otherwise(F.try_divide(c, i))
    return df.withColumn("penetration", lift * (c + i) / 2)


def seller_grid(base: DataFrame, products: DataFrame, freq: DataFrame,
                pen: DataFrame) -> DataFrame:
    """Every new seller with every offer product and its variables.

    Frequency (per seller and offer) and penetration (per offer) are reduced to
    the keys they are applied on, so no row is multiplied.
    """
    offers = (products.select("offer_type", "offer_id", "product_id", "flag_top", "price", "units")
              .join(pen.select("offer_id", "pen_const", "pen_inconst"), "offer_id", "left")
              .fillna(0.0, ["pen_const", "pen_inconst"]))
    grid = (seller_offer_grid(base.select("seller_id"), offers)
            .join(freq, ["seller_id", "offer_id"], "left")
            .withColumns({"frequency": F.coalesce(F.col("frequency").cast("double"), F.lit(0.0)),
                          "price": F.col("price").cast("double")}))
    return penetration_formula(grid)


def seller_scores(grid: DataFrame) -> DataFrame:
    """Score = z(penetration) - z(frequency); probability = logistic of
    z(score) + z(price), times the units of the offer product."""
    df = standardise(grid, {"frequency_z": "frequency", "penetration_z": "penetration",
                            "price_z": "price"})
    df = df.withColumn("score", F.col("penetration_z") - F.col("frequency_z"))
    df = standardise(df, {"score_z": "score"})
    return df.withColumn("probability",
                         logistic(F.col("score_z") + F.col("price_z")) * F.col("units"))


def offer_complement(products: DataFrame, pen: DataFrame) -> DataFrame:
    """Offer products scored without sellers, to complete short lists."""
    df = (products.select("offer_type", "offer_id", "product_id", "flag_top", "units",
                          F.col("price").cast("double").alias("price"))
          .join(pen.select("offer_id", "pen_const", "pen_inconst"), "offer_id", "left")
          .fillna(0.0, ["pen_const", "pen_inconst"]))
    df = standardise(penetration_formula(df),
                     {"price_z": "price", "penetration_z": "penetration"})
    df = df.withColumn("score", F.col("penetration_z") + F.col("price_z"))
    df = standardise(df, {"score_z": "score"})
    return df.withColumn("purchase_probability", logistic(F.col("score_z")) * F.col("units"))


def probability_table(scores: DataFrame, run: RunParams) -> DataFrame:
    """Scores as rows of the probability table of the run."""
    return scores.select(
        F.lit(run.country).alias("country"),
        F.lit(cycle_text(run.process_cycle)).alias("process_cycle"),
        F.lit(cycle_text(run.target_cycle)).alias("target_cycle"),
        "seller_id", "offer_id", "flag_top", "probability", F.lit(run.kind).alias("kind"),
        F.lit(run.personalisation).alias("personalisation"), F.lit(0).alias("engine"),
        F.lit(run.profile).alias("profile"))
