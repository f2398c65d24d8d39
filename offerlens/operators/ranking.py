"""Showroom ranking rules: top, free and forced slots per seller.

The slot rules are greedy: what one slot takes, a later slot cannot.  A
seller's candidates are at most the offers of the run (one row each), so they
are packed in one sorted array per seller and the slots are filled by folding
over it, once per seller: one shuffle by seller for all slots together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_text
from offerlens.functions.frames import spread_join
from offerlens.params import FINAL_OFFER_ORDER, TYPE_PRIORITY, RunParams

PICKS = "array<struct<offer_id:string,probability:double,rank:int,type:string>>"


def by_probability(*first: Column) -> Window:
    """Best offer first within a seller; the offer id breaks ties."""
    return (Window.partitionBy("seller_id")
            .orderBy(*first, F.col("probability").desc(), F.col("offer_id")))


# ---- slots of the run --------------------------------------------------------
def fixed_slots(forced: DataFrame) -> DataFrame:
    return (forced.where(F.col("forced_kind") == 1)
            .select("brand", "category", "forced_kind", "slot").distinct())


def not_to_repeat(forced: DataFrame) -> DataFrame:
    """Brand and category pairs that free slots may not use."""
    return (forced.where(F.col("forced_kind") == 0)
            .select("brand", "category", "forced_kind").distinct())


def slot_plan(counts: DataFrame, forced: DataFrame) -> DataFrame:
    """One row: slots, top slots, fixed slots and what is left as free slots.

    Missing or null counts read as 0.
    """
    n = counts.agg(F.coalesce(F.max("slots"), F.lit(0)).alias("slots"),
                   F.coalesce(F.max("top_slots"), F.lit(0)).alias("top_slots"))
    fixed = fixed_slots(forced).agg(F.coalesce(F.max("slot"), F.lit(0)).alias("f")).scalar()
    return (n.withColumn("fixed_slots", fixed)
            .withColumn("free_slots", F.col("slots") - F.col("fixed_slots") - F.col("top_slots")))


# ---- candidates --------------------------------------------------------------
def candidates(probabilities: DataFrame, run: RunParams, drop_zero: bool = True,
               parts: int | None = None) -> DataFrame:
    """The run's probability rows.  They are placed by seller once (a seller has
    at most one row per offer product); the distinct, the rankings and the slot
    rules that follow all keep that placement.  Rows that are dealt by seller over
    ``parts`` already stay where they are."""
    rows = probabilities.where(
        (F.col("personalisation") == run.personalisation) & (F.col("country") == run.country)
        & (F.col("process_cycle") == cycle_text(run.process_cycle))
        & (F.col("target_cycle") == cycle_text(run.target_cycle))
        & (F.col("kind") == run.kind) & (F.col("engine") == run.engine)
        & (F.col("profile") == run.profile))
    if drop_zero:
        rows = rows.where(F.col("probability") != 0)
    rows = rows.select("seller_id", "offer_id", "flag_top", "probability")
    return (rows.repartition("seller_id") if parts is None else rows.repartition(parts, "seller_id")).distinct()


def best_per_offer(cands: DataFrame) -> DataFrame:
    """One row per seller and offer where products were scored one by one."""
    return (cands.groupBy("seller_id", "offer_id")
            .agg(F.max("flag_top").alias("flag_top"), F.max("probability").alias("probability")))


def ranked(cands: DataFrame) -> DataFrame:
    return cands.withColumn("position", F.row_number().over(by_probability()))


def final_offers(ranking: DataFrame) -> DataFrame:
    """The third, first and second offer, in this interface order."""
    order = F.create_map(*[F.lit(v) for kv in FINAL_OFFER_ORDER.items() for v in kv])
    return (ranking.where(F.col("position") <= max(FINAL_OFFER_ORDER))
            .select("seller_id", "offer_id", "probability",
                    F.col("position").alias("order"),
                    order[F.col("position")].alias("interface_order")))


def without_final_offer(ranking: DataFrame) -> DataFrame:
    """The third offer is kept for the final offer and leaves the candidates."""
    return (ranking.where(F.col("position") != 3)
            .select("seller_id", "offer_id", "flag_top", "probability"))


def top_offers(cands: DataFrame, plan: DataFrame) -> DataFrame:
    top = plan.select("top_slots").scalar()
    return (ranked(cands.where((F.col("probability") != 0) & (F.col("flag_top") == 1)))
            .where(F.col("position") <= top)
            .select("seller_id", "offer_id", "probability", F.lit("T").alias("type")))


def proposals(cands: DataFrame, products: DataFrame) -> DataFrame:
    """Offers that are not top, with the products they hold."""
    rest = cands.where((F.col("probability") != 0) & (F.col("flag_top") == 0))
    return spread_join(rest.select("seller_id", "offer_id", "probability"),
                       products.select("offer_id", "product_id", "brand", "category"), ["offer_id"])


# ---- greedy slots ------------------------------------------------------------
def offer_cards(products: DataFrame, forced: DataFrame) -> DataFrame:
    """Per offer of the run: the forced slots it fits, all its products, and the
    products that free slots may use."""
    slots = fixed_slots(forced).select("brand", "category", "slot")
    barred = not_to_repeat(forced).select("brand", "category").withColumn("_barred", F.lit(1))
    return (products.select("offer_id", "product_id", "brand", "category")
            .join(slots, ["brand", "category"], "left")
            .join(barred, ["brand", "category"], "left")
            .groupBy("offer_id").agg(
                F.collect_set("slot").alias("fits"),
                F.collect_set(F.when(F.col("_barred").isNull(), F.col("product_id")))
                .alias("free_products"),
                F.collect_set("product_id").alias("products")))


def _pick(c: Column, rank: Column, kind: str) -> Column:
    return F.array(F.struct(c.offer_id.alias("offer_id"), c.probability.alias("probability"),
                            rank.cast("int").alias("rank"), F.lit(kind).alias("type"))).cast(PICKS)


def _forced(sorted_cands: Column, n_fixed: Column) -> Column:
    """Slot 1..n in turn: the best offer that fits the slot and is still free."""
    def fill(picks, slot):
        free = F.filter(sorted_cands, lambda c: F.array_contains(c.fits, slot)
                        & ~F.exists(picks, lambda p: p.offer_id == c.offer_id))
        return F.when(F.size(free) > 0, F.concat(picks, _pick(free[0], slot, "F"))).otherwise(picks)

    slots = F.when(n_fixed > 0, F.sequence(F.lit(1), n_fixed)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(slots, F.array().cast(PICKS), fill)


def _free(sorted_cands: Column, forced: Column, capacity: Column) -> Column:
    """Best offer first; an offer that shares a product with a chosen one is out.

    Products of the barred brand/categories do not count, and an offer with no
    other product is no candidate.
    """
    state = f"struct<picks:{PICKS},used:array<string>>"
    start = F.struct(F.array().cast(PICKS).alias("picks"),
                     F.array().cast("array<string>").alias("used")).cast(state)

    def fill(s, c):
        ok = ((F.size(s.picks) < capacity) & (F.size(c.free_products) > 0)
              & ~F.arrays_overlap(c.free_products, s.used)
              & ~F.exists(forced, lambda p: p.offer_id == c.offer_id))
        grown = F.struct(
            F.concat(s.picks, _pick(c, F.size(s.picks) + 1, "N")).alias("picks"),
            F.concat(s.used, c.free_products).alias("used")).cast(state)
        return F.when(ok, grown).otherwise(s)

    return F.aggregate(sorted_cands, start, fill, lambda s: s.picks)


def fill_slots(cands: DataFrame, cards: DataFrame, plan: DataFrame) -> DataFrame:
    """Forced slots, then free slots, then left-over slots, by the cards of the offers.

    Left over are the forced slots of a seller that no offer could fill: the
    free choice goes on until the seller has fixed + free offers.
    """
    rest = cands.where((F.col("probability") != 0) & (F.col("flag_top") == 0))
    packed = (spread_join(rest.select("seller_id", "offer_id", "probability"), cards, ["offer_id"])
              .groupBy("seller_id")
              .agg(F.sort_array(F.collect_list(F.struct(
                  (-F.col("probability")).alias("key"), "offer_id", "probability", "fits",
                  "free_products"))).alias("c"))
              .withColumn("n_fixed", plan.select("fixed_slots").scalar())
              .withColumn("n_free", plan.select("free_slots").scalar())
              .withColumn("forced", _forced(F.col("c"), F.col("n_fixed")))
              .withColumn("free", _free(F.col("c"), F.col("forced"),
                                        F.col("n_fixed") + F.col("n_free") - F.size("forced"))))
    return (packed.select("seller_id", F.explode(F.concat("forced", "free")).alias("p"))
            .select("seller_id", "p.offer_id", "p.probability", "p.type", "p.rank"))


# ---- final list --------------------------------------------------------------
def final_order(top: DataFrame, chosen: DataFrame) -> DataFrame:
    """Top offers, then free, then forced; by probability within each."""
    columns = ["seller_id", "offer_id", "probability", "type"]
    priority = F.create_map(*[F.lit(v) for kv in TYPE_PRIORITY.items() for v in kv])
    both = top.select(*columns).unionByName(chosen.select(*columns))
    return (both.withColumn("priority", priority[F.col("type")])
            .withColumn("order", F.row_number().over(by_probability(F.col("priority")))))


# ---- estimates ---------------------------------------------------------------
def sellers_per_offer(final: DataFrame) -> DataFrame:
    return final.groupBy("offer_id").agg(F.count_distinct("seller_id").alias("total_sellers"))


def estimated_totals(per_offer: DataFrame, totals: DataFrame, products: DataFrame,
                     run: RunParams) -> DataFrame:
    """Recommended sellers per offer product, gifts included."""
    described = (products.where(F.col("descr").isNotNull()).groupBy("product_id")
                 .agg(F.max("descr").alias("descr"), F.max("brand").alias("brand"),
                      F.max("category").alias("category"), F.max("solo_type").alias("solo_type")))
    return (totals.select("product_id", "offer_type", "offer_id", "sales_code", "units", "price",
                          "parent").distinct()
            .join(described, "product_id").join(per_offer, "offer_id")
            .groupBy("offer_type", "offer_id", "brand", "category", "solo_type", "product_id", "descr", "units")
            .agg(F.sum("total_sellers").alias("total_sellers"))
            .withColumn("personalisation", F.lit(run.personalisation)))
