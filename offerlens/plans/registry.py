"""Every query of the engine: name, result columns, how to build it.

The column spec fixes name and type of each result column:
``s`` string, ``i`` int, ``l`` bigint, ``d`` double, ``r`` double rounded to 6
decimals (averages of doubles, whose last bits depend on the order of the sum).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.functions import cycles as cyc
from offerlens.functions.frames import delete_matching, update_from
from offerlens.functions.scoring import mean_of, ratio
from offerlens.operators import (base as B, consolidate as C, daily as D, gap_engine as M,
                                 new_sellers as N, peers as G, ranking as T, rfm as R, sales as K,
                                 selection as L, validation as V)
from offerlens.params import (BUNDLE, DAILY_OFFER, ESTIMATION, NEW, SINGLE, RunParams)
from offerlens.plans.workspace import HISTORY_FRAMES, PEER_FRAMES, Workspace
from offerlens.sources.export import WrittenFiles, WrittenTables, source_frames, write_file
from offerlens.sources.repository import Repository, RunLog
from offerlens.sources.session import tune
from offerlens.sources.staging import new_stage_path
from offerlens.sources.star import StarTables
from offerlens.sources.warehouse import ParameterFiles, WarehouseTables, source_table

ESTABLISHED_RUN = RunParams(process_cycle=36027, target_cycle=36028)
NEW_RUN = RunParams(process_cycle=35939, target_cycle=35940, kind=NEW,
                    personalisation=DAILY_OFFER)
TYPES = {"s": "string", "i": "int", "l": "bigint", "d": "double", "r": "double"}


class Context:
    """The runs the queries refer to, over one set of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.t = spark, StarTables(spark, folder)
        tune(spark)
        self.e = Workspace(self.t, ESTABLISHED_RUN)

    def _lazy(self, name: str, build: Callable):
        if name not in self.__dict__:
            self.__dict__[name] = build()
        return self.__dict__[name]

    @property
    def n(self) -> Workspace:
        return self._lazy("_n", lambda: self.e.sibling(
            ("products", "kinds", "sellers"), process_cycle=NEW_RUN.process_cycle,
            target_cycle=NEW_RUN.target_cycle, kind=NEW_RUN.kind,
            personalisation=NEW_RUN.personalisation))

    @property
    def by_profile(self) -> Workspace:
        return self._lazy("_p", lambda: self.e.sibling(
            HISTORY_FRAMES + ("parameter_rows", "offers", "items", "offer_products"),
            peer_grouping=2))

    @property
    def daily(self) -> Workspace:
        return self._lazy("_d", lambda: self.e.sibling(HISTORY_FRAMES + PEER_FRAMES,
                                                       personalisation=DAILY_OFFER))

    @property
    def engine(self) -> Workspace:
        return self._lazy("_m", lambda: self.e.sibling(
            HISTORY_FRAMES + PEER_FRAMES + ("parameter_rows", "variables", "gaps", "opportunities"),
            engine=1))

    @property
    def profiled(self) -> Workspace:
        return self._lazy("_b", lambda: self.e.sibling(("sellers",), profile="2"))

    @property
    def warehouse(self) -> Workspace:
        """The established run from warehouse tables and parameter files."""
        return self._lazy("_w", lambda: Workspace(_as_warehouse(self), ESTABLISHED_RUN))

    @property
    def new_showroom(self) -> Workspace:
        return self._lazy("_s", lambda: self.n.sibling(
            ("products", "kinds", "sellers", "base_all", "base", "offers", "items", "offer_products",
             "new_purchases", "next_behaviour", "offer_penetration", "new_grid"),
            personalisation="SR"))


@dataclass(frozen=True)
class Query:
    name: str
    spec: str
    build: Callable[[Context], DataFrame]

    def columns(self) -> list[tuple[str, str]]:
        return [tuple(part.rsplit(":", 1)) for part in self.spec.split()]

    def __call__(self, context: Context) -> DataFrame:
        def shape(name, kind):
            col = F.col(name).cast(TYPES[kind])
            return (F.round(col, 6) if kind == "r" else col).alias(name)
        return self.build(context).select(*[shape(n, k) for n, k in self.columns()])


QUERIES: dict[str, Query] = {}


def query(name: str, spec: str):
    def register(build):
        QUERIES[name] = Query(name, spec, build)
        return build
    return register


def _q(name: str, spec: str, build: Callable[[Context], DataFrame]) -> None:
    QUERIES[name] = Query(name, spec, build)


SOP = "seller_id:l offer_id:s product_id:s "
SO = "seller_id:l offer_id:s "
GROUP = "region_id:i segment:s "
PROFILE = "peer_profile:i "
OFFER = ("offer_type:s offer_id:s product_id:s units:i price:d sales_code:s parent:i flag_top:i "
         "limit_units:i flag_last_minute:i link:i")

# ---- cycles and frame helpers --------------------------------------------------
_q("cycle_parse", "cycle_text:s cycle:i", lambda c: c.t.offer_parameters()
   .select("process_cycle", "target_cycle", F.col("offer_id").alias("bad"))
   .select(F.explode(F.array("process_cycle", "target_cycle", "bad")).alias("cycle_text"))
   .distinct().withColumn("cycle", cyc.parse_cycle("cycle_text")))
_q("cycle_shift", "cycle_text:s back_11:s back_23:s next:s", lambda c: c.t.orders()
   .select("cycle").distinct().select(
       cyc.format_cycle("cycle").alias("cycle_text"),
       cyc.format_cycle(cyc.shift_cycle("cycle", -11)).alias("back_11"),
       cyc.format_cycle(cyc.shift_cycle("cycle", -23)).alias("back_23"),
       cyc.format_cycle(cyc.shift_cycle("cycle", 1)).alias("next")))
_q("cycle_delta", "seller_id:l distance:i later:i", lambda c: c.t.sellers().select(
    "seller_id",
    cyc.cycle_distance("enrol_cycle", F.lit(NEW_RUN.process_cycle)).alias("distance"),
    (F.col("enrol_cycle") > NEW_RUN.process_cycle).cast("int").alias("later")))
_q("update_from", "seller_id:l profile:i", lambda c: update_from(
    c.t.sellers().select("seller_id", F.lit(-1).alias("profile")), c.e.profiles,
    ["seller_id"], ["profile"]))
_q("delete_matching", "seller_id:l enrol_cycle:i",
   lambda c: delete_matching(c.t.sellers(), c.e.profiles, ["seller_id"]))
_q("except_rows", "seller_id:l", lambda c: c.t.sellers().select("seller_id").subtract(
    c.e.profiles.where(F.col("profile") == 2).select("seller_id")))

# ---- sources -------------------------------------------------------------------
_q("source_sales", "seller_id:l cycle:i n_lines:l units:l net:d", lambda c: c.t.sales()
   .groupBy("seller_id", "cycle").agg(F.count("*").alias("n_lines"), F.sum("units").alias("units"),
                                      F.sum("net").alias("net")))
_q("source_catalog", "item_id:l offer_kind:s n_cycles:l low_price:d high_price:d vehicle:s",
   lambda c: c.t.catalog().groupBy("item_id", "offer_kind", "vehicle").agg(
       F.count("cycle").alias("n_cycles"), F.min("price").alias("low_price"),
       F.max("price").alias("high_price")))
_q("source_status", "seller_id:l n_cycles:l ordered:l active:l n_web:l n_new:l",
   lambda c: c.t.status().groupBy("seller_id").agg(
       F.count("*").alias("n_cycles"), F.sum("flag_order").alias("ordered"),
       F.sum("flag_active").alias("active"),
       F.count_if(F.col("channel").isin("WEB", "WMX")).alias("n_web"),
       F.count_if(F.col("behaviour") == "Nuevas").alias("n_new")))

# ---- parameter selection and validation ----------------------------------------
_q("run_parameters", "country:s process_cycle:s target_cycle:s profile:s slots:i top_slots:i " + OFFER,
   lambda c: c.e.parameter_rows)
_q("product_list", OFFER, lambda c: c.e.offers)
_q("gift_list", "offer_type:s offer_id:s product_id:s units:i price:d country:s",
   lambda c: c.e.gifts)
_q("estimation_products", OFFER.split(" limit_units")[0],
   lambda c: L.all_products(c.e.sibling(load=ESTIMATION).parameter_rows))
_q("slot_counts", "target_cycle:s slots:i top_slots:i",
   lambda c: L.slot_counts(c.e.sibling(load=ESTIMATION).parameter_rows))


def _checked(c: Context, profile: str = "2", **options) -> DataFrame:
    """The rows that the checks of a run see: those of its target cycle alone."""
    return L.run_rows(c.t.offer_parameters(), ESTABLISHED_RUN.with_(profile=profile), target=True, **options)


_q("validate_missing_products", "product_id:s", lambda c: V.missing_products(_checked(c), c.t.products()))
_q("validate_several_parents", "offer_id:s n_parents:l", lambda c: V.several_parents(_checked(c)))
_q("validate_repeated_codes", "sales_code:s n_rows:l", lambda c: V.repeated_sales_codes(_checked(c)))
_q("validate_without_parent", "profile:s offer_id:s", lambda c: V.offers_without_parent(_checked(c, any_profile=True)))
_q("validate_no_parameters", "n_rows:l", lambda c: V.no_parameters(_checked(c, "9")))
_q("validation_report", "message:s", lambda c: V.validation_report(
    c.t.offer_parameters(), c.t.products(), ESTABLISHED_RUN.with_(profile="2")))
_q("validation_report_estimation", "message:s", lambda c: V.validation_report(
    c.t.estimation_parameters(), c.t.products(),
    ESTABLISHED_RUN.with_(load=ESTIMATION, profile="9")))

# ---- seller base ---------------------------------------------------------------
BASE = ("seller_id:l region_id:i region:s zone:s segment:s process_cycle:s profile:s seniority:i "
        "kind:s")
_q("base_new", "seller_id:l", lambda c: B.new_sellers(
    c.n.recent_status, c.t.sellers(), c.n.profiles, NEW_RUN))
_q("base_new_all", "seller_id:l", lambda c: B.new_sellers(
    c.n.recent_status, c.t.sellers(), c.n.profiles, NEW_RUN.with_(personalisation="OPT")))
_q("base_ordering", "seller_id:l net_sales:d", lambda c: B.ordering_sellers(
    c.t.sales(36025, 36027), c.e.kinds, ESTABLISHED_RUN))
_q("base_fifth_sixth", "seller_id:l", lambda c: B.fifth_sixth_sellers(
    c.n.recent_status, c.t.sellers(), NEW_RUN))
_q("base_info", BASE, lambda c: c.e.base_all)
_q("base_info_new_run", BASE, lambda c: c.n.base_all)
_q("base_profiled", BASE, lambda c: c.profiled.base_all)
_q("base_peer_profile", "seller_id:l kind:s peer_profile:i", lambda c: c.e.base_with_profile)

# ---- products, sales, status ---------------------------------------------------
_q("offer_items", "offer_type:s offer_id:s product_id:s units:i descr:s price:d brand:s item_id:l "
   "flag_top:i", lambda c: c.e.items)
_q("offer_products", "product_id:s offer_type:s offer_id:s sales_code:s units:i price:d parent:i "
   "flag_top:i descr:s brand:s category:s limit_units:i flag_last_minute:i",
   lambda c: c.e.offer_products)
_q("item_codes", "offer_id:s product_id:s item_code:s", lambda c: c.e.offer_products_coded)
_q("offer_units", "offer_id:s total_units:l", lambda c: c.e.units)
_q("status_history", "seller_id:l cycle:i flag_order:i flag_active:i segment:s channel:s",
   lambda c: K.status_history(c.t.status(36004, 36027), 36004, 36027))
_q("base_status", "seller_id:l cycle:i flag_order:i flag_active:i",
   lambda c: K.base_status(c.e.base, c.e.history_status))
_q("seller_activity", "seller_id:l ordered_cycles:l web_recent:i active_now:i segment_now:s",
   lambda c: c.e.activity.withColumn("ordered_cycles", cyc.cycle_count("order_cycles")))
_q("valid_sales", "cycle:i seller_id:l item_id:l offer_kind:s territory:i invoice:l sales_code:s "
   "units:i net:d", lambda c: c.e.valid_sales)

# ---- single offers -------------------------------------------------------------
_q("single_products", "offer_id:s offer_type:s product_id:s units:i list_price:d flag_top:i descr:s",
   lambda c: c.e.single_products)
_q("single_sales", "seller_id:l cycle:i item_id:l offer_id:s product_id:s units:i net:d",
   lambda c: c.e.single_sales)
_q("sales_windows_6", SOP + "sales_6c:d sales_prev6:d sales_6c_ly:d", lambda c: c.e.single_history)
_q("rfm_single_24", SOP + "frequency_24c:l recency_24c:i sales_24c:d mean_24c:d",
   lambda c: c.e.single_history)
_q("orders_enough_units", SOP + "enough_orders:l",
   lambda c: c.e.single_history.where(F.col("enough_orders") > 0))
_q("listed_cycles", "product_id:s cycle:i",
   lambda c: R.listed_rows(c.e.single_sales, c.e.catalog).distinct())
_q("ordered_cycles", "seller_id:l cycle:i", lambda c: K.base_status(c.e.base, c.e.history_status)
   .where(F.col("flag_order") == 1).select("seller_id", "cycle").distinct())
_q("listed_and_ordered", SOP + "listed_cycles:l", lambda c: c.e.listed_and_ordered)
_q("trigger_rate", SOP + "trigger_rate:d", lambda c: c.e.trigger_rates)
_q("price_catalog", "offer_id:s product_id:s item_id:l cycle:i offer_kind:s sales_code:s price:d",
   lambda c: c.e.single_catalog)
PRICES = SOP + "price:d exposures:l pure_orders:l probability:d"
_q("price_exposure", PRICES, lambda c: c.e.single_prices)
_q("optimal_price", SOP + "optimal_price:d", lambda c: c.e.optimal_prices)
_q("price_minimum", "offer_id:s product_id:s min_price:d",
   lambda c: R.minimum_prices(c.e.single_prices))
GRID = (SOP + "region_id:i segment:s seniority:i flag_top:i list_price:d sales_6c:d sales_prev6:d "
        "sales_6c_ly:d sales_24c:d mean_24c:d frequency_24c:d recency_24c:d repurchase_cycle:d "
        "repurchase_gap:d min_sale_6c:d optimal_price:d trigger_rate:d min_price:d flag_bought:i")
_q("grid_single", GRID, lambda c: c.e.single_grid)

# ---- bundles -------------------------------------------------------------------
_q("bundle_products", "offer_id:s offer_type:s product_id:s units:i list_price:d flag_top:i descr:s",
   lambda c: c.e.bundle_products)
_q("bundle_sales", "seller_id:l cycle:i item_id:l offer_id:s product_id:s units:i net:d",
   lambda c: c.e.bundle_sales)
_q("bundle_rfm_24", SOP + "frequency_24c:l recency_24c:i sales_24c:d sales_6c:d sales_prev6:d "
   "sales_6c_ly:d", lambda c: c.e.bundle_product_history)
_q("repurchase_cycle", SOP + "lines:l repurchase_cycle:d",
   lambda c: c.e.bundle_product_history.where(F.col("repurchase_cycle").isNotNull()))
_q("bundle_sizes", "offer_id:s offer_type:s n_products:l", lambda c: c.e.bundle_sizes)
_q("bundle_complete_cycles", SO + "cycle:i net:d", lambda c: c.e.bundle_cycles.where("complete"))
_q("bundle_min_sale", SO + "min_sale_6c:d",
   lambda c: c.e.bundle_history.where(F.col("min_sale_6c").isNotNull()))
_q("bundle_totals", SO + "sales_24c:d recency_24c:i frequency_24c:l", lambda c: c.e.bundle_history)
_q("bundle_enough_units", SO + "enough_orders:l",
   lambda c: c.e.bundle_history.where(F.col("enough_orders") > 0))
_q("bundle_listed_and_ordered", SO + "listed_cycles:l", lambda c: c.e.bundle_listed_and_ordered)
_q("bundle_trigger", SO + "trigger_rate:d", lambda c: c.e.bundle_trigger_rates)
_q("bundle_price_catalog", "offer_id:s product_id:s item_id:l cycle:i offer_kind:s sales_code:s "
   "price:d", lambda c: c.e.bundle_catalog)
_q("bundle_price_exposure", PRICES, lambda c: c.e.bundle_prices)
_q("bundle_optimal_price", SOP + "optimal_price:d", lambda c: R.optimal_prices(c.e.bundle_prices))
_q("bundle_price_minimum", "offer_id:s product_id:s min_price:d",
   lambda c: R.minimum_prices(c.e.bundle_prices))
_q("grid_bundle", GRID, lambda c: c.e.bundle_grid)

# ---- new sellers ---------------------------------------------------------------
_q("new_purchases", "cycle:i seller_id:l offer_id:s product_id:s", lambda c: c.n.new_purchases)
_q("new_entrants", "seller_id:l cycle:i behaviour:s enrol_cycle:i", lambda c: c.n.entrants)
_q("cycle_after_new", "seller_id:l next_cycle:i", lambda c: N.first_cycle_after_new(c.n.entrants))
_q("next_behaviour", "seller_id:l cycle:i behaviour:s", lambda c: c.n.next_behaviour)
_q("behaviour_totals", "behaviour:s total_sellers:l",
   lambda c: N.behaviour_totals(c.n.next_behaviour))
_q("penetration", "offer_id:s product_id:s n_const:l n_inconst:l pen_const:d pen_inconst:d",
   lambda c: N.penetration(c.n.next_behaviour, c.n.new_purchases, ["offer_id", "product_id"]))
_q("new_frequency", SOP + "frequency:l", lambda c: N.frequency(
    c.n.base, c.n.new_purchases, NEW_RUN, ["offer_id", "product_id"]))
_q("new_grid", SOP + "flag_top:i price:d units:i frequency:d pen_const:d pen_inconst:d "
   "penetration:d", lambda c: c.n.new_grid)
_q("new_probability", SOP + "frequency_z:d penetration_z:d price_z:d score:r score_z:d "
   "probability:r", lambda c: c.n.new_scores)
_q("new_probability_table", "country:s process_cycle:s target_cycle:s seller_id:l offer_id:s "
   "flag_top:i probability:r kind:s personalisation:s engine:i profile:s",
   lambda c: c.n.probabilities)
_q("offer_complement", "offer_type:s offer_id:s product_id:s flag_top:i pen_const:d pen_inconst:d "
   "penetration:d price_z:d penetration_z:d score:r score_z:d units:i purchase_probability:r",
   lambda c: c.n.complement)

# ---- peer groups ---------------------------------------------------------------
for _suffix, _ws, _keys in (("segment", lambda c: c.e, GROUP),
                            ("profile", lambda c: c.by_profile, PROFILE)):
    def _reg(name, spec, build, ws=_ws, suffix=_suffix):
        _q(f"{name}_{suffix}", spec, lambda c: build(ws(c)))
    _reg("peer_group_sizes", _keys + "group_sellers:l", lambda w: w.group_sizes)
    _reg("peer_potential_sales", _keys + SOP + "cycle:i invoice:l potential:d web_recent:i",
         lambda w: G.active_potential(w.potential, w.seller_traits, w.run))
    _reg("peer_sellers", _keys + SOP + "min_sale:d pure_6c:l recency:i pure_24c:l repurchase_cycle:d",
         lambda w: w.peer_sellers)
    _reg("peer_recent", _keys + "offer_id:s product_id:s buyer_min_sale:d frequency_6c:d min_sale:d",
         lambda w: w.recent_peers)
    _reg("peer_history", _keys + "offer_id:s product_id:s buyer_recency:d buyer_frequency:l "
         "priced_buyers:l group_sellers:l repurchase_cycle:l frequency:d recency:d optimal_price:d",
         lambda w: w.history_peers)
    _reg("peer_fill_single", SOP + "frequency_24c:d recency_24c:d repurchase_cycle:d min_sale_6c:d "
         "optimal_price:d trigger_rate:r flag_bought:i", lambda w: w.single_complete)
    _reg("peer_offer_averages", _keys + "offer_id:s trigger_rate:r frequency_24c:r",
         lambda w: w.offer_averages)
    _reg("peer_table_single", _keys + "offer_id:s product_id:s frequency_24c:d recency_24c:d "
         "optimal_price:d repurchase_cycle:l min_sale_6c:d trigger_rate:r",
         lambda w: G.single_peer_table(w.history_peers, w.recent_peers, w.offer_averages, w.run))
    _reg("peer_bundle_products", _keys + "offer_id:s product_id:s repurchase_cycle:l min_price:r",
         lambda w: w.bundle_product_peers)
    _reg("peer_bundle_flags", SOP + "repurchase_cycle:d optimal_price:r flag_overdue:i "
         "flag_below_last_year:i flag_below_previous:i", lambda w: w.bundle_flagged)
    _reg("peer_bundle_rollup", SO + "sales_6c:r sales_24c:r mean_24c:r frequency_24c:r "
         "recency_24c:r recency_or_24:r repurchase_cycle:r repurchase_gap:r min_sale_6c:r "
         "optimal_price:r trigger_rate:r price_gap:r flag_overdue:l flag_below_last_year:l "
         "flag_below_previous:l flag_top:i", lambda w: w.bundle_rolled)
    _reg("peer_bundle_offers", _keys + "offer_id:s min_sale_6c:r frequency_24c:r recency_24c:r "
         "trigger_rate:r price_gap:r", lambda w: w.bundle_offer_peers)
    _reg("peer_fill_bundle", SO + "sales_gap:r frequency_24c:r recency_24c:r trigger_rate:r "
         "price_gap:r", lambda w: w.bundle_complete)
    _reg("peer_table_bundle", _keys + "offer_id:s product_id:s frequency_24c:r recency_24c:r "
         "optimal_price:r repurchase_cycle:l min_sale_6c:r trigger_rate:r",
         lambda w: G.bundle_peer_table(w.bundle_product_peers, w.bundle_offer_peers, w.run))
_q("bundle_products_from_grid", "offer_id:s product_id:s units:i price:d flag_top:i "
   "product_descr:s", lambda c: G.bundle_products_from_grid(c.e.bundle_grid, c.t.products()))
_q("bundle_price_gap", SO + "price_gap:r", lambda c: G.bundle_price_gap(
    c.e.bundle_rolled, c.e.bundle_products))

# ---- consolidation -------------------------------------------------------------
_q("single_gaps", SOP + "repurchase_gap:d price_gap:d gap:d sales_gap:d", lambda c: c.e.single_gaps)
_q("gift_items", "offer_id:s product_id:s units:i item_id:l price:d", lambda c: c.e.gift_items)
_q("gift_value", "offer_id:s gift_gap:d", lambda c: c.e.gift_values)
_q("gift_orders", "seller_id:l gift_cycles:l", lambda c: c.e.gift_orders)
_q("gift_trigger", "seller_id:l gift_rate:d", lambda c: c.e.gift_triggers)
RFM = ("seller_id:l region_id:i segment:s seniority:i offer_type:s offer_id:s sales_6c:r "
       "sales_prev6:r sales_6c_ly:r sales_24c:r mean_24c:r frequency_24c:r recency_24c:r "
       "repurchase_cycle:r repurchase_gap:r min_sale_6c:r gap:r sales_gap:r flag_bought:r "
       "optimal_price:r price_gap:r gift_gap:r trigger_rate:r gift_trigger:r total_units:i "
       "flag_top:i country:s process_cycle:s target_cycle:s kind:s personalisation:s profile:s")
_q("rfm_consolidated", RFM, lambda c: c.e.variables)
_q("rfm_consolidated_profile", RFM, lambda c: c.by_profile.variables)

# ---- gap engine ----------------------------------------------------------------
_q("gap_single", SO + "sales_gap_mc:r", lambda c: M.single_gap(c.e.run_variables))
_q("gap_bundle", SO + "sales_gap_mc:r", lambda c: M.bundle_gap(c.e.run_variables))
_q("run_variables", RFM + " peer_profile:i", lambda c: c.e.run_variables)
_q("gap_all", SO + "sales_gap_mc:r sales_gap_round:d optimal_price_round:d sales_gap_mc_round:d",
   lambda c: c.e.gaps)
_q("gap_all_profile", SO + "sales_gap_mc:r", lambda c: c.by_profile.gaps)
_q("engine_statistics", " ".join(f"mean_{x}:d sd_{x}:d" for x in M.Z_COLUMNS.values()),
   lambda c: M.statistics(c.e.gaps))
_q("zscores", SO + " ".join(f"{z}:d" for z in M.Z_COLUMNS), lambda c: M.z_scores(c.e.gaps))
_q("opportunity", SO + "opportunity:d opportunity_mc:d", lambda c: c.e.opportunities)
_q("normalised_opportunity", SO + "opportunity_z:d opportunity_mc_z:d", lambda c: c.e.normalised)
_q("scores", SO + "score:r score_mc:r score_units:r score_mc_units:r", lambda c: c.e.scored)
_q("rfm_scored", RFM + " score:r score_mc:r score_units:r score_mc_units:r sales_gap_mc:r n_listings:i "
   + " ".join(f"{z}:d" for z in M.Z_COLUMNS) + " opportunity:d opportunity_mc:d opportunity_z:d opportunity_mc_z:d "
   "official_profile:s flag_recommended:i",
   lambda c: M.scored_variables(c.e.scored))
PROB = ("country:s process_cycle:s target_cycle:s seller_id:l offer_id:s flag_top:i probability:r "
        "kind:s personalisation:s engine:i profile:s")
_q("probability_plain", PROB, lambda c: c.e.probabilities)
_q("probability_engine", PROB, lambda c: c.engine.probabilities)

# ---- showroom ranking ----------------------------------------------------------
_q("slot_plan", "slots:i top_slots:i fixed_slots:i free_slots:i", lambda c: c.e.slot_plan)
_q("forced_slot_rows", "brand:s category:s forced_kind:i slot:i", lambda c: c.e.forced)
_q("fixed_slots", "brand:s category:s slot:i n_offers:l", lambda c: T.fixed_slots(c.e.forced)
   .join(c.e.offer_products, ["brand", "category"], "left")
   .groupBy("brand", "category", "slot").agg(F.count("offer_id").alias("n_offers")))
_q("not_to_repeat", "offer_id:s product_id:s", lambda c: c.e.offer_products.join(
    T.not_to_repeat(c.e.forced), ["brand", "category"], "left_semi"))
_q("candidates", SO + "flag_top:i probability:r",
   lambda c: c.e.candidates())
_q("offer_rank", SO + "probability:r position:i", lambda c: c.e.ranking)
_q("final_offers", SO + "probability:r order:i interface_order:i",
   lambda c: T.final_offers(c.e.ranking))
_q("top_slots", SO + "probability:r type:s", lambda c: c.e.top_offers)
_q("proposals", SOP + "brand:s category:s probability:r",
   lambda c: T.proposals(c.e.showroom_candidates, c.e.offer_products))
_q("forced_slots", SO + "probability:r rank:i",
   lambda c: c.e.slot_choices.where(F.col("type") == "F"))
_q("free_slots", SO + "probability:r rank:i",
   lambda c: c.e.slot_choices.where(F.col("type") == "N"))
FINAL = SO + "probability:r type:s priority:i order:i"
_q("final_order", FINAL, lambda c: c.e.final_order)
_q("final_order_engine", FINAL, lambda c: c.engine.final_order)
_q("final_order_new", FINAL, lambda c: c.new_showroom.final_order)
_q("sellers_per_offer", "offer_id:s total_sellers:l", lambda c: T.sellers_per_offer(c.e.final_order))
_q("estimated_totals", "offer_type:s offer_id:s brand:s category:s solo_type:s product_id:s descr:s units:i "
   "total_sellers:l personalisation:s", lambda c: c.e.estimates)

# ---- daily offer ---------------------------------------------------------------
INTERFACE = ("country:s personalisation:s sale_cycle:s seller_id:s product_id:s item_code:s "
             "sales_code:s portal_zone:s start_day:i end_day:i order:i flag_manual:i kind:s "
             "link:i price_per_unit:d limit_units:i flag_last_minute:i profile:s")


def _daily_candidates(w: Workspace) -> DataFrame:
    return w.candidates(drop_zero=False)


def _interface(w: Workspace, configured: bool | None) -> DataFrame:
    return D.daily_interface(
        _daily_candidates(w), w.complement if w.run.kind == NEW else None, w.slot_plan,
        w.offer_products_coded, w.sellers, w.tables.offer_parameters(),
        w.tables.start_days, w.run, configured)


_q("daily_established", SO + "probability:r order:i",
   lambda c: D.daily_established(_daily_candidates(c.daily), c.daily.slot_plan))
_q("daily_new", SO + "probability:r order:i",
   lambda c: D.daily_new(_daily_candidates(c.n), c.n.slot_plan))
_q("daily_complement", "seller_id:s offer_id:s probability:r order:i",
   lambda c: D.generic_complement(c.n.complement))
_q("daily_interface_configured", INTERFACE, lambda c: _interface(c.daily, True))
_q("daily_interface_default", INTERFACE, lambda c: _interface(c.daily, False))
_q("daily_interface_new_configured", INTERFACE, lambda c: _interface(c.n, True))
_q("daily_interface_new", INTERFACE, lambda c: _interface(c.n, None))


# ---- stored tables -------------------------------------------------------------
def _store(c: Context):
    """A repository whose tables live under a new stage folder."""
    folder = new_stage_path(c.spark, "tables")
    return Repository(c.spark, "default", folder), f"offerlens_{folder.rsplit('-', 1)[1]}"


def _cycle_totals(c: Context) -> DataFrame:
    return (c.t.sales(36010, 36027).groupBy("cycle", "seller_id")
            .agg(F.sum("net").alias("net")))


def _parameter_csv(c: Context) -> DataFrame:
    """Offer parameters through a header CSV and back, typed, one country."""
    files = ParameterFiles(c.spark, new_stage_path(c.spark, "csv"), "C1")
    write_file(c.t.offer_parameters(), "offers", files.path("offers"))
    return files.get("offers")


def _full_overwrite(c: Context) -> DataFrame:
    repo, table = _store(c)
    repo.save(c.t.sellers(), table)
    return repo.save(c.t.sellers().where(F.col("enrol_cycle") > NEW_RUN.process_cycle), table)


def _partition_overwrite(c: Context) -> DataFrame:
    """Store all cycles, then only the last one again with doubled sales."""
    repo, table = _store(c)
    totals = _cycle_totals(c)
    repo.save(totals, table, ["cycle"])
    last = totals.where(F.col("cycle") == 36027).withColumn(
        "net", (F.col("net") * 2).cast(totals.schema["net"].dataType))
    return repo.save(last, table, ["cycle"])


def _self_overwrite(c: Context) -> DataFrame:
    """Double every partition of a table from the table itself."""
    repo, table = _store(c)
    stored = repo.save(_cycle_totals(c), table, ["cycle"])
    doubled = stored.withColumn("net", (F.col("net") * 2).cast(stored.schema["net"].dataType))
    repo.save(doubled, table, ["cycle"], overwrite_self=True)
    return repo.save(doubled, table, skip=True)


def _source_table(c: Context) -> DataFrame:
    """A catalog table under its warehouse names, one country, renamed."""
    view = "DWH_DEBELISTA"
    (c.t.sellers().select(F.when(F.col("seller_id") % 3 == 0, "C2").otherwise("C1").alias("CODPAIS"),
                          F.col("seller_id").alias("CODEBELISTA"),
                          cyc.format_cycle("enrol_cycle").alias("AnioCampanaIngreso"))
     .createOrReplaceTempView(view))
    return source_table(c.spark, "", view, "C1")


def _run_log(c: Context) -> DataFrame:
    """A run that logs, fails, and is tried again under its id: one set of rows stays."""
    repo, table = _store(c)
    counts = (c.t.status(ESTABLISHED_RUN.recent_start, ESTABLISHED_RUN.process_cycle, sellers=c.e.sellers)
              .groupBy("cycle").agg(F.sum("flag_order").alias("n")).collect())     # a row per cycle of the window
    for attempt in range(2):
        log = RunLog("run-1", ESTABLISHED_RUN, "status")
        for r in counts[:len(counts) if attempt else 2]:
            log.ok(f"{cyc.cycle_text(r['cycle'])}: {r['n']} sellers with orders")
        if not attempt:
            log.error("run failed")
        log.flush(repo, table)
    other = RunLog("run-2", ESTABLISHED_RUN, "status")
    other.ok("another run")
    stored = other.flush(repo, table)
    return stored.select("run_id", "step", "country", "process_cycle", "target_cycle", "kind", "message", "status")


def _optional_table(c: Context) -> DataFrame:
    """A stored table that is absent, empty, or has drifted, read under one schema."""
    repo, table = _store(c)
    columns = "seller_id bigint, enrol_cycle int, profile int"
    whole = c.t.sellers().join(c.e.profiles, "seller_id", "left")
    repo.save(whole.limit(0), f"{table}_empty")
    repo.save(whole.select(F.lit("x").alias("extra"), F.col("enrol_cycle").cast("bigint").alias("ENROL_CYCLE"),
                           F.col("seller_id").cast("string").alias("seller_id")), f"{table}_drifted")
    repo.save(whole, f"{table}_whole")
    out = None
    for state in ("absent", "empty", "drifted", "whole"):
        df = repo.read(f"{table}_{state}", columns).withColumn("state", F.lit(state))
        out = df if out is None else out.unionByName(df)
    return out


def _faulty_lines(parameters: DataFrame) -> DataFrame:
    """Offer lines with a text where a number belongs, or with a comma too many."""
    bad = F.col("profile") == "2"
    extra = (F.col("kind") == "N") & (F.col("flag_top") == 1)
    faulty = parameters.where(bad | extra).withColumns({
        "units": F.when(bad, F.concat(F.lit("x"), F.col("units").cast("string"))).otherwise(F.col("units").cast("string")),
        "product_id": F.when(extra, F.concat("product_id", F.lit(",?"))).otherwise(F.col("product_id"))})
    return parameters.withColumn("units", F.col("units").cast("string")).unionByName(faulty)


def _as_warehouse(c: Context) -> WarehouseTables:
    """The given tables under their original names, beside a second country, with
    parameter files that hold faulty lines.  A table or file is written when it is read."""
    folder, run = new_stage_path(c.spark, "warehouse"), ESTABLISHED_RUN
    schema = f"offerlens_{folder.rsplit('-', 1)[1]}"
    c.spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{folder}'")
    files = WrittenFiles(c.spark, f"{folder}/files", "C1", {
        "offers": lambda: _faulty_lines(c.t.offer_parameters()), "offers_estimation": c.t.estimation_parameters,
        "forced_slots": lambda: c.t.forced_slots, "forced_slots_estimation": lambda: c.t.forced_slots_estimation,
        "profiles": c.t.profiles, "start_days": lambda: c.t.start_days}, {"offers": "parameters.csv"})
    return WrittenTables(c.spark, schema, "C1", files, source_frames(c.t, run.start, run.process_cycle),
                         ["C1", "C2"], configured_days=True)


PARAMETERS = ("country:s process_cycle:s target_cycle:s kind:s personalisation:s profile:s " + OFFER
              + " slots:i top_slots:i")
SLOTS = ("country:s process_cycle:s target_cycle:s kind:s personalisation:s profile:s brand:s category:s "
         "forced_kind:i slot:i")
_q("io_parameter_csv", PARAMETERS, _parameter_csv)
_q("io_source_table", "seller_id:l enrol_cycle:i", _source_table)
_q("io_full_overwrite", "seller_id:l enrol_cycle:i", _full_overwrite)
_q("io_partition_overwrite", "seller_id:l cycle:i net:d", _partition_overwrite)
_q("io_self_overwrite", "seller_id:l cycle:i net:d", _self_overwrite)
_q("io_run_log", "run_id:s step:s country:s process_cycle:s target_cycle:s kind:s message:s status:i", _run_log)
_q("io_optional_table", "state:s seller_id:l enrol_cycle:i profile:i", _optional_table)

# ---- the same from warehouse tables and parameter files ------------------------
_q("warehouse_sales", "cycle:i ref_cycle:i seller_id:l item_id:l offer_kind:s territory:i invoice:l sales_code:s units:i net:d",
   lambda c: c.warehouse.tables.sales(ESTABLISHED_RUN.start, ESTABLISHED_RUN.process_cycle))
_q("warehouse_status", "seller_id:l cycle:i territory:i segment:s flag_order:i flag_active:i channel:s behaviour:s",
   lambda c: c.warehouse.tables.status(ESTABLISHED_RUN.recent_start, ESTABLISHED_RUN.process_cycle))
_q("warehouse_catalog", "cycle:i item_id:l offer_kind:s sales_code:s price:d normal_price:d vehicle:s",
   lambda c: c.warehouse.tables.catalog())
_q("warehouse_sellers", "seller_id:l enrol_cycle:i", lambda c: c.warehouse.tables.sellers())
_q("warehouse_products", "product_id:s item_id:l descr:s brand:s category:s solo_type:s",
   lambda c: c.warehouse.tables.products())
_q("warehouse_geography", "territory:i zone:s region_id:i region:s", lambda c: c.warehouse.geography)
_q("warehouse_base", "seller_id:l region_id:i region:s zone:s segment:s process_cycle:s profile:s seniority:i kind:s",
   lambda c: c.warehouse.base_all)
_q("parameter_offers", PARAMETERS, lambda c: c.warehouse.tables.offer_parameters())
_q("parameter_offers_estimation", PARAMETERS, lambda c: c.warehouse.tables.estimation_parameters())
_q("parameter_forced_slots", SLOTS, lambda c: c.warehouse.tables.forced_slots)
_q("parameter_forced_slots_estimation", SLOTS, lambda c: c.warehouse.tables.forced_slots_estimation)
_q("parameter_profiles", "seller_id:l profile:i", lambda c: c.warehouse.profiles)
_q("parameter_rejected", "file:s line:s reason:s", lambda c: c.warehouse.tables.files.rejected())
_q("warehouse_final_order", FINAL, lambda c: c.warehouse.final_order)


# ---- contexts ------------------------------------------------------------------
_CONTEXTS: dict[tuple, Context] = {}


def _signature(spark: SparkSession, folder: str) -> tuple:
    """Number, bytes and a hash of names, sizes and times of all input files, as any
    store lists them, part files of nested folders too."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
             .select("length", F.xxhash64("path", "length", "modificationTime").alias("h")))
    return tuple(files.agg(F.count("h"), F.sum("length"),
                           F.sum(F.col("h").cast("decimal(38,0)"))).first())


def context(spark: SparkSession, folder: str, fresh: bool = False) -> Context:
    """The context of a folder.  Stage tables are shared by the queries of one
    session as long as the input files stay the same; ``fresh`` starts anew."""
    if fresh:
        return Context(spark, folder)
    key = (spark.sparkContext.applicationId, folder, _signature(spark, folder))
    if key not in _CONTEXTS:
        _CONTEXTS[key] = Context(spark, folder)
    return _CONTEXTS[key]
