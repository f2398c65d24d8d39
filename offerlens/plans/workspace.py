"""The intermediate frames of a run, each built at most once.

``Workspace`` names the frames of one (tables, run) pair.  Frames marked
``@staged`` are written as stage tables and read back, because several later
steps read them, or because they are short frames that large ones are joined with
and whose size Spark should know; the others stay lazy and are planned into their readers.
"""

from __future__ import annotations

from functools import cached_property, wraps

from pyspark.sql import DataFrame

from offerlens.operators import (base as base_ops, consolidate, gap_engine, new_sellers, peers,
                                 ranking, rfm, sales as sales_ops, selection)
from offerlens.params import BUNDLE, NEW, SINGLE, RunParams, SHOWROOM
from offerlens.sources.staging import cut, placed

# Rows of the (seller, offer product) table in a bucket, about, and the least number of buckets
BUCKET_ROWS = 150_000
LEAST_BUCKETS = 8


class frame(cached_property):
    """A frame of a run, built at most once.  A shared one is that of the other run, which
    builds it when either run asks for it, and not before."""

    def __get__(self, instance, owner=None):
        if instance is not None and self.attrname in instance.shared:
            return instance.__dict__.setdefault(
                self.attrname, getattr(instance.shared[self.attrname], self.attrname))
        return super().__get__(instance, owner)


def staged(fn):
    @wraps(fn)
    def build(self) -> DataFrame:
        return cut(fn(self), fn.__name__)
    prop = frame(build)
    prop.__set_name__(None, fn.__name__)
    return prop


def by_seller(fn):
    """A staged frame of sellers and offers.  All of a run are dealt by seller over the same
    buckets, so they meet and are reduced by seller where they lie."""
    @wraps(fn)
    def build(self) -> DataFrame:
        return placed(fn(self), fn.__name__, self.buckets)
    prop = frame(build)
    prop.__set_name__(None, fn.__name__)
    return prop


# Frames that depend neither on the peer grouping nor on the rule set
HISTORY_FRAMES = ("products", "kinds", "items", "single_products", "bundle_products", "sellers",
                  "base_all", "base", "base_with_profile", "activity", "tagged_sales", "catalog", "cycle_sales", "single_prices", "single_grid",
                  "bundle_prices", "bundle_grid")
# Frames of one peer grouping, shared by the showroom and the daily rule set
PEER_FRAMES = ("offers", "gifts", "offer_products", "peer_sellers", "single_filled",
               "bundle_rolled")


class Workspace:
    def __init__(self, tables, run: RunParams):
        self.tables, self.run = tables, run
        self.shared: dict[str, Workspace] = {}     # frames that another run builds
        self.provided: set[str] = set()            # frames that are stored tables
        if hasattr(tables, "expect"):
            tables.expect(run.new_start if run.kind == NEW else run.start, run.target_cycle)

    def sibling(self, share: tuple[str, ...] = (), **changes) -> "Workspace":
        """Another run on the same tables.  ``share`` names the frames that do
        not depend on what changes, so they are built once for both runs, and only
        those that one of them reads."""
        other = Workspace(self.tables, self.run.with_(**changes))
        other.shared = {name: self for name in share}
        return other

    def provide(self, **frames: DataFrame) -> "Workspace":
        """Use stored tables for some frames instead of building them."""
        self.__dict__.update(frames)
        self.provided |= frames.keys()
        return self

    @frame
    def buckets(self) -> int:
        """Over how many buckets the tables of sellers and offers are dealt: as the grid grows."""
        if "variables" in self.provided:
            rows = gap_engine.of_run(self.variables, self.run).count()     # partitions of a stored table
        else:
            rows = self.sellers.count() * self.offer_products.count()      # both are staged
        return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))

    # ---- parameters ----------------------------------------------------------
    @staged
    def parameter_rows(self) -> DataFrame:
        source = selection.pick_source(self.run, self.tables.offer_parameters(),
                                       self.tables.estimation_parameters())
        return selection.run_rows(source, self.run)

    @frame
    def offers(self) -> DataFrame:
        return selection.product_list(self.parameter_rows)

    @frame
    def gifts(self) -> DataFrame:
        return selection.gift_list(self.parameter_rows)

    @frame
    def products(self) -> DataFrame:
        return self.tables.products()

    @frame
    def kinds(self) -> DataFrame:
        return self.tables.offer_kinds()

    @frame
    def profiles(self) -> DataFrame:
        return selection.run_profiles(self.tables.profiles(), self.run)

    @frame
    def geography(self) -> DataFrame:
        return selection.run_geography(self.tables.geography(), self.run)

    @staged
    def items(self) -> DataFrame:
        return sales_ops.offer_items(self.offers, self.products)

    @staged
    def offer_products(self) -> DataFrame:
        return sales_ops.offer_products(self.offers, self.products)

    @frame
    def offer_products_coded(self) -> DataFrame:
        p = self.run.target_cycle
        return sales_ops.with_item_code(self.offer_products, self.tables.catalog(p, p),
                                        self.products, self.run)

    @frame
    def units(self) -> DataFrame:
        return sales_ops.offer_units(self.offer_products)

    # ---- base ----------------------------------------------------------------
    @staged
    def sellers(self) -> DataFrame:
        """Enrolment cycles: the one frame that needs the whole order history."""
        return self.tables.sellers()

    @staged
    def recent_status(self) -> DataFrame:
        """Enough status history to find sellers of their first six cycles."""
        p = self.run.process_cycle
        return self.tables.status(p - 5, p, sellers=self.sellers)

    @staged
    def base_all(self) -> DataFrame:
        t, p = self.tables, self.run.process_cycle
        return base_ops.seller_base(t.sales(p - 2, p), self.recent_status, self.sellers, self.kinds,
                                    self.geography, self.profiles, self.run)

    @frame
    def base(self) -> DataFrame:
        return base_ops.filter_base(self.base_all, self.run)

    @frame
    def base_with_profile(self) -> DataFrame:
        return base_ops.with_peer_profile(self.base, self.profiles)

    # ---- history, established sellers ---------------------------------------
    @staged
    def history_status(self) -> DataFrame:
        r = self.run
        return sales_ops.status_history(
            self.tables.status(r.start, r.process_cycle, only=self.base_all,
                               sellers=self.sellers),
            r.start, r.process_cycle)

    @staged
    def activity(self) -> DataFrame:
        own = self.history_status.join(self.base.select("seller_id"), "seller_id", "left_semi")
        return sales_ops.seller_activity(own, self.run)

    @frame
    def valid_sales(self) -> DataFrame:
        r = self.run
        return sales_ops.valid_sales(
            self.tables.sales(r.start, r.process_cycle, only=self.base_all), self.kinds,
            r.start, r.process_cycle, items=self.items)

    @staged
    def tagged_sales(self) -> DataFrame:
        r = self.run
        lines = sales_ops.valid_sales(
            self.tables.sales(r.start, r.process_cycle, only=self.base_all), self.kinds,
            r.start, r.process_cycle)
        return sales_ops.tag_with_offers(lines, self.items)

    @frame
    def single_sales(self) -> DataFrame:
        return rfm.of_type(self.tagged_sales, SINGLE)

    @frame
    def bundle_sales(self) -> DataFrame:
        return rfm.of_type(self.tagged_sales, BUNDLE)

    @staged
    def catalog(self) -> DataFrame:
        return self.tables.catalog(self.run.start, self.run.process_cycle)

    @staged
    def cycle_sales(self) -> DataFrame:
        return rfm.cycle_sales(self.tagged_sales)

    @frame
    def product_history(self) -> DataFrame:
        return rfm.product_history(self.cycle_sales, self.run)

    # ---- single offers -------------------------------------------------------
    @staged
    def single_products(self) -> DataFrame:
        return rfm.grid_products(self.items, SINGLE)

    @frame
    def single_history(self) -> DataFrame:
        return rfm.of_type(self.product_history, SINGLE)

    @staged
    def listed(self) -> DataFrame:
        return rfm.listed_cycles(self.single_sales, self.catalog, self.run)

    @frame
    def listed_and_ordered(self) -> DataFrame:
        return rfm.listed_and_ordered(self.single_history, self.listed, self.activity)

    @frame
    def trigger_rates(self) -> DataFrame:
        return rfm.trigger_rates(self.listed_and_ordered)

    @frame
    def single_catalog(self) -> DataFrame:
        return sales_ops.price_catalog(self.catalog, self.kinds, self.items, self.run, SINGLE)

    @staged
    def single_prices(self) -> DataFrame:
        return rfm.price_table(self.single_sales, self.single_catalog, self.activity, self.run)

    @frame
    def optimal_prices(self) -> DataFrame:
        return rfm.optimal_prices(self.single_prices)

    @frame
    def single_variables(self) -> DataFrame:
        return rfm.single_variables(self.single_history, self.trigger_rates, self.optimal_prices)

    @by_seller
    def single_grid(self) -> DataFrame:
        return rfm.single_grid(self.base_with_profile, self.single_products, self.single_variables,
                               self.buckets)

    # ---- bundles -------------------------------------------------------------
    @staged
    def bundle_products(self) -> DataFrame:
        return rfm.grid_products(self.items, BUNDLE)

    @staged
    def bundle_sizes(self) -> DataFrame:
        return rfm.bundle_sizes(self.bundle_products)

    @frame
    def bundle_product_history(self) -> DataFrame:
        return rfm.repurchase_cycle(rfm.of_type(self.product_history, BUNDLE), self.run)

    @frame
    def bundle_cycles(self) -> DataFrame:
        return rfm.bundle_cycles(self.cycle_sales, self.bundle_sizes)

    @frame
    def bundle_history(self) -> DataFrame:
        return rfm.bundle_history(self.bundle_cycles, self.run)

    @staged
    def bundle_listed(self) -> DataFrame:
        return rfm.bundle_listed_cycles(self.items, self.bundle_sizes, self.catalog, self.run)

    @frame
    def bundle_listed_and_ordered(self) -> DataFrame:
        return rfm.bundle_listed_and_ordered(self.bundle_history, self.bundle_listed, self.activity)

    @frame
    def bundle_trigger_rates(self) -> DataFrame:
        return rfm.trigger_rates(self.bundle_listed_and_ordered)

    @frame
    def bundle_catalog(self) -> DataFrame:
        return sales_ops.price_catalog(self.catalog, self.kinds, self.items, self.run, BUNDLE)

    @staged
    def bundle_prices(self) -> DataFrame:
        return rfm.price_table(self.bundle_sales, self.bundle_catalog, self.activity, self.run)

    @by_seller
    def bundle_grid(self) -> DataFrame:
        return rfm.bundle_grid(
            self.base_with_profile, self.bundle_products,
            rfm.bundle_product_variables(self.bundle_product_history,
                                         rfm.optimal_prices(self.bundle_prices)),
            rfm.bundle_offer_variables(self.bundle_history, self.bundle_trigger_rates),
            rfm.minimum_prices(self.bundle_prices), self.buckets)

    # ---- peers ---------------------------------------------------------------
    @frame
    def group_sizes(self) -> DataFrame:
        return peers.group_sizes(self.base_with_profile, self.run.peer_keys)

    @frame
    def potential(self) -> DataFrame:
        return peers.potential_sales(self.single_sales, self.geography, self.run)

    @frame
    def seller_traits(self) -> DataFrame:
        return peers.seller_traits(self.activity, self.base_with_profile, self.run)

    @staged
    def peer_sellers(self) -> DataFrame:
        return peers.peer_sellers(self.potential, self.seller_traits, self.run)

    @staged
    def recent_peers(self) -> DataFrame:
        return peers.recent_peers(self.peer_sellers, self.group_sizes, self.run)

    @staged
    def history_peers(self) -> DataFrame:
        return peers.history_peers(self.peer_sellers, self.optimal_prices,
                                   rfm.minimum_prices(self.single_prices), self.group_sizes,
                                   self.run)

    @by_seller
    def single_filled(self) -> DataFrame:
        return peers.fill_single(self.single_grid, self.history_peers, self.recent_peers, self.run)

    @staged
    def offer_averages(self) -> DataFrame:
        return peers.offer_averages(self.single_filled, self.run)

    @frame
    def single_complete(self) -> DataFrame:
        return peers.fill_trigger(self.single_filled, self.offer_averages, self.run)

    @staged
    def bundle_product_peers(self) -> DataFrame:
        return peers.bundle_product_peers(self.bundle_grid, self.run)

    @frame
    def bundle_flagged(self) -> DataFrame:
        return peers.bundle_flags(
            peers.fill_bundle(self.bundle_grid, self.bundle_product_peers, self.run))

    @by_seller
    def bundle_rolled(self) -> DataFrame:
        return peers.roll_up_bundle(self.bundle_flagged, self.run)

    @staged
    def bundle_offer_peers(self) -> DataFrame:
        return peers.bundle_offer_peers(self.bundle_rolled, self.run)

    @frame
    def bundle_complete(self) -> DataFrame:
        return peers.fill_bundle_offers(self.bundle_rolled, self.bundle_offer_peers, self.run)

    # ---- consolidation -------------------------------------------------------
    @frame
    def single_gaps(self) -> DataFrame:
        return consolidate.single_gaps(self.single_complete)

    @frame
    def gift_items(self) -> DataFrame:
        return consolidate.gift_items(self.gifts, self.products)

    @frame
    def gift_values(self) -> DataFrame:
        return consolidate.gift_values(self.gift_items,
                                       self.tables.normal_prices(self.gift_items), self.kinds,
                                       self.units)

    @staged
    def offer_extras(self) -> DataFrame:
        return consolidate.offer_extras(self.gift_values, self.gifts, self.units)

    @frame
    def gift_orders(self) -> DataFrame:
        r = self.run
        return consolidate.gift_orders(self.tables.sales(r.start, r.process_cycle), self.kinds,
                                       self.base, r)

    @frame
    def gift_triggers(self) -> DataFrame:
        return consolidate.gift_triggers(self.gift_orders,
                                         consolidate.ordered_cycles(self.activity))

    @frame
    def consolidated(self) -> DataFrame:
        return consolidate.consolidate(consolidate.roll_up_single(self.single_gaps), self.bundle_complete,
                                       self.offer_extras, self.gift_triggers)

    @by_seller
    def variables(self) -> DataFrame:
        return consolidate.variable_table(self.consolidated, self.run)

    # ---- gap engine ----------------------------------------------------------
    @frame
    def run_variables(self) -> DataFrame:
        return gap_engine.run_variables(self.variables, self.profiles, self.run)

    @staged
    def bundle_potential(self) -> DataFrame:
        return gap_engine.bundle_potential(gap_engine.bundle_gap(self.run_variables), self.run)

    @by_seller
    def gaps(self) -> DataFrame:
        return gap_engine.all_gaps(self.run_variables, self.bundle_potential, self.run)

    @by_seller
    def opportunities(self) -> DataFrame:
        return gap_engine.opportunity(gap_engine.z_scores(self.gaps))

    @frame
    def normalised(self) -> DataFrame:
        return gap_engine.normalised_opportunity(self.opportunities)

    @frame
    def scored(self) -> DataFrame:
        return gap_engine.scores(self.normalised)

    # ---- new sellers ---------------------------------------------------------
    @staged
    def new_purchases(self) -> DataFrame:
        t, r = self.tables, self.run
        return new_sellers.listed_purchases(
            t.sales(r.new_start, r.process_cycle), self.items,
            t.catalog(r.new_start, r.process_cycle), self.kinds, r)

    @frame
    def entrants(self) -> DataFrame:
        t, r = self.tables, self.run
        return new_sellers.recent_entrants(
            t.status(r.new_start, r.process_cycle, sellers=self.sellers), self.sellers, r)

    @staged
    def next_behaviour(self) -> DataFrame:
        return new_sellers.next_behaviour(self.entrants)

    @staged
    def offer_penetration(self) -> DataFrame:
        return new_sellers.penetration(self.next_behaviour, self.new_purchases, ["offer_id"])

    @staged
    def new_grid(self) -> DataFrame:
        freq = new_sellers.frequency(self.base, self.new_purchases, self.run, ["offer_id"])
        return new_sellers.seller_grid(self.base, self.offer_products, freq,
                                       self.offer_penetration)

    @frame
    def new_scores(self) -> DataFrame:
        return new_sellers.seller_scores(self.new_grid)

    @frame
    def complement(self) -> DataFrame:
        return new_sellers.offer_complement(self.offer_products, self.offer_penetration)

    # ---- ranking -------------------------------------------------------------
    @by_seller
    def probabilities(self) -> DataFrame:
        if self.run.kind == NEW:
            return new_sellers.probability_table(self.new_scores, self.run)
        return gap_engine.probability_table(self.scored, self.run)

    @staged
    def ranking_rows(self) -> DataFrame:
        """Showroom rules rank by the estimation file, whatever the load."""
        source = (self.tables.estimation_parameters() if self.run.personalisation == SHOWROOM
                  else self.tables.offer_parameters())
        return selection.run_rows(source, self.run, target=True)

    @frame
    def forced(self) -> DataFrame:
        slots = (self.tables.forced_slots_estimation if self.run.personalisation == SHOWROOM
                 else self.tables.forced_slots)
        return selection.forced_slot_rows(slots, self.run)

    @frame
    def slot_plan(self) -> DataFrame:
        return ranking.slot_plan(selection.slot_counts(self.ranking_rows), self.forced)

    def candidates(self, drop_zero: bool = True) -> DataFrame:
        parts = None if "probabilities" in self.provided else self.buckets
        return ranking.candidates(self.probabilities, self.run, drop_zero, parts)

    @frame
    def ranking(self) -> DataFrame:
        return ranking.ranked(self.candidates())

    @frame
    def showroom_candidates(self) -> DataFrame:
        """Established sellers set their third offer aside for the final offer."""
        if self.run.kind == NEW:
            return ranking.best_per_offer(self.candidates())
        return ranking.without_final_offer(self.ranking)

    @frame
    def top_offers(self) -> DataFrame:
        return ranking.top_offers(self.showroom_candidates, self.slot_plan)

    @staged
    def offer_cards(self) -> DataFrame:
        return ranking.offer_cards(self.offer_products, self.forced)

    @frame
    def slot_choices(self) -> DataFrame:
        return ranking.fill_slots(self.showroom_candidates, self.offer_cards, self.slot_plan)

    @staged
    def final_order(self) -> DataFrame:
        return ranking.final_order(self.top_offers, self.slot_choices)

    @frame
    def estimates(self) -> DataFrame:
        return ranking.estimated_totals(
            ranking.sellers_per_offer(self.final_order),
            selection.all_products(self.ranking_rows), self.products, self.run)
