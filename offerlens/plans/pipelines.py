"""The three runs of the engine, handing over through stored tables.

1. :func:`build_scores`: validate, seller base, variables, peer groups (or, for
   new sellers, probabilities at once);
2. :func:`apply_gap_engine`: score the variable table in place, probabilities;
3. :func:`apply_ranking_rules`: showroom estimates or the daily-offer interface.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_text
from offerlens.operators import daily, gap_engine, peers, ranking, selection, validation
from offerlens.params import DAILY_OFFER, ESTABLISHED, NEW, SHOWROOM, RunParams
from offerlens.plans.workspace import Workspace
from offerlens.sources.repository import Repository, RunLog
from offerlens.sources.session import tune

RUN_KEYS = ["country", "process_cycle", "target_cycle", "kind", "personalisation", "profile"]
# Partition columns of the stored tables
BASE_PARTITIONS = ["country", "process_cycle", "profile"]
PEER_PARTITIONS = [*RUN_KEYS, "offer_type", "peer_grouping"]
VARIABLE_PARTITIONS = RUN_KEYS
PROBABILITY_PARTITIONS = [*RUN_KEYS, "engine"]
PROBABILITY_SCHEMA = ("seller_id bigint, offer_id string, flag_top int, probability double, "
                      "country string, process_cycle string, target_cycle string, kind string, "
                      "personalisation string, profile string, engine int")


def _logged(log: RunLog, repository: Repository, name: str, step: Callable[[], DataFrame]) -> DataFrame:
    """Run a step; success and failure both end up in the run log."""
    tune(repository.spark)
    log.step = name
    try:
        result = step()
        log.ok("run complete")
        return result
    except Exception as error:
        log.error(f"run failed: {error}")
        raise
    finally:
        log.flush(repository, "run_log")


def _tagged(df: DataFrame, run: RunParams, keys: dict) -> DataFrame:
    values = {"country": run.country, "process_cycle": cycle_text(run.process_cycle),
              "target_cycle": cycle_text(run.target_cycle), "kind": run.kind,
              "personalisation": run.personalisation, "profile": run.profile, **keys}
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def build_scores(tables, run: RunParams, repository: Repository, log: RunLog) -> DataFrame:
    """Store base, variables and peer groups; returns the variables (established)
    or the probabilities (new sellers)."""
    w = Workspace(tables, run)

    def step() -> DataFrame:
        parameters = selection.pick_source(run, tables.offer_parameters(),
                                           tables.estimation_parameters())
        # one message row per failed check
        for row in validation.validation_report(parameters, w.products, run).collect():
            log.error(row["message"])
        country = w.base_all.withColumn("country", F.lit(run.country))
        stored = repository.save(country, "seller_base", BASE_PARTITIONS)
        w.provide(base_all=stored.where(
            (F.col("country") == run.country) & (F.col("profile") == run.profile)
            & (F.col("process_cycle") == cycle_text(run.process_cycle)))
            .select(*w.base_all.columns))
        if run.kind == NEW:
            repository.save(_tagged(w.complement, run, {}), "offer_complement", RUN_KEYS)
            return repository.save(w.probabilities, "probabilities", PROBABILITY_PARTITIONS)
        w.provide(single_grid=repository.save(w.single_grid, "single_variables"),
                  bundle_grid=repository.save(w.bundle_grid, "bundle_variables"))
        for kind, table in (("Individual", peers.single_peer_table(
                w.history_peers, w.recent_peers, w.offer_averages, run)),
                            ("Bundle", peers.bundle_peer_table(
                                w.bundle_product_peers, w.bundle_offer_peers, run))):
            repository.save(_peer_rows(table, run, kind), "peer_groups", PEER_PARTITIONS)
        return repository.save(w.variables, "variables", VARIABLE_PARTITIONS)

    return _logged(log, repository, "scores", step)


def _peer_rows(table: DataFrame, run: RunParams, offer_type: str) -> DataFrame:
    """Both peer tables under one schema; keys of the other grouping stay blank."""
    have = set(table.columns)
    blanks = {"region_id": F.lit(0), "segment": F.lit(""), "peer_profile": F.lit(None).cast("int")}
    df = table.withColumns({k: v for k, v in blanks.items() if k not in have})
    df = df.select("region_id", "segment", "peer_profile", "offer_id", "product_id",
                   *[F.col(c).cast("double").alias(c) for c in
                     ("frequency_24c", "recency_24c", "optimal_price", "repurchase_cycle",
                      "min_sale_6c", "trigger_rate")])
    return _tagged(df, run, {"offer_type": offer_type, "peer_grouping": run.peer_grouping})


def apply_gap_engine(tables, run: RunParams, repository: Repository, log: RunLog) -> DataFrame:
    """Score the stored variables in place and store the probabilities."""
    def step() -> DataFrame:
        w = Workspace(tables, run).provide(
            variables=repository.spark.table(repository.name("variables")))
        repository.save(gap_engine.scored_variables(w.scored), "variables", VARIABLE_PARTITIONS,
                        overwrite_self=True)
        return repository.save(w.probabilities, "probabilities", PROBABILITY_PARTITIONS)

    if run.kind != ESTABLISHED:
        return repository.read("probabilities", PROBABILITY_SCHEMA)
    return _logged(log, repository, "gap_engine", step)


def apply_ranking_rules(tables, run: RunParams, repository: Repository, log: RunLog) -> DataFrame:
    """Showroom: estimated totals.  Daily offer: the 18-column interface."""
    w = Workspace(tables, run).provide(
        probabilities=repository.read("probabilities", PROBABILITY_SCHEMA))

    def step() -> DataFrame:
        if run.personalisation == SHOWROOM:
            return repository.save(w.estimates, "estimated_totals")
        if run.personalisation != DAILY_OFFER:
            raise ValueError(f"no ranking rules for {run.personalisation}")
        complement = None
        if run.kind == NEW:
            stored = repository.spark.table(repository.name("offer_complement"))
            complement = selection.run_rows(stored, run, target=True)
        rows = daily.daily_interface(
            ranking.candidates(w.probabilities, run, drop_zero=False), complement, w.slot_plan,
            w.offer_products_coded, w.sellers, tables.offer_parameters(),
            tables.start_days, run)
        return repository.save(rows, "daily_offers")

    return _logged(log, repository, "ranking_rules", step)
