"""Physical plans: what reaches the scan, and joins and exchanges that must not appear."""

import re

import pytest
from pyspark.sql import functions as F

from offerlens.functions.cycles import cycle_text
from offerlens.functions.frames import seller_offer_grid
from offerlens.operators.ranking import candidates, ranked
from offerlens.operators.rfm import KEYS, _own_grid
from offerlens.plans.registry import ESTABLISHED_RUN, context
from offerlens.sources.session import tune
from offerlens.sources.staging import cut, placed


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cycle_window_reaches_the_scans(spark, sf):
    t = context(spark, sf).t
    plan = _plan(t.orders(36004, 36027))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    for df in (t.sales(36004, 36027), t.catalog(36004, 36027)):
        assert "PartitionFilters: [isnotnull(cycle" in _plan(df) and "(cycle" in _plan(df) and "36004" in _plan(df)


def test_scan_reads_needed_columns_only(spark, sf):
    plan = _plan(context(spark, sf).t.sellers())
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_no_cross_joins_in_the_heavy_frames(spark, sf):
    w = context(spark, sf).e
    for df in (w.single_grid, w.bundle_grid, w.scored, w.slot_choices, w.run_variables,
               w.tables.status(36004, 36027), w.consolidated):
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scoring_shuffles_only_for_seller_counts(spark, sf):
    """The (seller, offer) rows themselves pass from scan to scores unshuffled."""
    plan = _plan(context(spark, sf).e.scored)
    main = plan.split("Subqueries")[0]
    assert "SortMergeJoin" not in main and "Window" not in main


# Keys of few values, some of them hot: sellers must not be placed by these alone.
FEW = {"offer_id", "product_id", "offer_type", "region_id", "segment", "peer_profile", "territory"}


def few_key_exchanges(df) -> list[str]:
    """Exchanges that place rows of sellers by few keys alone."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    found = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\((.*?), \d+\)", text)
    bare = lambda names: {re.sub(r"#\d+L?$", "", n.strip()) for n in names.split(",")}
    return [f"{k} <- {c}" for c, k in found if bare(k) <= FEW and "seller_id" in bare(c)]


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_sellers_are_not_placed_by_few_keys(spark, sf, limit):
    c = context(spark, sf)
    frames = ["single_filled", "single_complete", "bundle_flagged", "bundle_complete", "listed_and_ordered",
              "bundle_listed_and_ordered", "bundle_cycles", "potential", "consolidated", "gaps", "slot_choices"]
    for w in (c.e, c.by_profile):
        for name in frames:                       # short frames are staged, at the limit of the session
            getattr(w, name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        for w in (c.e, c.by_profile):
            fresh = w.sibling(tuple(n for n in w.__dict__ if n not in (*frames, "tables", "run")))
            for name in frames:
                build = type(fresh).__dict__[name].func
                df = getattr(build, "__wrapped__", build)(fresh)
                assert not few_key_exchanges(df), name
                if limit != "-1" and name in ("single_filled", "bundle_flagged", "consolidated"):
                    assert "BroadcastHashJoin" in _plan(df), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shared_frames_are_built_when_they_are_read(spark, sf):
    """A query of another grouping builds what it reads, in the run that shares it, and no bundles."""
    c = context(spark, sf, fresh=True)
    c.by_profile.recent_peers
    assert c.by_profile.__dict__["tagged_sales"] is c.e.__dict__["tagged_sales"]
    for w in (c.e, c.by_profile):
        assert not {"single_grid", "bundle_grid", "bundle_prices", "single_prices", "catalog"} & set(w.__dict__)
    assert c.by_profile.single_products is c.e.single_products


def test_frames_of_sellers_are_not_broadcast_by_their_file_size(spark):
    """A million sellers lie in a few MB of parquet and hold many times that in the driver."""
    tune(spark)
    sellers = cut(spark.range(1_000_000).selectExpr("id AS seller_id", "int(id % 126) AS enrol_cycle"), "sellers")
    rows = cut(spark.range(2_000_000).selectExpr("id % 1000003 AS seller_id", "id AS invoice"), "rows")
    assert "BroadcastHashJoin" not in _plan(rows.join(sellers, "seller_id"))
    short = cut(sellers.where("seller_id < 1000"), "short")
    assert "BroadcastHashJoin" in _plan(rows.join(short, "seller_id"))


def test_rows_of_sellers_and_offers_stay_where_they_are(spark):
    """The grid is unfolded where its sellers lie, written so, and later reduced and ranked there."""
    tune(spark)
    base = spark.range(300).selectExpr("id AS seller_id", "int(id % 3) AS region_id")
    offers = spark.range(40).selectExpr("'I-' || id AS offer_id", "'P-' || id AS product_id")
    own = cut(spark.range(600).selectExpr("id % 300 AS seller_id", "'I-' || int(id / 300) AS offer_id",
                                          "'P-' || int(id / 300) AS product_id", "id AS net"), "own")
    grid = _own_grid(base, offers, own, 5)
    assert not re.search(r"hashpartitioning\(seller_id#\d+L, offer_id", _plan(grid))
    plain = seller_offer_grid(base, offers).join(own, KEYS, "left")
    assert sorted(map(repr, grid.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))
    stored = placed(grid, "grid", 5)
    best = ranked(candidates(_as_probabilities(stored), ESTABLISHED_RUN, parts=5))
    sums = stored.groupBy("seller_id", "offer_id").agg(F.sum("net").alias("net"))
    for df in (best, sums, stored.withColumn("twice", F.col("net") * 2).repartition(5, "seller_id")):
        assert "Exchange" not in _plan(df)


def _as_probabilities(rows):
    run = ESTABLISHED_RUN
    return rows.selectExpr("*", "double(net) AS probability", "1 AS flag_top", f"'{run.personalisation}' AS personalisation",
                           f"'{run.country}' AS country", f"'{cycle_text(run.process_cycle)}' AS process_cycle",
                           f"'{cycle_text(run.target_cycle)}' AS target_cycle", f"'{run.kind}' AS kind",
                           f"{run.engine} AS engine", f"'{run.profile}' AS profile")
