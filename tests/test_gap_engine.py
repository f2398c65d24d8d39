from pyspark.sql import functions as F

from offerlens.operators import gap_engine as M
from offerlens.operators.rfm import optimal_prices
from offerlens.params import RunParams

RUN = RunParams(36027, 36028)
COLUMNS = ("seller_id long, offer_type string, sales_24c double, frequency_24c double, "
           "repurchase_gap double, seniority int, sales_6c double, sales_6c_ly double, "
           "sales_prev6 double, mean_24c double, min_sale_6c double")


def test_gap_branches(spark):
    rows = [
        (1, "Individual", 0.0, 0.0, 0.0, 30, 0.0, 0.0, 0.0, 0.0, 12.0),    # no sales: potential
        (2, "Individual", 90.0, 1.0, 2.0, 30, 0.0, 0.0, 0.0, 90.0, 12.0),  # once, overdue: total
        (3, "Individual", 90.0, 1.0, 0.0, 30, 0.0, 0.0, 0.0, 90.0, 12.0),  # once, not overdue
        (4, "Individual", 90.0, 3.0, 0.0, 30, 5.0, 9.0, 0.0, 30.0, 12.0),  # old, below last year
        (5, "Individual", 90.0, 3.0, 0.0, 30, 9.0, 5.0, 0.0, 30.0, 12.0),  # old, above last year
        (6, "Individual", 90.0, 3.0, 0.0, 24, 5.0, 0.0, 9.0, 30.0, 12.0),  # young, below previous
        (7, "Individual", 90.0, 3.0, 0.0, 24, 9.0, 0.0, 5.0, 30.0, 12.0),  # young, above previous
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    got = {r.seller_id: r.sales_gap_mc for r in M.single_gap(df).collect()}
    assert got == {1: 12.0, 2: 90.0, 3: -1.0, 4: 90.0, 5: -1.0, 6: 30.0, 7: -1.0}
    bundles = df.withColumn("offer_type", F.lit("Bundle"))
    assert {r.seller_id: r.sales_gap_mc for r in M.bundle_gap(bundles).collect()}[1] == -1.0


def test_mean_divides_by_distinct_sellers(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 6.0)], "seller_id long, x double")
    out = M._with_stats(df, {"x": F.lit(True)}).select("_mean_x").first()
    assert out[0] == 6.0


def test_scores_are_probabilities_and_zero_below_gap(spark):
    df = spark.createDataFrame(
        [(1.5, -2.0, 1.0, -1.0, 3), (200.0, 200.0, 0.0, 0.0, 10), (-3.0, 1.0, -1.0, 2.0, 5)],
        "opportunity_z double, opportunity_mc_z double, sales_gap double, sales_gap_mc double, "
        "total_units int")
    for r in M.scores(df).collect():
        assert all(0.0 <= v <= 1.0 for v in (r.score, r.score_mc, r.score_units, r.score_mc_units))
        if r.sales_gap < 0:
            assert r.score == r.score_units == 0.0
        if r.sales_gap_mc < 0:
            assert r.score_mc == r.score_mc_units == 0.0


def test_optimal_price_tie_breaks(spark):
    df = spark.createDataFrame(
        [(1, "a", "p", 10.0, 4, 2, 0.5), (1, "a", "p", 12.0, 2, 1, 0.5), (1, "a", "p", 9.0, 4, 2, 0.5),
         (2, "a", "p", 7.0, 1, 1, 1.0), (2, "a", "p", 3.0, 4, 2, 0.5)],
        "seller_id long, offer_id string, product_id string, price double, exposures int, "
        "pure_orders int, probability double")
    got = {r.seller_id: r.optimal_price for r in optimal_prices(df).collect()}
    assert got == {1: 9.0, 2: 7.0}


def test_scores_do_not_depend_on_partitions(spark):
    """Statistics in exact sums: bit by bit the same however the rows come."""
    import random

    rng = random.Random(1)
    columns = ["sales_gap", "sales_gap_mc", "frequency_24c", "recency_24c", "price_gap", "trigger_rate"]
    rows = [(s, f"o{o}", rng.randrange(1, 4), *(rng.choice([-1.0, rng.uniform(0, 1e7), rng.random() / 3]) for _ in columns))
            for s in range(400) for o in range(5)]
    df = spark.createDataFrame(rows, "seller_id long, offer_id string, total_units int, " + ", ".join(f"{c} double" for c in columns))
    seen = set()
    for n, seed in ((1, 1), (3, 2), (8, 3)):
        gaps = df.orderBy(F.rand(seed)).repartition(n)
        out = M.scores(M.normalised_opportunity(M.opportunity(M.z_scores(gaps))))
        seen.add(tuple(sorted(repr(tuple(r)) for r in out.select(*sorted(out.columns)).collect())))
    assert len(seen) == 1


def test_statistics_of_constant_and_absent_values(spark):
    df = spark.createDataFrame([(1, 0.1, None), (1, 0.1, None), (2, 0.1, None)], "seller_id long, x double, y double")
    r = M.seller_mean_stats(df, {"x": F.lit(True), "y": F.lit(True)}).first()
    assert (r.mean_x, r.sd_x, r.mean_y, r.sd_y) == (0.15, 0.0, None, None)
    none = M.seller_mean_stats(df, {"x": F.col("x") > 1}).first()
    assert (none.mean_x, none.sd_x) == (None, None)
