from pyspark.sql import functions as F

from offerlens.functions.frames import delete_matching, seller_offer_grid, update_from
from offerlens.functions.scoring import logistic, ratio, standardise


def test_update_from(spark):
    left = spark.createDataFrame([(1, 5, 0), (2, 6, 0), (3, 7, 0), (3, 8, 0)], "k int, v int, w int")
    right = spark.createDataFrame([(1, 50), (3, None)], "k int, nv int")
    got = sorted(map(tuple, update_from(left, right, ["k"], {"v": "nv"}).collect()))
    assert got == [(1, 50, 0), (2, 6, 0), (3, 7, 0), (3, 8, 0)]


def test_delete_matching_with_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, v string")
    doomed = spark.createDataFrame([(1,), (1,), (9,)], "k int")
    assert [tuple(r) for r in delete_matching(df, doomed, ["k"]).collect()] == [(2, "a")]


def test_grid_holds_each_pair_once_whatever_the_cells(spark):
    sellers = spark.range(57).withColumnRenamed("id", "seller_id")
    offers = spark.range(41).select(F.col("id").cast("string").alias("offer_id"),
                                    (F.col("id") % 3).alias("flag_top"))
    expected = {(s, str(o), o % 3) for s in range(57) for o in range(41)}
    for df in (seller_offer_grid(sellers, offers), seller_offer_grid(sellers, offers, 1, 1),
               seller_offer_grid(sellers, offers, 50, 3)):
        rows = [tuple(r) for r in df.collect()]
        assert len(rows) == len(expected) and set(rows) == expected


def test_grid_with_repeated_sellers_and_no_offers(spark):
    sellers = spark.createDataFrame([(1,), (1,), (2,)], "seller_id long")
    offers = spark.createDataFrame([("a",), (None,)], "offer_id string")
    assert seller_offer_grid(sellers, offers).count() == 6
    assert seller_offer_grid(sellers, offers.limit(0)).count() == 0


def test_grid_cells_do_not_use_a_cross_join(spark):
    sellers = spark.range(10).withColumnRenamed("id", "seller_id")
    offers = spark.range(10).withColumnRenamed("id", "offer_id")
    plan = seller_offer_grid(sellers, offers)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 7), (2.0, 7), (6.0, 7)], "x double, same int")
    rows = standardise(df, {"z": "x", "z0": "same"}).orderBy("x").collect()
    mean, sd = 3.0, round((14 / 3) ** 0.5, 4)
    assert [r.z for r in rows] == [round((x - mean) / sd, 4) for x in (1.0, 2.0, 6.0)]
    assert [r.z0 for r in rows] == [0.0, 0.0, 0.0]


def test_ratio_and_logistic(spark):
    r = spark.range(1).select(ratio(F.lit(3), F.lit(0)).alias("a"), ratio(F.lit(3), F.lit(4)).alias("b"),
                              logistic(F.lit(0.0)).alias("c"), logistic(F.lit(700.0)).alias("d")).first()
    assert r.a is None and r.b == 0.75 and r.c == 0.5 and r.d == 1.0
