import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from offerlens.functions import cycles as cyc


def _one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_parse_and_format(spark):
    rows = spark.createDataFrame(
        [("200110",), ("199601",), ("199618",), (None,), ("abc",), ("2001",), ("200100",)], "t string")
    got = {r.t: r.c for r in rows.select("t", cyc.parse_cycle("t").alias("c")).collect()}
    assert got["200110"] == 36027 and got["199601"] == 1996 * 18 and got["199618"] == 1996 * 18 + 17
    assert got[None] == got["abc"] == got["2001"] == 0
    assert got["200100"] == 2001 * 18 - 1          # "00" reads as the cycle before "01"
    assert _one(spark, cyc.format_cycle(F.lit(36027))) == ("200110",)
    assert cyc.cycle_text(35939) == "199612"


def test_shift_crosses_years(spark):
    def shifted(text, n):
        return _one(spark, cyc.format_cycle(cyc.shift_cycle(cyc.parse_cycle(F.lit(text)), n)))[0]
    assert shifted("201810", -11) == "201717"
    assert shifted("201803", -23) == "201616"
    assert shifted("201818", 1) == "201901"
    assert shifted("201901", -24) == "201713"


def test_distance_is_symmetric(spark):
    a, b = F.lit(36027), F.lit(36004)
    assert _one(spark, cyc.cycle_distance(a, b), cyc.cycle_distance(b, a)) == (23, 23)


def _cycle_of(d: dt.date) -> int:
    return d.year * 18 + (d.timetuple().tm_yday - 1) * 18 // 366


@settings(max_examples=200)
@given(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)))
def test_date_range_equals_cycle(d):
    c = _cycle_of(d)
    assert cyc.first_date(c) <= d < cyc.first_date(c + 1)


def test_cycle_of_date_column(spark):
    days = spark.sql("SELECT explode(sequence(date'1995-01-01', date'2001-12-31')) AS d")
    for r in days.select("d", cyc.cycle_of_date("d").alias("c")).collect():
        assert r.c == _cycle_of(r.d)


def test_cycle_sets_count_distinct_cycles(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (1, 33), (2, 12)], "k int, cycle int")
    got = {r.k: r.n for r in df.groupBy("k").agg(
        cyc.cycle_count(cyc.cycle_set("cycle", 10)).alias("n")).collect()}
    assert got == {1: 2, 2: 1}
    none = df.groupBy("k").agg(cyc.cycle_count(
        cyc.cycle_set("cycle", 10, F.col("cycle") > 40)).alias("n"))
    assert {r.n for r in none.collect()} == {0}
