"""Sales and prices by cycle: lines are read once, later reads open the cycles they ask for."""

import re

import pytest
from pyspark.sql import functions as F

from offerlens.plans import workspace
from offerlens.plans.registry import ESTABLISHED_RUN, NEW_RUN
from offerlens.plans.workspace import Workspace
from offerlens.sources.star import StarTables


class Counted(StarTables):
    reads = 0

    def raw(self, name):
        self.reads += name == "lineitem"
        return super().raw(name)


class NoLines(StarTables):
    def raw(self, name):
        assert name != "lineitem", "the line file is read again"
        return super().raw(name)


def rows(df):
    return sorted(map(repr, df.collect()))


def fact_scans(plan: str) -> list[str]:
    """The scans of sales and prices in a plan."""
    lines = [line for line in plan.split("\n") if "FileScan parquet" in line]
    return [line for line in lines if re.search(r"/facts-[^,\]]*/(sales|prices)[,\]]", line)]


@pytest.mark.parametrize("run, last", [(ESTABLISHED_RUN, "final_order"), (NEW_RUN, "probabilities")])
def test_lines_are_read_once_and_cycles_are_pruned(spark, sf, monkeypatch, run, last):
    tables, plans = Counted(spark, sf), []
    keep = workspace.cut

    def spied(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, name)

    monkeypatch.setattr(workspace, "cut", spied)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    w = Workspace(tables, run)
    getattr(w, last)
    w.offer_products_coded.count()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert tables.reads == 1
    scans = [(name, s) for name, plan in plans for s in fact_scans(plan)]
    assert len(scans) >= 2
    for name, s in scans:
        assert re.search(r"PartitionFilters: \[[^]]*cycle[^]]*>= ?\d+[^]]*<= ?\d+", s), (name, s[:600])


def test_gift_values_read_no_cycle(spark, sf):
    w = Workspace(StarTables(spark, sf), ESTABLISHED_RUN)
    plan = w.gift_values._jdf.queryExecution().executedPlan().toString()
    assert not fact_scans(plan) and "lineitem" not in plan


def test_kept_store_serves_later_runs(spark, sf, tmp_path):
    first = StarTables(spark, sf, f"file://{tmp_path}/facts")
    want = rows(first.sales(36004, 36027)), rows(first.catalog()), rows(first.normal_prices(first.catalog()))
    later = NoLines(spark, sf, f"file://{tmp_path}/facts")
    assert want == (rows(later.sales(36004, 36027)), rows(later.catalog()), rows(later.normal_prices(later.catalog())))
    assert len(want[0]) > 100


def test_refresh_replaces_its_cycles_alone(spark, sf, tmp_path):
    class Younger(StarTables):
        """The same tables before the orders of the last cycles came in, and with one cycle wrong."""
        def orders(self, lo=None, hi=None):
            o = super().orders(lo, hi)
            return o.where((F.col("cycle") < 36020) & ((F.col("cycle") != 36010) | (F.col("o_orderkey") % 2 == 0)))

    young = Younger(spark, sf, f"{tmp_path}/facts")
    assert young.sales(36020).count() == 0
    whole = StarTables(spark, sf)
    kept = StarTables(spark, sf, f"{tmp_path}/facts")
    assert rows(kept.sales()) != rows(whole.sales())
    kept.facts.refresh(36010, 36010)
    assert rows(kept.sales(hi=36019)) == rows(whole.sales(hi=36019)) and kept.sales(36020).count() == 0
    kept.facts.refresh(36020)
    for a, b in ((kept.sales(), whole.sales()), (kept.catalog(), whole.catalog()), (kept.facts.sold(), whole.facts.sold())):
        assert rows(a) == rows(b)


def test_a_session_lays_out_the_cycles_it_asks_for(spark, sf, tmp_path):
    """No file for other cycles; what is asked for piece by piece is what a whole store holds."""
    whole, t = StarTables(spark, sf, f"{tmp_path}/facts"), StarTables(spark, sf)
    t.expect(36004, 36010)
    assert rows(t.sales(36006, 36007)) == rows(whole.sales(36006, 36007))

    def cycles():
        return {r.cycle for r in spark.read.parquet(f"{t.facts.folder}/prices").select("cycle").distinct().collect()}
    assert cycles() and cycles() <= set(range(36004, 36011))
    assert rows(t.facts.sold()) == rows(whole.facts.sold())
    assert rows(t.catalog(36009, 36012)) == rows(whole.catalog(36009, 36012)) and max(cycles()) <= 36012
    assert rows(t.catalog(36009)) == rows(whole.catalog(36009))
    for a, b in ((t.sales(), whole.sales()), (t.catalog(), whole.catalog())):
        assert rows(a) == rows(b)
    t.facts.refresh(36010, 36010)
    assert rows(t.sales()) == rows(whole.sales()) and rows(t.facts.sold()) == rows(whole.facts.sold())


def test_lines_without_a_cycle_stay(spark, sf):
    class Undated(StarTables):
        def _lines(self, lo=None, hi=None):
            df = super()._lines(lo, hi)
            return df.withColumn("cycle", F.when(F.col("invoice") % 7 != 0, F.col("cycle")))

    a, b = Undated(spark, sf), Undated(spark, sf)
    b.sales(36004, 36027)
    assert rows(a.sales()) == rows(b.sales()) and a.sales().where("cycle IS NULL").count() > 0
    assert rows(a.catalog()) == rows(b.catalog()) and rows(a.facts.sold()) == rows(b.facts.sold())
