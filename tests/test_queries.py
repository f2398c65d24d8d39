"""Every registered query against its SQL."""

import math

import pytest

import __spark_entry__ as entry
from offerlens.plans.registry import QUERIES, context

SQL = entry.oracle_sql()


def _close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1.01e-6)
    return a == b


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, sf, name):
    df = QUERIES[name](context(spark, sf))
    columns = ", ".join(f'"{c}"' for c in df.columns)
    ours = sorted(map(tuple, df.collect()), key=repr)
    theirs = sorted(duck.execute(f"SELECT {columns} FROM ({SQL[name]}) t").fetchall(), key=repr)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert all(map(_close, a, b)), (a, b)


def test_entry(spark):
    assert entry.entry(spark).columns == ["seller_id", "offer_id", "probability", "type", "priority",
                                          "order"]


def test_ranking_invariants(spark, sf):
    w = context(spark, sf).e
    plan = w.slot_plan.first()
    per_seller = {}
    for r in w.final_order.collect():
        per_seller.setdefault(r.seller_id, []).append((r["order"], r.offer_id, r.type))
    for rows in per_seller.values():
        assert sorted(o for o, _, _ in rows) == list(range(1, len(rows) + 1))
        assert len({offer for _, offer, _ in rows}) == len(rows) <= plan.slots
        assert sum(t == "T" for _, _, t in rows) <= plan.top_slots
