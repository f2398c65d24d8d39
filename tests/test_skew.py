"""One seller with a third of the orders and one item with a third of the lines."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from offerlens.plans.registry import QUERIES, context

NAMES = ["base_info", "valid_sales", "rfm_single_24", "price_exposure", "grid_single", "grid_bundle",
         "new_probability", "peer_history_segment", "gift_value", "rfm_consolidated", "final_order"]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, sf):
    folder = str(tmp_path_factory.mktemp("skew"))
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "part"):
        os.symlink(f"{sf}/{t}.parquet", f"{folder}/{t}.parquet")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 60 ELSE o_custkey END AS o_custkey)
        FROM '{sf}/orders.parquet') TO '{folder}/orders.parquet'""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey)
        FROM '{sf}/lineitem.parquet') TO '{folder}/lineitem.parquet'""")
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return folder, con


@pytest.mark.parametrize("name", NAMES)
def test_skewed_data_matches_sql(spark, skewed, name):
    folder, con = skewed
    df = QUERIES[name](context(spark, folder))
    columns = ", ".join(f'"{c}"' for c in df.columns)
    ours = sorted(map(tuple, df.collect()), key=repr)
    theirs = sorted(con.execute(f"SELECT {columns} FROM ({entry.oracle_sql()[name]}) t").fetchall(), key=repr)
    assert len(ours) == len(theirs) > 0
    for a, b in zip(ours, theirs):
        assert all(x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1.01e-6))
                   for x, y in zip(a, b)), (a, b)
