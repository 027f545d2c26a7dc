"""Hot keys: one order holds a third of all lines and one customer a third of all
orders.  The order rollup (first-seen mode, sums) and the RFM window aggregates equal a
pandas brute force over the same lines."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

HOT_ORDER = 5
HOT_CUSTOMER = 7


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("skewed")
    rng = np.random.default_rng(11)

    def write(name, cols):
        pq.write_table(pa.table(cols), d / f"{name}.parquet")

    write("region", {"r_regionkey": pa.array(range(5), pa.int32()),
                     "r_name": [f"R{i}" for i in range(5)]})
    write("nation", {"n_nationkey": pa.array(range(25), pa.int32()), "n_name": [f"N{i}" for i in range(25)],
                     "n_regionkey": pa.array([i % 5 for i in range(25)], pa.int32())})
    n_cust = 120
    write("customer", {"c_custkey": pa.array(range(1, n_cust + 1), pa.int64()),
                       "c_name": [f"C{i}" for i in range(1, n_cust + 1)],
                       "c_nationkey": pa.array(rng.integers(0, 25, n_cust), pa.int32()),
                       "c_acctbal": rng.uniform(0, 10000, n_cust).round(2),
                       "c_mktsegment": ["BUILDING"] * n_cust})
    n_part = 40
    write("part", {"p_partkey": pa.array(range(1, n_part + 1), pa.int64()),
                   "p_name": [f"P{i}" for i in range(n_part)], "p_brand": ["B"] * n_part,
                   "p_type": [f"TYPE{i % 4}" for i in range(n_part)],
                   "p_size": pa.array([1] * n_part, pa.int32()), "p_retailprice": [100.0] * n_part})
    n_orders = 600
    cust = rng.integers(1, n_cust + 1, n_orders)
    cust[: n_orders // 3] = HOT_CUSTOMER
    start = dt.datetime(2000, 1, 1)
    dates = [start + dt.timedelta(days=int(x)) for x in rng.integers(0, 580, n_orders)]
    write("orders", {"o_orderkey": pa.array(range(1, n_orders + 1), pa.int64()),
                     "o_custkey": pa.array(cust, pa.int64()), "o_orderstatus": ["O"] * n_orders,
                     "o_totalprice": [1.0] * n_orders, "o_orderdate": pa.array(dates, pa.timestamp("us")),
                     "o_orderpriority": [["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"][i % 4] for i in range(n_orders)]})
    n_lines = 3000
    order = rng.integers(1, n_orders + 1, n_lines)
    order[: n_lines // 3] = HOT_ORDER
    write("lineitem", {
        "l_orderkey": pa.array(order, pa.int64()),
        "l_partkey": pa.array(rng.integers(1, n_part + 1, n_lines), pa.int64()),
        "l_suppkey": pa.array(rng.integers(1, 10, n_lines), pa.int64()),
        # line numbers repeat inside an order, as in the driver data
        "l_linenumber": pa.array(rng.integers(1, 8, n_lines), pa.int32()),
        "l_quantity": rng.integers(1, 50, n_lines).astype(float),
        "l_extendedprice": (rng.integers(1000, 500000, n_lines) / 100.0),
        "l_discount": (rng.integers(0, 11, n_lines) / 100.0),
        "l_tax": [0.0] * n_lines,
        "l_returnflag": [["N", "R", "A"][i % 3] for i in range(n_lines)],
        "l_linestatus": ["O"] * n_lines,
        "l_shipdate": pa.array([start + dt.timedelta(days=int(x)) for x in rng.integers(0, 600, n_lines)],
                               pa.timestamp("us")),
    })
    return str(d)


def _brute_orders(lines: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for oid, g in lines.groupby("order_id"):
        counts = g.groupby("category").size()
        first = g.assign(_k=g["line_order"].map(tuple)).groupby("category")["_k"].min()
        top = counts.max()
        tied = [c for c in counts.index if counts[c] == top]
        best = min(tied, key=lambda c: first[c])
        rows.append({"order_id": oid, "primary_category": best, "item_count": int(g["quantity"].sum()),
                     **{s: float(g[s].astype(float).sum()) for s in
                        ["gross_revenue", "discount_amount", "returned_amount", "net_revenue", "gross_margin"]}})
    return pd.DataFrame(rows).set_index("order_id").sort_index()


def test_order_rollup_with_hot_order(spark, skewed_dir):
    from cairn.sources.adapter import Canonical, MaterializedCanonical

    lines = Canonical(spark, skewed_dir).order_lines().toPandas()
    assert (lines["order_id"] == HOT_ORDER).sum() >= len(lines) // 3
    lines["line_order"] = lines["order_line_id"].map(lambda k: [int(x) for x in k.split("-")[1:3]])  # line number, part
    want = _brute_orders(lines)
    got = MaterializedCanonical(spark, skewed_dir).orders().toPandas().set_index("order_id").sort_index()
    assert list(got.index) == list(range(1, 601))  # every header, with or without lines
    bare = got.loc[got.index.difference(want.index)]
    assert len(bare) and bare["primary_category"].isna().all() and (bare["item_count"] == 0).all() and (bare["net_revenue"] == 0).all()
    got = got.loc[want.index]
    assert (got["primary_category"] == want["primary_category"]).all()
    assert (got["item_count"] == want["item_count"]).all()
    for s in ["gross_revenue", "discount_amount", "returned_amount", "net_revenue", "gross_margin"]:
        assert np.allclose(got[s].astype(float), want[s], rtol=0, atol=1e-6), s


def test_rfm_aggregates_with_hot_customer(spark, skewed_dir):
    from cairn.operators import rfm
    from cairn.sources.adapter import MaterializedCanonical

    c = MaterializedCanonical(spark, skewed_dir)
    day = "2001-07-31"
    got = rfm.calculate_rfm(c.customers(), c.orders(), day).toPandas().set_index("customer_id")
    orders = c.orders().toPandas()
    d = pd.Timestamp(day).date()
    w = orders[(orders["order_date"] <= d) & (orders["order_date"] >= d - dt.timedelta(days=364))]
    freq = w.groupby("customer_id")["order_id"].nunique()
    money = w.groupby("customer_id")["net_revenue"].sum().astype(float)
    assert freq[HOT_CUSTOMER] >= len(w) // 4  # about a third of the window's orders
    assert got.loc[HOT_CUSTOMER, "frequency"] == freq[HOT_CUSTOMER]
    for cid in got.index:
        assert got.loc[cid, "frequency"] == freq.get(cid, 0)
        assert abs(float(got.loc[cid, "monetary"]) - money.get(cid, 0.0)) < 1e-6
    # the hot customer holds the top frequency and gets the top score
    assert got.loc[HOT_CUSTOMER, "frequency_score"] == 5
