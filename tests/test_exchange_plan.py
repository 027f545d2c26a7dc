"""Facts move once: the order rollup exchanges the lines by order, the snapshots exchange the
facts by customer, and what follows needs no exchange of aggregates per (key, group)."""

from __future__ import annotations

import re

import pytest

from cairn.operators.snapshot import build_snapshots
from cairn.sources.adapter import Canonical

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture
def plain_plans(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


def test_lines_move_once_to_their_order(spark, plain_plans):
    keys = exchanges(Canonical(spark, SMOKE).orders())
    assert sorted(k for k in keys if "order_id" in k or "category" in k) == ["order_id", "order_id"]  # lines and headers


def test_facts_move_once_to_their_customer(spark, plain_plans):
    c = Canonical(spark, SMOKE)
    bare = [c.customers(), c.orders(), c.interactions()]
    held = [spark.createDataFrame(df.limit(50).collect(), df.schema) for df in bare]
    keys = exchanges(build_snapshots(*held, ["2000-03-31", "2000-06-30"], churn_horizon=90, clv_horizon=365))
    # the facts, the attributes, and the categories bought (one a customer and category first)
    assert sorted(keys) == ["customer_id", "customer_id", "customer_id", "customer_id, primary_category"]


def test_cents_give_exact_amounts(spark):
    from decimal import Decimal

    c = Canonical(spark, SMOKE)
    orders = c.orders()
    got = build_snapshots(c.customers(), orders, c.interactions(), ["2100-01-01"]).agg({"lifetime_revenue": "sum"}).first()[0]
    want = orders.join(c.customers(), "customer_id").agg({"net_revenue": "sum"}).first()[0]
    assert isinstance(got, Decimal) and got == want
