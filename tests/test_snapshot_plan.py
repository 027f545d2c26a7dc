"""Snapshots by differences: the same rows as windows over the facts, flat in the cutoffs,
and customer tables that join without an exchange."""

from __future__ import annotations

import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest

from cairn.constants import ONLINE_CHANNELS
from cairn.operators.snapshot import build_snapshots


SMOKE = "/root/testdata/sf0.001"
DAY = dt.date(2000, 1, 1)


@pytest.fixture(scope="module")
def facts(spark):
    rng = np.random.default_rng(8)
    day = lambda n: [DAY + dt.timedelta(days=int(x)) for x in rng.integers(0, 1500, n)]
    cust = pd.DataFrame({"customer_id": range(40), "acquisition_date": [DAY + dt.timedelta(days=20 * i) for i in range(40)], "region": "r", "age_band": "a",
                         "loyalty_tier": "Gold", "preferred_channel": "Web", "marketing_consent": 1})
    n = 900
    who = np.where(rng.random(n) < 0.35, 3, rng.integers(0, 45, n))  # a hot customer, and some unknown ones
    money = lambda: rng.integers(1, 90_000, n) / 100
    orders = pd.DataFrame({"order_id": range(n), "customer_id": who, "order_date": day(n), "channel": rng.choice([*ONLINE_CHANNELS, "Store"], n),
                           "primary_category": rng.choice(["a", "b", "c", "d", None], n), "net_revenue": money(), "gross_margin": money(),
                           "gross_revenue": money(), "discount_amount": money(), "returned_flag": rng.integers(0, 2, n)})
    orders.loc[:5, "order_date"] = None
    inter = pd.DataFrame({"customer_id": rng.integers(0, 40, 500), "month": day(500), "email_sent": rng.integers(0, 5, 500), "email_opens": rng.integers(0, 3, 500),
                          "support_tickets": rng.integers(0, 2, 500), "sessions": rng.integers(0, 4, 500)})
    typed = spark.createDataFrame(orders).selectExpr("order_id", "customer_id", "order_date", "channel", "primary_category", "returned_flag",
                                                     *[f"CAST({c} AS DECIMAL(18,2)) AS {c}" for c in ("net_revenue", "gross_margin", "gross_revenue", "discount_amount")])
    return (cust, orders, inter), (spark.createDataFrame(cust), typed, spark.createDataFrame(inter))


def brute(frames, cutoff, churn_h, clv_h):
    cust, orders, inter = frames
    out = {}
    for _, c in cust.iterrows():
        if c.acquisition_date > cutoff:
            continue
        o = orders[(orders.customer_id == c.customer_id) & orders.order_date.notna()]
        i = inter[inter.customer_id == c.customer_id]
        past, year = o[o.order_date <= cutoff], o[(o.order_date <= cutoff) & (o.order_date >= cutoff - dt.timedelta(days=364))]
        ahead = lambda h: o[(o.order_date > cutoff) & (o.order_date <= cutoff + dt.timedelta(days=h))]
        iyear = i[(i.month <= cutoff) & (i.month >= cutoff - dt.timedelta(days=364))]
        iq = i[(i.month <= cutoff) & (i.month >= cutoff - dt.timedelta(days=89))]
        seen = i[(i.month <= cutoff) & (i.sessions > 0)].month.max() if len(i[(i.month <= cutoff) & (i.sessions > 0)]) else None
        out[c.customer_id] = (
            past.order_date.max() if len(past) else None, len(past), round(past.net_revenue.sum(), 2), len(year), round(year.net_revenue.sum(), 2),
            round(year.discount_amount.sum(), 2), int(year.returned_flag.sum()), year.primary_category.dropna().nunique(),
            int(year.channel.isin(ONLINE_CHANNELS).sum()), int(iyear.email_sent.sum()), int(iq.sessions.sum()), seen,
            0 if len(ahead(churn_h)) else 1, round(ahead(clv_h).gross_margin.sum(), 2), len(ahead(clv_h)))
    return out


FIELDS = ["last_order_date", "lifetime_orders", "lifetime_revenue", "frequency_12m", "monetary_12m", "discount_amount_12m", "returned_orders_12m",
          "category_diversity_12m", "online_orders_12m", "email_sent_12m", "sessions_90d", "last_session_month", "churn_90d", "future_gross_margin", "future_orders"]


@pytest.mark.parametrize("count", [1, 7, 70])
def test_snapshots_equal_windows_over_the_facts(facts, count):
    plain, frames = facts
    days = [DAY + dt.timedelta(days=200 + (18 if count == 70 else 150) * i) for i in range(count)]
    got = {}
    for r in build_snapshots(*frames, [str(d) for d in days[::-1]], churn_horizon=90, clv_horizon=365).collect():
        values = tuple(float(v) if f.endswith(("revenue", "margin", "monetary_12m", "amount_12m")) else v for f, v in ((f, r[f]) for f in FIELDS))
        got[str(r.snapshot_date), r.customer_id] = values
    checked = days if count < 70 else [days[0], days[30], days[59], days[60], days[69]]
    for d in checked:
        assert {k[1]: v for k, v in got.items() if k[0] == str(d)} == brute(plain, d, 90, 365)
    assert len({k[0] for k in got}) == count


def test_aggregates_stay_in_codegen_and_flat(facts):
    _, frames = facts

    def plan(n):
        days = [str(DAY + dt.timedelta(days=200 + 30 * i)) for i in range(n)]
        return build_snapshots(*frames, days, churn_horizon=90, clv_horizon=365)

    spark = frames[0].sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan(10)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    aggregates = [x for x in lines if "Aggregate(" in x]
    assert aggregates and all(re.search(r"\*\(\d+\) HashAggregate", x) for x in aggregates)
    sums = [sum(x.count("sum(") for x in plan(n)._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [customer_id" in x and ", k" in x) for n in (3, 12)]
    assert sums[0] == sums[1] > 0


def test_customer_tables_join_without_exchange(spark):
    from cairn.plans.q_decision import production

    p = production(spark, SMOKE)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = p.c360._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("SortMergeJoin") == 4 and "Exchange" not in text


def test_generated_methods_are_small_enough_to_be_compiled(spark, facts):
    """The JVM leaves a method of more than 8000 bytes to its interpreter."""
    days = [str(DAY + dt.timedelta(days=100 * i)) for i in range(10)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = build_snapshots(*facts[1], days, churn_horizon=90, clv_horizon=365)
        code = plan._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
