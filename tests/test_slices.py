"""The slice cube against counts over the facts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cairn.operators.slices import slice_cube, slice_measures

C360 = [(i, ("A", "B", None)[i % 3], ("Low", "High")[i % 2]) for i in (1, 2, 3, 4, 5, 32768, 32769, 70_000, 5_000_000_001)]


@pytest.fixture(scope="module")
def facts(spark):
    c360 = spark.createDataFrame(C360, "customer_id long, rfm_segment string, risk_band string")
    rows = [(c, dt.date(2000, 1 + (c + k) % 4, 1 + k), Decimal(c % 97), Decimal(k)) for c, _, _ in C360 for k in range(1 + c % 5)]
    rows += [(999, dt.date(2000, 1, 1), Decimal(5), Decimal(1)), (None, dt.date(2000, 1, 1), Decimal(5), Decimal(1))]
    return c360, spark.createDataFrame(rows, "customer_id long, order_date date, net_revenue decimal(18,2), gross_margin decimal(18,2)")


@pytest.mark.parametrize("segments,risks,months", [
    (None, None, None), (["A"], None, None), (["A", "B"], ["High"], None), (None, ["Low", "High"], ("2000-02", "2000-03")), ([], None, None),
    (["nobody"], None, None)])
def test_any_selection_counts_customers_once(facts, segments, risks, months):
    c360, orders = facts
    got = slice_measures(slice_cube(c360, orders), segments, risks, months).first()
    rows = orders.join(c360, "customer_id").collect()
    rows = [r for r in rows if (segments is None or r.rfm_segment in segments) and (risks is None or r.risk_band in risks)
            and (months is None or months[0] <= r.order_date.strftime("%Y-%m") <= months[1])]
    assert (got.customers, got.orders) == (len({r.customer_id for r in rows}), len(rows))
    assert got.net_revenue == (sum(r.net_revenue for r in rows) if rows else None)
    assert got.gross_margin == (sum(r.gross_margin for r in rows) if rows else None)


def test_by_month_and_empty(spark, facts):
    c360, orders = facts
    cube = slice_cube(c360, orders)
    got = {r.month: (r.customers, r.orders) for r in slice_measures(cube, by=("month",)).collect()}
    want = {r.m: (r.c, r.n) for r in orders.join(c360, "customer_id").groupBy(F.trunc("order_date", "month").alias("m"))
            .agg(F.countDistinct("customer_id").alias("c"), F.count(F.lit(1)).alias("n")).collect()}
    assert got == want
    none = slice_measures(slice_cube(c360, orders.limit(0)))
    assert none.first().customers == 0 and slice_measures(slice_cube(c360, orders.limit(0)), by=("month",)).count() == 0
