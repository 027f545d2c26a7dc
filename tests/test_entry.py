"""Driver contract: entry() and every registered query, compared with its SQL on sf0.001."""

from __future__ import annotations

import contextlib
import io

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from cairn.plans.catalog import all_oracle_sql, all_queries
from conftest import ROOT, SMOKE

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import oracle_check  # noqa: E402

#: queries that fit all candidates; tests/test_models.py covers their parts on small specs
TRAINED = {"churn_model_comparison", "clv_model_comparison", "churn_model_scores", "clv_model_scores",
           "trained_campaign_targets", "trained_customer_360", "trained_chain_gates", "model_bundle_info",
           "attribution_global_importance", "attribution_local_reasons", "top_risk_drilldown"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in oracle_check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert set(df.columns) == {"rfm_segment", "customers", "revenue", "avg_recency", "customer_share",
                               "revenue_share"}


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    for name, fn in E.queries().items():
        assert fn.__doc__, name


@pytest.mark.parametrize("name", sorted(set(all_queries()) - TRAINED))
def test_every_query_equals_its_sql_on_smoke_data(spark, duck, name):
    df = E.queries()[name](spark, SMOKE)
    assert len(df.columns) == len(set(df.columns))
    got = oracle_check.rows(df.columns, (tuple(r) for r in df.collect()))
    assert got
    cur = duck.execute(all_oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == oracle_check.rows(names, cur.fetchall())
    # no query pairs rows without a key: scalars arrive as scalar subqueries
    plan = _plan(df)
    assert "CartesianProduct" not in plan, name
    assert "BroadcastNestedLoopJoin" not in plan, name


def test_no_order_or_line_is_dropped(spark, duck):
    for name, table in (("adapter_orders", "orders"), ("adapter_order_lines", "lineitem")):
        assert E.queries()[name](spark, SMOKE).count() == duck.execute(f"SELECT COUNT(*) FROM {table}").fetchone()[0]


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


def test_flagship_plan_prunes_and_pushes_down(spark):
    """The RFM window filter on the derived order date reaches the orders scan, and the
    lineitem scan reads only the columns the revenue rollup needs."""
    from pyspark.sql import functions as F

    from cairn.sources.adapter import lazy_canonical

    c = lazy_canonical(spark, SMOKE)
    day = F.lit("2001-07-31").cast("date")
    df = (c.orders().filter(F.col("order_date").between(F.date_sub(day, 364), day))
          .groupBy("customer_id").agg(F.sum("net_revenue").alias("monetary")))
    plan = _plan(df)
    assert "GreaterThanOrEqual(o_orderdate,2000-08-01T00:00)" in plan
    assert "LessThan(o_orderdate,2001-08-01T00:00)" in plan
    schemas = [x for x in plan.splitlines() if x.startswith("ReadSchema: struct<l_orderkey")]
    assert schemas == ["ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,"
                       "l_discount:double,l_returnflag:string>"]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_fact_join_shuffles_and_dimensions_broadcast(spark):
    """Lines join orders (a fact that grows with the data) by sort-merge join, never a
    broadcast; the small part table is broadcast by the optimizer's size statistics."""
    from cairn.sources.adapter import lazy_canonical

    plan = _plan(lazy_canonical(spark, SMOKE).order_lines())
    assert "SortMergeJoin" in plan
    lines = plan.splitlines()
    # the "Input [...]" line under each "(n) BroadcastExchange" node of the details section
    inputs = [lines[i + 1] for i, x in enumerate(lines) if x.startswith("(") and x.endswith(") BroadcastExchange")]
    assert inputs and all("p_partkey" in x and "o_orderkey" not in x for x in inputs)
