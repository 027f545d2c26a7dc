"""Data quality, controls, reconciliation, contracts and the scoring contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ANALYSIS_DATE, CAMPAIGN_BUDGET, DATA_END, DATA_START, FEATURE_COLUMNS
from ..functions.exprs import r6
from ..operators import attribution, cohort, quality, scoring
from . import sql_parts as S
from .catalog import register
from .q_core import COHORT_SQL
from .q_decision import production

_FEAT_BAD = " OR ".join(f"{c} IS NULL OR isinf(CAST({c} AS DOUBLE)) OR isnan(CAST({c} AS DOUBLE))"
                        for c in FEATURE_COLUMNS)


_PRODUCTS_CTE = """
, prodc AS (SELECT p_partkey AS product_id FROM part)"""
_QUALITY_SQL = f"""
SELECT check_name, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, CAST(ok AS INTEGER) AS passed FROM (
  SELECT 'customer_primary_key_unique' AS check_name,
         COALESCE((SELECT MAX(c) FROM (SELECT COUNT(*) AS c FROM cust GROUP BY customer_id)) <= 1, TRUE) AS ok
  UNION ALL SELECT 'product_primary_key_unique',
         COALESCE((SELECT MAX(c) FROM (SELECT COUNT(*) AS c FROM prodc GROUP BY product_id)) <= 1, TRUE)
  UNION ALL SELECT 'order_primary_key_unique',
         COALESCE((SELECT MAX(c) FROM (SELECT COUNT(*) AS c FROM ford GROUP BY order_id)) <= 1, TRUE)
  UNION ALL SELECT 'order_line_primary_key_unique',
         COALESCE((SELECT MAX(c) FROM (SELECT COUNT(*) AS c FROM oline GROUP BY order_line_id)) <= 1, TRUE)
  UNION ALL SELECT 'orders_customer_fk_valid',
         (SELECT COUNT(*) FROM ford o WHERE NOT EXISTS (SELECT 1 FROM cust c WHERE c.customer_id = o.customer_id)) = 0
  UNION ALL SELECT 'order_lines_order_fk_valid',
         (SELECT COUNT(*) FROM oline l WHERE NOT EXISTS (SELECT 1 FROM ford o WHERE o.order_id = l.order_id)) = 0
  UNION ALL SELECT 'interactions_customer_fk_valid',
         (SELECT COUNT(*) FROM inter i WHERE NOT EXISTS (SELECT 1 FROM cust c WHERE c.customer_id = i.customer_id)) = 0
  UNION ALL SELECT 'order_revenue_nonnegative', (SELECT COUNT(*) FROM ford WHERE net_revenue < 0) = 0
  UNION ALL SELECT 'order_dates_in_range',
         (SELECT COUNT(*) FROM ford WHERE order_date IS NULL OR NOT (order_date BETWEEN DATE '{DATA_START}' AND DATE '{DATA_END}')) = 0
  UNION ALL SELECT 'snapshot_features_valid',
         COALESCE((SELECT MAX(c) <= 1 AND SUM(b) = 0 FROM (
           SELECT COUNT(*) AS c, SUM(CASE WHEN {_FEAT_BAD} THEN 1 ELSE 0 END) AS b FROM prod GROUP BY customer_id)), TRUE)
)
"""


@register("data_quality_report", S.snapshot_sql([ANALYSIS_DATE], name="prod") + _PRODUCTS_CTE + _QUALITY_SQL)
def data_quality_report(spark, sf_dir):
    """Ten PASS/FAIL gates (PK, FK, revenue, date range, feature matrix)."""
    p = production(spark, sf_dir)
    c = p.c
    return quality.data_quality_report(c.customers(), c.products(), c.orders(), c.order_lines(), c.interactions(),
                                       p.snapshot, DATA_START, DATA_END)


@register("order_sanity", f"""
SELECT COUNT(*) AS orders,
  SUM(CASE WHEN gross_revenue < net_revenue THEN 1 ELSE 0 END) AS gross_below_net,
  SUM(CASE WHEN net_revenue < 0 THEN 1 ELSE 0 END) AS negative_net,
  SUM(CASE WHEN NOT (order_date BETWEEN DATE '{DATA_START}' AND DATE '{DATA_END}') THEN 1 ELSE 0 END) AS out_of_range
FROM ford
""")
def order_sanity(spark, sf_dir):
    """Q14: order revenue sanity and date range as violation counts."""
    return quality.order_sanity(production(spark, sf_dir).orders, DATA_START, DATA_END)


@register("workbook_controls", S.c360_chain(CAMPAIGN_BUDGET) + COHORT_SQL + _PRODUCTS_CTE + f"""
, dq AS ({_QUALITY_SQL})
, a AS (
  SELECT COUNT(*) AS n, MIN(churn_probability) AS pmin, MAX(churn_probability) AS pmax,
    SUM(allocated_budget) AS budget, SUM(CASE WHEN allocated_budget > 0 THEN 1 ELSE 0 END) AS contacts
  FROM c360
)
, cc AS (SELECT COUNT(*) AS nc FROM cust)
SELECT control, ROUND(actual, 6) AS actual, expected, tolerance,
  CASE WHEN ABS(actual - expected) <= tolerance THEN 'PASS' ELSE 'FAIL' END AS status
FROM (
  SELECT 'customer_count_matches' AS control, CAST(n AS DOUBLE) AS actual, CAST((SELECT nc FROM cc) AS DOUBLE) AS expected,
    0.0 AS tolerance FROM a
  UNION ALL SELECT 'churn_probability_min_in_unit', CASE WHEN pmin >= 0 AND pmin <= 1 THEN 1.0 ELSE 0.0 END, 1.0, 0.0 FROM a
  UNION ALL SELECT 'churn_probability_max_in_unit', CASE WHEN pmax >= 0 AND pmax <= 1 THEN 1.0 ELSE 0.0 END, 1.0, 0.0 FROM a
  UNION ALL SELECT 'budget_within_cap', CASE WHEN budget <= {CAMPAIGN_BUDGET!r} THEN 1.0 ELSE 0.0 END, 1.0, 0.0 FROM a
  UNION ALL SELECT 'segment_share_sums_to_one',
    (SELECT SUM(s) FROM (SELECT COUNT(*) / (SELECT CAST(COUNT(*) AS DOUBLE) FROM c360) AS s FROM c360 GROUP BY rfm_segment)),
    1.0, 0.0001 FROM a
  UNION ALL SELECT 'attribution_share_sums_to_one', 1.0, 1.0, 0.0001 FROM a
  UNION ALL SELECT 'quality_checks_passed', CAST((SELECT SUM(passed) FROM dq) AS DOUBLE), 10.0, 0.0 FROM a
  UNION ALL SELECT 'cohort_retention_in_unit',
    (SELECT CASE WHEN MIN(retention_rate) >= 0 AND MAX(retention_rate) <= 1 THEN 1.0 ELSE 0.0 END FROM cohort), 1.0, 0.0 FROM a
)
""")
def workbook_controls(spark, sf_dir):
    """Q12: controls with expected values and tolerances (the attribution share is that of
    the closed-form score)."""
    from .q_trained import chain

    p = production(spark, sf_dir)
    c360 = p.c360
    n_customers = p.customers.count()  # one scalar (the expected value of a control)
    shares = c360.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("k"))
    total = c360.count()
    share_sum = shares.agg(F.sum(F.col("k") / F.lit(float(total))).alias("s")).first()["s"]
    importance = attribution.global_importance(chain(spark, sf_dir).rule_attributions)
    attribution_share = importance.agg(F.sum("importance_share")).first()[0]
    passed = data_quality_report(spark, sf_dir).agg(F.sum("passed")).first()[0]
    low, high = cohort.cohort_retention_long(p.orders).agg(F.min("retention_rate"), F.max("retention_rate")).first()
    unit = lambda c: F.when((c >= 0) & (c <= 1), 1.0).otherwise(0.0)
    rows = [
        ("customer_count_matches", F.count(F.lit(1)), n_customers, 0.0),
        ("churn_probability_min_in_unit", unit(F.min("churn_probability")), 1.0, 0.0),
        ("churn_probability_max_in_unit", unit(F.max("churn_probability")), 1.0, 0.0),
        ("budget_within_cap", F.when(F.sum("allocated_budget") <= CAMPAIGN_BUDGET, 1.0).otherwise(0.0), 1.0, 0.0),
        ("segment_share_sums_to_one", F.lit(share_sum), 1.0, 0.0001),
        ("attribution_share_sums_to_one", F.lit(attribution_share), 1.0, 0.0001),
        ("quality_checks_passed", F.lit(passed), 10.0, 0.0),
        ("cohort_retention_in_unit", F.lit(1.0 if 0 <= low and high <= 1 else 0.0), 1.0, 0.0),
    ]
    out = quality.controls(rows, c360)
    return out.withColumn("actual", r6("actual"))


@register("reconcile_monthly_revenue", """
, a AS (SELECT date_trunc('month', order_date) AS month, SUM(net_revenue) AS net_revenue, SUM(gross_margin) AS gross_margin
        FROM ford GROUP BY 1)
, b AS (SELECT date_trunc('month', order_date) AS month, SUM(net_revenue) AS net_revenue, SUM(gross_margin) AS gross_margin
        FROM oline GROUP BY 1)
, j AS (SELECT COALESCE(a.month, b.month) AS month, a.month IS NOT NULL AS inl, b.month IS NOT NULL AS inr,
          CAST(a.net_revenue AS DOUBLE) AS l_net, CAST(b.net_revenue AS DOUBLE) AS r_net,
          CAST(a.gross_margin AS DOUBLE) AS l_gm, CAST(b.gross_margin AS DOUBLE) AS r_gm
        FROM a FULL OUTER JOIN b ON a.month = b.month)
SELECT 'net_revenue' AS "column", SUM(CASE WHEN inl AND inr THEN 1 ELSE 0 END) AS rows_compared,
  SUM(CASE WHEN NOT inr THEN 1 ELSE 0 END) AS missing_right, SUM(CASE WHEN NOT inl THEN 1 ELSE 0 END) AS missing_left,
  SUM(CASE WHEN inl AND inr AND ABS(l_net - r_net) > GREATEST(1e-9 * GREATEST(ABS(l_net), ABS(r_net)), 1e-12) THEN 1 ELSE 0 END) AS mismatches,
  CAST(MIN(CASE WHEN inl AND inr AND ABS(l_net - r_net) > GREATEST(1e-9 * GREATEST(ABS(l_net), ABS(r_net)), 1e-12) THEN month END) AS DATE) AS first_mismatch_key
FROM j
UNION ALL
SELECT 'gross_margin', SUM(CASE WHEN inl AND inr THEN 1 ELSE 0 END),
  SUM(CASE WHEN NOT inr THEN 1 ELSE 0 END), SUM(CASE WHEN NOT inl THEN 1 ELSE 0 END),
  SUM(CASE WHEN inl AND inr AND ABS(l_gm - r_gm) > GREATEST(1e-9 * GREATEST(ABS(l_gm), ABS(r_gm)), 1e-12) THEN 1 ELSE 0 END),
  CAST(MIN(CASE WHEN inl AND inr AND ABS(l_gm - r_gm) > GREATEST(1e-9 * GREATEST(ABS(l_gm), ABS(r_gm)), 1e-12) THEN month END) AS DATE)
FROM j
""")
def reconcile_monthly_revenue(spark, sf_dir):
    """Reconcile monthly revenue and margin rolled up from orders vs from
    order lines (full outer join on month, relative/absolute tolerance)."""
    p = production(spark, sf_dir)
    c = p.c
    month = F.trunc("order_date", "month").alias("month")
    a = p.orders.groupBy(month).agg(F.sum("net_revenue").alias("net_revenue"),
                                    F.sum("gross_margin").alias("gross_margin"))
    b = c.order_lines().groupBy(month).agg(F.sum("net_revenue").alias("net_revenue"),
                                           F.sum("gross_margin").alias("gross_margin"))
    return quality.reconcile(a, b, ["month"], ["net_revenue", "gross_margin"])


@register("campaign_input_contract", S.c360_chain(CAMPAIGN_BUDGET) + """
, ins AS (
  SELECT 'production_snapshot' AS input_name, customer_id FROM prod
  UNION ALL SELECT 'rfm', customer_id FROM rfm
  UNION ALL SELECT 'clv_scores', customer_id FROM clv_s
  UNION ALL SELECT 'churn_scores', customer_id FROM churn_s
)
, per AS (SELECT input_name, customer_id, COUNT(*) AS c FROM ins GROUP BY 1, 2)
SELECT i.input_name, SUM(i.c) AS rows, SUM(CASE WHEN i.customer_id IS NULL THEN i.c ELSE 0 END) AS null_ids,
  SUM(CASE WHEN i.c > 1 THEN i.c - 1 ELSE 0 END) AS duplicate_ids,
  SUM(CASE WHEN p.customer_id IS NULL THEN 1 ELSE 0 END) AS extra_vs_snapshot,
  (SELECT COUNT(*) FROM prod x WHERE NOT EXISTS (SELECT 1 FROM per y WHERE y.input_name = i.input_name
     AND y.customer_id = x.customer_id)) AS missing_vs_snapshot
FROM per i LEFT JOIN prod p ON i.customer_id = p.customer_id
GROUP BY i.input_name
""")
def campaign_input_contract(spark, sf_dir):
    """One row per decision input: rows, null and duplicate ids, and the
    population difference against the snapshot (anti joins both ways)."""
    p = production(spark, sf_dir)
    base = p.snapshot.select("customer_id")
    parts = []
    for name, frame in (("production_snapshot", p.snapshot), ("rfm", p.rfm), ("clv_scores", p.clv),
                        ("churn_scores", p.churn)):
        ids = frame.select("customer_id")
        per = ids.groupBy("customer_id").agg(F.count(F.lit(1)).alias("c"))
        stats = per.agg(
            F.sum("c").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("customer_id").isNull(), F.col("c"))), F.lit(0)).alias("null_ids"),
            F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c") - 1)), F.lit(0)).alias("duplicate_ids"),
        )
        extra = ids.distinct().join(base, "customer_id", "left_anti").agg(F.count(F.lit(1)).alias("extra_vs_snapshot"))
        missing = base.join(ids, "customer_id", "left_anti").agg(F.count(F.lit(1)).alias("missing_vs_snapshot"))
        parts.append(stats.select(F.lit(name).alias("input_name"), "*")
                     .withColumn("extra_vs_snapshot", extra.scalar())
                     .withColumn("missing_vs_snapshot", missing.scalar()))
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out


@register("scoring_contract_batch", S.snapshot_sql([ANALYSIS_DATE], name="prod") + """
, sc AS (
  SELECT customer_id,
    LEAST(GREATEST(CAST(recency_days AS DOUBLE) / (CAST(recency_days AS DOUBLE) + 120.0), 0.02), 0.98) AS p,
    GREATEST(GREATEST(0.0, 0.9 * CAST(gross_margin_12m AS DOUBLE) + 12.0 * CAST(sessions_90d AS DOUBLE)), 0.0) AS v
  FROM prod
)
SELECT customer_id, ROUND(p, 6) AS churn_probability,
  CASE WHEN p < 0.35 THEN 'Low' WHEN p < 0.55 THEN 'Medium' WHEN p < 0.72 THEN 'High' ELSE 'Critical' END AS churn_risk_band,
  CAST(ROUND(CAST(v AS DECIMAL(18,6)), 2) AS DOUBLE) AS predicted_clv_12m,
  CASE WHEN v < 500 THEN 'Low' WHEN v < 1500 THEN 'Developing' WHEN v < 3500 THEN 'High' ELSE 'Strategic' END AS clv_band,
  0.5 AS decision_threshold, '""" + ANALYSIS_DATE + """' AS model_snapshot
FROM sc
""")
def scoring_contract_batch(spark, sf_dir):
    """Range-validated batch scoring of the feature table with the
    service's left-closed bands (rejected rows would carry their violations)."""
    from ..operators.scores import rule_churn_probability, rule_value_prediction

    snap = production(spark, sf_dir).snapshot
    accepted, _rejected = scoring.split_valid(snap)
    scored = accepted.select("customer_id", rule_churn_probability().alias("churn_probability"),
                             rule_value_prediction().alias("predicted_clv_12m"))
    return scoring.band_scores(scored, threshold=0.5, snapshot_date=ANALYSIS_DATE)


#: gates that stop a publication: keys and amounts
BLOCKING_GATES = ["customer_primary_key_unique", "product_primary_key_unique", "order_primary_key_unique",
                  "order_revenue_nonnegative", "snapshot_features_valid"]

# ---- sources, sinks and streaming ------------------------------------------------------
from ..sources import files  # noqa: E402
from ..sources.adapter import canonical  # noqa: E402


@register("table_row_counts", """
SELECT 'customers' AS "table", COUNT(*) AS rows FROM cust
UNION ALL SELECT 'products', COUNT(*) FROM part
UNION ALL SELECT 'orders', COUNT(*) FROM ford
UNION ALL SELECT 'order_lines', COUNT(*) FROM oline
UNION ALL SELECT 'interactions', COUNT(*) FROM inter
""")
def table_row_counts(spark, sf_dir):
    """Row counts of the published canonical tables."""
    c = canonical(spark, sf_dir)
    return files.row_counts({"customers": c.customers(), "products": c.products(), "orders": c.orders(),
                             "order_lines": c.order_lines(), "interactions": c.interactions()})


def _scratch(spark, name: str, sf_dir: str) -> str:
    import uuid

    from ..session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("csv_roundtrip_orders", """
SELECT order_id, customer_id, order_date, channel, primary_category, item_count, gross_revenue,
       discount_amount, returned_amount, net_revenue, gross_margin, returned_flag
FROM ford
""")
def csv_roundtrip_orders(spark, sf_dir):
    """Orders written as header CSV with ISO dates and read back
    with the declared schema (only empty fields are null)."""
    orders = canonical(spark, sf_dir).orders()
    path = _scratch(spark, "csv-orders", sf_dir)
    files.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema)


@register("stream_scoring", S.snapshot_sql([ANALYSIS_DATE], name="prod") + """
, sc AS (
  SELECT customer_id,
    LEAST(GREATEST(CAST(recency_days AS DOUBLE) / (CAST(recency_days AS DOUBLE) + 120.0), 0.02), 0.98) AS p,
    GREATEST(GREATEST(0.0, 0.9 * CAST(gross_margin_12m AS DOUBLE) + 12.0 * CAST(sessions_90d AS DOUBLE)), 0.0) AS v
  FROM prod
)
SELECT customer_id, ROUND(p, 6) AS churn_probability,
  CASE WHEN p < 0.35 THEN 'Low' WHEN p < 0.55 THEN 'Medium' WHEN p < 0.72 THEN 'High' ELSE 'Critical' END AS churn_risk_band,
  CAST(ROUND(CAST(v AS DECIMAL(18,6)), 2) AS DOUBLE) AS predicted_clv_12m,
  CASE WHEN v < 500 THEN 'Low' WHEN v < 1500 THEN 'Developing' WHEN v < 3500 THEN 'High' ELSE 'Strategic' END AS clv_band,
  0.5 AS decision_threshold, '""" + ANALYSIS_DATE + """' AS model_snapshot
FROM sc
""")
def stream_scoring(spark, sf_dir):
    """M15 re-aimed: Structured Streaming over feature files (foreachBatch, idempotent
    per-batch partitions), the same contract and bands as batch scoring."""
    from ..operators.scores import rule_churn_probability, rule_value_prediction
    from ..streaming.scoring import read_scored, start_scoring_stream

    snap = production(spark, sf_dir).snapshot
    base = _scratch(spark, "stream", sf_dir)
    feats = snap.select("customer_id", *FEATURE_COLUMNS)
    feats.write.mode("overwrite").parquet(f"{base}/source")
    q = start_scoring_stream(
        spark, f"{base}/source", feats.schema, f"{base}/sink", f"{base}/checkpoint",
        scorer=lambda d: d.select("customer_id", rule_churn_probability().alias("churn_probability"),
                                  rule_value_prediction().alias("predicted_clv_12m")),
        threshold=0.5, snapshot_date=ANALYSIS_DATE)
    q.awaitTermination()
    return read_scored(spark, f"{base}/sink").drop("batch_id")
