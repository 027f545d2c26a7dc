"""Reports over the 360 / decision / cohort tables: the analysis SQL and views
(run by Spark SQL on DataFrame parameters), KPIs, BI measures and dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CAMPAIGN_BUDGET
from ..functions.exprs import r6
from ..operators import cohort, reports
from . import sql_parts as S
from .catalog import register
from .q_decision import C360_DOUBLES, production
from .q_core import COHORT_SQL
from .q_models import (CHURN_SCORED_SQL, F1_SQL, HOLD_CTES, VALUE_CTES, churn_holdout_metrics, clv_holdout_metrics)

CHAIN = S.c360_chain(CAMPAIGN_BUDGET)

# --- fixed values: reference lines of the value-risk portfolio chart ---
CHURN_LINE = 0.55
VALUE_LINE_QUANTILE = 0.8


def _sql_both(name: str, body: str, tables: tuple[str, ...], prefix: str = CHAIN, doc: str = ""):
    """Register a report whose body is plain SQL over ``tables`` (c360, targets,
    cohort): Spark runs it on DataFrame parameters, DuckDB on the CTE chain."""
    duck = prefix + body.format(**{t: t for t in tables})

    @register(name, duck)
    def run(spark, sf_dir):
        p = production(spark, sf_dir)
        frames = {}
        if "c360" in tables:
            frames["c360"] = p.c360
        if "targets" in tables:
            frames["targets"] = p.targets
        if "cohort" in tables:
            frames["cohort"] = cohort.cohort_retention_long(p.orders)
        return spark.sql(body, **frames)

    run.__doc__ = doc
    return run


# ---- analysis SQL (ties broken by id so LIMIT is deterministic); ``report_rank`` is the
# row's place in the report's order, over at most one row per group -----------------------
_sql_both("report_strategic_at_risk", """
SELECT customer_id, rfm_segment, predicted_clv_12m, churn_probability, recommended_action,
       expected_incremental_margin
FROM {c360}
WHERE clv_band = 'Strategic' AND risk_band IN ('High', 'Critical')
ORDER BY predicted_clv_12m DESC, customer_id
LIMIT 100
""", ("c360",), doc="T1, P9: top 100 strategic customers at high or critical risk.")

_sql_both("report_segment_economics", """
SELECT ROW_NUMBER() OVER (ORDER BY SUM(CAST(predicted_clv_12m AS DECIMAL(18,6))) DESC, rfm_segment) AS report_rank,
       rfm_segment, COUNT(*) AS customers, ROUND(SUM(monetary_12m), 2) AS revenue_12m,
       ROUND(SUM(gross_margin_12m), 2) AS margin_12m, ROUND(AVG(churn_probability), 4) AS avg_churn_probability,
       ROUND(SUM(CAST(predicted_clv_12m AS DECIMAL(18,6))), 2) AS predicted_clv_12m
FROM {c360}
GROUP BY rfm_segment
""", ("c360",), doc="A22, P42, T13: segment economics (double sums taken as exact decimals before rounding).")

_sql_both("report_campaign_portfolio", """
SELECT ROW_NUMBER() OVER (ORDER BY ROUND(SUM(expected_incremental_margin), 6) DESC, recommended_action, campaign_priority)
         AS report_rank,
       recommended_action, campaign_priority, CAST(SUM(selected_for_campaign) AS BIGINT) AS targeted_customers,
       ROUND(SUM(allocated_budget), 2) AS allocated_budget,
       ROUND(SUM(expected_incremental_margin), 2) AS expected_incremental_margin,
       ROUND(SUM(expected_incremental_margin) / NULLIF(SUM(allocated_budget), 0), 3) AS portfolio_roi
FROM {targets}
WHERE selected_for_campaign = 1
GROUP BY recommended_action, campaign_priority
""", ("targets",), doc="A23, P43, T13: campaign portfolio economics by action and priority.")

_sql_both("report_cohort_curve", """
SELECT cohort_month, cohort_index, cohort_size, active_customers, ROUND(retention_rate, 4) AS retention_rate
FROM {cohort}
WHERE cohort_index IN (0, 1, 3, 6, 12)
ORDER BY cohort_month, cohort_index
""", ("cohort",), prefix=CHAIN + COHORT_SQL, doc="T2, P8: retention curve at M0, M1, M3, M6, M12.")

_sql_both("view_customer_value_risk", """
SELECT customer_id, rfm_segment, clv_band, risk_band, monetary_12m, gross_margin_12m, predicted_clv_12m,
       churn_probability, recommended_action, campaign_priority
FROM {c360}
""", ("c360",), doc="P45: value x risk projection view.")

_sql_both("view_executive_customer_intelligence", """
SELECT rfm_segment, risk_band, clv_band, COUNT(*) AS customers, SUM(monetary_12m) AS revenue_12m,
       SUM(gross_margin_12m) AS gross_margin_12m, ROUND(SUM(predicted_clv_12m), 6) AS predicted_clv_12m,
       ROUND(AVG(churn_probability), 6) AS avg_churn_probability,
       ROUND(SUM(expected_incremental_margin), 6) AS expected_incremental_margin
FROM {c360}
GROUP BY rfm_segment, risk_band, clv_band
""", ("c360",), doc="A24: segment x risk x value rollup view.")

_sql_both("view_campaign_portfolio", """
SELECT recommended_action, campaign_priority, COUNT(*) AS targeted_customers,
       ROUND(SUM(allocated_budget), 6) AS allocated_budget,
       ROUND(SUM(expected_incremental_margin), 6) AS expected_incremental_margin,
       ROUND(AVG(expected_roi), 6) AS average_expected_roi
FROM {targets}
WHERE selected_for_campaign = 1
GROUP BY recommended_action, campaign_priority
""", ("targets",), doc="A25: campaign portfolio view.")

_sql_both("view_segment_portfolio", """
SELECT rfm_segment, COUNT(*) AS customers, SUM(monetary_12m) AS revenue_12m,
       ROUND(SUM(predicted_clv_12m), 6) AS predicted_clv_12m,
       ROUND(AVG(churn_probability), 6) AS average_churn_probability,
       ROUND(SUM(expected_incremental_margin), 6) AS expected_incremental_margin
FROM {c360}
GROUP BY rfm_segment
""", ("c360",), doc="A26: segment portfolio view.")

_sql_both("dashboard_filtered_header", """
SELECT COUNT(DISTINCT customer_id) AS customers, SUM(monetary_12m) AS revenue_12m,
       ROUND(SUM(predicted_clv_12m), 6) AS predicted_clv_12m, ROUND(AVG(churn_probability), 6) AS average_churn_probability
FROM {c360}
WHERE rfm_segment IN ('Champions', 'Loyal Customers', 'At Risk', 'Hibernating') AND risk_band IN ('High', 'Critical', 'Medium')
""", ("c360",), doc="P10, A43: two-dimension multi-select filter and header metrics.")


# ---- DataFrame reports ---------------------------------------------------------------
def _c360(spark, sf_dir) -> DataFrame:
    return production(spark, sf_dir).c360


@register("executive_kpis", CHAIN + COHORT_SQL + CHURN_SCORED_SQL + F1_SQL + HOLD_CTES + VALUE_CTES + """
, k AS (
  SELECT COUNT(DISTINCT customer_id) AS customers,
    SUM(CASE WHEN frequency_12m > 0 THEN 1 ELSE 0 END) AS active,
    CAST(SUM(monetary_12m) AS DOUBLE) AS revenue, CAST(SUM(gross_margin_12m) AS DOUBLE) AS margin,
    SUM(predicted_clv_12m) AS clv,
    SUM(CASE WHEN risk_band IN ('High', 'Critical') THEN 1 ELSE 0 END) AS high_risk,
    CAST(COALESCE(SUM(CASE WHEN risk_band IN ('High', 'Critical') THEN monetary_12m END), 0) AS DOUBLE) AS at_risk,
    AVG(churn_probability) AS avg_churn,
    SUM(allocated_budget) AS budget, SUM(expected_incremental_margin) AS eim
  FROM c360
)
, m3 AS (SELECT AVG(retention_rate) AS m3 FROM cohort WHERE cohort_index = 3 AND cohort_month >= '2000-01')
SELECT kpi, ROUND(value, 6) AS value, format FROM (
  SELECT 1 AS o, 'Customers' AS kpi, CAST(customers AS DOUBLE) AS value, 'count' AS format FROM k
  UNION ALL SELECT 2, 'Active Customers 12M', CAST(active AS DOUBLE), 'count' FROM k
  UNION ALL SELECT 3, 'Net Revenue 12M', revenue, 'currency' FROM k
  UNION ALL SELECT 4, 'Gross Margin 12M', margin, 'currency' FROM k
  UNION ALL SELECT 5, 'Predicted CLV 12M', clv, 'currency' FROM k
  UNION ALL SELECT 6, 'High/Critical Risk Customers', CAST(high_risk AS DOUBLE), 'count' FROM k
  UNION ALL SELECT 7, 'Revenue at Risk', at_risk, 'currency' FROM k
  UNION ALL SELECT 8, 'Average Churn Probability', avg_churn, 'percent' FROM k
  UNION ALL SELECT 9, 'M3 Cohort Retention', m3, 'percent' FROM m3
  UNION ALL SELECT 10, 'Churn ROC-AUC', roc_auc, 'decimal' FROM auc
  UNION ALL SELECT 11, 'Churn PR-AUC', pr_auc, 'decimal' FROM ap
  UNION ALL SELECT 12, 'Lift at Top 10%', CASE WHEN ys > 0 THEN (y10 / n10) / (ys / nn) ELSE 0.0 END, 'multiple' FROM topf
  UNION ALL SELECT 13, 'CLV Test MAE', mae, 'currency' FROM vag
  UNION ALL SELECT 14, 'CLV Test R2', CASE WHEN vy > 0 THEN 1.0 - sse / (vy * n) ELSE 0.0 END, 'decimal' FROM vag
  UNION ALL SELECT 15, 'Campaign Budget Allocated', budget, 'currency' FROM k
  UNION ALL SELECT 16, 'Expected Incremental Margin', eim, 'currency' FROM k
)
""")
def executive_kpis(spark, sf_dir):
    """The 16 KPIs: scalars of one global aggregate, recent retention and the
    holdout metrics, unpivoted to (kpi, value, format)."""
    p = production(spark, sf_dir)
    return reports.executive_kpis(p.c360, cohort.cohort_retention_long(p.orders), "2000-01",
                                  churn_holdout_metrics(spark, sf_dir), clv_holdout_metrics(spark, sf_dir))


@register("risk_band_rollup", CHAIN + """
, spine AS (SELECT * FROM (VALUES (1, 'Low'), (2, 'Medium'), (3, 'High'), (4, 'Critical')) t(band_order, risk_band))
, g AS (SELECT risk_band, COUNT(*) AS customers, SUM(monetary_12m) AS rev, SUM(predicted_clv_12m) AS clv
        FROM c360 GROUP BY risk_band)
SELECT s.risk_band, s.band_order, COALESCE(g.customers, 0) AS customers, CAST(COALESCE(g.rev, 0) AS DECIMAL(18,2)) AS revenue_12m,
  ROUND(COALESCE(g.clv, 0.0), 6) AS predicted_clv_12m
FROM spine s LEFT JOIN g ON s.risk_band = g.risk_band
""")
def risk_band_rollup(spark, sf_dir):
    """Rollup over the fixed risk labels with their order; absent bands are 0."""
    return reports.risk_band_rollup(_c360(spark, sf_dir))


@register("clv_band_rollup", CHAIN + """
, spine AS (SELECT * FROM (VALUES (1, 'Low'), (2, 'Developing'), (3, 'High'), (4, 'Strategic')) t(band_order, clv_band))
, g AS (SELECT clv_band, COUNT(*) AS customers, SUM(predicted_clv_12m) AS clv, SUM(monetary_12m) AS rev
        FROM c360 GROUP BY clv_band)
SELECT s.clv_band, s.band_order, COALESCE(g.customers, 0) AS customers,
  ROUND(COALESCE(g.clv, 0.0), 6) AS predicted_clv_12m, CAST(COALESCE(g.rev, 0) AS DECIMAL(18,2)) AS revenue_12m
FROM spine s LEFT JOIN g ON s.clv_band = g.clv_band
""")
def clv_band_rollup(spark, sf_dir):
    """Rollup over a fixed label spine; absent bands are 0."""
    return reports.clv_band_rollup(_c360(spark, sf_dir))


@register("clv_band_quartiles", CHAIN + """
SELECT clv_band, COUNT(*) AS customers,
  ROUND(quantile_cont(predicted_clv_12m, 0.25), 6) AS q1_predicted_clv_12m,
  ROUND(quantile_cont(predicted_clv_12m, 0.5), 6) AS median_predicted_clv_12m,
  ROUND(quantile_cont(predicted_clv_12m, 0.75), 6) AS q3_predicted_clv_12m
FROM c360 GROUP BY clv_band
""")
def clv_band_quartiles(spark, sf_dir):
    """Exact quartiles of predicted value per value band (distributed quantiles)."""
    return reports.clv_band_quartiles(_c360(spark, sf_dir))


@register("value_risk_reference_lines", CHAIN + f"""
, v AS (SELECT quantile_cont(predicted_clv_12m, {VALUE_LINE_QUANTILE}) AS t FROM c360)
SELECT ROUND((SELECT t FROM v), 6) AS value_threshold, {CHURN_LINE} AS churn_threshold,
  COUNT(*) AS customers,
  COUNT(*) FILTER (WHERE predicted_clv_12m > (SELECT t FROM v)) AS high_value_customers,
  COUNT(*) FILTER (WHERE churn_probability >= {CHURN_LINE}) AS high_risk_customers,
  COUNT(*) FILTER (WHERE predicted_clv_12m > (SELECT t FROM v) AND churn_probability >= {CHURN_LINE})
    AS high_value_high_risk_customers
FROM c360
""")
def value_risk_reference_lines(spark, sf_dir):
    """Exact 0.80 quantile of predicted value and the churn line of the value-risk
    portfolio, with the customers beyond them."""
    return reports.value_risk_reference_lines(_c360(spark, sf_dir), CHURN_LINE, VALUE_LINE_QUANTILE)


@register("regional_mean_risk", CHAIN + """
SELECT region, COUNT(*) AS customers, ROUND(AVG(churn_probability), 6) AS average_churn_probability
FROM c360 GROUP BY region
""")
def regional_mean_risk(spark, sf_dir):
    """A30."""
    return reports.regional_mean_risk(_c360(spark, sf_dir))


@register("rf_heatmap", CHAIN + """
SELECT recency_score,
""" + ",\n".join(
    f"  ROUND(COALESCE(AVG(CASE WHEN frequency_score = {f} THEN CAST(monetary_12m AS DOUBLE) END), 0.0), 6) AS F{f}"
    for f in range(1, 6)) + """
FROM c360 GROUP BY recency_score
""")
def rf_heatmap(spark, sf_dir):
    """R x F pivot of mean 12-month revenue, missing cells 0."""
    return reports.rf_heatmap(_c360(spark, sf_dir))


@register("retention_checkpoints", CHAIN + COHORT_SQL + """
SELECT cohort_index, COUNT(*) AS cohorts, ROUND(AVG(retention_rate), 6) AS average_retention
FROM cohort WHERE cohort_index IN (1, 3, 6, 12) GROUP BY cohort_index
""")
def retention_checkpoints(spark, sf_dir):
    """Mean retention at M1, M3, M6, M12 over all cohorts."""
    return reports.retention_checkpoints(cohort.cohort_retention_long(production(spark, sf_dir).orders))


_ACTIONS = ["VIP Experience", "Retain & Reward", "Win-Back", "Cross-Sell", "Onboarding", "Nurture"]


@register("selected_portfolio_pivot", CHAIN + """
SELECT campaign_priority,
""" + ",\n".join(
    f"  SUM(CASE WHEN recommended_action = '{a.replace(chr(39), chr(39) * 2)}' THEN 1 ELSE 0 END) AS \"{a}\""
    for a in _ACTIONS) + """,
  COUNT(*) AS selected_customers
FROM targets WHERE selected_for_campaign = 1 GROUP BY campaign_priority
""")
def selected_portfolio_pivot(spark, sf_dir):
    """Selected customers, priority x action pivot with row totals."""
    return reports.selected_portfolio_pivot(production(spark, sf_dir).targets, _ACTIONS)


@register("dashboard_top_targets", CHAIN + """
SELECT customer_id, rfm_segment, recommended_action, campaign_priority,
  ROUND(expected_incremental_margin, 6) AS expected_incremental_margin, ROUND(expected_roi, 6) AS expected_roi
FROM targets WHERE selected_for_campaign = 1
ORDER BY expected_incremental_margin DESC, customer_id LIMIT 250
""")
def dashboard_top_targets(spark, sf_dir):
    """The 250 selected customers with the highest expected margin."""
    return reports.top_targets(production(spark, sf_dir).targets, 250)


@register("top_dormant_customers", CHAIN + """
SELECT customer_id, recency_days, ROUND(churn_probability, 6) AS churn_probability
FROM c360 ORDER BY recency_days DESC, customer_id LIMIT 60
""")
def top_dormant_customers(spark, sf_dir):
    """The 60 most dormant customers (largest recency)."""
    return reports.top_k(_c360(spark, sf_dir), "recency_days", 60, ["customer_id", "recency_days", "churn_probability"])


@register("top_segments_by_value", CHAIN + """
SELECT rfm_segment, ROUND(SUM(predicted_clv_12m), 6) AS predicted_clv_12m FROM c360
GROUP BY rfm_segment ORDER BY SUM(predicted_clv_12m) DESC, rfm_segment LIMIT 3
""")
def top_segments_by_value(spark, sf_dir):
    """Top 3 segments by predicted value."""
    return reports.top_segments(_c360(spark, sf_dir), 3)


@register("distinct_segments", CHAIN + "SELECT DISTINCT rfm_segment FROM c360")
def distinct_segments(spark, sf_dir):
    """Distinct values for a filter widget."""
    return _c360(spark, sf_dir).select("rfm_segment").distinct()


@register("portfolio_totals_ex_suppress", CHAIN + """
SELECT COUNT(*) AS selected_contacts, ROUND(SUM(expected_incremental_margin), 6) AS expected_incremental_margin,
  ROUND(SUM(allocated_budget), 6) AS allocated_budget
FROM targets WHERE selected_for_campaign = 1 AND recommended_action <> 'Suppress'
""")
def portfolio_totals_ex_suppress(spark, sf_dir):
    """Selected totals excluding Suppress."""
    return reports.portfolio_totals(production(spark, sf_dir).targets)


@register("bi_row_measures", CHAIN + """
SELECT region,
  CAST(SUM(CASE WHEN churn_probability >= 0.55 THEN monetary_12m ELSE 0 END) AS DECIMAL(18,2)) AS value_at_risk,
  COUNT(DISTINCT CASE WHEN clv_band = 'Strategic' AND risk_band IN ('High', 'Critical') THEN customer_id END)
    AS strategic_risk_customers,
  ROUND(SUM(CASE WHEN selected_for_campaign = 1 THEN expected_incremental_margin ELSE 0.0 END), 6)
    AS campaign_selected_margin,
  ROUND(AVG(churn_probability), 6) AS average_churn_probability
FROM c360 GROUP BY region
""")
def bi_row_measures(spark, sf_dir):
    """Worksheet calculations (value at risk, strategic-risk flag,
    selected margin) aggregated by region (SUM / COUNTD / AVG)."""
    return reports.bi_row_measures(_c360(spark, sf_dir))


@register("scenario_allocation", CHAIN + """
, base AS (
  SELECT recommended_action, SUM(allocated_budget) AS b, SUM(expected_incremental_margin) AS m
  FROM targets WHERE recommended_action <> 'Suppress' GROUP BY recommended_action
)
, sh AS (SELECT *, b / SUM(b) OVER () AS share FROM base)
, scn AS (
  SELECT *, LEAST(b, 400000.0 * share) AS scenario_budget FROM sh
)
, sc2 AS (SELECT *, GREATEST(0.0, m * 1.0 - (scenario_budget - b)) AS scenario_margin FROM scn)
SELECT recommended_action, ROUND(share, 6) AS budget_share, ROUND(scenario_budget, 6) AS scenario_budget,
  ROUND(scenario_margin, 6) AS scenario_margin,
  ROUND(CASE WHEN scenario_budget > 0 THEN scenario_margin / scenario_budget ELSE 0.0 END, 6) AS scenario_roi,
  CASE WHEN scenario_budget > 0 AND scenario_margin / scenario_budget >= 1 THEN 'INVEST'
       WHEN scenario_budget > 0 AND scenario_margin / scenario_budget >= 0.25 THEN 'TEST' ELSE 'HOLD' END AS decision
FROM sc2
""")
def scenario_allocation(spark, sf_dir):
    """Scenario budget / margin / ROI and INVEST-TEST-HOLD per action."""
    return reports.scenario_allocation(production(spark, sf_dir).targets, budget=400_000.0, response=1.0)


@register("monthly_bi_measures", """
, cm AS (
  SELECT date_trunc('month', order_date) AS month, customer_id, COUNT(*) AS co, SUM(net_revenue) AS rev,
         SUM(gross_margin) AS gm
  FROM ford GROUP BY 1, 2
)
, sm AS (
  SELECT CAST(month AS DATE) AS month, CAST(SUM(co) AS BIGINT) AS orders, COUNT(*) AS active_customers,
         CAST(SUM(rev) AS DECIMAL(18,2)) AS net_revenue, CAST(SUM(gm) AS DECIMAL(18,2)) AS gross_margin
  FROM cm GROUP BY 1
)
, bounds AS (SELECT MIN(month) AS lo, MAX(month) AS hi FROM sm)
, cal AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM bounds)
, j AS (
  SELECT c.month, COALESCE(s.orders, 0) AS orders, COALESCE(s.active_customers, 0) AS active_customers,
    COALESCE(s.net_revenue, 0) AS net_revenue, COALESCE(s.gross_margin, 0) AS gross_margin
  FROM cal c LEFT JOIN sm s ON c.month = s.month
)
SELECT a.month, strftime(a.month, '%Y-%m') AS year_month, a.orders, a.active_customers,
  CAST(a.net_revenue AS DECIMAL(18,2)) AS net_revenue, CAST(a.gross_margin AS DECIMAL(18,2)) AS gross_margin,
  ROUND(""" + S.sdiv("a.gross_margin", "a.net_revenue") + """, 6) AS margin_rate,
  CAST(p.net_revenue AS DECIMAL(18,2)) AS net_revenue_prior_year,
  CAST(a.net_revenue - COALESCE(p.net_revenue, 0) AS DECIMAL(18,2)) AS net_revenue_yoy_change,
  ROUND(""" + S.sdiv("a.net_revenue - COALESCE(p.net_revenue, 0)", "p.net_revenue") + """, 6) AS net_revenue_yoy_pct
FROM j a LEFT JOIN j p ON p.month = a.month - INTERVAL 12 MONTH
""")
def monthly_bi_measures(spark, sf_dir):
    """Month calendar spine, base measures, prior year
    (self-join on month - 12), YoY change and YoY %, zero-safe margin rate."""
    from ..sources.adapter import canonical

    return reports.monthly_bi_measures(canonical(spark, sf_dir).orders())


@register("calendar_days", """
, b AS (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM ford)
, d AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT date, year(date) AS year, 'Q' || CAST(quarter(date) AS VARCHAR) AS quarter, month(date) AS month_number,
  monthname(date) AS month_name, strftime(date, '%Y-%m') AS year_month, CAST(date_trunc('month', date) AS DATE) AS month_start,
  CAST(weekofyear(date) AS INTEGER) AS week_of_year, dayname(date) AS day_of_week,
  CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM d
""")
def calendar_days(spark, sf_dir):
    """Day calendar over the order date range."""
    from ..sources.adapter import canonical

    return reports.day_calendar(canonical(spark, sf_dir).orders())


@register("latest_month_portfolio", CHAIN + """
, mm AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, COUNT(*) AS orders,
    CAST(SUM(net_revenue) AS DECIMAL(18,2)) AS net_revenue
  FROM ford GROUP BY 1
)
, rc AS (
  SELECT month, COUNT(*) AS active, SUM(CASE WHEN co >= 2 THEN 1 ELSE 0 END) AS rep
  FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, customer_id, COUNT(*) AS co FROM ford GROUP BY 1, 2)
  GROUP BY month
)
, port AS (SELECT SUM(predicted_clv_12m) AS clv, AVG(churn_probability) AS churn FROM c360)
SELECT m.month, m.orders, m.net_revenue,
  CASE WHEN m.month = (SELECT MAX(month) FROM mm) THEN ROUND((SELECT clv FROM port), 6) END AS predicted_clv_12m,
  ROUND(CASE WHEN m.month = (SELECT MAX(month) FROM mm) THEN (SELECT churn FROM port)
       ELSE 1.0 - """ + S.sdiv("r.rep", "r.active") + """ END, 6) AS churn_probability_or_proxy
FROM mm m JOIN rc r ON m.month = r.month
""")
def latest_month_portfolio(spark, sf_dir):
    """Portfolio scalars attached to the latest month only; earlier months
    carry 1 - repeat rate as a churn proxy."""
    p = production(spark, sf_dir)
    return reports.latest_month_portfolio(p.orders, p.c360)


@register("recent_cohort_matrix", COHORT_SQL + """
, ranked AS (SELECT DISTINCT cohort_month FROM cohort)
, last AS (SELECT cohort_month, ROW_NUMBER() OVER (ORDER BY cohort_month DESC) AS k FROM ranked)
SELECT c.cohort_month, """ + ", ".join(
    f"ROUND(MAX(CASE WHEN c.cohort_index = {i} THEN c.retention_rate END), 6) AS M{i}" for i in range(13)) + """,
  CASE WHEN MAX(l.k) <= 12 AND (MAX(l.k) - 1) % 3 = 0 THEN 1 ELSE 0 END AS highlighted
FROM cohort c JOIN last l ON c.cohort_month = l.cohort_month
WHERE l.k <= 24
GROUP BY c.cohort_month
""")
def recent_cohort_matrix(spark, sf_dir):
    """Last 24 cohorts x first 13 lags; every third of the last 12 flagged."""
    from ..sources.adapter import canonical

    return reports.recent_cohort_matrix(cohort.cohort_retention_long(canonical(spark, sf_dir).orders()))



@register("bi_customer_export", CHAIN + """
SELECT customer_id AS "Customer ID", rfm_segment AS "RFM Segment", risk_band AS "Risk Band", clv_band AS "CLV Band",
  monetary_12m AS "Net Revenue 12M", ROUND(predicted_clv_12m, 6) AS "Predicted CLV 12M",
  ROUND(churn_probability, 6) AS "Churn Probability", recommended_action AS "Recommended Action",
  format('{:,}', CAST(ROUND(CAST(monetary_12m AS DECIMAL(18,2)), 0) AS BIGINT)) AS "Net Revenue 12M (display)",
  format('{:,}', CAST(ROUND(CAST(predicted_clv_12m AS DECIMAL(18,6)), 0) AS BIGINT)) AS "Predicted CLV 12M (display)",
  format('{:.1f}', CAST(ROUND(CAST(churn_probability AS DECIMAL(18,6)) * 100, 1) AS DOUBLE)) || '%'
    AS "Churn Probability (display)"
FROM c360
""")
def bi_customer_export(spark, sf_dir):
    """Business renames and display formatting of the 360 export."""
    return reports.business_export(_c360(spark, sf_dir))


SLICE = ("2000-01", "2000-12")   # the months a slicer would pick


@register("monthly_bi_slice", f"""
, cm AS (
  SELECT strftime(order_date, '%Y-%m') AS ym, customer_id, COUNT(*) AS co, SUM(net_revenue) AS rev, SUM(gross_margin) AS gm
  FROM ford GROUP BY 1, 2
)
SELECT CAST(SUM(co) AS BIGINT) AS orders, COUNT(*) AS active_customer_months, CAST(SUM(rev) AS DECIMAL(18,2)) AS net_revenue,
  CAST(SUM(gm) AS DECIMAL(18,2)) AS gross_margin, ROUND(" + S.sdiv("SUM(gm)", "SUM(rev)") + ", 6) AS margin_rate
FROM cm WHERE ym BETWEEN '{SLICE[0]}' AND '{SLICE[1]}'
""".replace('" + S.sdiv("SUM(gm)", "SUM(rev)") + "', S.sdiv("SUM(gm)", "SUM(rev)")))
def monthly_bi_slice(spark, sf_dir):
    """The monthly base measures over a slice of months."""
    from ..sources.adapter import canonical

    return reports.monthly_slice(canonical(spark, sf_dir).orders(), *SLICE)


FILTER_SEGMENTS, FILTER_RISKS = ["Champions", "Loyal Customers", "At Risk", "Hibernating"], ["High", "Critical", "Medium"]
_TARGET_COLUMNS = ("customer_id, rfm_segment, clv_band, risk_band, ROUND(predicted_clv_12m, 6) AS predicted_clv_12m, "
                   "ROUND(churn_probability, 6) AS churn_probability, recommended_action, campaign_priority, "
                   "ROUND(expected_incremental_margin, 6) AS expected_incremental_margin")
_IN = lambda xs: ", ".join(f"'{x}'" for x in xs)


@register("dashboard_filtered_targets", CHAIN + f"""
SELECT ROW_NUMBER() OVER (ORDER BY expected_incremental_margin DESC, customer_id) AS report_rank, {_TARGET_COLUMNS}
FROM c360 WHERE selected_for_campaign = 1 AND rfm_segment IN ({_IN(FILTER_SEGMENTS)}) AND risk_band IN ({_IN(FILTER_RISKS)})
ORDER BY expected_incremental_margin DESC, customer_id LIMIT 250
""")
def dashboard_filtered_targets(spark, sf_dir):
    """Top 250 selected customers after the segment and risk filters, with
    value, risk and bands."""
    return reports.filtered_targets(_c360(spark, sf_dir), FILTER_SEGMENTS, FILTER_RISKS, 250)


@register("workbook_top_customers", CHAIN + f"""
SELECT ROW_NUMBER() OVER (ORDER BY predicted_clv_12m DESC, customer_id) AS report_rank, {_TARGET_COLUMNS}
FROM c360 ORDER BY predicted_clv_12m DESC, customer_id LIMIT 250
""")
def workbook_top_customers(spark, sf_dir):
    """The 250 customers of highest predicted value, selected or not."""
    return reports.ranked_customers(_c360(spark, sf_dir), "predicted_clv_12m", 250)


@register("segments_by_text", CHAIN + """
SELECT rfm_segment, COUNT(*) AS customers FROM c360 WHERE NOT contains(lower(rfm_segment), 'customers') GROUP BY rfm_segment
""")
def segments_by_text(spark, sf_dir):
    """Rows whose label does not contain a text, whatever its case."""
    kept = reports.without_text(_c360(spark, sf_dir), "rfm_segment", "Customers")
    return kept.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("customers"))


@register("bi_portfolio_measures", CHAIN + """
, seg AS (SELECT rfm_segment AS k, COUNT(*) AS customers, SUM(monetary_12m) AS rev, SUM(predicted_clv_12m) AS clv,
                 AVG(churn_probability) AS churn FROM c360 GROUP BY 1)
SELECT measure, ROUND(value, 6) AS value FROM (
  SELECT 'Segment Revenue' AS measure, CAST(SUM(rev) AS DOUBLE) AS value FROM seg
  UNION ALL SELECT 'Segment Predicted CLV', SUM(clv) FROM seg
  UNION ALL SELECT 'Segment Churn Risk', AVG(churn) FROM seg
  UNION ALL SELECT 'Segment Customers', CAST(SUM(customers) AS DOUBLE) FROM seg
  UNION ALL SELECT 'Campaign Budget', SUM(allocated_budget) FROM targets
  UNION ALL SELECT 'Campaign Expected Margin', SUM(expected_incremental_margin) FROM targets
  UNION ALL SELECT 'Risk Band Customers', CAST(COUNT(risk_band) AS DOUBLE) FROM c360
)
""")
def bi_portfolio_measures(spark, sf_dir):
    """The measures over the segment, campaign and risk-band tables."""
    p = production(spark, sf_dir)
    return reports.portfolio_measures(p.c360, p.targets)
