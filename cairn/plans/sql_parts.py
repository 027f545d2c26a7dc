"""Reusable oracle CTE fragments (DuckDB SQL), appended after ``ADAPTER_SQL``.

Each fragment starts with a comma so fragments chain: ``ADAPTER_SQL + RFM + ...``.
"""

from __future__ import annotations

from ..constants import ANALYSIS_DATE


def avg_pct(col: str, part: str = "") -> str:
    """Average-rank percentile, written in the same operand order as the Spark side."""
    p = f"PARTITION BY {part} " if part else ""
    pv = f"PARTITION BY {part + ', ' if part else ''}{col}"
    return (f"((RANK() OVER ({p}ORDER BY {col}) - 1 + (COUNT(*) OVER ({pv}) + 1) / 2) "
            f"/ COUNT(*) OVER ({p.strip()}))")


def quint(pct: str) -> str:
    return f"CAST(LEAST(GREATEST(CEIL({pct} * 5), 1), 5) AS INTEGER)"


def rfm_sql(day: str = ANALYSIS_DATE) -> str:
    d = f"DATE '{day}'"
    return f"""
, rfm_win AS (
  SELECT customer_id, MAX(order_date) AS last_order_date, COUNT(DISTINCT order_id) AS frequency,
         SUM(net_revenue) AS monetary, SUM(gross_margin) AS gross_margin
  FROM ford WHERE order_date BETWEEN {d} - 364 AND {d} GROUP BY customer_id
), rfm_base AS (
  SELECT c.customer_id, w.last_order_date,
         CAST(COALESCE(w.frequency, 0) AS BIGINT) AS frequency,
         CAST(COALESCE(w.monetary, 0) AS DECIMAL(18,2)) AS monetary,
         CAST(COALESCE(w.gross_margin, 0) AS DECIMAL(18,2)) AS gross_margin,
         CAST(COALESCE({d} - w.last_order_date, GREATEST({d} - c.acquisition_date, 0) + 365) AS INTEGER) AS recency
  FROM cust c LEFT JOIN rfm_win w ON c.customer_id = w.customer_id
  WHERE c.acquisition_date <= {d}
), rfm_pct AS (
  SELECT *, {avg_pct('recency')} AS r_pct, {avg_pct('frequency')} AS f_pct, {avg_pct('monetary')} AS m_pct
  FROM rfm_base
), rfm_sc AS (
  SELECT customer_id, last_order_date, frequency, monetary, gross_margin, recency,
         CAST(6 - {quint('r_pct')} AS INTEGER) AS recency_score,
         CASE WHEN frequency = 0 THEN 1 ELSE {quint('f_pct')} END AS frequency_score,
         CASE WHEN frequency = 0 THEN 1 ELSE {quint('m_pct')} END AS monetary_score
  FROM rfm_pct
), rfm AS (
  SELECT *, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR)
            AS rfm_score,
         CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
              WHEN recency_score >= 3 AND frequency_score >= 4 THEN 'Loyal Customers'
              WHEN recency_score >= 4 AND frequency_score IN (2, 3) THEN 'Potential Loyalists'
              WHEN recency_score = 5 AND frequency_score = 1 THEN 'New Customers'
              WHEN recency_score >= 3 AND frequency_score = 2 THEN 'Promising'
              WHEN recency_score IN (2, 3) AND frequency_score >= 3 THEN 'Need Attention'
              WHEN recency_score <= 2 AND frequency_score >= 4 THEN 'Can''t Lose Them'
              WHEN recency_score <= 2 AND frequency_score IN (2, 3) THEN 'At Risk'
              WHEN recency_score <= 2 AND frequency_score = 1 THEN 'Hibernating'
              ELSE 'Lost' END AS rfm_segment
  FROM rfm_sc
)
"""


def sdiv(num: str, den: str) -> str:
    """safe_divide: double ratio, 0 when the denominator is 0 or null."""
    return f"COALESCE(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), 0.0)"


def snapshot_sql(cutoffs, churn_h=None, clv_h=None, name: str = "snap") -> str:
    """Multi-cutoff snapshot as CTE ``name`` (relational form: facts x cutoffs)."""
    values = ", ".join(f"({i}, DATE '{c}')" for i, c in enumerate(cutoffs))
    w12 = "o.order_date <= k.snapshot_date AND o.order_date >= k.snapshot_date - 364"
    hist = "o.order_date <= k.snapshot_date"
    extra = ""
    if churn_h is not None:
        extra += (f", SUM(CASE WHEN o.order_date > k.snapshot_date AND o.order_date <= k.snapshot_date + {churn_h} "
                  f"THEN 1 ELSE 0 END) AS fut_churn")
    if clv_h is not None:
        fut = f"o.order_date > k.snapshot_date AND o.order_date <= k.snapshot_date + {clv_h}"
        extra += (f", SUM(CASE WHEN {fut} THEN o.gross_margin END) AS future_gross_margin"
                  f", SUM(CASE WHEN {fut} THEN o.net_revenue END) AS future_revenue"
                  f", SUM(CASE WHEN {fut} THEN 1 ELSE 0 END) AS future_orders")
    iw12 = "i.month <= k.snapshot_date AND i.month >= k.snapshot_date - 364"
    iw90 = "i.month <= k.snapshot_date AND i.month >= k.snapshot_date - 89"
    labels = ""
    if churn_h is not None:
        labels += ", CASE WHEN COALESCE(b.fut_churn, 0) > 0 THEN 0 ELSE 1 END AS churn_90d"
    if clv_h is not None:
        labels += (", CAST(COALESCE(b.future_gross_margin, 0) AS DECIMAL(18,2)) AS future_gross_margin"
                   ", CAST(COALESCE(b.future_revenue, 0) AS DECIMAL(18,2)) AS future_revenue"
                   ", CAST(COALESCE(b.future_orders, 0) AS BIGINT) AS future_orders")
    return f"""
, {name}_k AS (SELECT * FROM (VALUES {values}) t(k, snapshot_date))
, {name}_o AS (
  SELECT k.k, o.customer_id,
    MAX(CASE WHEN {hist} THEN o.order_date END) AS last_order_date,
    SUM(CASE WHEN {hist} THEN 1 ELSE 0 END) AS lifetime_orders,
    SUM(CASE WHEN {hist} THEN o.net_revenue END) AS lifetime_revenue,
    SUM(CASE WHEN {hist} THEN o.gross_margin END) AS lifetime_margin,
    SUM(CASE WHEN {w12} THEN 1 ELSE 0 END) AS frequency_12m,
    SUM(CASE WHEN {w12} THEN o.net_revenue END) AS monetary_12m,
    SUM(CASE WHEN {w12} THEN o.gross_margin END) AS gross_margin_12m,
    SUM(CASE WHEN {w12} THEN o.gross_revenue END) AS gross_revenue_12m,
    SUM(CASE WHEN {w12} THEN o.discount_amount END) AS discount_amount_12m,
    SUM(CASE WHEN {w12} THEN o.returned_flag END) AS returned_orders_12m,
    COUNT(DISTINCT CASE WHEN {w12} THEN o.primary_category END) AS category_diversity_12m,
    SUM(CASE WHEN {w12} AND o.channel IN ('Mobile App', 'Web') THEN 1 ELSE 0 END) AS online_orders_12m
    {extra}
  FROM ford o CROSS JOIN {name}_k k GROUP BY k.k, o.customer_id
)
, {name}_i AS (
  SELECT k.k, i.customer_id,
    SUM(CASE WHEN {iw12} THEN i.email_sent END) AS email_sent_12m,
    SUM(CASE WHEN {iw12} THEN i.email_opens END) AS email_opens_12m,
    SUM(CASE WHEN {iw12} THEN i.support_tickets END) AS support_tickets_12m,
    SUM(CASE WHEN {iw90} THEN i.sessions END) AS sessions_90d,
    MAX(CASE WHEN i.month <= k.snapshot_date AND i.sessions > 0 THEN i.month END) AS last_session_month
  FROM inter i CROSS JOIN {name}_k k GROUP BY k.k, i.customer_id
)
, {name}_b AS (
  SELECT c.customer_id, c.acquisition_date, c.region, c.age_band, c.loyalty_tier, c.preferred_channel,
    c.marketing_consent, k.snapshot_date,
    GREATEST(k.snapshot_date - c.acquisition_date, 0) AS tenure_days,
    b.last_order_date,
    CAST(COALESCE(b.lifetime_orders, 0) AS BIGINT) AS lifetime_orders,
    CAST(COALESCE(b.lifetime_revenue, 0) AS DECIMAL(18,2)) AS lifetime_revenue,
    CAST(COALESCE(b.lifetime_margin, 0) AS DECIMAL(18,2)) AS lifetime_margin,
    CAST(COALESCE(b.frequency_12m, 0) AS BIGINT) AS frequency_12m,
    CAST(COALESCE(b.monetary_12m, 0) AS DECIMAL(18,2)) AS monetary_12m,
    CAST(COALESCE(b.gross_margin_12m, 0) AS DECIMAL(18,2)) AS gross_margin_12m,
    CAST(COALESCE(b.gross_revenue_12m, 0) AS DECIMAL(18,2)) AS gross_revenue_12m,
    CAST(COALESCE(b.discount_amount_12m, 0) AS DECIMAL(18,2)) AS discount_amount_12m,
    CAST(COALESCE(b.returned_orders_12m, 0) AS BIGINT) AS returned_orders_12m,
    CAST(COALESCE(b.category_diversity_12m, 0) AS BIGINT) AS category_diversity_12m,
    CAST(COALESCE(b.online_orders_12m, 0) AS BIGINT) AS online_orders_12m,
    CAST(COALESCE(i.email_sent_12m, 0) AS BIGINT) AS email_sent_12m,
    CAST(COALESCE(i.email_opens_12m, 0) AS BIGINT) AS email_opens_12m,
    CAST(COALESCE(i.support_tickets_12m, 0) AS BIGINT) AS support_tickets_12m,
    CAST(COALESCE(i.sessions_90d, 0) AS BIGINT) AS sessions_90d,
    i.last_session_month
    {labels}
  FROM cust c JOIN {name}_k k ON c.acquisition_date <= k.snapshot_date
  LEFT JOIN {name}_o b ON b.customer_id = c.customer_id AND b.k = k.k
  LEFT JOIN {name}_i i ON i.customer_id = c.customer_id AND i.k = k.k
)
, {name} AS (
  SELECT *,
    COALESCE(snapshot_date - last_order_date, GREATEST(tenure_days, 1) + 365) AS recency_days,
    {sdiv('monetary_12m', 'frequency_12m')} AS avg_order_value_12m,
    {sdiv('discount_amount_12m', 'gross_revenue_12m')} AS discount_rate_12m,
    {sdiv('returned_orders_12m', 'frequency_12m')} AS return_rate_12m,
    {sdiv('online_orders_12m', 'frequency_12m')} AS online_order_share_12m,
    {sdiv('email_opens_12m', 'email_sent_12m')} AS email_open_rate_12m,
    COALESCE(snapshot_date - last_session_month, GREATEST(tenure_days, 1) + 90) AS days_since_last_session,
    CASE loyalty_tier WHEN 'Bronze' THEN 1 WHEN 'Silver' THEN 2 WHEN 'Gold' THEN 3 WHEN 'Platinum' THEN 4 ELSE 0 END
      AS loyalty_tier_score,
    marketing_consent AS consent_flag
  FROM {name}_b
)
"""


SNAPSHOT_OUT = """customer_id, snapshot_date, region, age_band, loyalty_tier, preferred_channel, marketing_consent,
  tenure_days, last_order_date, lifetime_orders, lifetime_revenue, lifetime_margin, recency_days, frequency_12m,
  monetary_12m, gross_margin_12m, gross_revenue_12m, discount_amount_12m, returned_orders_12m,
  category_diversity_12m, online_orders_12m, email_sent_12m, email_opens_12m, support_tickets_12m, sessions_90d,
  last_session_month, ROUND(avg_order_value_12m, 6) AS avg_order_value_12m,
  ROUND(discount_rate_12m, 6) AS discount_rate_12m, ROUND(return_rate_12m, 6) AS return_rate_12m,
  ROUND(online_order_share_12m, 6) AS online_order_share_12m, ROUND(email_open_rate_12m, 6) AS email_open_rate_12m,
  days_since_last_session, loyalty_tier_score, consent_flag"""

SNAPSHOT_COLUMNS = [
    "customer_id", "snapshot_date", "region", "age_band", "loyalty_tier", "preferred_channel", "marketing_consent",
    "tenure_days", "last_order_date", "lifetime_orders", "lifetime_revenue", "lifetime_margin", "recency_days",
    "frequency_12m", "monetary_12m", "gross_margin_12m", "gross_revenue_12m", "discount_amount_12m",
    "returned_orders_12m", "category_diversity_12m", "online_orders_12m", "email_sent_12m", "email_opens_12m",
    "support_tickets_12m", "sessions_90d", "last_session_month", "avg_order_value_12m", "discount_rate_12m",
    "return_rate_12m", "online_order_share_12m", "email_open_rate_12m", "days_since_last_session",
    "loyalty_tier_score", "consent_flag",
]


def _num(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def scores_sql(snap: str = "prod") -> str:
    """Rule-based churn and value score tables ``churn_s`` and ``clv_s`` over CTE ``snap``."""
    return f"""
, sc AS (
  SELECT customer_id, snapshot_date,
    LEAST(GREATEST(CAST(recency_days AS DOUBLE) / (CAST(recency_days AS DOUBLE) + 120.0), 0.02), 0.98)
      AS churn_probability,
    GREATEST(0.0, 0.9 * CAST(gross_margin_12m AS DOUBLE) + 12.0 * CAST(sessions_90d AS DOUBLE)) AS predicted_clv_12m
  FROM {snap}
)
, churn_s AS (
  SELECT customer_id, snapshot_date, churn_probability, {avg_pct('churn_probability')} AS risk_percentile,
    CASE WHEN churn_probability <= 0.35 THEN 'Low' WHEN churn_probability <= 0.55 THEN 'Medium'
         WHEN churn_probability <= 0.72 THEN 'High' ELSE 'Critical' END AS risk_band
  FROM sc
)
, clv_r AS (
  SELECT customer_id, snapshot_date, predicted_clv_12m,
    ROW_NUMBER() OVER (ORDER BY predicted_clv_12m, customer_id) AS rn, COUNT(*) OVER () AS n
  FROM sc
)
, clv_s AS (
  SELECT customer_id, snapshot_date, predicted_clv_12m, {avg_pct('predicted_clv_12m')} AS clv_percentile,
    CASE GREATEST(0, CASE WHEN n > 1 THEN ((rn - 1) * 4 + (n - 1) - 1) // (n - 1) ELSE 0 END - 1)
      WHEN 0 THEN 'Low' WHEN 1 THEN 'Developing' WHEN 2 THEN 'High' ELSE 'Strategic' END AS clv_band
  FROM clv_r
)
"""


def decision_sql(budget: float, snap: str = "prod") -> str:
    """Campaign decision ``targets`` over ``snap``, ``rfm``, ``clv_s``, ``churn_s``."""
    cost = ("CASE recommended_action WHEN 'VIP Experience' THEN 95.0 WHEN 'Retain & Reward' THEN 72.0 "
            "WHEN 'Win-Back' THEN 61.0 WHEN 'Cross-Sell' THEN 49.0 WHEN 'Onboarding' THEN 34.0 "
            "WHEN 'Nurture' THEN 28.0 ELSE 0.0 END")
    base = ("CASE recommended_action WHEN 'VIP Experience' THEN 0.26 WHEN 'Retain & Reward' THEN 0.23 "
            "WHEN 'Win-Back' THEN 0.14 WHEN 'Cross-Sell' THEN 0.18 WHEN 'Onboarding' THEN 0.21 "
            "WHEN 'Nurture' THEN 0.11 ELSE 0.0 END")
    core = ("((base_resp + 0.08 * engagement_norm) + 0.06 * COALESCE(clv_percentile, 0.0)) "
            "- 0.05 * COALESCE(churn_probability, 0.0)")
    elig = "(contact_cost > 0 AND eim > 0 AND marketing_consent = 1)"
    return f"""
, fr AS (
  SELECT p.customer_id, p.marketing_consent, p.frequency_12m, p.monetary_12m, p.gross_margin_12m,
    p.avg_order_value_12m, p.category_diversity_12m, p.recency_days, p.sessions_90d, r.rfm_segment,
    v.predicted_clv_12m, v.clv_percentile, v.clv_band, h.churn_probability, h.risk_percentile, h.risk_band
  FROM {snap} p LEFT JOIN rfm r ON p.customer_id = r.customer_id
  LEFT JOIN clv_s v ON p.customer_id = v.customer_id
  LEFT JOIN churn_s h ON p.customer_id = h.customer_id
)
, fr2 AS (
  SELECT *, CASE
    WHEN NOT (COALESCE(marketing_consent, 0) <> 0) THEN 'Suppress'
    WHEN clv_percentile >= 0.80 AND churn_probability >= 0.55 THEN 'Win-Back'
    WHEN clv_percentile >= 0.80 AND churn_probability < 0.55 THEN 'VIP Experience'
    WHEN rfm_segment IN ('Champions', 'Loyal Customers') THEN 'Retain & Reward'
    WHEN rfm_segment IN ('New Customers', 'Potential Loyalists', 'Promising') THEN 'Onboarding'
    WHEN category_diversity_12m <= 2 AND frequency_12m >= 2 THEN 'Cross-Sell'
    WHEN churn_probability >= 0.68 THEN 'Win-Back'
    WHEN frequency_12m = 0 AND recency_days > 365 THEN 'Suppress'
    ELSE 'Nurture' END AS recommended_action
  FROM fr
)
, fr3 AS (
  SELECT *, CAST({cost} AS DOUBLE) AS contact_cost, CAST({base} AS DOUBLE) AS base_resp,
    LEAST(GREATEST(COALESCE({avg_pct('sessions_90d')}, 0.0), 0.0), 1.0) AS engagement_norm
  FROM fr2
)
, fr4 AS (
  SELECT *, LEAST(GREATEST(CASE WHEN recommended_action = 'Win-Back'
      THEN {core} + 0.08 * COALESCE(churn_probability, 0.0) ELSE {core} END, 0.0), 0.55)
    AS expected_response_probability
  FROM fr3
)
, fr5 AS (
  SELECT *, expected_response_probability * LEAST(GREATEST(CAST(avg_order_value_12m AS DOUBLE), 450.0), 6500.0)
    * LEAST(GREATEST(COALESCE(CAST(gross_margin_12m AS DOUBLE) / NULLIF(CAST(monetary_12m AS DOUBLE), 0), 0.38),
                     0.18), 0.62)
    * (1.18 + 0.22 * COALESCE(clv_percentile, 0.0)) - contact_cost AS eim
  FROM fr4
)
, fr6 AS (SELECT *, CASE WHEN contact_cost > 0 THEN eim / contact_cost ELSE 0.0 END AS roi FROM fr5)
, fr7 AS (
  SELECT *, 0.36 * COALESCE(clv_percentile, 0.0) + 0.24 * COALESCE(risk_percentile, 0.0)
    + 0.25 * COALESCE({avg_pct('roi')}, 0.0) + 0.15 * engagement_norm AS priority_score
  FROM fr6
)
, fr8 AS (
  SELECT *, {elig} AS eligible,
    SUM(CASE WHEN {elig} THEN contact_cost ELSE 0.0 END)
      OVER (ORDER BY priority_score DESC, roi DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      AS run_cost
  FROM fr7
)
, targets AS (
  SELECT customer_id, marketing_consent, frequency_12m, monetary_12m, gross_margin_12m, avg_order_value_12m,
    category_diversity_12m, recency_days, sessions_90d, rfm_segment, predicted_clv_12m, clv_percentile, clv_band,
    churn_probability, risk_percentile, risk_band, recommended_action, contact_cost, expected_response_probability,
    CASE WHEN eligible AND run_cost <= {float(budget)!r} THEN eim ELSE 0.0 END AS expected_incremental_margin,
    CASE WHEN eligible AND run_cost <= {float(budget)!r} THEN roi ELSE 0.0 END AS expected_roi,
    priority_score,
    CASE WHEN priority_score <= 0.40 THEN 'Low' WHEN priority_score <= 0.60 THEN 'Medium'
         WHEN priority_score <= 0.78 THEN 'High' ELSE 'Critical' END AS campaign_priority,
    CASE WHEN eligible AND run_cost <= {float(budget)!r} THEN 1 ELSE 0 END AS selected_for_campaign,
    CASE WHEN eligible AND run_cost <= {float(budget)!r} THEN contact_cost ELSE 0.0 END AS allocated_budget
  FROM fr8
)
"""


C360_SQL = """
, c360 AS (
  SELECT p.customer_id, p.snapshot_date, p.region, p.age_band, p.loyalty_tier, p.preferred_channel,
    p.marketing_consent, p.lifetime_orders, p.lifetime_revenue, p.lifetime_margin,
    p.recency_days, p.frequency_12m, p.monetary_12m, p.gross_margin_12m, p.avg_order_value_12m,
    p.discount_rate_12m, p.return_rate_12m, p.category_diversity_12m, p.online_order_share_12m, p.sessions_90d,
    p.email_open_rate_12m, p.support_tickets_12m, p.days_since_last_session, p.tenure_days, p.loyalty_tier_score,
    p.consent_flag,
    r.rfm_segment, r.rfm_score, r.recency_score, r.frequency_score, r.monetary_score,
    v.predicted_clv_12m, v.clv_band, v.clv_percentile,
    h.churn_probability, h.risk_band, h.risk_percentile,
    t.recommended_action, t.campaign_priority, t.expected_incremental_margin, t.expected_roi,
    t.selected_for_campaign, t.allocated_budget
  FROM prod p
  LEFT JOIN rfm r ON p.customer_id = r.customer_id
  LEFT JOIN clv_s v ON p.customer_id = v.customer_id
  LEFT JOIN churn_s h ON p.customer_id = h.customer_id
  LEFT JOIN targets t ON p.customer_id = t.customer_id
)
"""


def c360_chain(budget: float) -> str:
    """prod snapshot, rfm, rule scores, decision and the 360 table, as CTEs."""
    return snapshot_sql([ANALYSIS_DATE], name="prod") + rfm_sql() + scores_sql() + decision_sql(budget) + C360_SQL
