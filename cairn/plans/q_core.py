"""Adapter tables and descriptive analytics: RFM, cohorts, monthly metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import (ANALYSIS_DATE, CHURN_HOLDOUT_CUTOFF, CHURN_HORIZON_DAYS, CHURN_TRAIN_CUTOFFS,
                         CLV_HOLDOUT_CUTOFF, CLV_HORIZON_DAYS, CLV_TRAIN_CUTOFFS, MAX_COHORT_LAG)
from ..operators import cohort, monthly, rfm
from ..sources.adapter import canonical
from . import sql_parts as S
from .catalog import register


@register("adapter_customers", """
SELECT customer_id, acquisition_date, region, age_band, loyalty_tier, preferred_channel, marketing_consent
FROM cust
""")
def adapter_customers(spark, sf_dir):
    """S12-style dimension derivation: customer ⨝ nation ⨝ region ⨝ first order."""
    return canonical(spark, sf_dir).customers()


@register("adapter_orders", """
SELECT order_id, customer_id, order_date, channel, primary_category, item_count, gross_revenue,
       discount_amount, returned_amount, net_revenue, gross_margin, returned_flag
FROM ford
""")
def adapter_orders(spark, sf_dir):
    """P38 line economics, J18 line ⨝ product, A36 first-seen mode, A37 order rollup."""
    return canonical(spark, sf_dir).orders()


@register("adapter_order_lines", """
SELECT order_line_id, order_id, customer_id, order_date, product_id, category, quantity, discount_rate,
       gross_revenue, discount_amount, returned_flag, returned_amount, net_revenue, gross_margin
FROM oline
""")
def adapter_order_lines(spark, sf_dir):
    """Line economics of every order line with its built line key."""
    return canonical(spark, sf_dir).order_lines().drop("channel")


@register("adapter_interactions", """
SELECT customer_id, month, sessions, email_sent, email_opens, email_clicks, support_tickets FROM inter
""")
def adapter_interactions(spark, sf_dir):
    """Monthly interaction facts (customer x month-end) from the event stream."""
    return canonical(spark, sf_dir).interactions().drop("nps_score")


@register("rfm_scores", S.rfm_sql() + """
SELECT customer_id, last_order_date, frequency, monetary, gross_margin, recency, recency_score,
       frequency_score, monetary_score, rfm_score, rfm_segment FROM rfm
""")
def rfm_scores(spark, sf_dir):
    """Q6, A1, J1, P16, W1, P19-P22."""
    c = canonical(spark, sf_dir)
    return rfm.calculate_rfm(c.customers(), c.orders(), ANALYSIS_DATE)


@register("rfm_segment_summary", S.rfm_sql() + """
, per AS (
  SELECT rfm_segment, COUNT(*) AS customers, CAST(SUM(monetary) AS DECIMAL(18,2)) AS revenue,
         AVG(recency) AS avg_recency
  FROM rfm GROUP BY rfm_segment
)
SELECT rfm_segment, customers, revenue, ROUND(avg_recency, 6) AS avg_recency,
       ROUND(customers / SUM(customers) OVER (), 6) AS customer_share,
       ROUND(CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER () AS DOUBLE), 6) AS revenue_share
FROM per
""")
def rfm_segment_summary(spark, sf_dir):
    """Flagship: RFM at the analysis date rolled up by segment."""
    from .q_decision import production

    return rfm.segment_rollup(production(spark, sf_dir).rfm)


COHORT_SQL = """
, am AS (SELECT DISTINCT customer_id, date_trunc('month', order_date) AS order_month FROM ford)
, fp AS (SELECT customer_id, MIN(order_month) AS cohort_start FROM am GROUP BY customer_id)
, act AS (
  SELECT f.cohort_start,
         CAST((year(a.order_month) - year(f.cohort_start)) * 12 + month(a.order_month) - month(f.cohort_start) AS INTEGER)
           AS cohort_index,
         COUNT(*) AS active_customers
  FROM am a JOIN fp f ON a.customer_id = f.customer_id GROUP BY 1, 2
)
, sz AS (SELECT cohort_start, COUNT(*) AS cohort_size FROM fp GROUP BY 1)
, cohort AS (
  SELECT strftime(a.cohort_start, '%Y-%m') AS cohort_month, a.cohort_index, a.active_customers, s.cohort_size,
         """ + S.sdiv("a.active_customers", "s.cohort_size") + """ AS retention_rate
  FROM act a LEFT JOIN sz s ON a.cohort_start = s.cohort_start
)
"""


@register("cohort_retention_long", COHORT_SQL + """
SELECT cohort_month, cohort_index, active_customers, cohort_size, ROUND(retention_rate, 6) AS retention_rate
FROM cohort
""")
def cohort_retention_long(spark, sf_dir):
    """Cohort x lag distinct active customers and retention."""
    c = canonical(spark, sf_dir)
    return cohort.cohort_retention_long(c.orders()).withColumn("retention_rate", F.round("retention_rate", 6))


_CELLS = ", ".join(f"ROUND(MAX(CASE WHEN cohort_index = {i} THEN retention_rate END), 6) AS M{i}"
                   for i in range(MAX_COHORT_LAG + 1))


@register("cohort_retention_matrix", COHORT_SQL + f"SELECT cohort_month, {_CELLS} FROM cohort GROUP BY cohort_month")
def cohort_retention_matrix(spark, sf_dir):
    """Long -> wide M0..M79 (the calendar's months), absent cells null."""
    c = canonical(spark, sf_dir)
    return cohort.cohort_matrix(cohort.cohort_retention_long(c.orders()), MAX_COHORT_LAG)


@register("monthly_customer_metrics", """
, cm AS (
  SELECT date_trunc('month', order_date) AS month, customer_id, COUNT(*) AS customer_orders,
         SUM(net_revenue) AS net_revenue, SUM(gross_margin) AS gross_margin, SUM(returned_flag) AS returned_orders
  FROM ford GROUP BY 1, 2
)
, sm AS (
  SELECT month, CAST(SUM(customer_orders) AS BIGINT) AS orders, COUNT(*) AS active_customers,
         CAST(SUM(net_revenue) AS DECIMAL(18,2)) AS net_revenue, CAST(SUM(gross_margin) AS DECIMAL(18,2)) AS gross_margin,
         CAST(SUM(returned_orders) AS BIGINT) AS returned_orders,
         CAST(SUM(CASE WHEN customer_orders >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS repeat_customers
  FROM cm GROUP BY month
)
, nw AS (SELECT date_trunc('month', acquisition_date) AS month, COUNT(*) AS new_customers FROM cust GROUP BY 1)
SELECT CAST(s.month AS DATE) AS month, orders, active_customers, net_revenue, gross_margin, returned_orders,
       repeat_customers, COALESCE(n.new_customers, 0) AS new_customers,
       ROUND(""" + S.sdiv("net_revenue", "orders") + """, 6) AS average_order_value,
       ROUND(""" + S.sdiv("gross_margin", "net_revenue") + """, 6) AS gross_margin_pct,
       ROUND(""" + S.sdiv("repeat_customers", "active_customers") + """, 6) AS repeat_customer_rate,
       ROUND(""" + S.sdiv("returned_orders", "orders") + """, 6) AS return_rate
FROM sm s LEFT JOIN nw n ON s.month = n.month
""")
def monthly_customer_metrics(spark, sf_dir):
    """A12-A15, J8."""
    c = canonical(spark, sf_dir)
    return monthly.monthly_metrics(c.customers(), c.orders())


def _snapshot_out(df):
    from ..functions.exprs import r6

    ratio = ["avg_order_value_12m", "discount_rate_12m", "return_rate_12m", "online_order_share_12m",
             "email_open_rate_12m"]
    cols = S.SNAPSHOT_COLUMNS
    extra = [c for c in ("churn_90d", "future_gross_margin", "future_revenue", "future_orders") if c in df.columns]
    return df.select(*[r6(c).alias(c) if c in ratio else F.col(c) for c in cols], *extra)


@register("customer_snapshot_features", S.snapshot_sql([ANALYSIS_DATE]) + "SELECT " + S.SNAPSHOT_OUT + " FROM snap")
def customer_snapshot_features(spark, sf_dir):
    """Production snapshot at the analysis date."""
    from .q_decision import production

    return _snapshot_out(production(spark, sf_dir).snapshot)  # the session's materialized snapshot


_CHURN_CUTS = CHURN_TRAIN_CUTOFFS + [CHURN_HOLDOUT_CUTOFF]
_CLV_CUTS = CLV_TRAIN_CUTOFFS + [CLV_HOLDOUT_CUTOFF]


@register("churn_training_snapshots",
          S.snapshot_sql(_CHURN_CUTS, churn_h=CHURN_HORIZON_DAYS) + "SELECT " + S.SNAPSHOT_OUT + ", churn_90d FROM snap")
def churn_training_snapshots(spark, sf_dir):
    """3 training cutoffs + holdout in one pass, churn label."""
    from .q_models import labelled_snapshots

    return _snapshot_out(labelled_snapshots(spark, sf_dir, "churn"))


@register("clv_training_snapshots",
          S.snapshot_sql(_CLV_CUTS, clv_h=CLV_HORIZON_DAYS) + "SELECT " + S.SNAPSHOT_OUT
          + ", future_gross_margin, future_revenue, future_orders FROM snap")
def clv_training_snapshots(spark, sf_dir):
    """4 training cutoffs + holdout, future margin/revenue/orders."""
    from .q_models import labelled_snapshots

    return _snapshot_out(labelled_snapshots(spark, sf_dir, "clv"))
