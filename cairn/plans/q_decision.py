"""Scores, campaign decision, customer 360 and segment economics."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (ANALYSIS_DATE, CAMPAIGN_BUDGET, CHURN_HOLDOUT_CUTOFF, CHURN_HORIZON_DAYS,
                         CHURN_TRAIN_CUTOFFS, CLV_HOLDOUT_CUTOFF, CLV_HORIZON_DAYS, CLV_TRAIN_CUTOFFS)
from ..functions.exprs import r6
from ..operators import decision, rfm, scores, snapshot
from ..session import materialize
from ..sources.adapter import canonical
from . import sql_parts as S
from .catalog import register

BINDING_BUDGET = 20_000.0   # a budget that binds at sf0.01, to exercise the prefix cut


LABELS = ("churn_90d", "future_gross_margin", "future_revenue", "future_orders")
ALL_CUTOFFS = sorted({ANALYSIS_DATE, *CHURN_TRAIN_CUTOFFS, CHURN_HOLDOUT_CUTOFF, *CLV_TRAIN_CUTOFFS,
                      CLV_HOLDOUT_CUTOFF})
_SNAPSHOTS: dict[tuple[str, str], DataFrame] = {}


def session_snapshots(spark, sf_dir) -> DataFrame:
    """Every cutoff of the session (production, churn and value training and holdout)
    in ONE pass over the facts, with both label horizons as extra conditional
    aggregates; written once, partitioned by ``snapshot_date`` so each consumer reads
    only its cutoffs."""
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    if key not in _SNAPSHOTS:
        c = canonical(spark, sf_dir)
        snaps = snapshot.build_snapshots(c.customers(), c.orders(), c.interactions(), ALL_CUTOFFS,
                                         churn_horizon=CHURN_HORIZON_DAYS, clv_horizon=CLV_HORIZON_DAYS)
        _SNAPSHOTS[key] = materialize(snaps, partition_by=("snapshot_date",), bucket_by="customer_id", placed=True)
    return _SNAPSHOTS[key]


def snapshots_at(snaps: DataFrame, cutoffs, labels: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``cutoffs`` (a partition filter) with only the ``labels`` asked for."""
    dates = [F.lit(c).cast("date") for c in cutoffs]
    return snaps.filter(F.col("snapshot_date").isin(*dates)).drop(*[x for x in LABELS if x not in labels])


def production_snapshot_of(snaps: DataFrame) -> DataFrame:
    return snapshots_at(snaps, [ANALYSIS_DATE])


class Production:
    """Production snapshot -> RFM -> rule scores -> decision -> 360.

    Each stage is built on first use and materialized once (it feeds several
    branches), so a query only pays for the stages it reads.
    """

    def __init__(self, spark, sf_dir, budget: float = CAMPAIGN_BUDGET):
        self.c = canonical(spark, sf_dir)
        self.budget = budget

    @cached_property
    def customers(self) -> DataFrame:
        return self.c.customers()

    @cached_property
    def orders(self) -> DataFrame:
        return self.c.orders()

    @cached_property
    def snapshot(self) -> DataFrame:
        return production_snapshot_of(session_snapshots(self.c.spark, self.c.sf_dir))

    @cached_property
    def rfm(self) -> DataFrame:
        return materialize(rfm.calculate_rfm(self.customers, self.orders, ANALYSIS_DATE, validate=True), bucket_by="customer_id")

    @cached_property
    def _scores(self) -> tuple[DataFrame, DataFrame]:
        return tuple(materialize(t, bucket_by="customer_id") for t in scores.rule_scores(self.snapshot))

    @property
    def clv(self) -> DataFrame:
        return self._scores[0]

    @property
    def churn(self) -> DataFrame:
        return self._scores[1]

    @cached_property
    def targets(self) -> DataFrame:
        return materialize(decision.recommend_campaigns(self.snapshot, self.rfm, self.clv, self.churn,
                                                        budget=self.budget, validate=False), bucket_by="customer_id")

    @cached_property
    def c360(self) -> DataFrame:
        return decision.build_customer_360(self.snapshot, self.rfm, self.clv, self.churn, self.targets)


_PRODUCTION: dict[tuple[str, str, float], Production] = {}


def production(spark, sf_dir, budget: float = CAMPAIGN_BUDGET) -> Production:
    """Session-wide processed tables (the tables that feed the SQL
    mart): each stage is materialized once and shared by every report."""
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"), float(budget))
    if key not in _PRODUCTION:
        _PRODUCTION[key] = Production(spark, sf_dir, budget)
    return _PRODUCTION[key]


def _round(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


@register("churn_scores", S.snapshot_sql([ANALYSIS_DATE], name="prod") + S.scores_sql() + """
SELECT customer_id, snapshot_date, ROUND(churn_probability, 6) AS churn_probability,
       ROUND(risk_percentile, 6) AS risk_percentile, risk_band FROM churn_s
""")
def churn_scores(spark, sf_dir):
    """W1 risk percentile, P29 right-closed risk band over a churn score table."""
    p = production(spark, sf_dir)
    return _round(p.churn, ["churn_probability", "risk_percentile"])


@register("clv_scores", S.snapshot_sql([ANALYSIS_DATE], name="prod") + S.scores_sql() + """
SELECT customer_id, snapshot_date, ROUND(predicted_clv_12m, 6) AS predicted_clv_12m,
       ROUND(clv_percentile, 6) AS clv_percentile, clv_band FROM clv_s
""")
def clv_scores(spark, sf_dir):
    """W1 value percentile, W2 quartile band by qcut on first-rank, M14 non-negative value."""
    p = production(spark, sf_dir)
    return _round(p.clv, ["predicted_clv_12m", "clv_percentile"])


TARGET_DOUBLES = ["avg_order_value_12m", "predicted_clv_12m", "clv_percentile", "churn_probability",
                  "risk_percentile", "contact_cost", "expected_response_probability", "expected_incremental_margin",
                  "expected_roi", "priority_score", "allocated_budget"]


@register("campaign_targets", S.c360_chain(CAMPAIGN_BUDGET) + """
SELECT customer_id, marketing_consent, frequency_12m, monetary_12m, gross_margin_12m,
  ROUND(avg_order_value_12m, 6) AS avg_order_value_12m, category_diversity_12m, recency_days, sessions_90d,
  rfm_segment, ROUND(predicted_clv_12m, 6) AS predicted_clv_12m, ROUND(clv_percentile, 6) AS clv_percentile,
  clv_band, ROUND(churn_probability, 6) AS churn_probability, ROUND(risk_percentile, 6) AS risk_percentile,
  risk_band, recommended_action, ROUND(contact_cost, 6) AS contact_cost,
  ROUND(expected_response_probability, 6) AS expected_response_probability,
  ROUND(expected_incremental_margin, 6) AS expected_incremental_margin, ROUND(expected_roi, 6) AS expected_roi,
  ROUND(priority_score, 6) AS priority_score, campaign_priority, selected_for_campaign,
  ROUND(allocated_budget, 6) AS allocated_budget
FROM targets
""")
def campaign_targets(spark, sf_dir):
    """Per-customer decision at the default budget."""
    return _round(production(spark, sf_dir).targets, TARGET_DOUBLES)


def _summary_sql(budget: float) -> str:
    return S.c360_chain(budget) + """
SELECT recommended_action, COUNT(*) AS eligible_customers, CAST(SUM(selected_for_campaign) AS BIGINT) AS selected_customers,
  ROUND(SUM(allocated_budget), 6) AS allocated_budget,
  ROUND(SUM(expected_incremental_margin), 6) AS expected_incremental_margin,
  ROUND(COALESCE(AVG(CASE WHEN selected_for_campaign = 1 THEN expected_roi END), 0.0), 6) AS average_expected_roi,
  ROUND(AVG(churn_probability), 6) AS average_churn_probability,
  ROUND(SUM(predicted_clv_12m), 6) AS predicted_clv,
  ROUND(SUM(allocated_budget) + SUM(expected_incremental_margin), 6) AS expected_total_value
FROM targets GROUP BY recommended_action
"""


SUMMARY_DOUBLES = ["allocated_budget", "expected_incremental_margin", "average_expected_roi",
                   "average_churn_probability", "predicted_clv", "expected_total_value"]


@register("campaign_summary", _summary_sql(CAMPAIGN_BUDGET))
def campaign_summary(spark, sf_dir):
    """Per-action economics; ROI averaged over selected rows only."""
    return _round(decision.campaign_summary(production(spark, sf_dir).targets), SUMMARY_DOUBLES)


@register("campaign_summary_binding_budget", _summary_sql(BINDING_BUDGET))
def campaign_summary_binding_budget(spark, sf_dir):
    """W3 with a budget that binds: the selection is a prefix of the priority order."""
    return _round(decision.campaign_summary(production(spark, sf_dir, BINDING_BUDGET).targets), SUMMARY_DOUBLES)


C360_DOUBLES = ["avg_order_value_12m", "discount_rate_12m", "return_rate_12m", "online_order_share_12m",
                "email_open_rate_12m", "predicted_clv_12m", "clv_percentile", "churn_probability", "risk_percentile",
                "expected_incremental_margin", "expected_roi", "allocated_budget"]


@register("customer_360", S.c360_chain(CAMPAIGN_BUDGET) + """
SELECT * REPLACE (""" + ", ".join(f"ROUND({c}, 6) AS {c}" for c in C360_DOUBLES) + """) FROM c360
""")
def customer_360(spark, sf_dir):
    """One row per customer with features, RFM, scores and decision."""
    return _round(production(spark, sf_dir).c360, C360_DOUBLES)


@register("segment_summary", S.c360_chain(CAMPAIGN_BUDGET) + """
, per AS (
  SELECT rfm_segment, COUNT(DISTINCT customer_id) AS customers,
    CAST(SUM(monetary_12m) AS DECIMAL(18,2)) AS revenue_12m, CAST(SUM(gross_margin_12m) AS DECIMAL(18,2)) AS gross_margin_12m,
    SUM(predicted_clv_12m) AS predicted_clv_12m, AVG(churn_probability) AS average_churn_probability,
    AVG(avg_order_value_12m) AS average_order_value, CAST(SUM(selected_for_campaign) AS BIGINT) AS campaign_selected,
    SUM(expected_incremental_margin) AS expected_incremental_margin
  FROM c360 GROUP BY rfm_segment
)
SELECT rfm_segment, customers, revenue_12m, gross_margin_12m, ROUND(predicted_clv_12m, 6) AS predicted_clv_12m,
  ROUND(average_churn_probability, 6) AS average_churn_probability, ROUND(average_order_value, 6) AS average_order_value,
  campaign_selected, ROUND(expected_incremental_margin, 6) AS expected_incremental_margin,
  ROUND(customers / SUM(customers) OVER (), 6) AS customer_share,
  ROUND(CAST(revenue_12m AS DOUBLE) / CAST(SUM(revenue_12m) OVER () AS DOUBLE), 6) AS revenue_share
FROM per
""")
def segment_summary(spark, sf_dir):
    """Segment economics of the 360 table with shares of total."""
    out = decision.summarize_segments(production(spark, sf_dir).c360)
    out = out.withColumns({
        "revenue_12m": F.col("revenue_12m").cast("decimal(18,2)"),
        "gross_margin_12m": F.col("gross_margin_12m").cast("decimal(18,2)"),
    })
    return _round(out, ["predicted_clv_12m", "average_churn_probability", "average_order_value",
                        "expected_incremental_margin", "customer_share", "revenue_share"])


@register("campaign_contact_sample", S.c360_chain(CAMPAIGN_BUDGET) + """
, base AS (
  SELECT t.customer_id, t.recommended_action, t.priority_score AS weight,
    CASE t.recommended_action WHEN 'VIP Experience' THEN 1 WHEN 'Retain & Reward' THEN 2 WHEN 'Win-Back' THEN 3
      WHEN 'Cross-Sell' THEN 4 WHEN 'Onboarding' THEN 5 WHEN 'Nurture' THEN 6 ELSE 0 END AS code
  FROM targets t JOIN cust c ON t.customer_id = c.customer_id
  WHERE t.marketing_consent = 1 AND t.recommended_action <> 'Suppress' AND t.priority_score > 0
    AND c.acquisition_date <= DATE '""" + ANALYSIS_DATE + """'
)
, mixed AS (
  SELECT *, (((customer_id % 2147483648) * 2654435761) % 4294967296
             + (((customer_id >> 31) % 2147483648) * 2246822519) % 4294967296 + 31) % 2147483648 AS x
  FROM base
)
, keyed AS (
  SELECT *, ln((CAST(((x * (1664525 + code * 195062)) % 4294967296 + (x >> 16) * 40503) % 4294967296
                   AS DOUBLE) + 0.5) / 4294967296.0) / weight AS sample_key
  FROM mixed
)
, ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY recommended_action ORDER BY sample_key DESC, customer_id) AS draw_order
  FROM keyed
)
SELECT recommended_action, customer_id, ROUND(weight, 6) AS weight, ROUND(sample_key, 6) AS sample_key, draw_order
FROM ranked WHERE draw_order <= 1500
""")
def campaign_contact_sample(spark, sf_dir):
    """Weighted per-campaign contact sample without replacement (n <= 1500) after the
    consent and acquisition filters."""
    p = production(spark, sf_dir)
    out = decision.weighted_contact_sample(p.targets, p.customers, ANALYSIS_DATE)
    return _round(out, ["weight", "sample_key"])
