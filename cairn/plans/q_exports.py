"""Business exports: the processed tables under their business column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import lookup, r6
from . import q_core, q_models, q_reports  # noqa: F401  (their SQL is read below)
from .catalog import ORACLE, QUERIES, register
from .q_decision import production

# --- fixed values: words and columns whose business name is not the word with a capital ---
WORDS = {"12m": "12M", "clv": "CLV", "rfm": "RFM", "id": "ID", "roi": "ROI", "psi": "PSI", "shap": "SHAP", "avg": "Average", "for": "for"}
COLUMNS = {"monetary_12m": "Revenue 12M", "gross_margin_pct": "Gross Margin Rate"}
RISK_ORDER = {"Low": 1, "Medium": 2, "High": 3, "Critical": 4}
#: columns of the customer export, in order
CUSTOMER = ["customer_id", "snapshot_date", "region", "age_band", "loyalty_tier", "preferred_channel", "recency_days", "frequency_12m", "monetary_12m",
            "gross_margin_12m", "avg_order_value_12m", "rfm_segment", "predicted_clv_12m", "clv_band", "churn_probability", "risk_band",
            "recommended_action", "campaign_priority", "expected_incremental_margin", "selected_for_campaign"]


def business_name(column: str) -> str:
    return COLUMNS.get(column) or " ".join(WORDS.get(w, w.capitalize()) for w in column.split("_"))


def renamed(df: DataFrame) -> DataFrame:
    """``df`` under business names."""
    return df.withColumnsRenamed({c: business_name(c) for c in df.columns})


def _as(columns, **more) -> str:
    return ", ".join([*(f'{c} AS "{business_name(c)}"' for c in columns), *(f'{v} AS "{k.replace("_", " ")}"' for k, v in more.items())])


MONTHLY = ["orders", "active_customers", "net_revenue", "gross_margin", "returned_orders", "repeat_customers", "new_customers", "average_order_value",
           "gross_margin_pct", "repeat_customer_rate", "return_rate"]


@register("bi_monthly_export", f" SELECT {_as(['month', *MONTHLY], Month_Key=chr(39).join(['strftime(month, ', '%Y-%m', ')']))} FROM ({ORACLE['monthly_customer_metrics']})")
def bi_monthly_export(spark, sf_dir):
    """The monthly metrics with the month's key."""
    m = QUERIES["monthly_customer_metrics"](spark, sf_dir).select("month", *MONTHLY)
    return renamed(m).withColumn("Month Key", F.date_format("Month", "yyyy-MM"))


def _plain_export(name: str, source: str, columns: list[str], ids: str):
    @register(name, f" SELECT {_as(columns)} FROM ({ORACLE[source]})")
    def export(spark, sf_dir):
        return renamed(QUERIES[source](spark, sf_dir).select(*columns))

    export.__doc__ = f"{ids}: `{source}` under its business names."


_plain_export("bi_segment_export", "segment_summary", [
    "rfm_segment", "customers", "revenue_12m", "gross_margin_12m", "predicted_clv_12m", "average_churn_probability", "average_order_value",
    "campaign_selected", "expected_incremental_margin", "customer_share", "revenue_share"], "P40")
_plain_export("bi_campaign_export", "campaign_summary", [
    "recommended_action", "eligible_customers", "selected_customers", "allocated_budget", "expected_incremental_margin", "average_expected_roi",
    "average_churn_probability", "predicted_clv", "expected_total_value"], "P40")
_plain_export("bi_drift_export", "drift_monitoring", ["feature", "psi", "status", "reference_mean", "production_mean"], "P40")
_plain_export("bi_customer_model", "customer_360", CUSTOMER, "P40")


@register("bi_cohort_export", f" SELECT {_as(['cohort_index', 'active_customers', 'cohort_size', 'retention_rate'])}, "
          f"CAST(cohort_month || '-01' AS DATE) AS \"Cohort Month\" FROM ({ORACLE['cohort_retention_long']})")
def bi_cohort_export(spark, sf_dir):
    """Cohort retention with the cohort's month as a date."""
    c = QUERIES["cohort_retention_long"](spark, sf_dir)
    return renamed(c.select(F.to_date(F.concat("cohort_month", F.lit("-01"))).alias("cohort_month"), "cohort_index", "active_customers", "cohort_size", "retention_rate"))


@register("bi_risk_export", f"""
 SELECT risk_band AS "Risk Band", COUNT(DISTINCT customer_id) AS "Customers", SUM(monetary_12m) AS "Revenue", ROUND(SUM(predicted_clv_12m), 6) AS "Predicted CLV",
   CASE risk_band {" ".join(f"WHEN '{k}' THEN {v}" for k, v in RISK_ORDER.items())} END AS "Risk Order"
 FROM ({ORACLE['customer_360']}) GROUP BY risk_band
""")
def bi_risk_export(spark, sf_dir):
    """Customers, revenue and value by risk band, with the band's place."""
    g = production(spark, sf_dir).c360.groupBy("risk_band").agg(
        F.count_distinct("customer_id").alias("customers"), F.sum("monetary_12m").alias("revenue"), r6(F.sum(r6("predicted_clv_12m"))).alias("predicted_clv"))
    return renamed(g.withColumn("risk_order", lookup("risk_band", RISK_ORDER, None)))
