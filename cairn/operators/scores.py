"""Score tables (churn risk and 12-month value) and their bands.

``rule_churn_scores`` / ``rule_value_scores`` are closed-form scorers over the snapshot
features.  They stand in for the trained models wherever an exact SQL oracle is
needed; the trained models (``operators.models``) produce tables of the same shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CLV_QUARTILE_LABELS, RISK_BAND_EDGES, RISK_BAND_TOP
from ..functions.exprs import clip, right_closed_band
from ..functions.ranking import avg_rank_pct, avg_rank_pcts, ordered_running, qcut_rank_bin
from ..session import materialize


def rule_churn_probability() -> Column:
    r = F.col("recency_days").cast("double")
    return clip(r / (r + F.lit(120.0)), 0.02, 0.98)


def rule_value_prediction() -> Column:
    return F.greatest(
        F.lit(0.0),
        F.lit(0.9) * F.col("gross_margin_12m").cast("double") + F.lit(12.0) * F.col("sessions_90d").cast("double"),
    )


def churn_score_table(scored: DataFrame, prob_col: str = "churn_probability") -> DataFrame:
    """(customer_id, snapshot_date, churn_probability, risk_percentile, risk_band)."""
    base = scored.select("customer_id", "snapshot_date", F.col(prob_col).alias("churn_probability"))
    out = avg_rank_pct(base, "churn_probability", "risk_percentile")
    return out.select(
        "customer_id",
        "snapshot_date",
        "churn_probability",
        "risk_percentile",
        right_closed_band("churn_probability", RISK_BAND_EDGES, RISK_BAND_TOP).alias("risk_band"),
    )


def value_score_table(scored: DataFrame, pred_col: str = "predicted_clv_12m") -> DataFrame:
    """(customer_id, snapshot_date, predicted_clv_12m, clv_percentile, clv_band).

    The band is ``qcut`` on the first-rank (ties broken by customer_id) into quartiles.
    """
    base = scored.select("customer_id", "snapshot_date", F.greatest(F.col(pred_col), F.lit(0.0)).alias("predicted_clv_12m"))
    ranked = ordered_running(base, [("predicted_clv_12m", True)], "customer_id")
    ranked = ranked.withColumn("_bin", qcut_rank_bin(F.col("_rn"), F.col("_n"), 4))
    label = F.element_at(F.array(*[F.lit(x) for x in CLV_QUARTILE_LABELS]), F.col("_bin") + 1)
    ranked = ranked.select("customer_id", "snapshot_date", "predicted_clv_12m", label.alias("clv_band"))
    out = avg_rank_pct(ranked, "predicted_clv_12m", "clv_percentile")
    return out.select("customer_id", "snapshot_date", "predicted_clv_12m", "clv_percentile", "clv_band")


def rule_scores(snapshot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(value_scores, churn_scores) from the closed-form scorers; both percentiles come
    from one materialized input and one edge job."""
    s = snapshot.select(
        "customer_id",
        "snapshot_date",
        rule_churn_probability().alias("churn_probability"),
        F.greatest(rule_value_prediction(), F.lit(0.0)).alias("predicted_clv_12m"),
    )
    ranked = avg_rank_pcts(s, {"churn_probability": "risk_percentile", "predicted_clv_12m": "clv_percentile"})
    ranked = ordered_running(ranked, [("predicted_clv_12m", True)], "customer_id")
    label = F.element_at(F.array(*[F.lit(x) for x in CLV_QUARTILE_LABELS]),
                         qcut_rank_bin(F.col("_rn"), F.col("_n"), 4) + 1)
    # both score tables are projections of one written table
    ranked = materialize(ranked.withColumn("clv_band", label).select(
        "customer_id", "snapshot_date", "predicted_clv_12m", "clv_percentile", "clv_band",
        "churn_probability", "risk_percentile"))
    value = ranked.select("customer_id", "snapshot_date", "predicted_clv_12m", "clv_percentile", "clv_band")
    churn = ranked.select("customer_id", "snapshot_date", "churn_probability", "risk_percentile",
                          right_closed_band("churn_probability", RISK_BAND_EDGES, RISK_BAND_TOP).alias("risk_band"))
    return value, churn
