"""Table-in / table-out scoring contract (the request-at-a-time service, re-aimed).

Each feature row is range-checked; valid rows are scored and banded with the
service's left-closed bands, invalid rows go to a reject output with the reasons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (FEATURE_COLUMNS, RISK_BAND_TOP, SERVICE_CLV_EDGES, SERVICE_CLV_TOP, SERVICE_RISK_EDGES)
from ..functions.exprs import is_finite, left_closed_band

# --- fixed values: per-feature ranges of the scoring contract (lower, upper) ------
FEATURE_RANGES: dict[str, tuple[float | None, float | None]] = {
    "recency_days": (0, None),
    "frequency_12m": (0, None),
    "monetary_12m": (0, None),
    "gross_margin_12m": (None, None),
    "avg_order_value_12m": (0, None),
    "discount_rate_12m": (0, 1),
    "return_rate_12m": (0, 1),
    "category_diversity_12m": (0, None),
    "online_order_share_12m": (0, 1),
    "sessions_90d": (0, None),
    "email_open_rate_12m": (0, 1),
    "support_tickets_12m": (0, None),
    "days_since_last_session": (0, None),
    "tenure_days": (0, None),
    "loyalty_tier_score": (1, 4),
    "consent_flag": (0, 1),
}


def violations(df: DataFrame) -> Column:
    """Array of the feature names that break the contract (missing, non-finite, out of range)."""
    checks = []
    for name in FEATURE_COLUMNS:
        lo, hi = FEATURE_RANGES[name]
        v = F.col(name).cast("double")
        bad = ~is_finite(v)
        if lo is not None:
            bad = bad | (v < F.lit(float(lo)))
        if hi is not None:
            bad = bad | (v > F.lit(float(hi)))
        checks.append(F.when(bad, F.lit(name)))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with ``violations``) - one pass, two filters."""
    tagged = df.withColumn("violations", violations(df))
    ok = F.size("violations") == 0
    return tagged.filter(ok).drop("violations"), tagged.filter(~ok)


def band_scores(scored: DataFrame, threshold: float, snapshot_date: str) -> DataFrame:
    """Service output: probability (6 dp), risk band, value (2 dp, >= 0), value band,
    decision threshold (4 dp) and model snapshot."""
    p = F.col("churn_probability")
    v = F.greatest(F.col("predicted_clv_12m"), F.lit(0.0))
    return scored.select(
        *[c for c in scored.columns if c not in ("churn_probability", "predicted_clv_12m")],
        F.round(p, 6).alias("churn_probability"),
        left_closed_band(p, SERVICE_RISK_EDGES, RISK_BAND_TOP).alias("churn_risk_band"),
        # round through an exact decimal: half-up on the decimal digits, not the binary value
        F.round(v.cast("decimal(18,6)"), 2).cast("double").alias("predicted_clv_12m"),
        left_closed_band(v, SERVICE_CLV_EDGES, SERVICE_CLV_TOP).alias("clv_band"),
        F.lit(round(float(threshold), 4)).alias("decision_threshold"),
        F.lit(snapshot_date).alias("model_snapshot"),
    )
