"""Fixed values the results depend on.

These are business constants of the customer-value model (costs, response rates,
bands, horizons).  They are stated here once, in natural order, and every operator
reads them from this module.
"""

from __future__ import annotations

# --- fixed values: model feature contract, in order -------------------------------
FEATURE_COLUMNS = [
    "recency_days",
    "frequency_12m",
    "monetary_12m",
    "gross_margin_12m",
    "avg_order_value_12m",
    "discount_rate_12m",
    "return_rate_12m",
    "category_diversity_12m",
    "online_order_share_12m",
    "sessions_90d",
    "email_open_rate_12m",
    "support_tickets_12m",
    "days_since_last_session",
    "tenure_days",
    "loyalty_tier_score",
    "consent_flag",
]

# --- fixed values: campaign economics per action ---------------------------------
CONTACT_COST = {
    "VIP Experience": 95.0,
    "Retain & Reward": 72.0,
    "Win-Back": 61.0,
    "Cross-Sell": 49.0,
    "Onboarding": 34.0,
    "Nurture": 28.0,
    "Suppress": 0.0,
}
BASE_RESPONSE = {
    "VIP Experience": 0.26,
    "Retain & Reward": 0.23,
    "Win-Back": 0.14,
    "Cross-Sell": 0.18,
    "Onboarding": 0.21,
    "Nurture": 0.11,
    "Suppress": 0.0,
}
CAMPAIGN_BUDGET = 400_000.0
# action rules
HIGH_VALUE_PERCENTILE, WIN_BACK_CHURN, STRONG_CHURN = 0.80, 0.55, 0.68
CROSS_SELL_MAX_CATEGORIES, CROSS_SELL_MIN_ORDERS, DORMANT_DAYS = 2, 2, 365
# response = base + engagement + value - churn (+ churn again for Win-Back), held to a range
RESPONSE_ENGAGEMENT, RESPONSE_VALUE, RESPONSE_CHURN, RESPONSE_WIN_BACK = 0.08, 0.06, 0.05, 0.08
RESPONSE_RANGE = (0.0, 0.55)
# margin = response * order value * margin rate * (lift + lift per value percentile) - cost
MARGIN_RATE_DEFAULT, MARGIN_RATE_RANGE, ORDER_VALUE_RANGE = 0.38, (0.18, 0.62), (450.0, 6500.0)
MARGIN_LIFT, MARGIN_LIFT_VALUE = 1.18, 0.22
# priority = weighted value, risk and ROI percentiles and engagement
PRIORITY_VALUE, PRIORITY_RISK, PRIORITY_ROI, PRIORITY_ENGAGEMENT = 0.36, 0.24, 0.25, 0.15

# --- fixed values: tiers, channels, horizons --------------------------------------
TIER_SCORE = {"Bronze": 1, "Silver": 2, "Gold": 3, "Platinum": 4}
ONLINE_CHANNELS = ["Mobile App", "Web"]
CHURN_HORIZON_DAYS = 90
CLV_HORIZON_DAYS = 365

# --- fixed values: bands -----------------------------------------------------------
# batch risk band: right-closed upper edges
RISK_BAND_EDGES = [(0.35, "Low"), (0.55, "Medium"), (0.72, "High")]
RISK_BAND_TOP = "Critical"
# campaign priority band: right-closed upper edges
PRIORITY_BAND_EDGES = [(0.40, "Low"), (0.60, "Medium"), (0.78, "High")]
PRIORITY_BAND_TOP = "Critical"
# scoring contract bands: left-closed upper edges
SERVICE_RISK_EDGES = [(0.35, "Low"), (0.55, "Medium"), (0.72, "High")]
SERVICE_CLV_EDGES = [(500.0, "Low"), (1500.0, "Developing"), (3500.0, "High")]
SERVICE_CLV_TOP = "Strategic"
CLV_QUARTILE_LABELS = ["Low", "Developing", "High", "Strategic"]
# drift status
PSI_STABLE_BELOW = 0.10
PSI_WATCH_BELOW = 0.25
FAIRNESS_MIN_GROUP = 25

# --- fixed values: RFM segment names -----------------------------------------------
RFM_SEGMENTS = [
    "Champions",
    "Loyal Customers",
    "Potential Loyalists",
    "New Customers",
    "Promising",
    "Need Attention",
    "Can't Lose Them",
    "At Risk",
    "Hibernating",
    "Lost",
]

# --- fixed values: model selection weights -----------------------------------------
CLASSIFIER_SELECTION_WEIGHTS = (0.45, 0.35, 0.20)  # roc_auc, pr_auc, 1 - brier
REGRESSOR_SELECTION_WEIGHTS = (0.45, 0.35, 0.20)   # 1 - nMAE, spearman, r2
THRESHOLD_GRID = (0.15, 0.85, 71)

# --- rebuild's own calendar on the driver tables (adapter) ----
ANALYSIS_DATE = "2001-07-31"
DATA_START = "1995-01-01"
DATA_END = "2001-08-01"
MAX_COHORT_LAG = 79   # months from the first to the last month of the data
CHURN_TRAIN_CUTOFFS = ["2000-03-31", "2000-06-30", "2000-09-30"]
CHURN_HOLDOUT_CUTOFF = "2000-12-31"
CLV_TRAIN_CUTOFFS = ["1998-03-31", "1998-09-30", "1999-03-31", "1999-06-30"]
CLV_HOLDOUT_CUTOFF = "2000-07-31"
