"""Next-best action, response and margin economics, budgeted selection, and the
customer 360 table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..constants import (BASE_RESPONSE, CAMPAIGN_BUDGET, CONTACT_COST, FEATURE_COLUMNS, PRIORITY_BAND_EDGES,
                         PRIORITY_BAND_TOP)
from ..functions.exprs import clip, lookup, right_closed_band
from ..functions.ranking import avg_rank_pct, ordered_running
from .contracts import check_budget, check_campaign_inputs


def assign_action() -> Column:
    """Nine ordered rules; Cross-Sell is tested before the churn and dormancy rules."""
    clv, churn = F.col("clv_percentile"), F.col("churn_probability")
    seg = F.col("rfm_segment")
    return (
        F.when(~(F.coalesce(F.col("marketing_consent"), F.lit(0)) != 0), "Suppress")
        .when((clv >= K.HIGH_VALUE_PERCENTILE) & (churn >= K.WIN_BACK_CHURN), "Win-Back")
        .when((clv >= K.HIGH_VALUE_PERCENTILE) & (churn < K.WIN_BACK_CHURN), "VIP Experience")
        .when(seg.isin("Champions", "Loyal Customers"), "Retain & Reward")
        .when(seg.isin("New Customers", "Potential Loyalists", "Promising"), "Onboarding")
        .when((F.col("category_diversity_12m") <= K.CROSS_SELL_MAX_CATEGORIES)
              & (F.col("frequency_12m") >= K.CROSS_SELL_MIN_ORDERS), "Cross-Sell")
        .when(churn >= K.STRONG_CHURN, "Win-Back")
        .when((F.col("frequency_12m") == 0) & (F.col("recency_days") > K.DORMANT_DAYS), "Suppress")
        .otherwise("Nurture")
    )


def recommend_campaigns(
    snapshot: DataFrame,
    rfm: DataFrame,
    clv_scores: DataFrame,
    churn_scores: DataFrame,
    budget: float = CAMPAIGN_BUDGET,
    validate: bool = True,
) -> DataFrame:
    """Per-customer decision table (``campaign_targets``).

    Selection is a prefix of the eligible rows in the total order (priority desc, ROI
    desc, id asc): the running cost includes rows that are later dropped, so once it
    passes the budget every later row is out.  The running sum is the distributed
    ``ordered_running`` helper, not a single-partition window.
    """
    budget = check_campaign_inputs(snapshot, rfm, clv_scores, churn_scores, budget) if validate \
        else check_budget(budget)
    frame = (
        snapshot.select("customer_id", "marketing_consent", "frequency_12m", "monetary_12m", "gross_margin_12m",
                        "avg_order_value_12m", "category_diversity_12m", "recency_days", "sessions_90d")
        .join(rfm.select("customer_id", "rfm_segment"), "customer_id", "left")
        .join(clv_scores.select("customer_id", "predicted_clv_12m", "clv_percentile", "clv_band"), "customer_id", "left")
        .join(churn_scores.select("customer_id", "churn_probability", "risk_percentile", "risk_band"), "customer_id",
              "left")
    )
    frame = frame.withColumn("recommended_action", assign_action())
    frame = frame.withColumn("contact_cost", lookup("recommended_action", CONTACT_COST, 0.0).cast("double"))
    frame = avg_rank_pct(frame, "sessions_90d", "_eng")
    eng = clip(F.coalesce(F.col("_eng"), F.lit(0.0)), 0.0, 1.0)
    clv_pct = F.coalesce(F.col("clv_percentile"), F.lit(0.0))
    churn = F.coalesce(F.col("churn_probability"), F.lit(0.0))
    response = lookup("recommended_action", BASE_RESPONSE, 0.0).cast("double")
    response = response + F.lit(K.RESPONSE_ENGAGEMENT) * eng
    response = response + F.lit(K.RESPONSE_VALUE) * clv_pct
    response = response - F.lit(K.RESPONSE_CHURN) * churn
    response = F.when(F.col("recommended_action") == "Win-Back", response + F.lit(K.RESPONSE_WIN_BACK) * churn).otherwise(response)
    frame = frame.withColumn("engagement_norm", eng).withColumn(
        "expected_response_probability", clip(response, *K.RESPONSE_RANGE)
    )
    rate = F.try_divide(F.col("gross_margin_12m").cast("double"),
                        F.when(F.col("monetary_12m") != 0, F.col("monetary_12m").cast("double")))
    margin_rate = clip(F.coalesce(rate, F.lit(K.MARGIN_RATE_DEFAULT)), *K.MARGIN_RATE_RANGE)
    order_value = clip(F.col("avg_order_value_12m").cast("double"), *K.ORDER_VALUE_RANGE)
    gross = F.col("expected_response_probability") * order_value * margin_rate * (
        F.lit(K.MARGIN_LIFT) + F.lit(K.MARGIN_LIFT_VALUE) * clv_pct)
    frame = frame.withColumn("expected_incremental_margin", gross - F.col("contact_cost"))
    frame = frame.withColumn(
        "expected_roi",
        F.when(F.col("contact_cost") > 0, F.col("expected_incremental_margin") / F.col("contact_cost")).otherwise(0.0),
    )
    frame = avg_rank_pct(frame, "expected_roi", "_roi_pct")
    priority = (
        F.lit(K.PRIORITY_VALUE) * clv_pct
        + F.lit(K.PRIORITY_RISK) * F.coalesce(F.col("risk_percentile"), F.lit(0.0))
        + F.lit(K.PRIORITY_ROI) * F.coalesce(F.col("_roi_pct"), F.lit(0.0))
        + F.lit(K.PRIORITY_ENGAGEMENT) * F.col("engagement_norm")
    )
    frame = frame.withColumn("priority_score", priority)
    frame = frame.withColumn("campaign_priority",
                             right_closed_band("priority_score", PRIORITY_BAND_EDGES, PRIORITY_BAND_TOP))
    eligible = (F.col("contact_cost") > 0) & (F.col("expected_incremental_margin") > 0) & (
        F.col("marketing_consent") == 1)
    frame = frame.withColumn("_eligible", eligible).withColumn(
        "_elig_cost", F.when(eligible, F.col("contact_cost")).otherwise(F.lit(0.0))
    )
    # running cost over eligible rows only == running sum of eligible cost over all rows
    frame = ordered_running(frame, [("priority_score", False), ("expected_roi", False)], "customer_id",
                            sums=["_elig_cost"])
    selected = F.col("_eligible") & (F.col("_run__elig_cost") <= F.lit(budget))
    frame = frame.withColumn("selected_for_campaign", F.when(selected, 1).otherwise(0))
    sel = F.col("selected_for_campaign") == 1
    return frame.select(
        "customer_id", "marketing_consent", "frequency_12m", "monetary_12m", "gross_margin_12m",
        "avg_order_value_12m", "category_diversity_12m", "recency_days", "sessions_90d", "rfm_segment",
        "predicted_clv_12m", "clv_percentile", "clv_band", "churn_probability", "risk_percentile", "risk_band",
        "recommended_action", "contact_cost", "expected_response_probability",
        F.when(sel, F.col("expected_incremental_margin")).otherwise(0.0).alias("expected_incremental_margin"),
        F.when(sel, F.col("expected_roi")).otherwise(0.0).alias("expected_roi"),
        "priority_score", "campaign_priority", "selected_for_campaign",
        F.when(sel, F.col("contact_cost")).otherwise(0.0).alias("allocated_budget"),
    )


def campaign_summary(targets: DataFrame) -> DataFrame:
    """Per action: all rows, selected rows, budget, margin, ROI over selected only."""
    sel = F.col("selected_for_campaign") == 1
    return targets.groupBy("recommended_action").agg(
        F.count(F.lit(1)).alias("eligible_customers"),
        F.sum("selected_for_campaign").cast("long").alias("selected_customers"),
        F.sum("allocated_budget").alias("allocated_budget"),
        F.sum("expected_incremental_margin").alias("expected_incremental_margin"),
        F.coalesce(F.avg(F.when(sel, F.col("expected_roi"))), F.lit(0.0)).alias("average_expected_roi"),
        F.avg("churn_probability").alias("average_churn_probability"),
        F.sum("predicted_clv_12m").alias("predicted_clv"),
    ).withColumn("expected_total_value", F.col("allocated_budget") + F.col("expected_incremental_margin"))


def build_customer_360(snapshot: DataFrame, rfm: DataFrame, clv_scores: DataFrame, churn_scores: DataFrame,
                       targets: DataFrame) -> DataFrame:
    """One row per customer: features, RFM, value and risk scores, decision (4 left joins
    on customer_id; every input is 1:1 by contract)."""
    base = snapshot.select("customer_id", "snapshot_date", "region", "age_band", "loyalty_tier", "preferred_channel",
                           "marketing_consent", "lifetime_orders", "lifetime_revenue", "lifetime_margin",
                           *FEATURE_COLUMNS)
    return (
        base.join(rfm.select("customer_id", "rfm_segment", "rfm_score", "recency_score", "frequency_score",
                             "monetary_score"), "customer_id", "left")
        .join(clv_scores.select("customer_id", "predicted_clv_12m", "clv_band", "clv_percentile"), "customer_id", "left")
        .join(churn_scores.select("customer_id", "churn_probability", "risk_band", "risk_percentile"), "customer_id",
              "left")
        .join(targets.select("customer_id", "recommended_action", "campaign_priority", "expected_incremental_margin",
                             "expected_roi", "selected_for_campaign", "allocated_budget"), "customer_id", "left")
    )


def summarize_segments(c360: DataFrame) -> DataFrame:
    """Eight measures per RFM segment plus customer and revenue shares."""
    from pyspark.sql import Window

    per = c360.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),  # one row per customer
        F.sum("monetary_12m").alias("revenue_12m"),
        F.sum("gross_margin_12m").alias("gross_margin_12m"),
        F.sum("predicted_clv_12m").alias("predicted_clv_12m"),
        F.avg("churn_probability").alias("average_churn_probability"),
        F.avg("avg_order_value_12m").alias("average_order_value"),
        F.sum("selected_for_campaign").cast("long").alias("campaign_selected"),
        F.sum("expected_incremental_margin").alias("expected_incremental_margin"),
    )
    everything = Window.partitionBy()  # one row per segment: at most ten rows
    return per.withColumns({
        "customer_share": F.col("customers") / F.sum("customers").over(everything),
        "revenue_share": F.col("revenue_12m").cast("double") / F.sum("revenue_12m").over(everything).cast("double"),
    })


# --- fixed values: campaign code of each action, used to vary the sampling stream -----
ACTION_CODE = {"VIP Experience": 1, "Retain & Reward": 2, "Win-Back": 3, "Cross-Sell": 4, "Onboarding": 5,
               "Nurture": 6}
# --- fixed values: multipliers of the sampling stream, all below 2^32 -------------------
_MULT_LOW, _MULT_HIGH, _MULT_FOLD = 2654435761, 2246822519, 40503
_STREAM_BASE, _STREAM_STEP = 1664525, 195062
_HALF, _FULL = 2147483648, 4294967296    # 2^31, 2^32


def uniform_from_key(key: Column, stream: Column, seed: int) -> Column:
    """Repeatable uniform in (0, 1) from integer keys of any size.  Pure integer arithmetic
    with every product below 2^63, so any engine reproduces it; each stream has a
    multiplier of its own, so streams are not shifted copies of one another."""
    low, high = F.pmod(key, F.lit(_HALF)), F.pmod(F.shiftright(key, 31), F.lit(_HALF))
    x = F.pmod(F.pmod(low * F.lit(_MULT_LOW), F.lit(_FULL)) + F.pmod(high * F.lit(_MULT_HIGH), F.lit(_FULL)) + F.lit(seed),
               F.lit(_HALF))
    own = (F.lit(_STREAM_BASE) + stream * F.lit(_STREAM_STEP)).cast("long")
    mixed = F.pmod(F.pmod(x * own, F.lit(_FULL)) + F.shiftright(x, 16) * F.lit(_MULT_FOLD), F.lit(_FULL))
    return (mixed.cast("double") + F.lit(0.5)) / F.lit(float(_FULL))


def weighted_contact_sample(targets: DataFrame, acquisition: DataFrame, analysis_date: str, cap: int = 1500,
                            seed: int = 31, weight: str = "priority_score") -> DataFrame:
    """Per campaign (action), a weighted sample without replacement of consented
    customers acquired by ``analysis_date``: key = ln(u) / w (the order of u^(1/w)),
    the ``min(cap, group size)`` largest keys are drawn (ties by id).  The per-group top-n
    runs on the distributed ordered helper, so a campaign holding most customers is not
    sorted in one task; the cap is the feature of the operator.
    """
    from ..functions.ranking import ordered_running

    code = lookup("recommended_action", ACTION_CODE, 0)
    base = (targets.filter((F.col("marketing_consent") == 1) & (F.col("recommended_action") != "Suppress")
                           & (F.col(weight) > 0))
            .join(acquisition.select("customer_id", "acquisition_date"), "customer_id")
            .filter(F.col("acquisition_date") <= F.lit(analysis_date).cast("date")))
    u = uniform_from_key(F.col("customer_id"), code, seed)
    keyed = base.select("customer_id", "recommended_action", F.col(weight).alias("weight"),
                        (F.log(u) / F.col(weight)).alias("sample_key"))
    ranked = ordered_running(keyed, [("sample_key", False)], "customer_id", partition_by=["recommended_action"])
    return ranked.filter(F.col("_rn") <= F.lit(cap)).select(
        "recommended_action", "customer_id", "weight", "sample_key", F.col("_rn").alias("draw_order"))
