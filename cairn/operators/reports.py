"""Report-shaped aggregates over the 360, decision, cohort and order tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import CLV_QUARTILE_LABELS
from ..functions.exprs import r6, safe_divide
from ..functions.ranking import exact_quantiles


def _long(df: DataFrame, rows: Sequence[tuple[int, str, str, str]]) -> DataFrame:
    """One-row aggregate -> (kpi, value, format) rows via explode."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(o).alias("o"), F.lit(k).alias("kpi"), F.col(c).cast("double").alias("value"),
                 F.lit(fmt).alias("format"))
        for o, k, c, fmt in rows
    ])).alias("r")).select("r.*")


def executive_kpis(c360: DataFrame, cohort_long: DataFrame, m3_from: str, churn_metrics: DataFrame,
                   value_metrics: DataFrame) -> DataFrame:
    """KPI scalars of one global aggregate (conditional count / sum), the M3
    retention mean over recent cohorts and the models' holdout metrics, in long form.
    ``customer_id`` is unique in the 360 table, so customers are rows."""
    high = F.col("risk_band").isin("High", "Critical")
    k = c360.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("frequency_12m") > 0).alias("active"),
        F.sum("monetary_12m").cast("double").alias("revenue"),
        F.sum("gross_margin_12m").cast("double").alias("margin"),
        F.sum("predicted_clv_12m").alias("clv"),
        F.count_if(high).alias("high_risk"),
        F.coalesce(F.sum(F.when(high, F.col("monetary_12m"))), F.lit(0)).cast("double").alias("at_risk"),
        F.avg("churn_probability").alias("avg_churn"),
        F.sum("allocated_budget").alias("budget"),
        F.sum("expected_incremental_margin").alias("eim"),
    )
    m3 = cohort_long.filter((F.col("cohort_index") == 3) & (F.col("cohort_month") >= m3_from)).agg(
        F.avg("retention_rate").alias("m3"))
    rows = _long(k, [
        (1, "Customers", "customers", "count"),
        (2, "Active Customers 12M", "active", "count"),
        (3, "Net Revenue 12M", "revenue", "currency"),
        (4, "Gross Margin 12M", "margin", "currency"),
        (5, "Predicted CLV 12M", "clv", "currency"),
        (6, "High/Critical Risk Customers", "high_risk", "count"),
        (7, "Revenue at Risk", "at_risk", "currency"),
        (8, "Average Churn Probability", "avg_churn", "percent"),
        (15, "Campaign Budget Allocated", "budget", "currency"),
        (16, "Expected Incremental Margin", "eim", "currency"),
    ]).unionByName(_long(m3, [(9, "M3 Cohort Retention", "m3", "percent")])).unionByName(_long(churn_metrics, [
        (10, "Churn ROC-AUC", "roc_auc", "decimal"),
        (11, "Churn PR-AUC", "pr_auc", "decimal"),
        (12, "Lift at Top 10%", "lift_at_10pct", "multiple"),
    ])).unionByName(_long(value_metrics, [
        (13, "CLV Test MAE", "mae", "currency"),
        (14, "CLV Test R2", "r2", "decimal"),
    ]))
    return rows.select("kpi", r6("value").alias("value"), "format")


def _band_rollup(c360: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Customers, value and revenue per label of a fixed list; absent labels are 0."""
    spine = c360.sparkSession.createDataFrame(list(enumerate(labels, 1)), f"band_order int, {column} string")
    g = c360.groupBy(column).agg(F.count(F.lit(1)).alias("customers"), F.sum("predicted_clv_12m").alias("clv"),
                                 F.sum("monetary_12m").alias("rev"))
    return spine.join(g, column, "left").select(
        column, "band_order",
        F.coalesce(F.col("customers"), F.lit(0)).alias("customers"),
        r6(F.coalesce(F.col("clv"), F.lit(0.0))).alias("predicted_clv_12m"),
        F.coalesce(F.col("rev"), F.lit(0)).cast("decimal(18,2)").alias("revenue_12m"),
    )


def risk_band_rollup(c360: DataFrame) -> DataFrame:
    return _band_rollup(c360, "risk_band", ["Low", "Medium", "High", "Critical"])


def clv_band_rollup(c360: DataFrame) -> DataFrame:
    return _band_rollup(c360, "clv_band", CLV_QUARTILE_LABELS)


def clv_band_quartiles(c360: DataFrame) -> DataFrame:
    """Exact quartiles (linear interpolation) of predicted value per value band.

    The distributed quantile helper locates the covering values by prefix counts, so a
    band holding most customers is never gathered into one task.
    """
    q = exact_quantiles(c360, "predicted_clv_12m", [0.25, 0.5, 0.75], partition_by=["clv_band"])
    n = c360.groupBy("clv_band").agg(F.count(F.lit(1)).alias("customers"))
    return n.join(q, "clv_band").select(
        "clv_band", "customers",
        r6(F.col("_q")[0]).alias("q1_predicted_clv_12m"),
        r6(F.col("_q")[1]).alias("median_predicted_clv_12m"),
        r6(F.col("_q")[2]).alias("q3_predicted_clv_12m"),
    )


def value_risk_reference_lines(c360: DataFrame, churn_line: float, value_quantile: float) -> DataFrame:
    """The value-risk portfolio's reference lines: the exact ``value_quantile`` of
    predicted value over all customers and the fixed churn line, with the customers
    on the high side of each line and of both."""
    # the threshold as a scalar subquery (one row), no join
    v = exact_quantiles(c360, "predicted_clv_12m", [value_quantile]).select(F.col("_q")[0]).scalar()
    high_value = F.col("predicted_clv_12m") > v
    high_risk = F.col("churn_probability") >= F.lit(churn_line)
    return c360.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(high_value).alias("high_value_customers"),
        F.count_if(high_risk).alias("high_risk_customers"),
        F.count_if(high_value & high_risk).alias("high_value_high_risk_customers"),
    ).select(
        r6(v).alias("value_threshold"),
        F.lit(churn_line).alias("churn_threshold"),
        "customers", "high_value_customers", "high_risk_customers", "high_value_high_risk_customers",
    )


def regional_mean_risk(c360: DataFrame) -> DataFrame:
    return c360.groupBy("region").agg(F.count(F.lit(1)).alias("customers"),
                                      r6(F.avg("churn_probability")).alias("average_churn_probability"))


def rf_heatmap(c360: DataFrame) -> DataFrame:
    wide = c360.groupBy("recency_score").pivot("frequency_score", [1, 2, 3, 4, 5]).agg(
        F.avg(F.col("monetary_12m").cast("double")))
    return wide.select("recency_score", *[r6(F.coalesce(F.col(str(f)), F.lit(0.0))).alias(f"F{f}")
                                          for f in range(1, 6)])


def retention_checkpoints(cohort_long: DataFrame, lags: Sequence[int] = (1, 3, 6, 12)) -> DataFrame:
    return cohort_long.filter(F.col("cohort_index").isin(*lags)).groupBy("cohort_index").agg(
        F.count(F.lit(1)).alias("cohorts"), r6(F.avg("retention_rate")).alias("average_retention"))


def selected_portfolio_pivot(targets: DataFrame, actions: Sequence[str]) -> DataFrame:
    sel = targets.filter(F.col("selected_for_campaign") == 1)
    wide = sel.groupBy("campaign_priority").pivot("recommended_action", list(actions)).count()
    total = sel.groupBy("campaign_priority").agg(F.count(F.lit(1)).alias("selected_customers"))
    return wide.fillna(0, subset=list(actions)).join(total, "campaign_priority").select(
        "campaign_priority", *[F.col(f"`{a}`").cast("long").alias(a) for a in actions], "selected_customers")


def top_targets(targets: DataFrame, k: int) -> DataFrame:
    """T5: top-k selected rows by expected margin (the limit is the feature)."""
    return (targets.filter(F.col("selected_for_campaign") == 1)
            .orderBy(F.col("expected_incremental_margin").desc(), F.col("customer_id"))
            .limit(k)
            .select("customer_id", "rfm_segment", "recommended_action", "campaign_priority",
                    r6("expected_incremental_margin").alias("expected_incremental_margin"),
                    r6("expected_roi").alias("expected_roi")))


def top_k(df: DataFrame, column: str, k: int, columns: Sequence[str]) -> DataFrame:
    """``nlargest`` with the id as tie-breaker (TakeOrderedAndProject)."""
    out = df.orderBy(F.col(column).desc(), F.col("customer_id")).limit(k).select(*columns)
    return out.withColumns({c: r6(c) for c, t in out.dtypes if t == "double"})


def top_segments(c360: DataFrame, k: int) -> DataFrame:
    g = c360.groupBy("rfm_segment").agg(F.sum("predicted_clv_12m").alias("_v"))
    return g.orderBy(F.col("_v").desc(), "rfm_segment").limit(k).select("rfm_segment",
                                                                         r6("_v").alias("predicted_clv_12m"))


def portfolio_totals(targets: DataFrame) -> DataFrame:
    sel = targets.filter((F.col("selected_for_campaign") == 1) & (F.col("recommended_action") != "Suppress"))
    return sel.agg(F.count(F.lit(1)).alias("selected_contacts"),
                   r6(F.sum("expected_incremental_margin")).alias("expected_incremental_margin"),
                   r6(F.sum("allocated_budget")).alias("allocated_budget"))


def bi_row_measures(c360: DataFrame) -> DataFrame:
    """P34-P36 row calculations, aggregated by region."""
    at_risk = F.when(F.col("churn_probability") >= 0.55, F.col("monetary_12m")).otherwise(F.lit(0))
    strategic = (F.col("clv_band") == "Strategic") & F.col("risk_band").isin("High", "Critical")
    sel_margin = F.when(F.col("selected_for_campaign") == 1, F.col("expected_incremental_margin")).otherwise(0.0)
    return c360.groupBy("region").agg(
        F.sum(at_risk).cast("decimal(18,2)").alias("value_at_risk"),
        F.count_distinct(F.when(strategic, F.col("customer_id"))).alias("strategic_risk_customers"),
        r6(F.sum(sel_margin)).alias("campaign_selected_margin"),
        r6(F.avg("churn_probability")).alias("average_churn_probability"),
    )


def scenario_allocation(targets: DataFrame, budget: float, response: float = 1.0) -> DataFrame:
    """Per action, budget share, capped scenario budget, scenario margin and
    ROI with an INVEST / TEST / HOLD call (one row per action)."""
    base = targets.filter(F.col("recommended_action") != "Suppress").groupBy("recommended_action").agg(
        F.sum("allocated_budget").alias("b"), F.sum("expected_incremental_margin").alias("m"))
    share = F.col("b") / F.sum("b").over(Window.partitionBy())  # at most six rows
    sc = base.withColumn("share", share).withColumn("scenario_budget",
                                                    F.least(F.col("b"), F.lit(budget) * F.col("share")))
    sc = sc.withColumn("scenario_margin", F.greatest(F.lit(0.0), F.col("m") * F.lit(response)
                                                     - (F.col("scenario_budget") - F.col("b"))))
    roi = F.when(F.col("scenario_budget") > 0, F.col("scenario_margin") / F.col("scenario_budget")).otherwise(0.0)
    decision = F.when((F.col("scenario_budget") > 0) & (roi >= 1), "INVEST").when(
        (F.col("scenario_budget") > 0) & (roi >= 0.25), "TEST").otherwise("HOLD")
    return sc.select("recommended_action", r6("share").alias("budget_share"),
                     r6("scenario_budget").alias("scenario_budget"), r6("scenario_margin").alias("scenario_margin"),
                     r6(roi).alias("scenario_roi"), decision.alias("decision"))


def _monthly_base(orders: DataFrame) -> DataFrame:
    per = orders.groupBy(F.trunc("order_date", "month").alias("month"), "customer_id").agg(
        F.count(F.lit(1)).alias("co"), F.sum("net_revenue").alias("rev"), F.sum("gross_margin").alias("gm"))
    return per.groupBy("month").agg(
        F.sum("co").cast("long").alias("orders"), F.count(F.lit(1)).alias("active_customers"),
        F.sum("rev").cast("decimal(18,2)").alias("net_revenue"), F.sum("gm").cast("decimal(18,2)").alias("gross_margin"),
        F.count_if(F.col("co") >= 2).alias("repeat_customers"))


def monthly_bi_measures(orders: DataFrame) -> DataFrame:
    """S13 month spine, A44 base measures, A45 zero-safe ratio, J17 prior year, A46 YoY."""
    base = _monthly_base(orders).drop("repeat_customers")
    bounds = base.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    spine = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    j = spine.join(base, "month", "left").fillna(0, subset=["orders", "active_customers"])
    j = j.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("decimal(18,2)")) for c in ("net_revenue", "gross_margin")})
    prior = j.select(F.add_months("month", 12).alias("month"), F.col("net_revenue").alias("net_revenue_prior_year"))
    out = j.join(prior, "month", "left")
    # a month without a prior year changes by its whole revenue, and by 0 percent
    yoy = F.col("net_revenue") - F.coalesce(F.col("net_revenue_prior_year"), F.lit(0).cast("decimal(18,2)"))
    return out.select(
        "month", F.date_format("month", "yyyy-MM").alias("year_month"), "orders", "active_customers",
        "net_revenue", "gross_margin", r6(safe_divide("gross_margin", "net_revenue")).alias("margin_rate"),
        F.col("net_revenue_prior_year").cast("decimal(18,2)").alias("net_revenue_prior_year"),
        yoy.cast("decimal(18,2)").alias("net_revenue_yoy_change"),
        r6(safe_divide(yoy, F.col("net_revenue_prior_year"))).alias("net_revenue_yoy_pct"),
    )


def monthly_slice(orders: DataFrame, first: str, last: str) -> DataFrame:
    """The base measures over the months ``first`` .. ``last`` (yyyy-MM)."""
    base = _monthly_base(orders).filter(F.date_format("month", "yyyy-MM").between(first, last))
    out = base.agg(F.sum("orders").alias("orders"), F.sum("active_customers").alias("active_customer_months"),
                   F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue"),
                   F.sum("gross_margin").cast("decimal(18,2)").alias("gross_margin"))
    return out.withColumn("margin_rate", r6(safe_divide("gross_margin", "net_revenue")))


def ranked_customers(c360: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` customers with the largest ``by`` and their place (the limit is the feature)."""
    top = c360.orderBy(F.col(by).desc(), F.col("customer_id")).limit(k)
    place = F.row_number().over(Window.orderBy(F.col(by).desc(), F.col("customer_id")))  # k rows
    return top.select(place.alias("report_rank"), "customer_id", "rfm_segment", "clv_band", "risk_band",
                      r6("predicted_clv_12m").alias("predicted_clv_12m"), r6("churn_probability").alias("churn_probability"),
                      "recommended_action", "campaign_priority",
                      r6("expected_incremental_margin").alias("expected_incremental_margin"))


def filtered_targets(c360: DataFrame, segments: Sequence[str], risks: Sequence[str], k: int) -> DataFrame:
    """T5 / P10: the top selected customers of the chosen segments and risk bands."""
    kept = c360.filter((F.col("selected_for_campaign") == 1) & F.col("rfm_segment").isin(*segments)
                       & F.col("risk_band").isin(*risks))
    return ranked_customers(kept, "expected_incremental_margin", k)


def without_text(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose ``column`` does not contain ``text``, whatever its case."""
    return df.filter(~F.contains(F.lower(column), F.lit(text.lower())))


def portfolio_measures(c360: DataFrame, targets: DataFrame) -> DataFrame:
    """Measures over the segment, campaign and risk-band tables as (measure, value)."""
    seg = c360.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary_12m").alias("rev"), F.sum("predicted_clv_12m").alias("clv"),
        F.avg("churn_probability").alias("churn"))
    rows = _long(seg.agg(F.sum("rev").alias("rev"), F.sum("clv").alias("clv"), F.avg("churn").alias("churn"),
                         F.sum("customers").alias("customers")),
                 [(1, "Segment Revenue", "rev", ""), (2, "Segment Predicted CLV", "clv", ""),
                  (3, "Segment Churn Risk", "churn", ""), (4, "Segment Customers", "customers", "")])
    rows = rows.unionByName(_long(targets.agg(F.sum("allocated_budget").alias("b"), F.sum("expected_incremental_margin").alias("m")),
                                  [(5, "Campaign Budget", "b", ""), (6, "Campaign Expected Margin", "m", "")]))
    rows = rows.unionByName(_long(c360.agg(F.count("risk_band").alias("n")), [(7, "Risk Band Customers", "n", "")]))
    return rows.select(F.col("kpi").alias("measure"), r6("value").alias("value"))


def day_calendar(orders: DataFrame) -> DataFrame:
    """One row per day between the first and last order date."""
    bounds = orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    d = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    dow = F.dayofweek("date")  # 1 = Sunday ... 7 = Saturday
    return d.select(
        "date", F.year("date").alias("year"), F.concat(F.lit("Q"), F.quarter("date").cast("string")).alias("quarter"),
        F.month("date").alias("month_number"), F.date_format("date", "MMMM").alias("month_name"),
        F.date_format("date", "yyyy-MM").alias("year_month"), F.trunc("date", "month").alias("month_start"),
        F.weekofyear("date").alias("week_of_year"), F.date_format("date", "EEEE").alias("day_of_week"),
        F.when(dow.isin(1, 7), 1).otherwise(0).alias("is_weekend"),
    )


def latest_month_portfolio(orders: DataFrame, c360: DataFrame) -> DataFrame:
    """Portfolio scalars on the latest month only (scalar subqueries, no
    cross join); earlier months carry 1 - repeat rate as a churn proxy."""
    base = _monthly_base(orders)
    clv = c360.select(F.sum("predicted_clv_12m")).scalar()
    churn = c360.select(F.avg("churn_probability")).scalar()
    latest = F.col("month") == F.max("month").over(Window.partitionBy())  # one row per month
    return base.select(
        "month", "orders", "net_revenue",
        F.when(latest, r6(clv)).alias("predicted_clv_12m"),
        r6(F.when(latest, churn).otherwise(F.lit(1.0) - safe_divide("repeat_customers", "active_customers")))
        .alias("churn_probability_or_proxy"),
    )


def recent_cohort_matrix(cohort_long: DataFrame, last: int = 24, lags: int = 13, every: int = 3,
                         within: int = 12) -> DataFrame:
    """Last ``last`` cohorts x first ``lags`` lags; every ``every``-th of the
    last ``within`` cohorts flagged."""
    months = cohort_long.select("cohort_month").distinct()
    ranked = months.select("cohort_month", F.row_number().over(
        Window.orderBy(F.col("cohort_month").desc())).alias("k"))  # one row per cohort month
    sel = cohort_long.join(ranked.filter(F.col("k") <= last), "cohort_month")
    wide = sel.groupBy("cohort_month").pivot("cohort_index", list(range(lags))).agg(F.max("retention_rate"))
    flags = ranked.select("cohort_month", F.when((F.col("k") <= within) & ((F.col("k") - 1) % every == 0), 1)
                          .otherwise(0).alias("highlighted"))
    return wide.join(flags, "cohort_month").select(
        "cohort_month", *[r6(F.col(str(i))).alias(f"M{i}") for i in range(lags)], "highlighted")


# --- fixed values: business display names of the 360 export ------------------------
BUSINESS_NAMES = {
    "customer_id": "Customer ID",
    "rfm_segment": "RFM Segment",
    "risk_band": "Risk Band",
    "clv_band": "CLV Band",
    "monetary_12m": "Net Revenue 12M",
    "predicted_clv_12m": "Predicted CLV 12M",
    "churn_probability": "Churn Probability",
    "recommended_action": "Recommended Action",
}


def business_export(c360: DataFrame) -> DataFrame:
    """Business column names plus display strings for money (thousands
    separators, whole units) and percentages (one decimal); values are rounded
    half-up as exact decimals before formatting."""
    money = F.format_number(F.round(F.col("monetary_12m").cast("decimal(18,2)"), 0), 0)
    clv = F.format_number(F.round(F.col("predicted_clv_12m").cast("decimal(18,6)"), 0), 0)
    pct = F.concat(F.format_number(F.round(F.col("churn_probability").cast("decimal(18,6)") * 100, 1), 1), F.lit("%"))
    out = c360.select(*BUSINESS_NAMES, money.alias("_money"), clv.alias("_clv"), pct.alias("_pct"))
    out = out.withColumn("predicted_clv_12m", r6("predicted_clv_12m")).withColumn(
        "churn_probability", r6("churn_probability"))
    return out.withColumnsRenamed({**BUSINESS_NAMES, "_money": "Net Revenue 12M (display)",
                                   "_clv": "Predicted CLV 12M (display)", "_pct": "Churn Probability (display)"})


def worst_drift_feature(report: DataFrame) -> DataFrame:
    """The feature with the largest PSI (ties by name)."""
    return report.orderBy(F.col("psi").desc(), F.col("feature")).limit(1)


def top_risk_drilldown(c360: DataFrame, reasons: DataFrame) -> DataFrame:
    """The riskiest customer's reason codes; when that customer was not explained,
    fall back to the first explained customer (smallest id).  Both picks are scalar
    subqueries (top-1 and min), no join of the two tables."""
    explained = reasons.select("customer_id").distinct()
    top = c360.orderBy(F.col("churn_probability").desc(), F.col("customer_id")).limit(1).select("customer_id")
    top_explained = top.join(explained, "customer_id", "left_semi").select(F.max("customer_id")).scalar()
    first = reasons.select(F.min("customer_id")).scalar()
    return reasons.filter(F.col("customer_id") == F.coalesce(top_explained, first))
