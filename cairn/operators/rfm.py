"""Recency / frequency / monetary scoring and segment rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import quintile_score
from ..functions.ranking import avg_rank_pcts
from .contracts import check_rfm_inputs


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Ordered rules; the first match wins (see the R x F table in the README)."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 4), "Loyal Customers")
        .when((r >= 4) & f.isin(2, 3), "Potential Loyalists")
        .when((r == 5) & (f == 1), "New Customers")
        .when((r >= 3) & (f == 2), "Promising")
        .when(r.isin(2, 3) & (f >= 3), "Need Attention")
        .when((r <= 2) & (f >= 4), "Can't Lose Them")
        .when((r <= 2) & f.isin(2, 3), "At Risk")
        .when((r <= 2) & (f == 1), "Hibernating")
        .otherwise("Lost")
    )


def calculate_rfm(customers: DataFrame, orders: DataFrame, analysis_date: str, validate: bool = True) -> DataFrame:
    """One row per customer acquired on or before ``analysis_date``.

    Recency uses the last order *inside* the inclusive 365-day window; customers
    without one get tenure + 365.  Scores are quintiles of the average-rank
    percentile; zero-frequency customers get F = M = 1.
    """
    if validate:
        check_rfm_inputs(customers, orders, analysis_date)
    day = F.lit(analysis_date).cast("date")
    window = orders.filter(F.col("order_date").between(F.date_sub(day, 364), day))
    agg = window.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count_distinct("order_id").alias("frequency"),
        F.sum("net_revenue").alias("monetary"),
        F.sum("gross_margin").alias("gross_margin"),
    )
    eligible = customers.filter(F.col("acquisition_date") <= day).select("customer_id", "acquisition_date")
    rfm = eligible.join(agg, "customer_id", "left")
    tenure = F.greatest(F.datediff(day, F.col("acquisition_date")), F.lit(0))
    rfm = rfm.select(
        "customer_id",
        "last_order_date",
        F.coalesce(F.col("frequency"), F.lit(0)).cast("long").alias("frequency"),
        F.coalesce(F.col("monetary"), F.lit(0)).cast("decimal(18,2)").alias("monetary"),
        F.coalesce(F.col("gross_margin"), F.lit(0)).cast("decimal(18,2)").alias("gross_margin"),
        F.coalesce(F.datediff(day, F.col("last_order_date")), tenure + 365).cast("int").alias("recency"),
    )
    rfm = avg_rank_pcts(rfm, {"recency": "_r_pct", "frequency": "_f_pct", "monetary": "_m_pct"})
    zero = F.col("frequency") == 0
    rfm = rfm.withColumns({
        "recency_score": quintile_score("_r_pct", higher_is_better=False),
        "frequency_score": F.when(zero, F.lit(1)).otherwise(quintile_score("_f_pct")),
        "monetary_score": F.when(zero, F.lit(1)).otherwise(quintile_score("_m_pct")),
    })
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    return rfm.select(
        "customer_id",
        "last_order_date",
        "frequency",
        "monetary",
        "gross_margin",
        "recency",
        "recency_score",
        "frequency_score",
        "monetary_score",
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_score"),
        rfm_segment(r, f, m).alias("rfm_segment"),
    )


def segment_rollup(rfm: DataFrame) -> DataFrame:
    """Customers, revenue and their shares per RFM segment."""
    per = rfm.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("monetary").cast("decimal(18,2)").alias("revenue"),
        F.avg("recency").alias("avg_recency"),
    )
    everything = Window.partitionBy()  # over the handful of segment rows only
    return per.select(
        "rfm_segment",
        "customers",
        "revenue",
        F.round("avg_recency", 6).alias("avg_recency"),
        F.round(F.col("customers") / F.sum("customers").over(everything), 6).alias("customer_share"),
        F.round(F.col("revenue").cast("double") / F.sum("revenue").over(everything).cast("double"), 6).alias(
            "revenue_share"
        ),
    )
