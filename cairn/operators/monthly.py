"""Monthly customer economics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import safe_divide


def monthly_metrics(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders, active and repeat customers, revenue, margin and returns per month.

    Two-level aggregate: (month, customer) then month; both levels are keyed by
    month first, so the second reuses the first one's partitioning.  Months without
    orders are absent (new customers are attached by a left join).
    """
    per_customer = orders.groupBy(F.trunc("order_date", "month").alias("month"), "customer_id").agg(
        F.count(F.lit(1)).alias("customer_orders"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("gross_margin").alias("gross_margin"),
        F.sum("returned_flag").alias("returned_orders"),
    )
    summary = per_customer.groupBy("month").agg(
        F.sum("customer_orders").alias("orders"),
        F.count(F.lit(1)).alias("active_customers"),
        F.sum("net_revenue").cast("decimal(18,2)").alias("net_revenue"),
        F.sum("gross_margin").cast("decimal(18,2)").alias("gross_margin"),
        F.sum("returned_orders").cast("long").alias("returned_orders"),
        F.count_if(F.col("customer_orders") >= 2).alias("repeat_customers"),
    )
    new = customers.groupBy(F.trunc("acquisition_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("new_customers")
    )
    out = summary.join(new, "month", "left").fillna(0, subset=["new_customers"])
    return out.select(
        "month",
        "orders",
        "active_customers",
        "net_revenue",
        "gross_margin",
        "returned_orders",
        "repeat_customers",
        "new_customers",
        F.round(safe_divide("net_revenue", "orders"), 6).alias("average_order_value"),
        F.round(safe_divide("gross_margin", "net_revenue"), 6).alias("gross_margin_pct"),
        F.round(safe_divide("repeat_customers", "active_customers"), 6).alias("repeat_customer_rate"),
        F.round(safe_divide("returned_orders", "orders"), 6).alias("return_rate"),
    )
