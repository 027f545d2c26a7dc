"""Purchase cohorts: long retention table and the wide M0..Mn matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import safe_divide
from .contracts import require


def cohort_retention_long(orders: DataFrame) -> DataFrame:
    """(cohort_month 'yyyy-MM', cohort_index, active_customers, cohort_size, retention_rate).

    Customer-months are de-duplicated first (map-side), so the distinct count is a
    plain count and a customer with many orders never widens a group.
    """
    active_months = orders.select(
        "customer_id", F.trunc("order_date", "month").alias("order_month")
    ).distinct()
    first = active_months.groupBy("customer_id").agg(F.min("order_month").alias("cohort_start"))
    lag = (F.year("order_month") - F.year("cohort_start")) * 12 + F.month("order_month") - F.month("cohort_start")
    active = (
        active_months.join(first, "customer_id")
        .groupBy("cohort_start", lag.cast("int").alias("cohort_index"))
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    sizes = first.groupBy("cohort_start").agg(F.count(F.lit(1)).alias("cohort_size"))
    # one row per cohort month: tiny, AQE broadcasts it at run time
    return active.join(sizes, "cohort_start", "left").select(
        F.date_format("cohort_start", "yyyy-MM").alias("cohort_month"),
        "cohort_index",
        "active_customers",
        "cohort_size",
        safe_divide("active_customers", "cohort_size").alias("retention_rate"),
    )


def cohort_matrix(long: DataFrame, max_index: int) -> DataFrame:
    """One row per cohort with columns M0..M<max_index> (absent cells stay null), by
    conditional aggregates.  A lag outside the declared range is refused, never dropped."""
    outside = long.filter(~F.col("cohort_index").between(0, max_index)).count()
    require("cohort_index", {f"outside_0_{max_index}": outside})
    cells = [F.round(F.max(F.when(F.col("cohort_index") == i, F.col("retention_rate"))), 6).alias(f"M{i}")
             for i in range(max_index + 1)]
    return long.groupBy("cohort_month").agg(*cells)
