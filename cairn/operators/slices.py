"""A cube of additive measures and customer bitmaps, from which any multi-select of segments,
risk bands and months is answered without the facts, distinct counts included.

A cell is (rfm_segment, risk_band, month, bucket): customers are dealt to buckets of 32,768
ids and a cell holds one bit per customer with an order in it.  Bitmaps of selected cells are
or-ed per bucket, so a customer of several cells counts once; the cube grows with customers,
not with orders.  Customer ids are whole numbers.  Orders of customers outside the 360 table
are in no cell; a null segment or band is a cell of its own that no selection picks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import r6, safe_divide

MONEY = "decimal(18,2)"


def slice_cube(c360: DataFrame, orders: DataFrame) -> DataFrame:
    """rfm_segment, risk_band, month, bucket, customers (bitmap), orders, net_revenue, gross_margin."""
    # orders are added up per customer and month first: the bands are joined to few rows
    per = orders.groupBy("customer_id", F.trunc("order_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("net_revenue").alias("rev"), F.sum("gross_margin").alias("gm"))
    rows = per.join(c360.select("customer_id", "rfm_segment", "risk_band"), "customer_id")
    customer = F.col("customer_id").cast("long")
    return rows.groupBy("rfm_segment", "risk_band", "month", F.bitmap_bucket_number(customer).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(customer)).alias("customers"), F.sum("n").alias("orders"),
        F.sum("rev").cast(MONEY).alias("net_revenue"), F.sum("gm").cast(MONEY).alias("gross_margin"))


def slice_measures(cube: DataFrame, segments: Sequence[str] | None = None, risks: Sequence[str] | None = None,
                   months: tuple[str, str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The measures of the selected cells (None: all), in all or by some of rfm_segment,
    risk_band and month.  months are the first and last (yyyy-MM)."""
    picked = cube
    if segments is not None:
        picked = picked.where(F.col("rfm_segment").isin(list(segments)))
    if risks is not None:
        picked = picked.where(F.col("risk_band").isin(list(risks)))
    if months is not None:
        picked = picked.where(F.date_format("month", "yyyy-MM").between(*months))
    buckets = picked.groupBy(*by, "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("customers")).alias("customers"),
        *(F.sum(c).alias(c) for c in ("orders", "net_revenue", "gross_margin")))
    out = buckets.groupBy(*by).agg(
        F.coalesce(F.sum("customers"), F.lit(0)).alias("customers"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        *(F.sum(c).cast(MONEY).alias(c) for c in ("net_revenue", "gross_margin")))
    return out.withColumn("orders_per_customer", r6(safe_divide("orders", "customers")))
