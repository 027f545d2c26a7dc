"""The order rollup in whole cents against the decimal economics of the lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.sources.adapter import lazy_canonical

SMOKE = "/root/testdata/sf0.001"
SUMS = ["gross_revenue", "discount_amount", "returned_amount", "net_revenue", "gross_margin"]


def test_sums_of_cents_equal_decimal_sums(spark):
    c = lazy_canonical(spark, SMOKE)
    want = c.order_lines().groupBy("order_id").agg(*[F.sum(s).cast("decimal(16,2)").alias(s) for s in SUMS])
    got = c.orders().where("item_count > 0").select("order_id", *SUMS)
    assert got.dtypes == want.dtypes
    assert got.count() > 1000 and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_an_order_sums_longs(spark):
    kinds = dict(lazy_canonical(spark, SMOKE)._lines_in_cents().dtypes)
    assert {kinds[s] for s in SUMS} == {"bigint"}


def test_negative_and_missing_values_follow_the_decimals(spark, tmp_path):
    for name in ("orders", "part", "customer", "nation", "region", "events"):
        spark.read.parquet(f"{SMOKE}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    odd = spark.read.parquet(f"{SMOKE}/lineitem.parquet").withColumns({
        "l_extendedprice": F.when(F.col("l_linenumber") == 1, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")),
        "l_discount": F.when(F.col("l_linenumber") != 2, F.col("l_discount")),
        "l_partkey": F.when(F.col("l_linenumber") != 3, F.col("l_partkey"))})
    odd.write.parquet(str(tmp_path / "lineitem.parquet"))
    c = lazy_canonical(spark, str(tmp_path))
    zero = F.lit(0).cast("decimal(16,2)")
    want = c.order_lines().groupBy("order_id").agg(*[F.coalesce(F.sum(s).cast("decimal(16,2)"), zero).alias(s) for s in SUMS])
    got = c.orders().where("item_count > 0").select("order_id", *SUMS)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
