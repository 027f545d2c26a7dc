"""Data-quality gates, feature-matrix validity, workbook-style controls and table
reconciliation.  Every check is an aggregate or an anti join; only one row per check
reaches the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FEATURE_COLUMNS
from ..functions.exprs import is_finite
from ..functions.ranking import ordered_running
from ..sources.files import type_map
from .compare import differs
from .contracts import require


def _check(df: DataFrame, name: str, passed: Column) -> DataFrame:
    """One-row frame (check_name, passed) from an aggregate boolean."""
    return df.agg(passed.alias("_ok")).select(F.lit(name).alias("check_name"),
                                             F.coalesce(F.col("_ok"), F.lit(True)).alias("_ok"))


def pk_unique(df: DataFrame, key: str | Sequence[str], name: str) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return _check(per, name, F.max("_c") <= 1)


def fk_valid(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    orphans = child.select(key).join(parent.select(key), key, "left_anti")
    return _check(orphans, name, F.count(F.lit(1)) == 0)


def feature_matrix_valid(snapshot: DataFrame, name: str = "snapshot_features_valid") -> DataFrame:
    """Q4: all feature columns present, unique ids, no nulls, no infinities."""
    if any(c not in snapshot.columns for c in FEATURE_COLUMNS):
        return snapshot.sparkSession.createDataFrame([(name, False)], "check_name string, _ok boolean")
    bad = None
    for c in FEATURE_COLUMNS:
        cond = ~is_finite(c)
        bad = cond if bad is None else (bad | cond)
    per = snapshot.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_c"), F.count_if(bad).alias("_bad"))
    return _check(per, name, (F.max("_c") <= 1) & (F.sum("_bad") == 0))


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """Q5: (check_name, status PASS/FAIL, passed 0/1)."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.select("check_name", F.when(F.col("_ok"), "PASS").otherwise("FAIL").alias("status"),
                      F.col("_ok").cast("int").alias("passed"))


def data_quality_report(customers: DataFrame, products: DataFrame, orders: DataFrame, order_lines: DataFrame,
                        interactions: DataFrame, snapshot: DataFrame, date_start: str, date_end: str) -> DataFrame:
    """The ten production gates."""
    d = F.col("order_date")
    return report([
        pk_unique(customers, "customer_id", "customer_primary_key_unique"),
        pk_unique(products, "product_id", "product_primary_key_unique"),
        pk_unique(orders, "order_id", "order_primary_key_unique"),
        pk_unique(order_lines, "order_line_id", "order_line_primary_key_unique"),
        fk_valid(orders, customers, "customer_id", "orders_customer_fk_valid"),
        fk_valid(order_lines, orders, "order_id", "order_lines_order_fk_valid"),
        fk_valid(interactions, customers, "customer_id", "interactions_customer_fk_valid"),
        _check(orders, "order_revenue_nonnegative", F.count_if(F.col("net_revenue") < 0) == 0),
        _check(orders, "order_dates_in_range",
               F.count_if(~d.between(F.lit(date_start).cast("date"), F.lit(date_end).cast("date")) | d.isNull()) == 0),
        feature_matrix_valid(snapshot),
    ])


def raise_on_failure(report_df: DataFrame) -> None:
    """Publication gate: collect only the failing check names (at most one per check)."""
    failed = report_df.filter(F.col("status") != "PASS").select("check_name").collect()
    require("publication", {r["check_name"]: 1 for r in failed})


def order_sanity(orders: DataFrame, date_start: str, date_end: str) -> DataFrame:
    """Q14: gross >= net >= 0 and dates in range, as violation counts."""
    d = F.col("order_date")
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("gross_revenue") < F.col("net_revenue")).alias("gross_below_net"),
        F.count_if(F.col("net_revenue") < 0).alias("negative_net"),
        F.count_if(~d.between(F.lit(date_start).cast("date"), F.lit(date_end).cast("date"))).alias("out_of_range"),
    )


def controls(rows: Sequence[tuple[str, Column, float, float]], source: DataFrame) -> DataFrame:
    """Q12: (control, actual, expected, tolerance, status) where the status is PASS when
    |actual - expected| <= tolerance; ``rows`` hold aggregate expressions over ``source``."""
    agg = source.agg(*[expr.cast("double").alias(f"_{i}") for i, (_, expr, _, _) in enumerate(rows)])
    long = agg.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("control"), F.col(f"_{i}").alias("actual"), F.lit(float(exp)).alias("expected"),
                 F.lit(float(tol)).alias("tolerance"))
        for i, (name, _, exp, tol) in enumerate(rows)
    ])).alias("r")).select("r.*")
    return long.withColumn("status", F.when(F.abs(F.col("actual") - F.col("expected")) <= F.col("tolerance"), "PASS")
                           .otherwise("FAIL"))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str],
              rel_tol: float = 1e-9, abs_tol: float = 1e-12) -> DataFrame:
    """Full outer join on the business key; per column, rows compared,
    rows missing on either side, values outside tolerance and the first differing key.

    Numbers are equal within max(rel_tol * max(|a|, |b|), abs_tol), other values exactly;
    both null -> equal.  Rows that share a key are paired in the order of the compared
    columns.  With several key columns the first differing key is their text, joined by "|".
    """
    keys, kinds = list(keys), type_map(left)
    check_same_columns(left, right)
    number = [kinds[c] in ("double", "int") for c in columns]

    def side(df: DataFrame, mark: str) -> DataFrame:
        values = [(F.col(c).cast("double") if n else F.col(c).cast("string")).alias(f"_v{i}") for i, (c, n) in enumerate(zip(columns, number))]
        rows = df.select(*keys, *values, F.xxhash64(*keys, F.lit(1)).alias("_k1"), F.xxhash64(F.lit(2), *keys).alias("_k2"))
        rows = rows.withColumn("_id", F.xxhash64(*[f"_v{i}" for i in range(len(columns))]))
        ordered = [(f"_v{i}", True) for i, n in enumerate(number) if n] or [("_id", True)]
        placed = ordered_running(rows, ordered, "_id", partition_by=["_k1", "_k2"])
        return placed.select(*[F.col(k).alias(f"{mark}k_{k}") for k in keys], *[F.col(f"_v{i}").alias(f"{mark}{i}") for i in range(len(columns))],
                             F.col("_rn").alias(f"{mark}rn"), F.lit(1).alias(f"{mark}in"))

    l, r = side(left, "_l"), side(right, "_r")
    same = F.col("_lrn") == F.col("_rrn")
    for k in keys:
        same = same & F.col(f"_lk_{k}").eqNullSafe(F.col(f"_rk_{k}"))
    j = l.join(r, same, "full_outer")
    both = F.col("_lin").isNotNull() & F.col("_rin").isNotNull()
    held = [F.coalesce(f"_lk_{k}", f"_rk_{k}") for k in keys]
    key = held[0] if len(keys) == 1 else F.concat_ws("|", *[F.coalesce(h.cast("string"), F.lit("")) for h in held])
    # one pass: every column's figures are aggregates of the same join
    aggs = []
    for i, n in enumerate(number):
        wrong = both & differs(F.col(f"_l{i}"), F.col(f"_r{i}"), n, rel_tol, abs_tol)
        aggs += [F.count_if(wrong).alias(f"_m_{i}"), F.min(F.when(wrong, key)).alias(f"_k_{i}")]
    total = j.agg(F.count_if(both).alias("rows_compared"), F.count_if(F.col("_rin").isNull()).alias("missing_right"),
                  F.count_if(F.col("_lin").isNull()).alias("missing_left"), *aggs)
    return total.select("rows_compared", "missing_right", "missing_left", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_m_{i}").alias("mismatches"), F.col(f"_k_{i}").alias("first_mismatch_key"))
        for i, c in enumerate(columns)])).alias("_x")).select(
            "_x.column", "rows_compared", "missing_right", "missing_left", "_x.mismatches", "_x.first_mismatch_key")


def check_same_columns(left: DataFrame, right: DataFrame) -> None:
    """Both tables have the same set of columns."""
    l, r = set(left.columns), set(right.columns)
    require("columns", {**{f"{c}_only_left": 1 for c in sorted(l - r)}, **{f"{c}_only_right": 1 for c in sorted(r - l)}})
