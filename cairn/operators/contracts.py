"""Input contracts as named conditions with violation counts.

A contract counts the violations of each of its conditions in Spark (one aggregate per
frame, anti joins for populations) and raises one ``ContractError`` that carries every
count that is not zero.  Only counts reach the driver.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence
from numbers import Integral, Real

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import is_finite

MAX_HORIZON_DAYS = 3660
_NUMERIC = {"double", "float", "decimal", "integer", "long", "short", "byte"}


class ContractError(ValueError):
    """Violated conditions of one input; ``violations`` maps condition -> count."""

    def __init__(self, subject: str, violations: Mapping[str, int]):
        self.subject, self.violations = subject, dict(violations)
        super().__init__(f"{subject}: " + ", ".join(f"{name}={n}" for name, n in self.violations.items()))


def require(subject: str, counts: Mapping[str, int | bool]) -> None:
    found = {name: int(n) for name, n in counts.items() if n}
    if found:
        raise ContractError(subject, found)


def count_where(df: DataFrame, conditions: Mapping[str, Column]) -> dict[str, int]:
    """Rows that meet each condition, in one pass; ``rows`` is the number of all."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()]).first()
    return row.asDict()


def key_violations(df: DataFrame, key: str | Sequence[str]) -> tuple[int, int]:
    """(null keys, duplicate keys); one group-by on the key, combined on the map side."""
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    row = per_key.agg(
        F.coalesce(F.sum(F.when(null_key, F.col("_c"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("dups"),
    ).first()
    return int(row["nulls"]), int(row["dups"])


def _key_counts(df: DataFrame, key: str) -> dict[str, int]:
    if key not in df.columns:
        return {f"{key}_absent": 1}
    nulls, dups = key_violations(df, key)
    return {f"{key}_null": nulls, f"{key}_repeated": dups}


def _outside(column: str, lo: float, hi: float) -> Column:
    return ~is_finite(column) | ~F.col(column).between(lo, hi)


def _is_number(x: object) -> bool:
    return isinstance(x, Real) and not isinstance(x, bool) and math.isfinite(float(x))


def check_rfm_inputs(customers: DataFrame, orders: DataFrame, analysis_date: str) -> None:
    """Unique customers, dated orders with finite amounts, an ISO analysis date."""
    try:
        dt.date.fromisoformat(str(analysis_date)[:10])
    except ValueError:
        raise ContractError("analysis_date", {"not_a_date": 1}) from None
    require("customers", _key_counts(customers, "customer_id"))
    counts = count_where(orders, {
        "order_date_null": F.col("order_date").isNull(),
        **{f"{c}_not_finite": ~is_finite(c) for c in ("net_revenue", "gross_margin")},
    })
    counts.pop("rows")
    require("orders", counts)


def check_horizon(horizon_days: object) -> int:
    """A whole number of days from 1 to ``MAX_HORIZON_DAYS``; another type is a TypeError."""
    if not isinstance(horizon_days, Integral) or isinstance(horizon_days, bool):
        raise TypeError(f"horizon_days is {type(horizon_days).__name__}, not a whole number")
    require("horizon_days", {"out_of_range": not 1 <= horizon_days <= MAX_HORIZON_DAYS})
    return int(horizon_days)


def check_label_windows(cutoffs: Sequence[str], horizon_days: int, holdout: str) -> None:
    """Every training label window closes before the holdout cutoff."""
    end = dt.date.fromisoformat(holdout)
    late = [c for c in cutoffs if dt.date.fromisoformat(c) + dt.timedelta(days=horizon_days) > end]
    require("training_cutoffs", {"label_window_after_holdout": len(late)})


def check_budget(budget: object) -> float:
    """A finite amount of zero or more."""
    number = _is_number(budget)
    require("budget", {"not_a_finite_number": not number, "negative": number and budget < 0})
    return float(budget)


def check_campaign_inputs(
    snapshot: DataFrame, rfm: DataFrame, clv: DataFrame, churn: DataFrame, budget: object
) -> float:
    """Q8: budget, one row per customer in every input, the same customers in all, consent
    of 0 or 1, and scores in [0, 1]."""
    amount = check_budget(budget)
    score_columns = {"clv_scores": ["clv_percentile"], "churn_scores": ["churn_probability", "risk_percentile"]}
    population = snapshot.select("customer_id") if "customer_id" in snapshot.columns else None
    for name, frame in (("production_snapshot", snapshot), ("rfm", rfm), ("clv_scores", clv), ("churn_scores", churn)):
        counts = _key_counts(frame, "customer_id")
        if frame is not snapshot and "customer_id" in frame.columns and population is not None:
            own = frame.select("customer_id")
            counts["customers_missing"] = population.join(own, "customer_id", "left_anti").count()
            counts["customers_unknown"] = own.join(population, "customer_id", "left_anti").count()
        wrong_type = [c for c in score_columns.get(name, []) if frame.schema[c].dataType.typeName() not in _NUMERIC]
        counts.update({f"{c}_not_numeric": 1 for c in wrong_type})
        rules = {f"{c}_outside_0_1": _outside(c, 0, 1) for c in score_columns.get(name, []) if c not in wrong_type}
        if frame is snapshot:
            consent = F.col("marketing_consent")
            rules["marketing_consent_not_0_or_1"] = consent.isNull() | ~consent.cast("int").isin(0, 1)
        if rules:
            counts.update(count_where(frame, rules))
            counts.pop("rows")
        require(name, counts)
    return amount


def check_psi_inputs(bins: object) -> int:
    """At least two bins."""
    whole = isinstance(bins, int) and not isinstance(bins, bool)
    require("bins", {"not_a_whole_number": not whole, "under_2": whole and bins < 2})
    return bins


def check_psi_samples(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> None:
    """Both samples have rows, and finite numbers in every compared column."""
    for name, frame in (("reference_sample", reference), ("current_sample", current)):
        counts = count_where(frame, {f"{c}_not_finite": ~is_finite(c) for c in columns})
        counts["empty"] = counts.pop("rows") == 0
        require(name, counts)


def check_fairness_inputs(scored: DataFrame, threshold: object, attributes: Sequence[str]) -> float:
    """Q9 on a scored frame (customer_id, attributes..., churn_90d, probability)."""
    needed = ["customer_id", *attributes, "churn_90d", "probability"]
    require("fairness_frame", {f"{c}_absent": 1 for c in needed if c not in scored.columns})
    number = _is_number(threshold)
    require("threshold", {"not_a_finite_number": not number, "outside_0_1": number and not 0 < float(threshold) < 1})
    counts = count_where(scored, {
        "probability_outside_0_1": _outside("probability", 0, 1),
        "outcome_not_binary": F.col("churn_90d").isNull() | ~F.col("churn_90d").isin(0, 1),
        **{f"{a}_blank": F.col(a).isNull() | (F.trim(F.col(a).cast("string")) == "") for a in attributes},
    })
    counts.pop("rows")
    require("fairness_frame", counts)
    return float(threshold)
