"""Column expressions shared by the operators (all JVM-side, no Python UDF)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def _c(x: Col) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(num: Col, den: Col) -> Column:
    """num / den as double; 0/0, x/0, null and +-inf become 0.0 (ANSI-safe)."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.when(q.isNull() | F.isnan(q) | (F.abs(q) == F.lit(float("inf"))), F.lit(0.0)).otherwise(q)


def clip(x: Col, lo: float | None = None, hi: float | None = None) -> Column:
    out = _c(x)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def lookup(x: Col, mapping: Mapping[str, float | int], default: float | int | None = None) -> Column:
    """Dictionary lookup as a CASE expression; unmatched -> default."""
    expr = None
    for key, value in mapping.items():
        cond = _c(x) == F.lit(key)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def right_closed_band(x: Col, edges: Sequence[tuple[float, str]], top: str) -> Column:
    """pd.cut with right-closed bins: x <= e1 -> l1, x <= e2 -> l2, ..., else top."""
    expr = None
    for edge, label in edges:
        cond = _c(x) <= F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(top))


def left_closed_band(x: Col, edges: Sequence[tuple[float, str]], top: str) -> Column:
    """x < e1 -> l1, x < e2 -> l2, ..., else top."""
    expr = None
    for edge, label in edges:
        cond = _c(x) < F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(top))


def quintile_score(pct: Col, higher_is_better: bool = True) -> Column:
    """clip(ceil(pct * 5), 1, 5); inverted as 6 - score when lower is better."""
    score = F.least(F.greatest(F.ceil(_c(pct) * F.lit(5)), F.lit(1)), F.lit(5)).cast("int")
    return score if higher_is_better else (F.lit(6) - score).cast("int")


def r6(x: Col) -> Column:
    """Ratios rounded to 6 places for stable comparison across engines."""
    return F.round(_c(x).cast("double"), 6)


def is_finite(x: Col) -> Column:
    v = _c(x).cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
