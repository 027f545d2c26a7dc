"""Model evaluation on the rule scorers (SQL-checkable): threshold search, holdout
metrics, calibration, lift, regression metrics, fairness and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (ANALYSIS_DATE, CHURN_HOLDOUT_CUTOFF, CHURN_HORIZON_DAYS, CHURN_TRAIN_CUTOFFS,
                         CLV_HOLDOUT_CUTOFF, CLV_HORIZON_DAYS, FEATURE_COLUMNS)
from ..functions.exprs import r6
from ..operators import drift, fairness, metrics, scores
from ..session import materialize
from . import sql_parts as S
from .catalog import register

CHURN_CUTS = CHURN_TRAIN_CUTOFFS + [CHURN_HOLDOUT_CUTOFF]


_CHURN_FRAMES: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def churn_frames(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(training rows, holdout rows) with y = churn_90d and p = rule churn score; built
    once per session (one pass over the facts for the four cutoffs) and materialized."""
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    if key not in _CHURN_FRAMES:
        _CHURN_FRAMES[key] = _build_churn_frames(spark, sf_dir)
    return _CHURN_FRAMES[key]


def labelled_snapshots(spark, sf_dir, kind: str) -> DataFrame:
    """Session-wide materialized multi-cutoff snapshots with labels: ``churn`` (three
    training cutoffs + holdout, 90-day label) or ``clv`` (four + holdout, 365-day
    value label): selections of the session's one-pass snapshot table."""
    from ..constants import CLV_TRAIN_CUTOFFS
    from .q_decision import session_snapshots, snapshots_at

    snaps = session_snapshots(spark, sf_dir)
    if kind == "churn":
        return snapshots_at(snaps, CHURN_CUTS, ("churn_90d",))
    return snapshots_at(snaps, CLV_TRAIN_CUTOFFS + [CLV_HOLDOUT_CUTOFF],
                        ("future_gross_margin", "future_revenue", "future_orders"))


_KEPT: dict[tuple[str, str, str], object] = {}


def kept(spark, sf_dir, name: str, build):
    """What ``build`` makes, once per session: it feeds several queries."""
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"), name)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def hold_runs(spark, sf_dir) -> metrics.ScoreRuns:
    """The holdout rows sorted by score, once for all metrics."""
    return kept(spark, sf_dir, "hold_runs", lambda: metrics.ScoreRuns(churn_frames(spark, sf_dir)[1]))


def _build_churn_frames(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    snaps = labelled_snapshots(spark, sf_dir, "churn")
    scored = materialize(snaps.select(
        "customer_id", "snapshot_date", "region", "age_band", F.col("churn_90d").alias("y"),
        scores.rule_churn_probability().alias("p"), *FEATURE_COLUMNS))
    hold = F.col("snapshot_date") == F.lit(CHURN_HOLDOUT_CUTOFF).cast("date")
    return scored.filter(~hold), scored.filter(hold)


def _production_snapshot(spark, sf_dir) -> DataFrame:
    """The production snapshot at the analysis date, built once per session."""
    from .q_decision import production

    return production(spark, sf_dir).snapshot


def _round_all(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    return df.withColumns({c: r6(c) for c, t in df.dtypes if t == "double" and c not in skip})


# ---- oracle fragments --------------------------------------------------------------
CHURN_SCORED_SQL = S.snapshot_sql(CHURN_CUTS, churn_h=CHURN_HORIZON_DAYS, name="cs") + f"""
, scored AS (
  SELECT customer_id, snapshot_date, region, age_band, churn_90d AS y,
    LEAST(GREATEST(CAST(recency_days AS DOUBLE) / (CAST(recency_days AS DOUBLE) + 120.0), 0.02), 0.98) AS p,
    {", ".join(FEATURE_COLUMNS)}
  FROM cs
)
, train AS (SELECT * FROM scored WHERE snapshot_date <> DATE '{CHURN_HOLDOUT_CUTOFF}')
, hold AS (SELECT * FROM scored WHERE snapshot_date = DATE '{CHURN_HOLDOUT_CUTOFF}')
"""

GRID_SQL = "(VALUES " + ", ".join(f"({j}, {t!r})" for j, t in enumerate(metrics.THRESHOLDS)) + ") g(j, threshold)"

F1_SQL = f"""
, f1t AS (
  SELECT g.j, g.threshold,
    SUM(CASE WHEN t.p >= g.threshold AND t.y = 1 THEN 1 ELSE 0 END) AS tp,
    SUM(CASE WHEN t.p >= g.threshold THEN 1 ELSE 0 END) AS pred_pos,
    SUM(t.y) AS positives
  FROM {GRID_SQL} CROSS JOIN train t GROUP BY g.j, g.threshold
)
, f1s AS (
  SELECT j, threshold, tp, pred_pos, positives,
    CASE WHEN pred_pos + positives > 0 THEN 2.0 * tp / (pred_pos + positives) ELSE 0.0 END AS f1,
    CASE WHEN pred_pos > 0 THEN tp / pred_pos ELSE 0.0 END AS precision,
    CASE WHEN positives > 0 THEN tp / positives ELSE 0.0 END AS recall
  FROM f1t
)
, best AS (SELECT threshold FROM f1s ORDER BY f1 DESC, j LIMIT 1)
"""


@register("churn_threshold_search", CHURN_SCORED_SQL + F1_SQL + """
SELECT j, threshold, CAST(tp AS BIGINT) AS tp, CAST(pred_pos AS BIGINT) AS pred_pos, CAST(positives AS BIGINT) AS positives,
  ROUND(f1, 6) AS f1, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall
FROM f1s
""")
def churn_threshold_search(spark, sf_dir):
    """F1 / precision / recall at 71 grid thresholds on the training snapshots."""
    train, _ = churn_frames(spark, sf_dir)
    t = metrics.f1_threshold_table(train)
    return _round_all(t.withColumns({"tp": F.col("tp").cast("long"), "pred_pos": F.col("pred_pos").cast("long"),
                                     "positives": F.col("positives").cast("long")}), skip=("threshold",))


def _threshold(train: DataFrame) -> float:
    return float(metrics.optimal_f1_threshold(train).first()["threshold"])


HOLD_METRICS_SQL = """
, hr AS (
  SELECT *, RANK() OVER (ORDER BY p) - 1 + (COUNT(*) OVER (PARTITION BY p) + 1) / 2 AS avg_rank,
    ROW_NUMBER() OVER (ORDER BY p DESC, customer_id) AS rn, COUNT(*) OVER () AS n
  FROM hold
)
, auc AS (
  SELECT (SUM(CASE WHEN y = 1 THEN avg_rank ELSE 0 END) - SUM(y) * (SUM(y) + 1) / 2.0)
         / (SUM(y) * (COUNT(*) - SUM(y))) AS roc_auc FROM hr
)
, dp AS (SELECT p, COUNT(*) AS c, SUM(y) AS pos FROM hold GROUP BY p)
, dpc AS (
  SELECT p, c, pos, SUM(c) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc,
    SUM(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpos,
    SUM(pos) OVER () AS tot_pos
  FROM dp
)
, ap AS (SELECT COALESCE(SUM(CASE WHEN tot_pos > 0 THEN (pos / tot_pos) * (cpos / cc) END), 0.0) AS pr_auc FROM dpc)
, conf AS (
  SELECT AVG((p - y) * (p - y)) AS brier_score,
    SUM(CASE WHEN p >= (SELECT threshold FROM best) AND y = 1 THEN 1 ELSE 0 END) AS tp,
    SUM(CASE WHEN p >= (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS pp,
    SUM(y) AS pos
  FROM hold
)
, topf AS (
  SELECT SUM(CASE WHEN rn <= GREATEST(1, FLOOR(n * 0.1)) THEN y END) AS y10,
    SUM(CASE WHEN rn <= GREATEST(1, FLOOR(n * 0.1)) THEN 1 ELSE 0 END) AS n10,
    SUM(CASE WHEN rn <= GREATEST(1, FLOOR(n * 0.2)) THEN y END) AS y20,
    SUM(y) AS ys, COUNT(*) AS nn
  FROM hr
)
SELECT ROUND(roc_auc, 6) AS roc_auc, ROUND(pr_auc, 6) AS pr_auc, ROUND(brier_score, 6) AS brier_score,
  ROUND(CASE WHEN pp + pos > 0 THEN 2.0 * tp / (pp + pos) ELSE 0.0 END, 6) AS f1,
  ROUND(CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END, 6) AS precision,
  ROUND(CASE WHEN pos > 0 THEN tp / pos ELSE 0.0 END, 6) AS recall,
  ROUND(CASE WHEN ys > 0 THEN (y10 / n10) / (ys / nn) ELSE 0.0 END, 6) AS lift_at_10pct,
  ROUND(y20 / GREATEST(1, ys), 6) AS recall_at_20pct,
  (SELECT threshold FROM best) AS threshold
FROM auc, ap, conf, topf
"""


HOLD_CTES, _HOLD_SELECT = HOLD_METRICS_SQL.split("\nSELECT ROUND(roc_auc", 1)


@register("churn_holdout_metrics", CHURN_SCORED_SQL + F1_SQL + HOLD_METRICS_SQL)
def churn_holdout_metrics(spark, sf_dir):
    """E1-E5 on the holdout cutoff at the training-optimal threshold."""
    threshold = kept(spark, sf_dir, "threshold", lambda: _threshold(churn_frames(spark, sf_dir)[0]))
    return kept(spark, sf_dir, "churn_holdout_metrics", lambda: materialize(_round_all(
        metrics.classification_metrics(hold_runs(spark, sf_dir), threshold), skip=("threshold",))))


@register("churn_calibration", CHURN_SCORED_SQL + """
, r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY p, customer_id) AS rn, COUNT(*) OVER () AS n FROM hold)
, d AS (SELECT *, CAST(GREATEST(0, CASE WHEN n > 1 THEN ((rn - 1) * 10 + (n - 1) - 1) // (n - 1) ELSE 0 END - 1)
                      AS INTEGER) AS decile FROM r)
SELECT decile, COUNT(*) AS customers, ROUND(AVG(p), 6) AS mean_predicted_probability,
  ROUND(AVG(y), 6) AS observed_churn_rate
FROM d GROUP BY decile
""")
def churn_calibration(spark, sf_dir):
    """Decile calibration table on the holdout."""
    return _round_all(metrics.calibration_table(hold_runs(spark, sf_dir)))


LIFT_VALUES = "(VALUES " + ", ".join(f"({c!r})" for c in metrics.LIFT_CHECKPOINTS) + ") v(population_pct)"


@register("churn_lift_curve", CHURN_SCORED_SQL + f"""
, r AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY p DESC, customer_id) AS rn, COUNT(*) OVER () AS n,
    SUM(y) OVER (ORDER BY p DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cy,
    SUM(y) OVER () AS ys
  FROM hold
)
SELECT v.population_pct, ROUND(r.cy / GREATEST(1, r.ys), 6) AS cumulative_gain,
  ROUND((r.cy / GREATEST(1, r.ys)) / (r.rn / r.n), 6) AS cumulative_lift
FROM {LIFT_VALUES} JOIN r ON r.rn = LEAST(r.n, GREATEST(1, CEIL(v.population_pct * r.n)))
""")
def churn_lift_curve(spark, sf_dir):
    """Cumulative gain and lift at ten population checkpoints."""
    return _round_all(metrics.lift_table(hold_runs(spark, sf_dir)), skip=("population_pct",))


VALUE_CTES = S.snapshot_sql([CLV_HOLDOUT_CUTOFF], clv_h=CLV_HORIZON_DAYS, name="vs") + """
, vsc AS (
  SELECT customer_id, CAST(future_gross_margin AS DOUBLE) AS y,
    GREATEST(GREATEST(0.0, 0.9 * CAST(gross_margin_12m AS DOUBLE) + 12.0 * CAST(sessions_90d AS DOUBLE)), 0.0) AS yhat
  FROM vs
)
, vrk AS (
  SELECT *, (RANK() OVER (ORDER BY y) - 1 + (COUNT(*) OVER (PARTITION BY y) + 1) / 2) / COUNT(*) OVER () AS ry,
    (RANK() OVER (ORDER BY yhat) - 1 + (COUNT(*) OVER (PARTITION BY yhat) + 1) / 2) / COUNT(*) OVER () AS rp
  FROM vsc
)
, vag AS (
  SELECT AVG(ABS(yhat - y)) AS mae, SQRT(AVG((yhat - y) * (yhat - y))) AS rmse, SUM((yhat - y) * (yhat - y)) AS sse,
    AVG(y) AS ybar, VAR_POP(y) AS vy, COUNT(*) AS n, CORR(ry, rp) AS rho
  FROM vrk
)
"""
VALUE_SELECT = """SELECT ROUND(mae, 6) AS mae, ROUND(rmse, 6) AS rmse,
  ROUND(CASE WHEN vy > 0 THEN 1.0 - sse / (vy * n) ELSE 0.0 END, 6) AS r2,
  ROUND(COALESCE(CASE WHEN isnan(rho) THEN NULL ELSE rho END, 0.0), 6) AS spearman_correlation,
  ROUND(mae / GREATEST(1.0, ybar), 6) AS normalized_mae
FROM vag
"""


@register("clv_holdout_metrics", VALUE_CTES + VALUE_SELECT)
def clv_holdout_metrics(spark, sf_dir):
    """Value-model metrics on predictions clipped at zero."""
    def build():
        snap = labelled_snapshots(spark, sf_dir, "clv").filter(
            F.col("snapshot_date") == F.lit(CLV_HOLDOUT_CUTOFF).cast("date"))
        scored = snap.select("customer_id", F.col("future_gross_margin").cast("double").alias("y"),
                             scores.rule_value_prediction().alias("yhat"))
        return materialize(_round_all(metrics.regression_metrics(scored)))

    return kept(spark, sf_dir, "clv_holdout_metrics", build)


@register("fairness_audit", CHURN_SCORED_SQL + F1_SQL + """
, lg AS (
  SELECT customer_id, y, p, 'region' AS audit_attribute, region AS audit_group FROM hold
  UNION ALL
  SELECT customer_id, y, p, 'age_band' AS audit_attribute, age_band AS audit_group FROM hold
)
, lr AS (
  SELECT *, RANK() OVER (PARTITION BY audit_attribute, audit_group ORDER BY p) - 1
      + (COUNT(*) OVER (PARTITION BY audit_attribute, audit_group, p) + 1) / 2 AS ar
  FROM lg
)
, g AS (
  SELECT audit_attribute, audit_group, COUNT(*) AS customers, AVG(y) AS observed_churn_rate,
    AVG(p) AS average_predicted_risk, SUM(y) AS pos, COUNT(*) - SUM(y) AS neg,
    SUM(CASE WHEN y = 1 THEN ar ELSE 0 END) AS rs,
    SUM(CASE WHEN p >= (SELECT threshold FROM best) AND y = 1 THEN 1 ELSE 0 END) AS tp
  FROM lr GROUP BY audit_attribute, audit_group
)
SELECT audit_attribute, audit_group, customers, ROUND(observed_churn_rate, 6) AS observed_churn_rate,
  ROUND(average_predicted_risk, 6) AS average_predicted_risk,
  ROUND(CASE WHEN pos > 0 AND neg > 0 THEN (rs - pos * (pos + 1) / 2.0) / (pos * neg) END, 6) AS roc_auc,
  ROUND(tp / GREATEST(1, pos), 6) AS true_positive_rate
FROM g WHERE customers >= 25
""")
def fairness_audit(spark, sf_dir):
    """Fairness by region and age band on the holdout at the tuned threshold."""
    train, hold = churn_frames(spark, sf_dir)
    scored = hold.select("customer_id", "region", "age_band", F.col("y").alias("churn_90d"),
                         F.col("p").alias("probability"))
    return _round_all(fairness.fairness_audit(scored, _threshold(train)))


def _psi_sql() -> str:
    ref_long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM hold" for f in FEATURE_COLUMNS)
    cur_long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM prod" for f in FEATURE_COLUMNS)
    probs = ", ".join(repr(i / 10) for i in range(11))
    return S.snapshot_sql([ANALYSIS_DATE], name="prod") + f"""
, rl AS ({ref_long})
, cl AS ({cur_long})
, ed AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS e, COUNT(*) AS nref,
    AVG(value) AS reference_mean
  FROM rl GROUP BY feature
)
, ed2 AS (
  SELECT feature, nref, reference_mean, len(e) AS ne,
    CASE WHEN len(e) >= 3 THEN e[2:len(e) - 1] ELSE [] END AS inner_e
  FROM ed
)
, rb AS (
  SELECT r.feature, len(list_filter(d.inner_e, lambda x: x < r.value)) AS bin, COUNT(*) AS c
  FROM rl r JOIN ed2 d ON r.feature = d.feature GROUP BY 1, 2
)
, cb AS (
  SELECT r.feature, len(list_filter(d.inner_e, lambda x: x < r.value)) AS bin, COUNT(*) AS c
  FROM cl r JOIN ed2 d ON r.feature = d.feature GROUP BY 1, 2
)
, cstat AS (SELECT feature, COUNT(*) AS ncur, AVG(value) AS production_mean FROM cl GROUP BY feature)
, sp AS (SELECT feature, nref, reference_mean, ne, UNNEST(range(0, len(inner_e) + 1)) AS bin FROM ed2)
, tm AS (
  SELECT s.feature, s.ne, s.reference_mean, x.production_mean,
    GREATEST(COALESCE(r.c, 0) / s.nref, 1e-6) AS rp, GREATEST(COALESCE(c.c, 0) / x.ncur, 1e-6) AS cp
  FROM sp s LEFT JOIN rb r ON s.feature = r.feature AND s.bin = r.bin
  LEFT JOIN cb c ON s.feature = c.feature AND s.bin = c.bin
  LEFT JOIN cstat x ON s.feature = x.feature
)
, ps AS (
  SELECT feature, CASE WHEN MIN(ne) >= 3 THEN SUM((cp - rp) * ln(cp / rp)) ELSE 0.0 END AS psi,
    MIN(reference_mean) AS reference_mean, MIN(production_mean) AS production_mean
  FROM tm GROUP BY feature
)
SELECT feature, ROUND(psi, 6) AS psi,
  CASE WHEN psi < 0.10 THEN 'Stable' WHEN psi < 0.25 THEN 'Watch' ELSE 'Investigate' END AS status,
  ROUND(reference_mean, 6) AS reference_mean, ROUND(production_mean, 6) AS production_mean
FROM ps
"""


@register("drift_monitoring", CHURN_SCORED_SQL + _psi_sql())
def drift_monitoring(spark, sf_dir):
    """PSI of the 16 features, holdout snapshot vs production."""
    _, hold = churn_frames(spark, sf_dir)
    prod = _production_snapshot(spark, sf_dir)
    return _round_all(drift.drift_report(hold, prod))


@register("worst_drift_feature", CHURN_SCORED_SQL + _psi_sql().replace(
    "SELECT feature, ROUND(psi, 6) AS psi,", "SELECT * FROM (SELECT feature, ROUND(psi, 6) AS psi,", 1)
    + ") ORDER BY psi DESC, feature LIMIT 1")
def worst_drift_feature(spark, sf_dir):
    """The feature with the largest PSI."""
    from ..operators.reports import worst_drift_feature as worst

    return worst(drift_monitoring(spark, sf_dir))
