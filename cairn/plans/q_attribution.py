"""Attribution of a closed-form score of two features, checked by SQL.

The score is a product of a function of recency and one of tenure, so the two interact.
With two features that matter, one order and its reverse give the exact Shapley values,
whatever the places of the other features in the order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..constants import ANALYSIS_DATE, CHURN_HORIZON_DAYS, CHURN_TRAIN_CUTOFFS, FEATURE_COLUMNS
from ..operators import attribution
from ..operators.reports import top_risk_drilldown as drilldown
from ..session import materialize
from . import sql_parts as S
from .catalog import register
from .q_models import _round_all
from .q_trained import BACKGROUND, EXPLAINED, chain

_P = "(CAST({r} AS DOUBLE) / (CAST({r} AS DOUBLE) + 120.0)) * (0.5 + 500.0 / (1000.0 + CAST({t} AS DOUBLE)))"


def two_feature_score(df):
    r, t = F.col("recency_days").cast("double"), F.col("tenure_days").cast("double")
    return df.withColumn("p", (r / (r + 120.0)) * (0.5 + 500.0 / (1000.0 + t)))


_SAMPLE = S.snapshot_sql(CHURN_TRAIN_CUTOFFS, churn_h=CHURN_HORIZON_DAYS, name="tr") + f"""
, bg AS (SELECT * FROM tr ORDER BY md5(CAST(customer_id AS VARCHAR) || '|' || CAST(snapshot_date AS VARCHAR) || '|{attribution.SEED}'),
         customer_id, snapshot_date LIMIT {BACKGROUND})
"""
_PHI = _SAMPLE + S.snapshot_sql([ANALYSIS_DATE], name="prod") + f"""
, x AS (SELECT customer_id, recency_days AS r, tenure_days AS t FROM prod ORDER BY recency_days DESC, customer_id LIMIT {EXPLAINED})
, v AS (SELECT x.customer_id, x.r, x.t, AVG({_P.format(r="bg.recency_days", t="bg.tenure_days")}) AS v00,
    AVG({_P.format(r="x.r", t="bg.tenure_days")}) AS v10, AVG({_P.format(r="bg.recency_days", t="x.t")}) AS v01,
    MAX({_P.format(r="x.r", t="x.t")}) AS v11 FROM x, bg GROUP BY x.customer_id, x.r, x.t)
, two AS (SELECT customer_id, 'recency_days' AS feature, CAST(r AS DOUBLE) AS feature_value, (v10 - v00 + v11 - v01) / 2 AS phi, v00, v11 FROM v
  UNION ALL SELECT customer_id, 'tenure_days', CAST(t AS DOUBLE), (v01 - v00 + v11 - v10) / 2, v00, v11 FROM v)
"""
_DIRECTION = "CASE WHEN ROUND(phi, 12) > 0 THEN 'Increases risk' ELSE 'Decreases risk' END AS direction"
_CACHE: dict = {}


def _phi(spark, sf_dir):
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    if key not in _CACHE:
        c = chain(spark, sf_dir)
        _CACHE[key] = materialize(attribution.antithetic_attribution(two_feature_score, c.dormant, c.background))
    return _CACHE[key]


@register("attribution_background", _SAMPLE + "SELECT customer_id, snapshot_date FROM bg")
def attribution_background(spark, sf_dir):
    """The background rows of the explanations, a repeatable sample."""
    return chain(spark, sf_dir).background.select("customer_id", "snapshot_date")


@register("attribution_background_medians", _SAMPLE + "SELECT " + ", ".join(
    f"ROUND(quantile_cont(CAST(COALESCE({c}, 0) AS DOUBLE), 0.5), 6) AS {c}" for c in FEATURE_COLUMNS) + " FROM bg")
def attribution_background_medians(spark, sf_dir):
    """Column-wise medians of the background."""
    return _round_all(attribution.baseline_medians(chain(spark, sf_dir).background))


@register("two_feature_attributions", _PHI + f"""
SELECT customer_id, feature, ROUND(feature_value, 6) AS feature_value, ROUND(phi, 6) AS shap_value, ROUND(v00, 6) AS base_value,
  ROUND(v11, 6) AS churn_probability, {_DIRECTION}, 14 AS features_without_effect FROM two
""")
def two_feature_attributions(spark, sf_dir):
    """Both features' attributions on the most dormant customers;
    no other feature has any."""
    phi = _phi(spark, sf_dir)
    active = phi.where(F.col("feature").isin("recency_days", "tenure_days"))
    rest = phi.groupBy("customer_id").agg(F.count_if(~F.col("feature").isin("recency_days", "tenure_days") & (F.abs("shap_value") < 1e-12)).alias("features_without_effect"))
    return _round_all(attribution.local_reasons(active, k=2).drop("rank").join(rest, "customer_id"))


@register("two_feature_importance", _PHI + f"""
, g AS (SELECT feature, AVG(ABS(phi)) AS m, AVG(phi) AS s FROM two GROUP BY feature
  UNION ALL SELECT f, 0.0, 0.0 FROM (VALUES {", ".join(f"('{c}')" for c in FEATURE_COLUMNS if c not in ("recency_days", "tenure_days"))}) o(f))
SELECT feature, ROUND(m, 6) AS mean_abs_shap, ROUND(s, 6) AS mean_shap, ROUND(m / (SELECT SUM(m) FROM g), 6) AS importance_share FROM g
""")
def two_feature_importance(spark, sf_dir):
    """Global importance per feature."""
    return _round_all(attribution.global_importance(_phi(spark, sf_dir)))


@register("two_feature_drilldown", _PHI + f"""
, top AS (SELECT customer_id FROM v ORDER BY v11 DESC, customer_id LIMIT 1)
, every AS (SELECT t.customer_id, t.feature, t.feature_value, t.phi, t.v00, t.v11 FROM two t JOIN top USING (customer_id)
  UNION ALL SELECT customer_id, o.f, o.x, 0.0, v00, v11 FROM v JOIN top USING (customer_id) JOIN (
    {" UNION ALL ".join(f"SELECT customer_id AS c, '{c}' AS f, CAST(COALESCE({c}, 0) AS DOUBLE) AS x FROM prod" for c in FEATURE_COLUMNS if c not in ("recency_days", "tenure_days"))}
  ) o ON o.c = v.customer_id)
SELECT customer_id, feature, ROUND(feature_value, 6) AS feature_value, ROUND(phi, 6) AS shap_value, ROUND(v00, 6) AS base_value,
  ROUND(v11, 6) AS churn_probability, {_DIRECTION}, CAST(ROW_NUMBER() OVER (ORDER BY ROUND(ABS(phi), 12) DESC, feature) AS INTEGER) AS rank
FROM every QUALIFY ROW_NUMBER() OVER (ORDER BY ROUND(ABS(phi), 12) DESC, feature) <= 5
""")
def two_feature_drilldown(spark, sf_dir):
    """The top reasons of the explained customer with the highest score."""
    phi = _phi(spark, sf_dir)
    scores = phi.groupBy("customer_id").agg(F.first("churn_probability").alias("churn_probability"))
    return _round_all(drilldown(scores, attribution.local_reasons(phi)))
