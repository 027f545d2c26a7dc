"""The trained chain: train, choose, calibrate, score production, decide, explain.

Candidates are compared on the holdout cutoff; the churn champion is calibrated on class-balanced
folds and scores the production snapshot, the value champion scores it too, and both
feed the same decision and 360 operators as the closed-form scores.  Model values differ
between libraries, so the SQL side checks gates: row counts, probabilities in [0, 1],
the champion having the best selection score, the budget, and additivity.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (ANALYSIS_DATE, CAMPAIGN_BUDGET, CHURN_HOLDOUT_CUTOFF, CHURN_HORIZON_DAYS, CHURN_TRAIN_CUTOFFS,
                         CLV_HOLDOUT_CUTOFF, CLV_HORIZON_DAYS, CLV_TRAIN_CUTOFFS, FEATURE_COLUMNS)
from ..operators import attribution, decision, metrics, models
from ..operators.contracts import check_label_windows
from ..operators.reports import top_risk_drilldown as drilldown
from ..operators.scores import churn_score_table, rule_churn_probability, value_score_table
from ..session import ensure_checkpoint_dir, materialize
from ..sources.files import head_columns
from . import sql_parts as S
from .catalog import register
from .q_decision import production
from .q_models import _round_all, churn_frames, labelled_snapshots

EXPLAINED, BACKGROUND = 60, 24   # rows explained and background rows: the feature's sizes
COMPARISON = ["model", "roc_auc", "pr_auc", "brier_score", "f1", "precision", "recall", "lift_at_10pct",
              "recall_at_20pct", "threshold", "selection_score"]
VALUE_COMPARISON = ["model", "mae", "rmse", "r2", "spearman_correlation", "normalized_mae", "selection_score"]


def churn_train_test(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    check_label_windows(CHURN_TRAIN_CUTOFFS, CHURN_HORIZON_DAYS, CHURN_HOLDOUT_CUTOFF)
    train, hold = churn_frames(spark, sf_dir)
    train = models.add_balanced_weights(models.prepare(train, "y").drop("y", "p"))
    test = models.prepare(hold, "y").drop("y", "p").withColumn("weight", F.lit(1.0))
    return materialize(train), materialize(test)


class TrainedChain:
    """Every stage is built on first use and kept for the session."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    def side_by_side(self, *stages: str) -> None:
        """Build stages of both champions, which share only their inputs, as concurrent jobs."""
        _ = self.production_features, self.churn_data
        with ThreadPoolExecutor(max_workers=len(stages)) as pool:
            list(pool.map(lambda name: getattr(self, name), stages))

    @cached_property
    def churn_data(self):
        return churn_train_test(self.spark, self.sf_dir)

    @cached_property
    def churn_comparison(self) -> DataFrame:
        train, test = self.churn_data
        return materialize(models.compare_classifiers(train, test)[0])

    @cached_property
    def churn_champion(self) -> str:
        return self.churn_comparison.orderBy(F.col("selection_score").desc(), "model").first()["model"]

    @cached_property
    def churn_model(self) -> models.CalibratedClassifier:
        train, _ = self.churn_data
        data = models.assembled(train)
        name = self.churn_champion
        model = models.CalibratedClassifier(lambda n: models.classifier_candidates(models.ClassifierSpec(), n)[name])
        model.fit(data, ["customer_id", "snapshot_date"])
        data.unpersist()
        return model

    @cached_property
    def churn_threshold(self) -> float:
        train, _ = self.churn_data
        fitted = self.churn_model.predict(train).withColumnRenamed("label", "y")
        return float(metrics.optimal_f1_threshold(fitted).first()["threshold"])

    @cached_property
    def calibrated_row(self) -> DataFrame:
        _, test = self.churn_data
        row = metrics.classification_metrics(self.churn_model.predict(test).withColumnRenamed("label", "y"), self.churn_threshold)
        return row.withColumn("model", F.lit(f"{self.churn_champion} (calibrated champion)")).withColumn(
            "selection_score", metrics.selection_score_classifier(F.col("roc_auc"), F.col("pr_auc"), F.col("brier_score")))

    @cached_property
    def value_fit(self):
        check_label_windows(CLV_TRAIN_CUTOFFS, CLV_HORIZON_DAYS, CLV_HOLDOUT_CUTOFF)
        data = materialize(models.prepare(labelled_snapshots(self.spark, self.sf_dir, "clv"), "future_gross_margin"))
        hold = F.col("snapshot_date") == F.lit(CLV_HOLDOUT_CUTOFF).cast("date")
        rows, fitted = models.compare_regressors(data.filter(~hold), data.filter(hold))
        return materialize(rows), fitted

    @cached_property
    def value_champion(self) -> str:
        return self.value_fit[0].orderBy(F.col("selection_score").desc(), "model").first()["model"]

    @property
    def value_model(self):
        return self.value_fit[1][self.value_champion]

    @cached_property
    def production_features(self) -> DataFrame:
        return models.prepare(production(self.spark, self.sf_dir).snapshot)

    @cached_property
    def churn_scores(self) -> DataFrame:
        return materialize(churn_score_table(self.churn_model.predict(self.production_features, "churn_probability")))

    @cached_property
    def value_scores(self) -> DataFrame:
        scored = self.value_model.transform(self.production_features).withColumnRenamed("prediction", "predicted_clv_12m")
        return materialize(value_score_table(scored))

    @cached_property
    def targets(self) -> DataFrame:
        self.side_by_side("churn_scores", "value_scores")
        p = production(self.spark, self.sf_dir)
        return materialize(decision.recommend_campaigns(p.snapshot, p.rfm, self.value_scores, self.churn_scores))

    @cached_property
    def c360(self) -> DataFrame:
        p = production(self.spark, self.sf_dir)
        return decision.build_customer_360(p.snapshot, p.rfm, self.value_scores, self.churn_scores, self.targets)

    @cached_property
    def background(self) -> DataFrame:
        return attribution.seeded_sample(self.churn_data[0], BACKGROUND, ("customer_id", "snapshot_date"))

    @cached_property
    def dormant(self) -> DataFrame:
        return attribution.most_dormant(self.production_features, EXPLAINED)

    @cached_property
    def attributions(self) -> DataFrame:
        """The calibrated champion on the most dormant customers."""
        return materialize(attribution.antithetic_attribution(self.churn_model.predict, self.dormant, self.background))

    @cached_property
    def rule_attributions(self) -> DataFrame:
        """The closed-form score against the median row of the background."""
        return materialize(attribution.permutation_attribution(
            lambda d: d.withColumn("p", rule_churn_probability()), self.dormant, attribution.baseline_medians(self.background)))


_CHAINS: dict[tuple[str, str], TrainedChain] = {}


def chain(spark, sf_dir) -> TrainedChain:
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    if key not in _CHAINS:
        _CHAINS[key] = TrainedChain(spark, sf_dir)
    return _CHAINS[key]


@register("churn_model_comparison")
def churn_model_comparison(spark, sf_dir):
    """The three candidates on the holdout cutoff and the
    calibrated champion, ordered by selection score (rank)."""
    c = chain(spark, sf_dir)
    rows = c.calibrated_row.select(F.lit(0).alias("rank"), *COMPARISON)
    order = F.row_number().over(_one_group("selection_score"))
    return _round_all(rows.unionByName(c.churn_comparison.select(order.alias("rank"), *COMPARISON)))


def _one_group(column: str):
    from pyspark.sql import Window

    return Window.partitionBy().orderBy(F.col(column).desc(), F.col("model"))  # one row per candidate


@register("clv_model_comparison")
def clv_model_comparison(spark, sf_dir):
    """The three value candidates, ordered by selection score (rank)."""
    rows = chain(spark, sf_dir).value_fit[0]
    return _round_all(rows.select(F.row_number().over(_one_group("selection_score")).alias("rank"), *VALUE_COMPARISON))


@register("churn_model_scores")
def churn_model_scores(spark, sf_dir):
    """Production scores of the calibrated champion."""
    return _round_all(chain(spark, sf_dir).churn_scores)


@register("clv_model_scores")
def clv_model_scores(spark, sf_dir):
    """Production scores of the value champion, with percentile and band."""
    return _round_all(chain(spark, sf_dir).value_scores)


@register("trained_campaign_targets")
def trained_campaign_targets(spark, sf_dir):
    """The campaign decision on the champions' scores, inputs validated."""
    return _round_all(chain(spark, sf_dir).targets)


@register("trained_customer_360")
def trained_customer_360(spark, sf_dir):
    """The 360 table with the champions' scores and decision."""
    return _round_all(chain(spark, sf_dir).c360)


@register("trained_chain_gates", S.snapshot_sql([ANALYSIS_DATE], name="prod") + """
, n AS (SELECT COUNT(*) AS n FROM prod)
SELECT * FROM (
  SELECT 'churn_scores_rows' AS gate, n AS value FROM n
  UNION ALL SELECT 'value_scores_rows', n FROM n
  UNION ALL SELECT 'decision_rows', n FROM n
  UNION ALL SELECT 'customer_360_rows', n FROM n
  UNION ALL SELECT 'probabilities_outside_0_1', 0
  UNION ALL SELECT 'negative_values', 0
  UNION ALL SELECT 'churn_candidates', 3
  UNION ALL SELECT 'value_candidates', 3
  UNION ALL SELECT 'champions_without_best_score', 0
  UNION ALL SELECT 'budget_exceeded', 0
  UNION ALL SELECT 'explained_customers', LEAST(n, 60) FROM n
  UNION ALL SELECT 'additivity_error_above_1e_6', 0
)
""")
def trained_chain_gates(spark, sf_dir):
    """Counts read from the tables of the trained chain."""
    c = chain(spark, sf_dir)
    c.side_by_side("churn_scores", "value_scores")
    one = lambda df, name, e: df.agg(e.cast("long").alias("value")).select(F.lit(name).alias("gate"), "value")
    rows = F.count(F.lit(1))

    def best(comparison, champion):
        return F.when(F.max_by("model", F.struct("selection_score")) == F.lit(champion), 0).otherwise(1)

    churn, value = c.churn_comparison, c.value_fit[0]
    best_scores = churn.agg(best(churn, c.churn_champion).alias("x")).unionByName(value.agg(best(value, c.value_champion).alias("x")))
    gates = [
        one(c.churn_scores, "churn_scores_rows", rows), one(c.value_scores, "value_scores_rows", rows),
        one(c.targets, "decision_rows", rows), one(c.c360, "customer_360_rows", rows),
        one(c.churn_scores, "probabilities_outside_0_1", F.count_if(~F.col("churn_probability").between(0, 1))),
        one(c.value_scores, "negative_values", F.count_if(F.col("predicted_clv_12m") < 0)),
        one(churn, "churn_candidates", rows), one(value, "value_candidates", rows),
        one(best_scores, "champions_without_best_score", F.sum("x")),
        one(c.targets, "budget_exceeded", F.when(F.sum("allocated_budget") > CAMPAIGN_BUDGET, 1).otherwise(0)),
        one(c.attributions.select("customer_id").distinct(), "explained_customers", rows),
        one(attribution.additivity_error(c.attributions), "additivity_error_above_1e_6",
            F.count_if(F.col("additivity_mean_absolute_error") > 1e-6)),
    ]
    out = gates[0]
    for g in gates[1:]:
        out = out.unionByName(g)
    return out


@register("model_bundle_info")
def model_bundle_info(spark, sf_dir):
    """Both champions saved with threshold, features and snapshot, loaded
    back, and scoring 50 rows alike."""
    c = chain(spark, sf_dir)
    c.side_by_side("churn_scores", "value_fit")
    root = ensure_checkpoint_dir(spark).rstrip("/") + f"/bundles/{spark.sparkContext.applicationId}"
    shared = {"production_snapshot": ANALYSIS_DATE, "feature_columns": FEATURE_COLUMNS}
    members, sigmoids = models.calibrated_bundle(c.churn_model)
    models.save_bundle(members, f"{root}/churn", {**shared, **sigmoids, "champion": c.churn_champion, "threshold": c.churn_threshold})
    models.save_bundle([c.value_model], f"{root}/value", {**shared, "champion": c.value_champion, "threshold": None})
    sample = head_columns(c.production_features.orderBy("customer_id"), ["customer_id", *FEATURE_COLUMNS], 50)
    churn, churn_meta = models.load_bundle(f"{root}/churn")
    value, value_meta = models.load_bundle(f"{root}/value")
    loaded = models.calibrated_from(churn, churn_meta).predict(sample, "p").join(
        c.churn_scores.select("customer_id", "churn_probability"), "customer_id")
    same = loaded.agg(F.count_if(F.abs(F.col("p") - F.col("churn_probability")) < 1e-9)).first()[0]
    finite = models.finite_count(value[0].transform(sample), "prediction")
    rows = [("churn", churn_meta["champion"], churn_meta["production_snapshot"], len(churn_meta["feature_columns"]),
             churn_meta["threshold"], int(same)),
            ("value", value_meta["champion"], value_meta["production_snapshot"], len(value_meta["feature_columns"]), None, finite)]
    return spark.createDataFrame(rows, "bundle string, champion string, production_snapshot string, feature_count int, "
                                       "threshold double, rows_scored_alike int")


@register("bundle_roundtrip", S.snapshot_sql([ANALYSIS_DATE], name="prod") + f"""
, s AS (SELECT customer_id FROM prod ORDER BY customer_id LIMIT 50)
SELECT field, CAST(value AS VARCHAR) AS value FROM (
  SELECT 'champion' AS field, 'Logistic Regression' AS value
  UNION ALL SELECT 'production_snapshot', '{ANALYSIS_DATE}'
  UNION ALL SELECT 'feature_columns', '{",".join(FEATURE_COLUMNS)}'
  UNION ALL SELECT 'members', '1'
  UNION ALL SELECT 'threshold', '0.5'
  UNION ALL SELECT 'nested_snapshot_rows', CAST((SELECT COUNT(*) FROM prod) AS VARCHAR)
  UNION ALL SELECT 'sample_rows', CAST((SELECT COUNT(*) FROM s) AS VARCHAR)
  UNION ALL SELECT 'sample_id_sum', CAST((SELECT SUM(customer_id) FROM s) AS VARCHAR)
  UNION ALL SELECT 'rows_scored_alike', CAST((SELECT COUNT(*) FROM s) AS VARCHAR)
)
""")
def bundle_roundtrip(spark, sf_dir):
    """A fitted model saved with its nested JSON record, both read back;
    the record's fields, the sample of 50 rows, and rows scored alike by the loaded model."""
    c = chain(spark, sf_dir)
    train, _ = c.churn_data
    data = models.assembled(train)
    n = float(data.count())
    model = models.fit_pipeline(models.classifier_candidates(models.ClassifierSpec(), n)["Logistic Regression"], data)
    data.unpersist()
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/bundles/{spark.sparkContext.applicationId}/roundtrip-{uuid.uuid4().hex}"
    models.save_bundle([model], path, {"champion": "Logistic Regression", "production_snapshot": ANALYSIS_DATE, "feature_columns": FEATURE_COLUMNS,
                                       "threshold": 0.5, "counts": {"snapshot_rows": c.production_features.count()}})
    members, meta = models.load_bundle(path)
    sample = materialize(head_columns(c.production_features.orderBy("customer_id"), ["customer_id", *FEATURE_COLUMNS], 50))
    one, two = (models.positive_probability(m, sample, name).select("customer_id", name) for m, name in ((model, "a"), (members[0], "b")))
    alike = one.join(two, "customer_id").where(F.abs(F.col("a") - F.col("b")) < 1e-12).count()
    held = sample.agg(F.count(F.lit(1)), F.sum("customer_id")).first()
    fields = [("champion", meta["champion"]), ("production_snapshot", meta["production_snapshot"]), ("feature_columns", ",".join(meta["feature_columns"])),
              ("members", meta["members"]), ("threshold", meta["threshold"]), ("nested_snapshot_rows", meta["counts"]["snapshot_rows"]),
              ("sample_rows", held[0]), ("sample_id_sum", held[1]), ("rows_scored_alike", alike)]
    return spark.createDataFrame([(k, str(v)) for k, v in fields], "field string, value string")


@register("attribution_global_importance")
def attribution_global_importance(spark, sf_dir):
    """Attribution of the calibrated champion on the 60
    most dormant customers; global importance per feature."""
    return _round_all(attribution.global_importance(chain(spark, sf_dir).attributions))


@register("attribution_local_reasons")
def attribution_local_reasons(spark, sf_dir):
    """Top-5 reason codes per explained customer and the additivity error."""
    phi = chain(spark, sf_dir).attributions
    err = attribution.additivity_error(phi)
    return _round_all(attribution.local_reasons(phi).withColumn(
        "additivity_mean_absolute_error", err.select("additivity_mean_absolute_error").scalar()),
        skip=("additivity_mean_absolute_error",))


@register("top_risk_drilldown")
def top_risk_drilldown(spark, sf_dir):
    """Reason codes of the customer whom the explained model ranks riskiest."""
    c = chain(spark, sf_dir)
    return _round_all(drilldown(c.churn_scores, attribution.local_reasons(c.attributions)))


# ---- the closed-form score has closed-form attributions ------------------------------
# it depends on recency alone, so recency carries the whole difference to the baseline
_RULE = "LEAST(GREATEST(CAST({0} AS DOUBLE) / (CAST({0} AS DOUBLE) + 120.0), 0.02), 0.98)"


@register("rule_attribution_reasons", S.snapshot_sql([ANALYSIS_DATE], name="prod") + f"""
, r AS (SELECT customer_id, {_RULE.format("recency_days")} AS p FROM prod ORDER BY p DESC, customer_id LIMIT {EXPLAINED})
SELECT customer_id, 1 AS rank, 'recency_days' AS feature, ROUND(p, 6) AS churn_probability, TRUE AS additive,
  15 AS features_without_effect
FROM r
""")
def rule_attribution_reasons(spark, sf_dir):
    """Attributions of the closed-form score: the first reason is recency,
    nothing else has an effect, and base plus attributions is the probability."""
    phi = chain(spark, sf_dir).rule_attributions
    per = phi.groupBy("customer_id").agg(
        F.max("churn_probability").alias("churn_probability"),
        (F.abs(F.max("base_value") + F.sum("shap_value") - F.max("churn_probability")) < 1e-9).alias("additive"),
        F.count_if((F.col("feature") != "recency_days") & (F.abs("shap_value") < 1e-12)).alias("features_without_effect"))
    first = attribution.local_reasons(phi, k=1).select("customer_id", "rank", "feature")
    return _round_all(first.join(per, "customer_id"))


@register("calibration_folds", S.snapshot_sql(CHURN_TRAIN_CUTOFFS, churn_h=CHURN_HORIZON_DAYS, name="tr") + """
, f AS (SELECT customer_id, churn_90d, (ROW_NUMBER() OVER (PARTITION BY churn_90d ORDER BY customer_id, snapshot_date) - 1) % 3 AS fold FROM tr)
SELECT CAST(fold AS INTEGER) AS fold, CAST(churn_90d AS DOUBLE) AS label, COUNT(*) AS training_rows, CAST(SUM(customer_id) AS BIGINT) AS customer_id_sum
FROM f GROUP BY fold, churn_90d
""")
def calibration_folds(spark, sf_dir):
    """Rows of each class in every calibration fold."""
    train, _ = chain(spark, sf_dir).churn_data
    folds = models.stratified_folds(train.select("customer_id", "snapshot_date", "label"), ["customer_id", "snapshot_date"], 3)
    return folds.groupBy(F.col("_fold").alias("fold"), "label").agg(
        F.count(F.lit(1)).alias("training_rows"), F.sum("customer_id").alias("customer_id_sum"))


@register("class_weights", S.snapshot_sql(CHURN_TRAIN_CUTOFFS, churn_h=CHURN_HORIZON_DAYS, name="tr") + """
SELECT CAST(churn_90d AS DOUBLE) AS label, COUNT(*) AS customers,
  ROUND((SELECT CAST(COUNT(*) AS DOUBLE) FROM tr) / (2.0 * COUNT(*)), 6) AS weight
FROM tr GROUP BY churn_90d
""")
def class_weights(spark, sf_dir):
    """M6: balanced class weights of the churn training rows."""
    train, _ = chain(spark, sf_dir).churn_data
    return _round_all(train.groupBy("label", "weight").agg(F.count(F.lit(1)).alias("customers")).select("label", "customers", "weight"))
