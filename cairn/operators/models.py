"""Churn and value models on ``pyspark.ml``: candidates, class weights, sigmoid
calibration on class-balanced folds, comparison and champion choice, batch scoring and model
persistence.  Training and scoring are data-parallel; the driver only loops over
the (three) candidate estimators and collects metric rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import FEATURE_COLUMNS
from ..functions.ranking import ordered_running
from ..session import materialize
from ..sources.files import read_json_record, write_json_record
from . import metrics
from .boosting import BoostingSpec, HistogramBoosting
from .forest import ForestSpec, SampledForest, SampledForestModel
from .snapshot import feature_vector_columns

SEED = 11
ROUNDING = 1e-12  # relative error of a sum over rows
ROWS_PER_PARTITION = 50_000  # training rows of one task; a small table trains in one


# --- fixed values: hyper-parameters of the candidates --------------------------------
@dataclass
class ClassifierSpec:
    logistic_c: float = 0.75
    rf_trees: int = 260
    rf_depth: int = 14
    rf_min_leaf: int = 12
    sampled: bool = True        # per-tree balanced subsamples (operators.forest) in place of one weight a class
    boosting: BoostingSpec = field(default_factory=lambda: BoostingSpec(
        "log_loss", learning_rate=0.055, max_iter=220, max_leaves=25, min_leaf=24, l2=0.75))


@dataclass
class RegressorSpec:
    ridge_alpha: float = 18.0
    rf_trees: int = 240
    rf_depth: int = 14
    rf_min_leaf: int = 10
    rf_feature_fraction: float = 0.8
    sampled: bool = True
    boosting: BoostingSpec = field(default_factory=lambda: BoostingSpec(
        "squared_error", learning_rate=0.055, max_iter=230, max_leaves=25, min_leaf=24, l2=1.0))


def prepare(df: DataFrame, label: str | None = None) -> DataFrame:
    """16 double features (nulls -> 0) and an optional double ``label``."""
    out = feature_vector_columns(df)
    if label is not None:
        out = out.withColumn("label", F.col(label).cast("double"))
    return out


def add_balanced_weights(train: DataFrame) -> DataFrame:
    """M6: weight = n / (2 * n_class) (two scalars from one aggregate)."""
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).first()
    n, pos = float(row["n"]), float(row["pos"] or 0.0)
    neg = n - pos
    w_pos = n / (2.0 * pos) if pos else 1.0
    w_neg = n / (2.0 * neg) if neg else 1.0
    return train.withColumn("weight", F.when(F.col("label") == 1.0, w_pos).otherwise(w_neg))


#: rows keep their node between levels, and a level of many trees is one pass
_TREES = {"cacheNodeIds": True, "checkpointInterval": 20, "maxMemoryInMB": 1024}


def forest_spec(spec: ClassifierSpec | RegressorSpec) -> ForestSpec:
    """The forest of a spec, with every tree's classes weighed by its own sample."""
    if isinstance(spec, ClassifierSpec):
        return ForestSpec("classify", spec.rf_trees, spec.rf_depth, spec.rf_min_leaf, "sqrt", True, seed=SEED)
    return ForestSpec("regress", spec.rf_trees, spec.rf_depth, spec.rf_min_leaf, spec.rf_feature_fraction, seed=SEED)


def assembled(train: DataFrame) -> DataFrame:
    """``train`` with its feature vector, kept for the many passes of the candidates, in as
    many partitions as its rows need."""
    n = max(1, -(-train.count() // ROWS_PER_PARTITION))
    return _assembler().transform(train).repartition(n, "customer_id", "snapshot_date").persist()


def fit_pipeline(pipe: Pipeline, data: DataFrame) -> PipelineModel:
    """Fit ``pipe`` on a frame that ``assembled`` made; the model assembles its own input."""
    assembler, *rest = pipe.getStages()
    return PipelineModel([assembler, *Pipeline(stages=rest).fit(data).stages])


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features", handleInvalid="keep")


def classifier_candidates(spec: ClassifierSpec, n_train: float) -> dict[str, Pipeline]:
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    logistic = LogisticRegression(featuresCol="scaled", labelCol="label", weightCol="weight", maxIter=200,
                                  regParam=1.0 / (spec.logistic_c * max(n_train, 1.0)), elasticNetParam=0.0)
    if spec.sampled:
        forest = SampledForest(forest_spec(spec))
    else:
        forest = RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=spec.rf_trees,
                                        maxDepth=spec.rf_depth, minInstancesPerNode=spec.rf_min_leaf,
                                        featureSubsetStrategy="sqrt", seed=SEED, **_TREES)
    boosted = HistogramBoosting(spec.boosting)
    return {
        "Logistic Regression": Pipeline(stages=[_assembler(), scaler, logistic]),
        "Random Forest": Pipeline(stages=[_assembler(), forest]),
        "Histogram Gradient Boosting": Pipeline(stages=[_assembler(), boosted]),
    }


def regressor_candidates(spec: RegressorSpec, n_train: float) -> dict[str, Pipeline]:
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    ridge = LinearRegression(featuresCol="scaled", labelCol="label", regParam=spec.ridge_alpha / max(n_train, 1.0),
                             elasticNetParam=0.0, standardization=False)
    if spec.sampled:
        forest = SampledForest(forest_spec(spec))
    else:
        forest = RandomForestRegressor(labelCol="label", numTrees=spec.rf_trees, maxDepth=spec.rf_depth,
                                       minInstancesPerNode=spec.rf_min_leaf,
                                       featureSubsetStrategy=str(spec.rf_feature_fraction), seed=SEED, **_TREES)
    boosted = HistogramBoosting(spec.boosting)
    return {
        "Ridge Regression": Pipeline(stages=[_assembler(), scaler, ridge]),
        "Random Forest Regressor": Pipeline(stages=[_assembler(), forest]),
        "Histogram Gradient Boosting Regressor": Pipeline(stages=[_assembler(), boosted]),
    }


def positive_probability(model: PipelineModel, df: DataFrame, out: str = "p") -> DataFrame:
    """Model.transform + P(class 1) as a double column."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(
        "features", "scaled", "rawPrediction", "probability", "prediction")


def stratified_folds(train: DataFrame, id_cols: Sequence[str], folds: int, label: str = "label", out: str = "_fold") -> DataFrame:
    """``train`` with a fold per row: rows of a class are dealt to the folds in turn, in the
    order of their ids, so every fold has its share of each class to within one row.  The
    turn is a distributed rank within the class: no class is sorted in one task."""
    first, last = id_cols[0], id_cols[-1]
    placed = ordered_running(train, [(c, True) for c in dict.fromkeys([first, *id_cols[:-1]])], last, partition_by=[label])
    return placed.withColumn(out, F.pmod(F.col("_rn") - 1, F.lit(folds)).cast("int")).select(*train.columns, out)


def fit_sigmoid(held: DataFrame, margin: str = "_margin", label: str = "label", steps: int = 50, tol: float = 1e-10) -> tuple[float, float]:
    """(a, b) of P(y = 1) = 1 / (1 + exp(a * margin + b)), the maximum of the likelihood with
    smoothed targets: (n1 + 1) / (n1 + 2) for positives and 1 / (n0 + 2) for negatives, so
    that a perfect separation keeps finite parameters.  Newton steps with halving; each
    evaluation is one aggregate over the rows."""
    f, y = F.col(margin), F.col(label)
    n1, n0 = (int(x) for x in held.agg(F.count_if(y == 1), F.count_if(y != 1)).first())
    target = F.when(y == 1, F.lit((n1 + 1) / (n1 + 2))).otherwise(F.lit(1 / (n0 + 2)))

    def at(a: float, b: float):
        z = f * F.lit(a) + F.lit(b)
        p = 1 / (1 + F.exp(z))
        # -t log p - (1 - t) log(1 - p), written so that no exponential overflows
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - (1 - target) * z
        r, h = target - p, p * (1 - p)
        row = held.agg(F.sum(loss), F.sum(r * f), F.sum(r), F.sum(h * f * f), F.sum(h * f), F.sum(h)).first()
        return [float(x or 0.0) for x in row]

    a, b = 0.0, math.log((n0 + 1) / (n1 + 1))
    now = at(a, b)
    for _ in range(steps):
        loss, ga, gb, haa, hab, hbb = now
        haa, hbb = haa + 1e-12, hbb + 1e-12
        det = haa * hbb - hab * hab
        if abs(ga) < tol * max(1, n0 + n1) and abs(gb) < tol * max(1, n0 + n1) or det <= 0:
            break
        da, db = -(hbb * ga - hab * gb) / det, -(haa * gb - hab * ga) / det
        if -(ga * da + gb * db) <= ROUNDING * max(1.0, loss):  # the sums cannot tell the losses apart
            return a + da, b + db
        size = 1.0
        while size > 1e-10:
            new = at(a + size * da, b + size * db)
            if new[0] <= loss + 1e-4 * size * (ga * da + gb * db):
                break
            size /= 2
        else:
            break
        a, b, now = a + size * da, b + size * db, new
    return a, b


class CalibratedClassifier:
    """Sigmoid calibration on ``folds`` class-balanced folds.  For each fold, the base
    pipeline is fitted on the other folds and a sigmoid maps its margin on the held-out rows
    to the label; predictions average the fold models."""

    def __init__(self, base: Callable[[float], Pipeline], folds: int = 3):
        self.base = base  # makes the pipeline for a number of training rows
        self.folds = folds
        self.members: list[tuple[PipelineModel, tuple[float, float]]] = []

    def fit(self, train: DataFrame, id_cols: Sequence[str]) -> CalibratedClassifier:
        keys = stratified_folds(train.select(*id_cols, "label"), id_cols, self.folds)
        tagged = train.join(keys.drop("label"), list(id_cols)).persist()

        def one(k: int) -> tuple[PipelineModel, tuple[float, float]]:
            fit_part = tagged.filter(F.col("_fold") != k)
            held = tagged.filter(F.col("_fold") == k)
            model = fit_pipeline(self.base(float(fit_part.count())), fit_part)
            margins = materialize(_margin_frame(model, held.drop("features")).select("_margin", "label"))
            return model, fit_sigmoid(margins)

        # the folds are independent Spark jobs: submit them concurrently
        with ThreadPoolExecutor(max_workers=self.folds) as pool:
            self.members = list(pool.map(one, range(self.folds)))
        tagged.unpersist()
        return self

    def predict(self, df: DataFrame, out: str = "p") -> DataFrame:
        scored, cols = df, []
        for i, (model, (a, b)) in enumerate(self.members):
            scored = _margin_frame(model, scored).withColumn(f"_p{i}", 1 / (1 + F.exp(F.col("_margin") * a + b))).drop("_margin")
            cols.append(f"_p{i}")
        return scored.withColumn(out, sum((F.col(c) for c in cols[1:]), F.col(cols[0])) / F.lit(float(len(cols)))).drop(*cols)


def _margin_frame(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with what the sigmoid is fitted on: the decision value, or a forest's share of votes."""
    scored = model.transform(df)
    p = vector_to_array("probability")[1]
    if not isinstance(model.stages[-1], (SampledForestModel, RandomForestClassificationModel)):
        p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
        p = F.log(p / (F.lit(1.0) - p))
    return scored.withColumn("_margin", p).drop("features", "scaled", "rawPrediction", "probability", "prediction")


def compare_classifiers(train: DataFrame, test: DataFrame, spec: ClassifierSpec | None = None,
                        names: Sequence[str] | None = None) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit each candidate, tune its F1 threshold on training predictions, score the
    holdout; comparison rows ordered by selection score."""
    spec = spec or ClassifierSpec()
    data = assembled(train)
    cands = {k: v for k, v in classifier_candidates(spec, float(data.count())).items() if names is None or k in names}

    def one(item):
        name, pipe = item
        model = fit_pipeline(pipe, data)
        thr = float(metrics.optimal_f1_threshold(positive_probability(model, train).withColumnRenamed("label", "y"))
                    .first()["threshold"])
        test_p = positive_probability(model, test).withColumnRenamed("label", "y")
        return name, model, metrics.classification_metrics(test_p, thr).withColumn("model", F.lit(name))

    # candidates are independent Spark jobs: fit them concurrently
    with ThreadPoolExecutor(max_workers=len(cands)) as pool:
        results = list(pool.map(one, cands.items()))
    data.unpersist()
    fitted, rows = {}, None
    for name, model, row in results:
        fitted[name] = model
        rows = row if rows is None else rows.unionByName(row)
    rows = rows.withColumn("selection_score", metrics.selection_score_classifier(
        F.col("roc_auc"), F.col("pr_auc"), F.col("brier_score")))
    return rows, fitted


def compare_regressors(train: DataFrame, test: DataFrame, spec: RegressorSpec | None = None,
                       names: Sequence[str] | None = None) -> tuple[DataFrame, dict[str, PipelineModel]]:
    spec = spec or RegressorSpec()
    data = assembled(train)
    cands = {k: v for k, v in regressor_candidates(spec, float(data.count())).items() if names is None or k in names}

    def one(item):
        name, pipe = item
        model = fit_pipeline(pipe, data)
        pred = model.transform(test).select("customer_id", F.col("label").alias("y"),
                                            F.col("prediction").alias("yhat"))
        return name, model, metrics.regression_metrics(pred).withColumn("model", F.lit(name))

    with ThreadPoolExecutor(max_workers=len(cands)) as pool:
        results = list(pool.map(one, cands.items()))
    data.unpersist()
    fitted, rows = {}, None
    for name, model, row in results:
        fitted[name] = model
        rows = row if rows is None else rows.unionByName(row)
    rows = rows.withColumn("selection_score", metrics.selection_score_regressor(
        F.col("normalized_mae"), F.col("spearman_correlation"), F.col("r2")))
    return rows, fitted


def save_bundle(members: Sequence[PipelineModel], path: str, meta: dict) -> None:
    """The models of a bundle, in order, with a one-line JSON metadata record."""
    session = SparkSession.getActiveSession()
    for i, model in enumerate(members):
        model.write().overwrite().save(f"{path}/model_{i}")
    write_json_record(session, {**meta, "members": len(members)}, f"{path}/metadata")


def load_bundle(path: str) -> tuple[list[PipelineModel], dict]:
    """The models and the metadata record."""
    meta = read_json_record(SparkSession.getActiveSession(), f"{path}/metadata")
    return [PipelineModel.load(f"{path}/model_{i}") for i in range(meta["members"])], meta


def calibrated_bundle(model: CalibratedClassifier) -> tuple[list[PipelineModel], dict]:
    """The fold models, and their sigmoids as metadata, for ``save_bundle``."""
    return [m for m, _ in model.members], {"sigmoids": [list(ab) for _, ab in model.members]}


def calibrated_from(members: Sequence[PipelineModel], meta: dict) -> CalibratedClassifier:
    out = CalibratedClassifier(lambda n: None, folds=len(members))
    out.members = [(m, tuple(ab)) for m, ab in zip(members, meta["sigmoids"])]
    return out


def finite_count(df: DataFrame, column: str) -> int:
    return int(df.agg(F.count_if(F.col(column).isNotNull() & ~F.isnan(column)
                                 & (F.abs(F.col(column)) != F.lit(math.inf)))).first()[0])
