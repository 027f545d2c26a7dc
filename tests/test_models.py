"""The parts of the trained chain on small specs: weights, folds, bundles, additivity."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cairn.constants import FEATURE_COLUMNS
from cairn.operators import attribution, models
from cairn.operators.boosting import BoostingSpec
from cairn.operators.contracts import ContractError, check_label_windows

SMALL = models.ClassifierSpec(rf_trees=6, rf_depth=4, boosting=BoostingSpec("log_loss", 0.3, max_iter=4, max_leaves=8))
SMALL_VALUE = models.RegressorSpec(rf_trees=6, rf_depth=4, boosting=BoostingSpec("squared_error", 0.3, max_iter=4, max_leaves=8))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    n = 600
    x = rng.normal(size=(n, len(FEATURE_COLUMNS)))
    pdf = pd.DataFrame(x, columns=FEATURE_COLUMNS)
    pdf.insert(0, "customer_id", np.arange(n))
    pdf["snapshot_date"] = "2000-03-31"
    p = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 3] - 1)))
    pdf["label"] = (rng.random(n) < p).astype(float)
    pdf["value"] = 3 * x[:, 2] + x[:, 0]
    df = spark.createDataFrame(pdf)
    return df.filter("customer_id < 450"), df.filter("customer_id >= 450").withColumn("weight", F.lit(1.0))


def test_balanced_weights(data):
    train = models.add_balanced_weights(data[0])
    rows = train.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("w"), F.min("weight").alias("v")).collect()
    assert all(r.w == r.v == pytest.approx(450 / (2 * r.n)) for r in rows)


@pytest.mark.parametrize("sampled", [False, True])
def test_candidates_learn_and_champion_is_best(data, sampled):
    train, test = models.add_balanced_weights(data[0]), data[1]
    rows, fitted = models.compare_classifiers(train, test, replace(SMALL, sampled=sampled))
    rows = {r.model: r for r in rows.collect()}
    assert set(rows) == set(fitted) == {"Logistic Regression", "Random Forest", "Histogram Gradient Boosting"}
    assert all(r.roc_auc > 0.75 and 0.15 <= r.threshold <= 0.85 for r in rows.values())
    value_train, value_test = (d.withColumn("label", F.col("value")) for d in data)
    rows, _ = models.compare_regressors(value_train, value_test, replace(SMALL_VALUE, sampled=sampled))
    rows = {r.model: r for r in rows.collect()}
    assert rows["Ridge Regression"].r2 > 0.5 and len(rows) == 3  # predictions are clipped at zero


def test_calibration_uses_the_rows_of_each_fold(spark, data, tmp_path):
    train, test = models.add_balanced_weights(data[0]), data[1]
    asked = []

    def base(n):
        asked.append(n)
        return models.classifier_candidates(SMALL, n)["Logistic Regression"]

    kept = models.assembled(train)
    model = models.CalibratedClassifier(base).fit(kept, ["customer_id", "snapshot_date"])
    kept.unpersist()
    assert sum(asked) == 2 * 450 and len(asked) == 3
    for pipe, n in zip([m for m, _ in model.members], asked):
        assert n in asked and pipe.stages[-1].getRegParam() in [pytest.approx(1 / (0.75 * k)) for k in asked]
    scored = model.predict(test).toPandas().set_index("customer_id")
    assert scored["p"].between(0, 1).all()
    assert abs(scored["p"].mean() - scored["label"].mean()) < 0.12
    # a bundle scores alike after it is loaded
    members, sigmoids = models.calibrated_bundle(model)
    models.save_bundle(members, str(tmp_path / "b"), {**sigmoids, "threshold": 0.4, "champion": "x"})
    members, meta = models.load_bundle(str(tmp_path / "b"))
    assert (meta["threshold"], meta["members"]) == (0.4, 3)
    again = models.calibrated_from(members, meta).predict(test).toPandas().set_index("customer_id")
    assert np.allclose(again["p"].sort_index(), scored["p"].sort_index(), atol=1e-12)


def test_attributions_add_up_for_a_trained_model(data):
    train, test = models.add_balanced_weights(data[0]), data[1]
    model = models.fit_pipeline(models.classifier_candidates(SMALL, 450.0)["Random Forest"], models.assembled(train))
    base = attribution.baseline_medians(attribution.seeded_sample(train, 24, ["customer_id", "snapshot_date"]))
    rows = test.orderBy("customer_id").limit(4)
    phi = attribution.permutation_attribution(lambda d: models.positive_probability(model, d), rows, base, n_permutations=6)
    err = attribution.additivity_error(phi).first()
    assert err.sample_size == 4 and err.additivity_mean_absolute_error < 1e-6
    share = attribution.global_importance(phi).agg(F.sum("importance_share")).first()[0]
    assert share == pytest.approx(1.0)


def test_label_windows_close_before_the_holdout():
    check_label_windows(["2000-03-31", "2000-06-30"], 90, "2000-09-28")
    with pytest.raises(ContractError) as e:
        check_label_windows(["2000-03-31", "2000-07-01"], 90, "2000-09-28")
    assert e.value.violations == {"label_window_after_holdout": 1}


def test_folds_hold_every_class_alike(spark):
    rows = [(i, f"2000-0{1 + i % 3}-01", float(i % 7 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id long, snapshot_date string, label double").repartition(5)
    got = {(r._fold, r.label): r["count"] for r in models.stratified_folds(df, ["customer_id", "snapshot_date"], 3).groupBy("_fold", "label").count().collect()}
    assert sum(got.values()) == 200
    for label in (0.0, 1.0):
        assert max(got[k, label] for k in range(3)) - min(got[k, label] for k in range(3)) <= 1


@pytest.mark.parametrize("case", ["noisy", "separated", "one_class"])
def test_sigmoid_equals_a_numpy_fit(spark, case):
    rng = np.random.default_rng(1)
    f = rng.normal(size=400) * 2
    y = {"noisy": (rng.random(400) < 1 / (1 + np.exp(-1.5 * f + 0.7))), "separated": f > 0.3, "one_class": f > -1e9}[case].astype(float)
    a, b = models.fit_sigmoid(spark.createDataFrame([(float(x), float(z)) for x, z in zip(f, y)], "_margin double, label double"))
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    ab = np.array([0.0, np.log((n0 + 1) / (n1 + 1))])
    design = np.column_stack([f, np.ones(400)])
    for _ in range(200):  # damped Newton on the whole arrays
        p = 1 / (1 + np.exp(design @ ab))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 1e-12 * np.eye(2), design.T @ (t - p))
        ab = ab - 0.5 * step
    assert np.allclose([a, b], ab, atol=1e-5)


def test_sigmoid_ends_where_sums_cannot_tell_losses_apart(spark):
    """Steps so small that they change no sum are not taken one after the other."""
    group = "sigmoid-steps"
    spark.sparkContext.setJobGroup(group, group)
    for seed in (4, 1, 20):
        rng = np.random.default_rng(seed)
        f = rng.uniform(0.2, 0.75, 2000)
        y = (rng.random(2000) < 1 / (1 + np.exp(-4 * (f - 0.47)))).astype(float)
        held = spark.createDataFrame([(float(x), float(z)) for x, z in zip(f, y)], "_margin double, label double").coalesce(1)
        a, b = models.fit_sigmoid(held)
        p = 1 / (1 + np.exp(a * f + b))
        r = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)) - p
        assert abs(r.sum()) < 1e-6 and abs((r * f).sum()) < 1e-6  # the maximum
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 100
