"""Antithetic attribution against a direct walk in numpy."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.operators import attribution

FEATS = ["a", "b", "c", "d"]


def f(x):
    return x[:, 0] * x[:, 1] + np.sin(x[:, 2]) * x[:, 0] + 0.5 * x[:, 3] ** 2


def walk(i, x, back, seed):
    """2 m + 1 states, the last equal to the first."""
    order = sorted(range(len(x)), key=lambda k: hashlib.md5(f"{i}|{k}|{seed}".encode()).hexdigest())
    on = np.zeros(len(x), bool)
    value = lambda: f(np.where(on, x, back)).mean()
    states, phi = [value()], np.zeros(len(x))
    for flip in (True, False):
        for k in order:
            on[k] = flip
            states.append(value())
            phi[k] += (states[-1] - states[-2]) * (1 if flip else -1) / 2
    return phi, states


@pytest.mark.parametrize("seed", [5, 6])
def test_walk_equals_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    x, back = rng.normal(size=(7, 4)), rng.normal(size=(24, 4))
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "customer_id long, a double, b double, c double, d double").repartition(3)
    bg = spark.createDataFrame([tuple(map(float, r)) for r in back], "a double, b double, c double, d double")
    scored = []

    def score(df):
        scored.append(df.count())
        return df.withColumn("p", F.col("a") * F.col("b") + F.sin("c") * F.col("a") + 0.5 * F.col("d") ** 2)

    phi = attribution.antithetic_attribution(score, rows, bg, features=FEATS, seed=seed)
    got = {(r.customer_id, r.feature): r for r in phi.collect()}
    assert scored == [7 * 8 * 24]  # one pass over 2 x 4 states (the ninth is the first again)
    for i in range(7):
        want, states = walk(i, x[i], back, seed)
        assert len(states) == 2 * 4 + 1 and states[-1] == pytest.approx(states[0])
        for k, name in enumerate(FEATS):
            r = got[i, name]
            assert r.shap_value == pytest.approx(want[k], abs=1e-12) and r.feature_value == x[i, k]
            assert (r.base_value, r.churn_probability) == (pytest.approx(states[0]), pytest.approx(f(x[i: i + 1])[0]))
    assert attribution.additivity_error(phi).first()[0] < 1e-12


def test_cohort_and_sample(spark):
    df = spark.createDataFrame([(i, f"2000-0{1 + i % 3}-01", i % 5) for i in range(40)], "customer_id long, snapshot_date string, recency_days int")
    assert [r.customer_id for r in attribution.most_dormant(df, 3).collect()] == [4, 9, 14]
    ids = lambda: [(r[0], r[1]) for r in attribution.seeded_sample(df.repartition(5), 6, ["customer_id", "snapshot_date"]).collect()]
    want = sorted((hashlib.md5(f"{i}|2000-0{1 + i % 3}-01|5".encode()).hexdigest(), i) for i in range(40))[:6]
    assert sorted(i for i, _ in ids()) == sorted(i for _, i in want) and ids() == ids()
