"""Metrics from runs of equal scores, where cuts fall inside a run."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest

from cairn.operators import metrics


@pytest.mark.parametrize("n,values", [(1, 1), (7, 2), (95, 3), (400, 5), (400, 400)])
def test_cuts_inside_ties_equal_sorting(spark, n, values):
    rng = np.random.default_rng(n + values)
    pdf = pd.DataFrame({"customer_id": rng.permutation(n), "y": rng.integers(0, 2, n), "p": rng.integers(0, values, n) / values})
    runs = metrics.ScoreRuns(spark.createDataFrame(pdf).repartition(3))
    down, up = (pdf.sort_values(["p", "customer_id"], ascending=[a, True]) for a in (False, True))
    cuts = list(range(0, n + 1, max(1, n // 13)))
    assert runs.positives_among(cuts) == [int(down["y"].head(k).sum()) for k in cuts]
    assert runs.positives_among(cuts, ascending=True) == [int(up["y"].head(k).sum()) for k in cuts]

    lift = metrics.lift_table(runs).toPandas().sort_values("population_pct")
    want = [down["y"].head(min(n, max(1, math.ceil(c * n)))).sum() / max(1, pdf["y"].sum()) for c in metrics.LIFT_CHECKPOINTS]
    assert np.allclose(lift["cumulative_gain"], want)

    first = np.arange(n)
    decile = np.maximum(0, np.ceil(first * 10 / (n - 1)) - 1) if n > 1 else np.zeros(1)
    want = up.assign(decile=decile.astype(int)).groupby("decile").agg(c=("y", "size"), p=("p", "mean"), y=("y", "mean"))
    got = metrics.calibration_table(runs).toPandas().set_index("decile").sort_index()
    assert list(got.index) == list(want.index) and (got["customers"] == want["c"]).all()
    assert np.allclose(got["mean_predicted_probability"], want["p"]) and np.allclose(got["observed_churn_rate"], want["y"])

    row = metrics.classification_metrics(runs, 0.5).first()
    k10, k20 = max(1, int(n * 0.1)), max(1, int(n * 0.2))
    share = pdf["y"].mean()
    assert row.lift_at_10pct == pytest.approx(down["y"].head(k10).mean() / share if share else 0)
    assert row.recall_at_20pct == pytest.approx(down["y"].head(k20).sum() / max(1, pdf["y"].sum()))
    assert row.brier_score == pytest.approx(((pdf["p"] - pdf["y"]) ** 2).mean())


def test_no_rows_and_no_scores(spark):
    empty = spark.createDataFrame([], "customer_id long, y long, p double")
    row = metrics.classification_metrics(empty, 0.5).first()
    assert row.roc_auc is None and row.lift_at_10pct == 0.0 and row.f1 == 0.0
    assert metrics.lift_table(empty).count() == 0 and metrics.calibration_table(empty).count() == 0
    rows = spark.createDataFrame([(1, 1, None), (2, 0, 0.5)], "customer_id long, y long, p double")
    assert metrics.ScoreRuns(rows).n == 1
