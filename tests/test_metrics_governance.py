"""Metric, drift, fairness, quality, reconciliation and scoring operators against
brute-force numpy/pandas computations on small fixtures."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cairn.operators import drift, fairness, metrics, quality, scoring


def _scored(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    p = np.round(rng.random(n), 2)  # ties on purpose
    y = (rng.random(n) < p).astype(int)
    pdf = pd.DataFrame({"customer_id": np.arange(n), "y": y, "p": p,
                        "region": rng.choice(["N", "S", "E"], n), "age_band": rng.choice(["a", "b"], n)})
    return pdf, spark.createDataFrame(pdf)


def _auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def _ap(y, p):
    order = np.argsort(-p, kind="mergesort")
    ys, ps = y[order], p[order]
    ap, tp, prev_r = 0.0, 0, 0.0
    P = y.sum()
    for i in range(len(ys)):
        tp += ys[i]
        if i == len(ys) - 1 or ps[i + 1] != ps[i]:
            r = tp / P
            ap += (r - prev_r) * (tp / (i + 1))
            prev_r = r
    return ap


def test_classification_metrics_brute_force(spark):
    pdf, df = _scored(spark)
    row = metrics.classification_metrics(df, 0.5).first()
    y, p = pdf["y"].to_numpy(), pdf["p"].to_numpy()
    assert row["roc_auc"] == pytest.approx(_auc(y, p), abs=1e-12)
    assert row["pr_auc"] == pytest.approx(_ap(y, p), abs=1e-12)
    assert row["brier_score"] == pytest.approx(np.mean((p - y) ** 2), abs=1e-12)
    pred = p >= 0.5
    tp = (pred & (y == 1)).sum()
    assert row["precision"] == pytest.approx(tp / pred.sum())
    assert row["recall"] == pytest.approx(tp / y.sum())
    order = pdf.sort_values(["p", "customer_id"], ascending=[False, True])
    k10 = max(1, int(len(pdf) * 0.1))
    assert row["lift_at_10pct"] == pytest.approx(order["y"].iloc[:k10].mean() / y.mean())


def test_threshold_search_first_best_wins(spark):
    pdf, df = _scored(spark)
    table = metrics.f1_threshold_table(df).toPandas().sort_values("j")
    y, p = pdf["y"].to_numpy(), pdf["p"].to_numpy()
    f1s = []
    for t in metrics.THRESHOLDS:
        pred = p >= t
        tp = (pred & (y == 1)).sum()
        f1s.append(2 * tp / (pred.sum() + y.sum()))
    assert np.allclose(table["f1"].to_numpy(), f1s)
    best = metrics.optimal_f1_threshold(df).first()["threshold"]
    assert best == metrics.THRESHOLDS[int(np.argmax(f1s))]


def test_lift_table_and_calibration(spark):
    pdf, df = _scored(spark, n=57)
    lift = metrics.lift_table(df).toPandas().sort_values("population_pct")
    order = pdf.sort_values(["p", "customer_id"], ascending=[False, True]).reset_index(drop=True)
    cum = order["y"].cumsum() / max(1, order["y"].sum())
    for cp, g in zip(lift["population_pct"], lift["cumulative_gain"]):
        idx = min(len(order) - 1, max(0, int(np.ceil(cp * len(order))) - 1))
        assert g == pytest.approx(cum.iloc[idx])
    cal = metrics.calibration_table(df).toPandas()
    assert cal["customers"].sum() == 57 and len(cal) == 10


def test_psi_matches_numpy(spark):
    rng = np.random.default_rng(0)
    ref = pd.DataFrame({"x": rng.normal(size=500), "flag": rng.integers(0, 2, 500).astype(float)})
    cur = pd.DataFrame({"x": rng.normal(0.3, 1.2, size=300), "flag": rng.integers(0, 2, 300).astype(float)})
    got = {r["feature"]: r["psi"] for r in drift.psi_by_feature(
        spark.createDataFrame(ref), spark.createDataFrame(cur), ["x", "flag"]).collect()}
    edges = np.unique(np.quantile(ref["x"], np.linspace(0, 1, 11)))
    edges[0], edges[-1] = -np.inf, np.inf
    r = pd.cut(ref["x"], edges, include_lowest=True).value_counts(normalize=True, sort=False).clip(lower=1e-6)
    c = pd.cut(cur["x"], edges, include_lowest=True).value_counts(normalize=True, sort=False).clip(lower=1e-6)
    c = c.reindex(r.index, fill_value=1e-6)
    assert got["x"] == pytest.approx(float(((c - r) * np.log(c / r)).sum()), abs=1e-12)
    assert got["flag"] == 0.0  # fewer than three distinct edges


def test_psi_rejects_bad_bins(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    for bins in (1, True):
        with pytest.raises(ValueError, match="bins"):
            drift.psi_by_feature(df, df, ["x"], bins=bins)


def test_fairness_brute_force_and_contract(spark):
    pdf, df = _scored(spark)
    scored = df.select("customer_id", "region", "age_band", F.col("y").alias("churn_90d"),
                       F.col("p").alias("probability"))
    got = {(r["audit_attribute"], r["audit_group"]): r for r in fairness.fairness_audit(scored, 0.5).collect()}
    for attr in ("region", "age_band"):
        for g, part in pdf.groupby(attr):
            row = got[(attr, g)]
            assert row["customers"] == len(part)
            assert row["roc_auc"] == pytest.approx(_auc(part["y"].to_numpy(), part["p"].to_numpy()))
    with pytest.raises(ValueError, match="threshold"):
        fairness.fairness_audit(scored, True)
    with pytest.raises(ValueError, match="outcome_not_binary"):
        fairness.fairness_audit(scored.withColumn("churn_90d", F.lit(2)), 0.5)
    with pytest.raises(ValueError, match="_blank"):
        fairness.fairness_audit(scored.withColumn("region", F.lit(" ")), 0.5)


def test_quality_report_and_reconciliation(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 20.0), (2, 21.0)], "k long, v double")
    rep = quality.report([quality.pk_unique(a, "k", "pk"),
                          quality.fk_valid(a, a.filter("k = 1"), "k", "fk")]).collect()
    assert {r["check_name"]: r["status"] for r in rep} == {"pk": "FAIL", "fk": "FAIL"}
    left = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    right = spark.createDataFrame([(1, 1.0), (2, 2.5), (3, 3.0)], "k long, v double")
    row = quality.reconcile(left, right, ["k"], ["v"]).first()
    assert row["mismatches"] == 1 and row["first_mismatch_key"] == 2 and row["missing_left"] == 1


def test_scoring_bands_and_rejects(spark):
    from cairn.constants import FEATURE_COLUMNS

    good = {c: 1.0 for c in FEATURE_COLUMNS}
    bad = dict(good, discount_rate_12m=1.5)
    df = spark.createDataFrame([dict(good, customer_id=1), dict(bad, customer_id=2)])
    ok, rej = scoring.split_valid(df)
    assert [r["customer_id"] for r in ok.collect()] == [1]
    assert rej.first()["violations"] == ["discount_rate_12m"]
    probe = spark.createDataFrame([(1, 0.35, 500.0), (2, 0.3499, 1499.99), (3, 0.72, 3500.0)],
                                  "customer_id long, churn_probability double, predicted_clv_12m double")
    out = {r["customer_id"]: r for r in scoring.band_scores(probe, 0.32, "2001-07-31").collect()}
    assert out[1]["churn_risk_band"] == "Medium" and out[1]["clv_band"] == "Developing"  # left-closed
    assert out[2]["churn_risk_band"] == "Low" and out[2]["clv_band"] == "Developing"
    assert out[3]["churn_risk_band"] == "Critical" and out[3]["clv_band"] == "Strategic"
    from cairn.constants import RISK_BAND_EDGES, RISK_BAND_TOP
    from cairn.functions.exprs import right_closed_band

    batch = probe.select(right_closed_band("churn_probability", RISK_BAND_EDGES, RISK_BAND_TOP).alias("b")).collect()
    assert batch[0]["b"] == "Low"  # 0.35 is Low in batch (right-closed), Medium in the service
