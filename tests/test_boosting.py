"""Histogram boosting against a plain numpy version that grows each tree step by step."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cairn.operators import boosting
from cairn.operators.boosting import BoostingSpec, HistogramBoosting, bin_edges, collected_edges, root_sums, train

COLUMNS = ["a", "b", "c", "d"]


def table(n=900, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n), rng.exponential(2, n).round(1), np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n))])
    margin = 2 * x[:, 0] - (x[:, 1] > 2) * x[:, 2] + x[:, 3] ** 2
    return x, (rng.random(n) < 1 / (1 + np.exp(-margin))).astype(float), rng.integers(1, 4, n).astype(float), margin


def frame(spark, x, y, w, parts=3):
    rows = [(r.tolist(), float(a), float(b)) for r, a, b in zip(x, y, w)]
    return spark.createDataFrame(rows, "features array<double>, label double, weight double").repartition(parts)


def plain_edges(v, bins):
    u = np.unique(v)
    if len(u) <= bins:
        return (u[:-1] + u[1:]) / 2
    v, at = np.sort(v), (len(v) - 1) * np.arange(1, bins)
    return np.unique((v[at // bins] + v[-(-at // bins)]) / 2)


def plain_boosting(x, y, w, spec):
    """Every candidate split of every leaf is tried on the rows themselves."""
    edges = [plain_edges(v, spec.max_bins) for v in x.T]
    if spec.loss == "log_loss":
        p = (w * y).sum() / w.sum()
        raw = np.full(len(y), np.log(p / (1 - p)))
    else:
        raw = np.full(len(y), (w * y).sum() / w.sum())
    out = []
    for _ in range(spec.max_iter):
        if spec.loss == "log_loss":
            p = 1 / (1 + np.exp(-raw))
            g, h = w * (p - y), w * p * (1 - p)
        else:
            g, h = w * (raw - y), w

        def best(rows, g=g, h=h):
            part = lambda r: g[r].sum() ** 2 / (h[r].sum() + spec.l2)
            top = None
            for f, es in enumerate(edges):
                for e in es:
                    left, right = rows[x[rows, f] <= e], rows[x[rows, f] > e]
                    if min(len(left), len(right)) < spec.min_leaf:
                        continue
                    gain = part(left) + part(right) - part(rows)
                    if gain > 1e-9 and (top is None or gain > top[0] + 1e-9):
                        top = (gain, f, e, left, right)
            return top

        every = np.arange(len(y))
        leaves = [(every, best(every))]
        splits = []
        while len(leaves) < spec.max_leaves and any(b for _, b in leaves):
            at = max((i for i, (_, b) in enumerate(leaves) if b), key=lambda i: leaves[i][1][0])
            _, (gain, f, e, left, right) = leaves.pop(at)
            splits.append((f, round(float(e), 9)))
            leaves += [(left, best(left)), (right, best(right))]
        for rows, _ in leaves:
            raw[rows] += -spec.learning_rate * g[rows].sum() / (h[rows].sum() + spec.l2)
        out.append(sorted(splits))
    return edges, out, raw


@pytest.mark.parametrize("spec", [BoostingSpec("log_loss", 0.3, max_iter=4, max_leaves=7, min_leaf=20, l2=0.75, max_bins=16),
                                  BoostingSpec("squared_error", 0.2, max_iter=3, max_leaves=9, min_leaf=15, l2=1.0, max_bins=12)])
def test_splits_and_leaf_values_equal_plain_numpy(spark, spec):
    x, y, w, margin = table()
    y = y if spec.loss == "log_loss" else margin
    got = train(frame(spark, x, y, w), spec)
    edges, splits, raw = plain_boosting(x, y, w, spec)
    for a, b in zip(got.edges, edges):
        assert np.allclose(a, b, rtol=0, atol=1e-12)
    assert [sorted((int(f), round(float(got.edges[f][c]), 9)) for f, c in zip(t.feature, t.cut) if f >= 0) for t in got.trees] == splits
    assert np.allclose(got.raw(x), raw, atol=1e-9)


@pytest.mark.parametrize("loss", ["log_loss", "squared_error"])
def test_one_task_grows_the_trees_of_the_cluster(spark, monkeypatch, loss):
    x, y, w, margin = table(12_000)
    rows = frame(spark, x, y if loss == "log_loss" else margin, w if loss == "log_loss" else np.ones(len(y))).persist()
    spec = BoostingSpec(loss, 0.4, max_iter=6, max_leaves=9, max_bins=20)
    group = f"boosting-in-a-task-{loss}"
    spark.sparkContext.setJobGroup(group, group)
    one = train(rows, spec)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 100)
    many = train(rows, spec)
    rows.unpersist()
    assert [(t.feature.tolist(), t.cut.tolist()) for t in one.trees] == [(t.feature.tolist(), t.cut.tolist()) for t in many.trees]
    assert len(one.trees) == 6 and np.allclose(one.raw(x), many.raw(x), atol=1e-9)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 30  # a pass over the cluster takes a job each


@pytest.mark.parametrize("bins", [4, 6, 255])
def test_edges_are_exact_quantiles(spark, bins):
    x, y, w, _ = table(700, seed=9)
    x[:, 1] = 2.0  # one value: no edge
    got = collected_edges(bin_edges(frame(spark, x, y, w), bins), 4)
    for a, v in zip(got, x.T):
        assert np.allclose(a, plain_edges(v, bins), rtol=0, atol=1e-12)


def test_root_sums(spark):
    x, y, w, _ = table(300)
    spec = BoostingSpec(max_bins=8)
    rows = frame(spark, x, y, w)
    edges = collected_edges(bin_edges(rows, 8), 4)
    got = root_sums(rows, edges, spec)
    p = (w * y).sum() / w.sum()
    for f in range(4):
        bins = np.searchsorted(edges[f], x[:, f])
        want = np.stack([np.bincount(bins, v, 8) for v in (w * (p - y), w * p * (1 - p), np.ones(len(y)))], axis=1)
        assert np.allclose(got[f], want, atol=1e-9)


def test_training_stops_early_on_held_out_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(12_000, 4))
    y = (rng.random(12_000) < 0.5).astype(float)  # nothing to learn
    got = train(frame(spark, x, y, np.ones(len(y))), BoostingSpec(learning_rate=0.5, max_iter=60, max_leaves=6))
    assert 10 <= len(got.trees) < 60


def test_constant_label_gives_one_leaf(spark):
    x, _, w, _ = table(200)
    got = train(frame(spark, x, np.zeros(200), w), BoostingSpec("squared_error", max_iter=5))
    assert len(got.trees) == 1 and np.allclose(got.raw(x), 0)


def test_pipeline_scores_alike_after_loading(spark, tmp_path):
    x, y, w, _ = table(400)
    df = spark.createDataFrame([(*map(float, r), float(a), float(b)) for r, a, b in zip(x, y, w)], "a double, b double, c double, d double, label double, weight double")
    model = Pipeline(stages=[VectorAssembler(inputCols=COLUMNS, outputCol="features"), HistogramBoosting(BoostingSpec(max_iter=5, learning_rate=0.3))]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    one, two = (m.transform(df).select("probability", "prediction", "label").toPandas() for m in (model, again))
    assert (one["probability"] == two["probability"]).all() and (one["prediction"] == two["prediction"]).all()
    assert (one["prediction"] == one["label"]).mean() > 0.75
    assert model.transform(df.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("loss", ["log_loss", "squared_error"])
def test_joint_bins_and_one_leaf_a_round_grow_the_same_trees(monkeypatch, loss):
    rng = np.random.default_rng(7)
    bins = np.stack([rng.integers(0, k, 3000, dtype=np.uint8) for k in (40, 3, 12, 1, 25)])
    y = (rng.random(3000) < (bins[0] + bins[2]) / 60).astype(float) if loss == "log_loss" else bins[0] - 0.5 * bins[4] + rng.normal(size=3000)
    w, training = (rng.choice([1.0, 3.0], 3000) if loss == "log_loss" else np.ones(3000)), rng.random(3000) < 0.9
    spec = boosting.BoostingSpec(loss, max_iter=6, max_leaves=9, min_leaf=20, max_bins=64)
    block = (bins, y, w, training, np.zeros(3000))

    class Ahead(boosting.InTask):
        ahead = True

    plain = boosting.boosted(Ahead(block, spec), spec)
    monkeypatch.setattr(boosting, "JOINT_ROWS", 100)
    monkeypatch.setattr(boosting, "JOINT_BINS", 600)
    state, summed = boosting.InTask(block, spec), []
    monkeypatch.setattr(state, "sums", lambda tree, wanted, own=state.sums: summed.append(len(wanted)) or own(tree, wanted))
    joint = boosting.boosted(state, spec)
    assert len(state.joint.groups) < 5 and max(map(len, state.joint.groups)) > 1
    assert sum(summed) == 6 * 9  # a root and a child of each split, no more
    for a, b in zip(plain, joint, strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value, atol=1e-12)
    whole = boosting.node_sums(bins, y, w, np.arange(3000), 64)
    assert np.allclose(state.joint.node_sums(5, y, w, np.arange(3000), 64), whole)
