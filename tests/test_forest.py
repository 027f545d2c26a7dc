"""Sampled forests against a plain numpy version that grows each tree on its rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cairn.operators import forest
from cairn.operators.forest import ForestSpec, SampledForest, drawn_features, sample_counts, train


def table(n, seed):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.normal(size=n), rng.exponential(1, n)])
    margin = 2 * x[:, 0] - (x[:, 1] > 2) * 1.5 + x[:, 3]
    return x, (rng.random(n) < 1 / (1 + np.exp(-margin))).astype(float), margin


def frame(spark, x, y, parts=3):
    return spark.createDataFrame([(r.tolist(), float(v), i) for i, (r, v) in enumerate(zip(x, y))], "features array<double>, label double, row_key long").repartition(parts)


def plain_tree(x, y, edges, spec, t):
    """(splits, function of rows): every cut of every drawn feature is tried."""
    count = sample_counts(np.arange(len(y)), t)
    w = count.astype(float)
    if spec.task == "classify" and spec.balanced:
        n, p = count.sum(), (count * y).sum()
        w = count * np.where(y > 0, n / (2 * p), n / (2 * (n - p)))
    value, splits = np.zeros(len(y)), []

    def impurity(r):
        if spec.task == "regress":
            mean = (w[r] * y[r]).sum() / w[r].sum()
            return (w[r] * (y[r] - mean) ** 2).sum()
        p = (w[r] * y[r]).sum() / w[r].sum()
        return w[r].sum() * 2 * p * (1 - p)

    def grow(inside, path, depth):
        r = inside[count[inside] > 0]
        value[inside] = (w[r] * y[r]).sum() / w[r].sum()
        best = None
        if depth < spec.depth:
            for f in drawn_features(spec, t, path, x.shape[1]):
                for e in edges[f]:
                    a, b = r[x[r, f] <= e], r[x[r, f] > e]
                    if min(len(a), len(b)) >= spec.min_leaf:
                        gain = impurity(r) - impurity(a) - impurity(b)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, e)
        if best:
            _, f, e = best
            splits.append((path, int(f), round(float(e), 9)))
            grow(inside[x[inside, f] <= e], 2 * path, depth + 1)
            grow(inside[x[inside, f] > e], 2 * path + 1, depth + 1)

    grow(np.arange(len(y)), 1, 0)
    return sorted(splits), value


def splits_of(tree, edges):
    out, stack = [], [(0, 1)]
    while stack:
        n, path = stack.pop()
        if tree.feature[n] >= 0:
            out.append((path, int(tree.feature[n]), round(float(edges[tree.feature[n]][tree.cut[n]]), 9)))
            stack += [(int(tree.left[n]), 2 * path), (int(tree.right[n]), 2 * path + 1)]
    return sorted(out)


@pytest.mark.parametrize("spec", [ForestSpec(trees=5, depth=4, min_leaf=9, max_bins=10), ForestSpec("regress", trees=4, depth=5, min_leaf=7, features=0.8, max_bins=12)])
@pytest.mark.parametrize("cells", [4_000_000, 200])
def test_trees_equal_plain_numpy(spark, monkeypatch, spec, cells):
    monkeypatch.setattr(forest, "LEVEL_CELLS", cells)  # one pass a level, or one a node
    x, y, margin = table(350, 2)
    y = y if spec.task == "classify" else margin
    got = train(frame(spark, x, y), spec)
    mean = np.zeros(len(y))
    for t, tree in enumerate(got.trees):
        splits, value = plain_tree(x, y, got.edges, spec, t)
        assert splits_of(tree, got.edges) == splits and len(splits) > 3
        mean += value / spec.trees
    assert np.allclose(got.mean(x), mean, atol=1e-9)


@pytest.mark.parametrize("spec", [ForestSpec(trees=5, depth=4, min_leaf=9, max_bins=10), ForestSpec("regress", trees=4, depth=5, min_leaf=7, features=0.8, max_bins=12)])
def test_large_nodes_grow_by_sums_and_small_ones_in_a_task(spark, monkeypatch, spec):
    monkeypatch.setattr(forest, "LOCAL_ROWS", 60)
    x, y, margin = table(350, 2)
    y = y if spec.task == "classify" else margin
    got = train(frame(spark, x, y), spec)
    for t, tree in enumerate(got.trees):
        splits, _ = plain_tree(x, y, got.edges, spec, t)
        assert splits_of(tree, got.edges) == splits and len(splits) > 3


def test_deep_trees_need_no_job_a_level(spark):
    x, y, _ = table(400, 5)
    sc = spark.sparkContext
    jobs = []
    for depth in (3, 14):
        sc.setJobGroup(f"forest-{depth}", "")
        got = train(frame(spark, x, y), ForestSpec(trees=6, depth=depth, min_leaf=1, max_bins=20))
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"forest-{depth}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert max(p.bit_length() for t in got.trees for p, _, _ in splits_of(t, got.edges)) > 6
    assert jobs[0] == jobs[1] > 0


def test_samples_look_like_drawing_with_replacement():
    key = np.arange(20_000)
    counts = np.stack([sample_counts(key, t) for t in range(30)])
    assert abs(counts.mean() - 1) < 0.01 and abs((counts == 0).mean() - np.exp(-1)) < 0.005
    assert np.abs(np.corrcoef(counts)[np.triu_indices(30, 1)]).max() < 0.04
    assert np.abs([np.corrcoef(counts[t, :-1], counts[t, 1:])[0, 1] for t in range(30)]).max() < 0.04


def test_pipeline_scores_alike_after_loading(spark, tmp_path):
    x, y, _ = table(500, 4)
    rows = [(i, "2000-01-01", *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "customer_id long, snapshot_date string, a double, b double, c double, d double, label double")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list("abcd"), outputCol="features"), SampledForest(ForestSpec(trees=8, depth=5))])
    model = pipe.fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    one, two = (m.transform(df).select("probability", "label").toPandas() for m in (model, PipelineModel.load(str(tmp_path / "m"))))
    assert (one["probability"] == two["probability"]).all()
    p = np.array([v[1] for v in one["probability"]])
    assert p[y == 1].mean() > p[y == 0].mean() + 0.2
    assert model.transform(df.where(F.lit(False))).count() == 0


def test_counts_packed_in_one_number_equal_plain_sums(monkeypatch):
    rng = np.random.default_rng(5)
    bins, y = rng.integers(0, 8, (5, 400), dtype=np.uint8), (rng.random(400) < 0.4).astype(np.uint8)
    count, at, rows = rng.integers(1, 6, 400), rng.integers(0, 3, 400), np.arange(400)
    drawn, spec = np.array([[0, 2], [1, 4], [3, 4]]), forest.ForestSpec(max_bins=8)
    one = forest.cell_sums(bins, y, count, rows, at, drawn, spec)
    monkeypatch.setattr(forest, "EXACT", 0.0)
    two = forest.cell_sums(bins, y, count, rows, at, drawn, spec)
    for node, features in enumerate(drawn):
        for j, f in enumerate(features):
            for b in range(8):
                cell = (at == node) & (bins[f] == b)
                want = [count[cell].sum(), (count * y)[cell].sum(), cell.sum()]
                assert one[node, j, b].tolist() == two[node, j, b].tolist() == want


def test_nodes_that_cannot_be_cut_are_not_summed(monkeypatch):
    seen, plain = [], forest.cell_sums

    def counted(bins, y, count, rows, at, drawn, spec):
        seen.extend(np.bincount(at, minlength=len(drawn)).tolist())
        return plain(bins, y, count, rows, at, drawn, spec)

    monkeypatch.setattr(forest, "cell_sums", counted)
    rng = np.random.default_rng(3)
    bins, count = rng.integers(0, 64, (5, 3000), dtype=np.uint8), np.ones(3000, np.uint8)
    spec = ForestSpec("regress", trees=1, depth=6, min_leaf=40, features=0.8)
    # one value everywhere is a pure node, whatever rounding makes of its gains
    assert forest.grown_below(bins, np.full(3000, 0.1), count, 1, 0, (1.0, 1.0), spec).feature.tolist() == [-1] and not seen
    y = bins[0] * 1.5 + rng.normal(size=3000)
    tree = forest.grown_below(bins, y, count, 1, 0, (1.0, 1.0), spec)
    assert min(seen) >= 80 and (tree.feature >= 0).sum() <= len(seen) < len(tree.feature)
    leaf = tree.leaves(bins)
    assert np.allclose(tree.value[leaf], [y[leaf == k].mean() for k in leaf])


@pytest.mark.parametrize("rows", [1, 500])
def test_pieces_of_any_size_grow_the_same_tree(monkeypatch, rows):
    rng = np.random.default_rng(4)
    bins, count = rng.integers(0, 64, (6, 2000), dtype=np.uint8), rng.integers(1, 4, 2000).astype(np.uint8)
    y, spec = (rng.random(2000) < bins[1] / 64).astype(np.uint8), ForestSpec(trees=1, depth=8, min_leaf=5)
    one = forest.grown_below(bins, y, count, 1, 0, (0.9, 1.2), spec)
    monkeypatch.setattr(forest, "PIECE_ROWS", rows)
    two = forest.grown_below(bins, y, count, 1, 0, (0.9, 1.2), spec)
    assert len(one.feature) > 50 and all((getattr(one, c) == getattr(two, c)).all() for c in ("feature", "cut", "left", "right", "value"))


@pytest.mark.parametrize("spec", [ForestSpec(trees=5, depth=6, min_leaf=9, max_bins=10), ForestSpec("regress", trees=4, depth=6, min_leaf=7, features=0.8, max_bins=12)])
def test_whole_trees_need_one_exchange_and_equal_those_grown_by_level(spark, monkeypatch, spec):
    x, y, margin = table(700, 8)
    rows = frame(spark, x, y if spec.task == "classify" else np.round(margin, 1)).persist()
    sent = []
    monkeypatch.setattr(forest, "_grow_handed", lambda *a, plain=forest._grow_handed: sent.append(len(a[1])) or plain(*a))
    one = train(rows, spec)
    assert not sent  # no sample leaves its task
    monkeypatch.setattr(forest, "LOCAL_ROWS", 100)
    two = train(rows, spec)
    assert sent and one.weights == two.weights
    assert [splits_of(t, one.edges) for t in one.trees] == [splits_of(t, two.edges) for t in two.trees]
    assert np.allclose(one.mean(x), two.mean(x), atol=1e-12)


@pytest.mark.parametrize("task", ["classify", "regress"])
@pytest.mark.parametrize("run", [1, 10_000])
def test_runs_of_rows_are_summed_like_single_rows(monkeypatch, task, run):
    monkeypatch.setattr(forest, "RUN_ROWS", run)
    monkeypatch.setattr(forest, "PIECE_ROWS", 64)
    rng = np.random.default_rng(6)
    at = np.sort(rng.integers(0, 3, 500))
    bins, y, count = rng.integers(0, 8, (5, 500), dtype=np.uint8), rng.integers(0, 2, 500).astype(float), rng.integers(1, 6, 500).astype(np.uint8)
    drawn, spec = np.array([[0, 2], [1, 4], [3, 4]]), forest.ForestSpec(task, max_bins=8)
    one = forest.cell_sums(bins, y, count, np.arange(500), at, drawn, spec)
    for held in (bins, np.ascontiguousarray(bins.T).T):
        assert (forest.cell_sums(held, y, count, slice(None), at, drawn, spec) == one).all()


def test_the_hash_needs_no_division():
    key = np.concatenate([np.arange(3), np.random.default_rng(1).integers(0, forest.PRIME, 5000), [forest.PRIME - 1]])
    h = (key + 8 * 48_271) % forest.PRIME
    h = (h * h + 7_919 * h) % forest.PRIME
    h = (h * h + 104_729 * h + 7) % forest.PRIME
    assert (forest.sample_hash(key, 7) == h).all()
    assert (sample_counts(key, 7) == np.searchsorted(forest.POISSON_EDGES, h, "right")).all()


def test_joint_bins_grow_the_same_regression_tree(monkeypatch):
    rng = np.random.default_rng(9)
    bins = np.stack([rng.integers(0, k, 4000, dtype=np.uint8) for k in (50, 3, 8, 1, 20, 2)])
    y, count = np.round(bins[0] * 1.5 - bins[4] + rng.normal(size=4000), 2), rng.integers(1, 4, 4000).astype(np.uint8)
    spec = ForestSpec("regress", trees=1, depth=7, min_leaf=10, features=0.8)
    one = forest.grown_below(bins, y, count, 1, 0, (1.0, 1.0), spec)
    used = []
    monkeypatch.setattr(forest, "JOINT_ROWS", 300)
    monkeypatch.setattr(forest, "_joint_sums", lambda *a, plain=forest._joint_sums: used.append(len(a[2])) or plain(*a))
    two = forest.grown_below(bins, y, count, 1, 0, (1.0, 1.0), spec)
    assert len(used) > 3 and min(used) >= 300
    assert (one.feature == two.feature).all() and (one.cut == two.cut).all() and (one.value == two.value).all()
