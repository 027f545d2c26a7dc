"""Histogram gradient boosting with best-first trees, trained data-parallel.

Features are cut into at most ``max_bins`` bins at exact quantiles (midpoints between
neighbours where a feature has few distinct values).  The binned rows lie in blocks of one
byte a feature, spread over the cluster and kept there with their scores so far.  One
aggregate gives the sums of gradient, hessian and rows per (leaf, feature, bin) of all
leaves that a round asks for; only the smaller child of a split is summed, its sibling is
the parent less the child.  The driver holds these sums (at most leaves x features x bins
numbers) and grows the tree best-first: the leaf with the largest gain is split next, up to
``max_leaves``.  A round sums the children of every leaf that best-first order would split
as far as gains are known, so a tree takes about as many rounds as it is deep.

A round over the cluster is a Spark job, and a job costs more than summing a few hundred
thousand rows.  So at most ``LOCAL_ROWS`` rows train in one task, by the same steps; more
rows train over the cluster.  In a task a round costs nothing, so it sums the children of
one leaf and no more than the tree needs.  Large nodes are summed there by few joint bins of
several features, and the sums of a feature's bins are read off these.

gain  = GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)
value = -learning_rate * G / (H + l2)

With more than ``EARLY_STOP_ROWS`` rows, a tenth of them (by a hash of their content) is
held out, and training ends when its loss has not improved in ``PATIENCE`` trees.
"""

from __future__ import annotations

import heapq
import math
import pickle
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import value_prefix
from ..session import materialize, ship_package

MAX_BINS = 255
MIN_HESSIAN = 1e-3
EARLY_STOP_ROWS = 10_000
HELD_OUT = 10  # one row in so many
PATIENCE, TOLERANCE = 10, 1e-7
#: rows that one task trains on (some 100 bytes each)
LOCAL_ROWS = 1 << 22
#: joint bins of a group of features, and rows from which a node is summed by them
JOINT_BINS, JOINT_ROWS = 1 << 13, 1 << 14
#: trees between two written copies of the rows' scores
CHECKPOINT_TREES = 20


@dataclass
class BoostingSpec:
    loss: str = "log_loss"  # or squared_error
    learning_rate: float = 0.055
    max_iter: int = 220
    max_leaves: int = 25
    min_leaf: int = 24
    l2: float = 0.75
    max_bins: int = MAX_BINS


# --- bins ----------------------------------------------------------------------------
def bin_edges(rows: DataFrame, max_bins: int = MAX_BINS) -> DataFrame:
    """(feature, edge) of ``rows`` (features array<double>): a value is in bin k if k edges
    are smaller.  At most ``max_bins`` - 1 edges a feature, from exact quantiles."""
    values = rows.select(F.posexplode("features").alias("feature", "value"))
    runs = materialize(value_prefix(values, "value", partition_by=["feature"]))
    distinct = runs.groupBy("feature").agg(F.count(F.lit(1)).alias("distinct"))
    of = runs.join(F.broadcast(distinct), "feature")  # one row a feature
    # few values: the midpoints of neighbours, found by their place among all rows
    few = of.where(F.col("distinct") <= max_bins)
    ends = few.select("feature", (F.col("_before") + F.col("_cnt")).alias("at"), F.col("value").alias("low"))
    starts = few.select("feature", F.col("_before").alias("at"), F.col("value").alias("high"))
    middle = ends.join(starts, ["feature", "at"]).select("feature", ((F.col("low") + F.col("high")) / 2).alias("edge"))
    # many: the middle of the two values around place (n - 1) * k / max_bins
    n1, b = F.col("_n") - 1, F.lit(max_bins)
    first, last = F.col("_before"), F.col("_before") + F.col("_cnt") - 1
    k = F.explode(F.sequence(F.greatest(F.lit(1), F.floor((first - 1) * b / n1)).cast("int"),
                             F.least(F.lit(max_bins - 1), F.ceil((last + 1) * b / n1)).cast("int"))).alias("k")
    at = n1 * F.col("k")
    low, high = F.floor(at / b), F.ceil(at / b)
    held = (of.where((F.col("distinct") > max_bins) & ((first - 1) * b <= n1 * (max_bins - 1)) & ((last + 1) * b >= n1))
            .select("feature", "value", "_before", "_cnt", "_n", k)
            .where((low.between(first, last)) | (high.between(first, last))))
    quantiles = held.groupBy("feature", "k").agg(((F.min("value") + F.max("value")) / 2).alias("edge")).select("feature", "edge")
    return middle.unionByName(quantiles).distinct()


def collected_edges(edges: DataFrame, features: int) -> list[np.ndarray]:
    """Ascending edges of each feature: at most ``max_bins`` - 1 numbers a feature."""
    rows = edges.toArrow()
    feature, edge = rows["feature"].to_numpy(), rows["edge"].to_numpy()
    return [np.sort(edge[feature == f]) for f in range(features)]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins (features x rows) of a matrix of rows."""
    return np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)]).astype(np.uint8)


def block_table(rows: DataFrame, edges: list[np.ndarray], held_out: bool) -> DataFrame:
    """Pickled (bins, y, w, training flag) blocks of the binned rows, written once."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                y, w, t = (b.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight", "training"))
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((binned(x, edges), y, w, t))], pa.binary())], ["block"])

    training = F.pmod(F.xxhash64("features", "label", "weight"), F.lit(HELD_OUT)) != 0 if held_out else F.lit(True)
    return materialize(rows.select("features", "label", "weight", training.alias("training")).mapInArrow(run, "block binary"))


def joined(parts):
    """One block of all rows of ``parts``, none if there are no rows."""
    parts = list(parts)
    if parts:
        columns = [list(c) for c in zip(*parts)]
        parts.clear()  # a column's parts go as it is joined
        yield tuple(np.concatenate(columns.pop(0), axis=-1) for _ in range(len(columns)))


def blocks(table: DataFrame, start: float):
    """The blocks of a table as an RDD of one (bins, y, w, training flag, score) block a partition."""
    return table.rdd.mapPartitions(lambda rows: joined(pickle.loads(r["block"]) for r in rows)).map(lambda b: (*b, np.full(len(b[1]), start)))


# --- one tree ------------------------------------------------------------------------
@dataclass
class Tree:
    """Nodes in arrays; feature -1 marks a leaf.  Rows with bin <= cut go left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Node that each row (column of ``bins``) ends in."""
        n = bins.shape[1]
        node = np.zeros(n, np.intp)
        if not n:
            return node
        own, inner = np.arange(len(self.feature)), self.feature >= 0
        child = np.empty(2 * len(own), np.intp)  # a leaf leads to itself
        child[0::2], child[1::2] = np.where(inner, self.left, own), np.where(inner, self.right, own)
        feature, flat, column = self.feature.astype(np.intp), bins.ravel(), np.arange(n)
        while True:
            f = feature.take(node)
            if f.max() < 0:
                return node
            node = child.take(2 * node + (flat.take(f * n + column) > self.cut.take(node)))

    def rows(self, wanted, bins: np.ndarray, held: dict[int, np.ndarray]) -> list[np.ndarray]:
        """The rows in each of the ``wanted`` nodes.  ``held`` has the rows of the root; the
        rows of cut nodes are replaced there by those of their children."""
        above = {int(c): int(n) for n in np.flatnonzero(self.feature >= 0) for c in (self.left[n], self.right[n])}

        def find(node: int) -> np.ndarray:
            if node not in held:
                up = above[node]
                rows = find(up)
                right = bins[self.feature[up]].take(rows) > self.cut[up]
                held[int(self.left[up])], held[int(self.right[up])] = rows[~right], rows[right]
                del held[up]
            return held[node]

        return [find(int(n)) for n in wanted]

    def step(self, bins: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """``raw`` plus the value of the leaf of each row."""
        leaves, out = np.flatnonzero(self.feature < 0), raw.copy()
        for leaf, rows in zip(leaves, self.rows(leaves, bins, {0: np.arange(bins.shape[1])})):
            out[rows] += self.value[leaf]
        return out


def gradients(loss: str, raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if loss == "squared_error":
        return w * (raw - y), w
    p = 1 / (1 + np.exp(-raw))
    return w * (p - y), w * p * (1 - p)


def loss_sum(loss: str, raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    if loss == "squared_error":
        return float((w * (raw - y) ** 2).sum())
    return float((w * (np.logaddexp(0, raw) - y * raw)).sum())


def node_sums(bins: np.ndarray, g: np.ndarray, h: np.ndarray | None, rows: np.ndarray, max_bins: int) -> np.ndarray:
    """(feature, bin, [gradient, hessian, rows]) sums of ``rows``, whose gradients and
    hessians (None: 1 each) are given."""
    out = np.empty((len(bins), max_bins, 3))
    for f in range(len(bins)):
        key = bins[f].take(rows).astype(np.intp)
        out[f, :, 2] = np.bincount(key, None, max_bins)
        out[f, :, 0] = np.bincount(key, g, max_bins)
        out[f, :, 1] = out[f, :, 2] if h is None else np.bincount(key, h, max_bins)
    return out


def block_sums(block, tree: Tree, wanted: list[int], loss: str, max_bins: int, held: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """(node, feature, bin, [gradient, hessian, rows]) sums of the training rows in ``wanted``
    nodes.  ``held``: rows found in earlier rounds of the same tree."""
    bins, y, w, training, raw = block
    held = held if held is not None else {0: np.flatnonzero(training)}
    out = np.empty((len(wanted), len(bins), max_bins, 3))
    for i, rows in enumerate(tree.rows(wanted, bins, held)):
        g, h = gradients(loss, raw.take(rows), y.take(rows), w.take(rows))
        out[i] = node_sums(bins, g, None if loss == "squared_error" and (h == 1).all() else h, rows, max_bins)
    return out


def held_out_loss(block, loss: str) -> tuple[float, float]:
    """(loss, weight) of the rows that are held out."""
    _, y, w, training, raw = block
    out = ~training
    return loss_sum(loss, raw[out], y[out], w[out]), float(w[out].sum())


@dataclass
class Split:
    gain: float
    feature: int
    cut: int


def best_split(sums: np.ndarray, spec: BoostingSpec) -> Split | None:
    """The first split of the largest gain, None if no split is allowed or gains."""
    gain = split_gains(sums, spec)
    at = int(np.argmax(gain))
    if not gain.flat[at] > 0:
        return None
    return Split(float(gain.flat[at]), *divmod(at, sums.shape[1]))


def split_gains(sums: np.ndarray, spec: BoostingSpec) -> np.ndarray:
    """(feature, bin) gains of a cut after each bin; -inf where a side is too small."""
    left = np.cumsum(sums, axis=1)
    total = left[:, -1:, :]
    right = total - left
    score = lambda x: x[..., 0] ** 2 / np.maximum(x[..., 1] + spec.l2, 1e-300)
    fits = np.minimum(left[..., 2], right[..., 2]) >= spec.min_leaf
    fits &= np.minimum(left[..., 1], right[..., 1]) >= MIN_HESSIAN
    return np.where(fits, score(left) + score(right) - score(total), -np.inf)


class Grower:
    """Best-first growth of one tree from sums that ``summed(tree, nodes)`` gives."""

    def __init__(self, spec: BoostingSpec, summed, ahead: bool = True):
        self.spec, self.summed, self.ahead = spec, summed, ahead  # ahead: all leaves known to be split in one round
        self.sums: list[np.ndarray] = []
        self.split: list[Split | None] = []
        self.children: list[tuple[int, int] | None] = []
        self.path: list[int] = []  # 1 for the root, 2p and 2p + 1 for the children of p

    def _add(self, path: int, sums: np.ndarray) -> int:
        self.sums.append(sums)
        self.split.append(best_split(sums, self.spec))
        self.children.append(None)
        self.path.append(path)
        return len(self.sums) - 1

    def order(self) -> list[int]:
        """Nodes that best-first growth splits, as far as gains are known."""
        heap, picked = [], []

        def offer(node: int) -> None:
            if self.split[node] is not None:
                heapq.heappush(heap, (-self.split[node].gain, self.path[node], node))

        offer(0)
        while heap and len(picked) < self.spec.max_leaves - 1:
            node = heapq.heappop(heap)[2]
            picked.append(node)
            for child in self.children[node] or ():
                offer(child)
        return picked

    def tree(self, splits, values: bool = False) -> Tree:
        n, inner = len(self.sums), set(splits)
        t = Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n))
        for node in range(n):
            if node in inner:
                t.feature[node], t.cut[node] = self.split[node].feature, self.split[node].cut
                t.left[node], t.right[node] = self.children[node]
            elif values:
                g, h, _ = self.sums[node][0].sum(0)
                t.value[node] = -self.spec.learning_rate * g / (h + self.spec.l2) if h + self.spec.l2 > 0 else 0.0
        return t

    def grow(self, root: np.ndarray) -> Tree:
        self._add(1, root)
        while open_ := [n for n in self.order() if self.children[n] is None]:
            wanted, plans = [], []
            for node in open_ if self.ahead else open_[:1]:
                cut, sums = self.split[node], self.sums[node]
                small_left = 2 * sums[cut.feature, : cut.cut + 1, 2].sum() <= sums[cut.feature, :, 2].sum()
                left = self._reserve(2 * self.path[node])
                right = self._reserve(2 * self.path[node] + 1)
                self.children[node] = (left, right)
                wanted.append(left if small_left else right)
                plans.append((node, left, right, small_left))
            got = self.summed(self.tree([n for n in range(len(self.sums)) if self.children[n]]), wanted)
            for (node, left, right, small_left), sums in zip(plans, got):
                rest = self.sums[node] - sums
                rest[..., 2] = np.rint(rest[..., 2])
                for child, own in ((left, sums if small_left else rest), (right, rest if small_left else sums)):
                    self.sums[child], self.split[child] = own, best_split(own, self.spec)
        return compact(self.tree(self.order(), values=True))

    def _reserve(self, path: int) -> int:
        self.sums.append(None)
        self.split.append(None)
        self.children.append(None)
        self.path.append(path)
        return len(self.sums) - 1


def compact(t: Tree) -> Tree:
    """The tree without the nodes that were summed but not kept, in the order of a walk."""
    order, stack = [], [0]
    while stack:
        node = stack.pop()
        order.append(node)
        if t.feature[node] >= 0:
            stack += [int(t.right[node]), int(t.left[node])]
    new = {old: i for i, old in enumerate(order)}
    inner = t.feature[order] >= 0
    link = lambda side: np.array([new[int(side[n])] if k else 0 for n, k in zip(order, inner)], np.int64)
    return Tree(t.feature[order], t.cut[order], link(t.left), link(t.right), t.value[order])


# --- training ------------------------------------------------------------------------
def reduce_depth(rdd) -> int:
    """Sums of few partitions go to the driver directly, without a stage between."""
    return 1 if rdd.getNumPartitions() <= 32 else 2


def _plus(a, b):
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def base_score(rows: DataFrame, loss: str) -> float:
    """The constant that training starts from."""
    r = rows.agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("label")).alias("wy")).first()
    mean = (r["wy"] or 0.0) / (r["w"] or 1.0)
    if loss == "squared_error":
        return mean
    p = min(max(mean, 1e-9), 1 - 1e-9)
    return math.log(p / (1 - p))


def root_sums(rows: DataFrame, edges: list[np.ndarray], spec: BoostingSpec) -> np.ndarray:
    """(feature, bin, [gradient, hessian, rows]) of the first tree's root."""
    start, root, loss, most = base_score(rows, spec.loss), _stump(), spec.loss, spec.max_bins
    return blocks(block_table(rows, edges, False), start).map(lambda b: block_sums(b, root, [0], loss, most)).treeReduce(lambda a, b: a + b)[0]


def _stump() -> Tree:
    return Tree(np.array([-1]), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1))


class JointBins:
    """Groups of features with a code for each row of a group: its place among the bins that
    the features have together, ``JOINT_BINS`` at most."""

    def __init__(self, bins: np.ndarray):
        sizes = bins.max(axis=1, initial=0).astype(int) + 1
        self.groups: list[list[int]] = []
        for f in np.argsort(-sizes, kind="stable").tolist():
            for group in self.groups:
                if math.prod(sizes[group]) * sizes[f] <= JOINT_BINS:
                    group.append(f)
                    break
            else:
                self.groups.append([f])
        self.shapes = [tuple(sizes[group].tolist()) for group in self.groups]
        self.codes = []
        for group, shape in zip(self.groups, self.shapes):
            code = bins[group[0]].astype(np.uint16)
            for f, size in zip(group[1:], shape[1:]):
                code *= size
                code += bins[f]
            self.codes.append(code)

    def sums(self, features: int, weights: list, codes: list[np.ndarray], max_bins: int) -> np.ndarray:
        """(feature, bin, weight) sums of rows with these codes; None counts rows."""
        out = np.zeros((features, max_bins, len(weights)))
        for group, shape, code in zip(self.groups, self.shapes, codes):
            key = code.astype(np.intp)
            for i, weight in enumerate(weights):
                sums = np.bincount(key, weight, math.prod(shape)).reshape(shape)
                for axis, f in enumerate(group):
                    out[f, : shape[axis], i] = sums.sum(axis=tuple(k for k in range(len(shape)) if k != axis))
        return out

    def node_sums(self, features: int, g: np.ndarray, h: np.ndarray | None, rows: np.ndarray, max_bins: int) -> np.ndarray:
        """``node_sums`` of the rows."""
        got = self.sums(features, [g, None] if h is None else [g, h, None], [c.take(rows) for c in self.codes], max_bins)
        return got if h is not None else got[..., [0, 1, 1]]


class InTask:
    """The rows of one task."""

    ahead = False

    def __init__(self, block, spec: BoostingSpec):
        self.block, self.loss, self.bins = block, spec.loss, spec.max_bins
        self.training = np.flatnonzero(block[3])
        self.joint = JointBins(block[0]) if len(self.training) >= JOINT_ROWS else None
        self.plain = spec.loss == "squared_error" and (block[2] == 1).all()  # every hessian is 1

    def root(self) -> tuple[np.ndarray, float, float]:
        self.held = {0: self.training}
        _, y, w, _, raw = self.block
        self.g, h = gradients(self.loss, raw, y, w)  # once a tree
        self.h = None if self.plain else h
        return self.sums(_stump(), [0])[0], *held_out_loss(self.block, self.loss)

    def sums(self, tree: Tree, wanted: list[int]) -> np.ndarray:
        bins, out = self.block[0], []
        for rows in tree.rows(wanted, bins, self.held):
            g, h = self.g.take(rows), None if self.h is None else self.h.take(rows)
            out.append(node_sums(bins, g, h, rows, self.bins) if len(rows) < JOINT_ROWS or not self.joint
                       else self.joint.node_sums(len(bins), g, h, rows, self.bins))
        return np.stack(out)

    def step(self, tree: Tree) -> None:
        self.block = (*self.block[:4], tree.step(self.block[0], self.block[4]))


class OverCluster:
    """Blocks kept over the cluster; a pass is one aggregate, only its sums reach the driver."""

    ahead = True

    def __init__(self, table: DataFrame, start: float, spec: BoostingSpec):
        self.loss, self.bins, self.trees, self.before = spec.loss, spec.max_bins, 0, None
        self.state = blocks(table, start).persist(StorageLevel.MEMORY_AND_DISK)
        self.depth = reduce_depth(self.state)

    def root(self) -> tuple[np.ndarray, float, float]:
        loss, bins = self.loss, self.bins
        got = self.state.map(lambda b: (block_sums(b, _stump(), [0], loss, bins)[0], *held_out_loss(b, loss))).treeReduce(_plus, self.depth)
        if self.before is not None:
            self.before.unpersist()  # the new scores were kept by this pass
        return got

    def sums(self, tree: Tree, wanted: list[int]) -> np.ndarray:
        loss, bins = self.loss, self.bins
        return self.state.map(lambda b: block_sums(b, tree, wanted, loss, bins)).treeReduce(lambda a, b: a + b, self.depth)

    def step(self, tree: Tree) -> None:
        self.before, self.state = self.state, self.state.map(lambda b: (*b[:4], tree.step(b[0], b[4]))).persist(StorageLevel.MEMORY_AND_DISK)
        self.trees += 1
        if self.trees % CHECKPOINT_TREES == 0:
            self.state.checkpoint()  # cuts the lineage, in the shared folder

    def close(self) -> None:
        self.state.unpersist()


def boosted(state: InTask | OverCluster, spec: BoostingSpec) -> list[Tree]:
    """The trees, each grown on what those before leave."""
    trees: list[Tree] = []
    losses: list[float] = []
    for _ in range(spec.max_iter):
        root, held_loss, held_weight = state.root()
        if held_weight:
            losses.append(held_loss / held_weight)
            if len(losses) > PATIENCE and min(losses[-PATIENCE:]) >= losses[-PATIENCE - 1] - TOLERANCE:
                break
        trees.append(Grower(spec, state.sums, state.ahead).grow(root))
        if len(trees[-1].feature) == 1:
            break  # no split gains any more
        state.step(trees[-1])
    return trees


def train(rows: DataFrame, spec: BoostingSpec) -> BoostedTrees:
    """``rows``: features array<double>, label, weight."""
    features, n = len(rows.first()["features"]), rows.count()
    edges = collected_edges(bin_edges(rows, spec.max_bins), features)
    start = base_score(rows, spec.loss)
    table = block_table(rows, edges, n > EARLY_STOP_ROWS)
    if n <= LOCAL_ROWS:
        trees = trained_in_task(table, start, spec)
    else:
        state = OverCluster(table, start, spec)
        trees = boosted(state, spec)
        state.close()
    return BoostedTrees(spec, start, edges, trees)


def trained_in_task(table: DataFrame, start: float, spec: BoostingSpec) -> list[Tree]:
    def run(batches):
        for block in joined(pickle.loads(b.as_py()) for batch in batches for b in batch.column("block")):
            trees = boosted(InTask((*block, np.full(len(block[1]), start)), spec), spec)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trees)], pa.binary())], ["trees"])

    return pickle.loads(table.coalesce(1).mapInArrow(run, "trees binary").first()["trees"])  # the model


@dataclass
class BoostedTrees:
    spec: BoostingSpec
    start: float
    edges: list[np.ndarray]
    trees: list[Tree]

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = binned(x, self.edges)
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += t.value[t.leaves(bins)]
        return out


# --- pyspark.ml ----------------------------------------------------------------------
class HistogramBoosting(Estimator):
    """Estimator over ``features`` (vector), ``label`` and, if present, ``weight``."""

    def __init__(self, spec: BoostingSpec):
        super().__init__()
        self.spec = spec

    def _fit(self, dataset: DataFrame) -> HistogramBoostingModel:
        ship_package(dataset.sparkSession)
        weight = F.col("weight").cast("double") if "weight" in dataset.columns else F.lit(1.0)
        rows = dataset.select(vector_to_array("features").alias("features"), F.col("label").cast("double").alias("label"), weight.alias("weight"))
        rows = rows.persist()
        try:
            return HistogramBoostingModel(train(rows, self.spec))
        finally:
            rows.unpersist()


class HistogramBoostingModel(Model, MLWritable, MLReadable):
    """Adds ``prediction``, and ``probability`` for a classifier.  Rows are scored in Arrow batches."""

    def __init__(self, fitted: BoostedTrees):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        fitted = dataset.sparkSession.sparkContext.broadcast(self.fitted)

        @F.pandas_udf("double")
        def raw(x: pd.Series) -> pd.Series:
            return pd.Series(fitted.value.raw(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

        score = raw(vector_to_array("features"))
        if self.fitted.spec.loss == "squared_error":
            return dataset.withColumn("prediction", score)
        out = dataset.withColumn("_raw", score).withColumn("_p", 1 / (1 + F.exp(-F.col("_raw"))))
        return (out.withColumn("rawPrediction", array_to_vector(F.array(-F.col("_raw"), F.col("_raw"))))
                .withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))))
                .withColumn("prediction", (F.col("_p") > 0.5).cast("double")).drop("_raw", "_p"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    """The parameters as metadata, the nodes and edges as two tables."""

    def __init__(self, model: HistogramBoostingModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        fitted, spark = self.model.fitted, self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={
            "spec": asdict(fitted.spec), "start": fitted.start, "features": len(fitted.edges)})
        save_trees(spark, path, fitted.trees, fitted.edges)


def save_trees(spark: SparkSession, path: str, trees: list[Tree], edges: list[np.ndarray]) -> None:
    sizes = [len(t.feature) for t in trees]
    columns = {"tree": np.repeat(np.arange(len(trees)), sizes), "node": np.concatenate([np.arange(k) for k in sizes])} if trees else {"tree": [], "node": []}
    columns |= {c: np.concatenate([getattr(t, c) for t in trees]) if trees else [] for c in ("feature", "cut", "left", "right")}
    table = pa.table({c: pa.array(x, pa.int32()) if isinstance(x, list) else pa.array(x.astype(np.int32)) for c, x in columns.items()}
                     | {"value": pa.array(np.concatenate([t.value for t in trees]) if trees else np.zeros(0))})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/nodes")
    spark.createDataFrame([(f, float(e)) for f, es in enumerate(edges) for e in es], "feature int, edge double").coalesce(1).write.parquet(f"{path}/edges")


def load_trees(spark: SparkSession, path: str, features: int) -> tuple[list[Tree], list[np.ndarray]]:
    nodes = spark.read.parquet(f"{path}/nodes").toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
    held = {c: nodes[c].to_numpy() for c in ("tree", "feature", "cut", "left", "right", "value")}
    starts = np.flatnonzero(np.diff(held.pop("tree"), prepend=-1))
    trees = [Tree(*x) for x in zip(*(np.split(held[c], starts[1:]) for c in ("feature", "cut", "left", "right", "value")))]
    return trees, collected_edges(spark.read.parquet(f"{path}/edges"), features)


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> HistogramBoostingModel:
        spark: SparkSession = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        trees, edges = load_trees(spark, path, meta["features"])
        model = self.cls(BoostedTrees(BoostingSpec(**meta["spec"]), meta["start"], edges, trees))
        model._resetUid(meta["uid"])
        return model
