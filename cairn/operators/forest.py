"""Random forests with per-tree subsamples, trained data-parallel.

Every tree draws its own sample: a row counts 0, 1, 2, ... times by a hash of its key and
the tree's number (Poisson with mean 1, which is what drawing n rows with replacement comes
to).  A balanced classifier weighs the classes of each tree by that tree's own sample:
n / (2 * n of the class), from one aggregate over all trees.

A sample of up to ``LOCAL_ROWS`` rows grows whole in one task: the binned rows, some 20 bytes
each, are copied to a few tasks a core, and each draws the samples of its trees itself.

Of larger samples, nodes of more than ``LOCAL_ROWS`` rows grow together, level by level.  A pass sums (tree,
node, feature, bin) counts of open nodes over the binned rows, each node over the features
that were drawn for it; the open nodes of a level are dealt to passes so that the sums of
one stay under ``LEVEL_CELLS`` numbers.  The sampled rows of a smaller node, packed to a byte
a feature, are exchanged once by (tree, node), and one task grows what is below it: the sums
of the many deep nodes never leave a task.  There the rows, a record each, are kept in the
order of their nodes, so that a node is one run of records.  A large node of a regression
is summed by joint bins of several features.  A node is cut where the weighted Gini impurity
(or the squared error) falls most, and stays a leaf if it is pure, at full depth, or if no
cut of its features leaves ``min_leaf`` rows on both sides.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .boosting import JointBins, Tree, bin_edges, binned, collected_edges, load_trees, reduce_depth, save_trees

#: numbers of one pass (8 bytes each)
LEVEL_CELLS = 4_000_000
#: rows of a tree's sample that one task can grow on (some 100 bytes each)
LOCAL_ROWS = 2_500_000
#: share of the rows that a sample holds
SAMPLED = 1 - math.exp(-1)
#: tasks a core that trees are dealt to
DEALT = 3
#: rows whose sums are made together: their columns stay in a core's cache
PIECE_ROWS = 1 << 15
#: nodes of so many rows on average are summed one by one
RUN_ROWS = 600
#: rows from which a node of a regression is summed by joint bins
JOINT_ROWS = 1 << 13
#: tasks of the exchanged rows, or as many as make this many bytes each
MOST_TASKS, TASK_BYTES = 4096, 32 << 20
#: counts and rows are summed in one number: both stay below this
PACK = float(1 << 26)
#: integers below this are exact in a double
EXACT = float(1 << 53)
#: modulus of the hash, a prime
PRIME = 2_147_483_647


@dataclass
class ForestSpec:
    task: str = "classify"  # or regress
    trees: int = 260
    depth: int = 14
    min_leaf: int = 12
    features: float | str = "sqrt"  # or a share of the features
    balanced: bool = True  # classes weighed per tree
    max_bins: int = 64
    seed: int = 11

    def drawn(self, n: int) -> int:
        return max(1, int(math.sqrt(n)) if self.features == "sqrt" else int(self.features * n))


# --- samples ---------------------------------------------------------------------------
def _poisson_edges() -> np.ndarray:
    """Hash values up to which a row counts 0, 1, 2, ... times: exp(-1) / k! of them each."""
    share = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.floor(share * PRIME).astype(np.int64)


POISSON_EDGES = _poisson_edges()


def _modulo(x: np.ndarray) -> np.ndarray:
    """``x % PRIME`` of numbers from 0: the prime is 2**31 - 1, so no division is needed."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    x -= PRIME * (x >= PRIME)
    return x


def sample_hash(key: np.ndarray, tree: int) -> np.ndarray:
    """Two quadratic steps modulo a prime, in 64-bit integers."""
    h = (key + (tree + 1) * 48_271) % PRIME if np.min(key, initial=0) < 0 else _modulo(key + (tree + 1) * 48_271)
    h = _modulo(h * h + 7_919 * h)
    return _modulo(h * h + 104_729 * h + tree)


def sample_counts(key: np.ndarray, tree: int) -> np.ndarray:
    out = np.empty(len(key), np.uint8)
    for lo in range(0, len(key), PIECE_ROWS):  # in a core's cache
        h = sample_hash(key[lo:lo + PIECE_ROWS].astype(np.int64), tree)
        piece = np.zeros(len(h), np.uint8)
        for edge in POISSON_EDGES:
            piece += h >= edge
        out[lo:lo + PIECE_ROWS] = piece
    return out


def class_weights(block, trees: int) -> np.ndarray:
    """(tree, [rows, positive rows]) of the samples of a block."""
    _, y, key = block
    out = np.zeros((trees, 2))
    for t in range(trees):
        c = sample_counts(key, t)
        out[t] = c.sum(), (c * y).sum()
    return out


def drawn_features(spec: ForestSpec, tree: int, path, n: int) -> np.ndarray:
    """The features that a node may be cut by: those that hash lowest with the node's place.
    ``path`` may be an array of places, for a row of features each."""
    place = (np.asarray(path, np.int64) % PRIME * 31 + (tree + 1) * 7_477 + spec.seed * 104_651) % PRIME
    hashed = sample_hash((place[..., None] + np.arange(n) * 15_485_863) % PRIME, tree)
    return np.sort(np.argsort(hashed, axis=-1, kind="stable")[..., : spec.drawn(n)], axis=-1)


# --- growth ----------------------------------------------------------------------------
def cell_sums(bins, y, count, rows, at, drawn, spec: ForestSpec) -> np.ndarray:
    """(node, drawn feature, bin, [count, count * y, rows]) sums of ``rows``, which lie in
    nodes ``at``; y is 1 for a positive row of a classifier.  A slice of rows lies node after
    node."""
    m, k = drawn.shape
    run = isinstance(rows, slice)
    c, label = count[rows].astype(float), y[rows]
    positive = c * ((label > 0) if spec.task == "classify" else label)
    out = np.zeros((3, m, k, spec.max_bins))
    if not run:
        flat, (step, row) = _in_memory_order(bins)
        base, place = at * spec.max_bins, rows * row
        cells = lambda a, b, j: base + flat.take((drawn[:, j] * step).take(at) + place)
        _add_sums(out, cells, m, c, positive, 0, len(c), lambda a, b: at, spec)
        return np.moveaxis(out, 0, -1)
    near, sizes = bins[:, rows], np.bincount(at, minlength=m)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    if len(c) >= RUN_ROWS * m:
        for i in range(m):
            _add_sums(out[:, i:i + 1], lambda a, b, j: near[drawn[i, j], a:b], 1, c, positive, starts[i], starts[i + 1], None, spec)  # noqa: B023
        return np.moveaxis(out, 0, -1)
    flat, (step, row) = _in_memory_order(near)
    base, place = np.repeat(np.arange(0, m * spec.max_bins, spec.max_bins), sizes), np.arange(len(c)) * row
    cells = lambda a, b, j: base[a:b] + flat.take(np.repeat(drawn[:, j] * step, sizes)[a:b] + place[a:b])
    _add_sums(out, cells, m, c, positive, 0, len(c), lambda a, b: at[a:b], spec)
    return np.moveaxis(out, 0, -1)


def _in_memory_order(bins: np.ndarray) -> tuple[np.ndarray, tuple[int, int]]:
    """The bins as they lie in memory, and the steps there from feature to feature and from row
    to row."""
    if bins.flags.c_contiguous:
        return bins.ravel(), (bins.shape[1], 1)
    return np.ascontiguousarray(bins.T).ravel(), (1, bins.shape[0])


def _add_sums(out, cells, m: int, c, positive, lo: int, hi: int, nodes, spec: ForestSpec) -> None:
    """Add to ``out`` (sum, node, drawn feature, bin) the rows from ``lo`` to ``hi``, whose
    cells of drawn feature j ``cells`` gives, and whose nodes ``nodes`` (None: there is one)."""
    size = m * spec.max_bins
    step = PIECE_ROWS if nodes is None and spec.task == "classify" else max(1, hi - lo)  # whole numbers: in any order
    for a in range(lo, hi, step):
        b = min(a + step, hi)
        top = c[a:b].sum() if nodes is None else np.bincount(nodes(a, b), c[a:b], 1).max(initial=1.0)
        most = 2.0 ** math.ceil(math.log2(top + 1))  # over any sum of counts
        whole = spec.task == "classify" and most ** 3 <= EXACT  # all three sums in one number
        packed = (c[a:b] * most + positive[a:b]) * most + 1 if whole else c[a:b] * PACK + 1
        for j in range(out.shape[2]):
            cell = cells(a, b, j)
            sums = np.bincount(cell, packed, size).reshape(m, -1)
            if whole:
                rest = np.floor(sums / most)
                count = np.floor(rest / most)
                out[1, :, j] += rest - count * most
                out[2, :, j] += sums - rest * most
            else:
                count = np.floor(sums / PACK)
                out[1, :, j] += np.bincount(cell, positive[a:b], size).reshape(m, -1)
                out[2, :, j] += sums - count * PACK
            out[0, :, j] += count


def node_sums(block, trees: dict[int, Tree], wanted: dict[int, tuple[np.ndarray, np.ndarray]], spec: ForestSpec) -> dict[int, np.ndarray]:
    """``cell_sums`` of a block for the wanted (nodes, their drawn features) of each tree."""
    bins, y, key = block
    out = {}
    for t, (nodes, drawn) in wanted.items():
        count = sample_counts(key, t)
        at, rows = _inside(trees[t], nodes, bins, count)
        out[t] = cell_sums(bins, y, count, rows, at, drawn, spec)
    return out


def _inside(tree: Tree, nodes, bins: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the node in ``nodes``, row) of the sampled rows in ``nodes``."""
    slot = np.full(len(tree.feature), -1)
    slot[nodes] = np.arange(len(nodes))
    at = slot[tree.leaves(bins)]
    rows = np.flatnonzero((at >= 0) & (count > 0))
    return at[rows], rows


def _add(a: dict, b: dict) -> dict:
    return {t: a[t] + b[t] for t in a}


def best_cuts(sums: np.ndarray, weights: tuple[float, float], spec: ForestSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each node its value, and of its best cut, the first among equals, the place among
    the drawn features (-1 if no cut helps), the bin, and the rows to the left."""
    m, _, most, _ = sums.shape
    # three arrays, each in one piece: count, count * y, rows up to a bin
    count, label, number = left = [np.cumsum(np.ascontiguousarray(sums[..., i]), axis=2) for i in range(3)]

    def parts(n, positive):  # weight, and what is squared over it
        if spec.task == "classify":
            none, some = weights[0] * (n - positive), weights[1] * positive
            return none + some, none ** 2 + some ** 2, some
        return n, positive ** 2, positive

    def score(n, positive):
        w, top, _ = parts(n, positive)
        return top / np.maximum(w, 1e-300)

    right = [x[:, :, -1:] - x for x in left]
    gain = score(count, label)
    gain += score(*right[:2])
    gain[np.minimum(number, right[2]) < spec.min_leaf] = -np.inf
    gain = gain.reshape(m, -1)
    at = gain.argmax(axis=1)
    top, whole = gain[np.arange(m), at], (count[:, 0, -1], label[:, 0, -1])
    w, _, some = parts(*whole)
    found = np.isfinite(top) & (top > score(*whole) + 1e-12)
    j, cut = np.divmod(at, most)
    return np.where(w > 0, some / np.where(w > 0, w, 1), 0.0), np.where(found, j, -1), cut, number[np.arange(m), j, cut]


def leaf_values(y, count, rows, ends, weights: tuple[float, float], spec: ForestSpec) -> tuple[np.ndarray, np.ndarray]:
    """The values of nodes that hold ``rows`` one after another, up to ``ends``, and which of
    the nodes are pure."""
    starts = np.concatenate([[0], ends[:-1]])
    c, label = count[rows].astype(float), y[rows]
    pure = np.minimum.reduceat(label, starts) == np.maximum.reduceat(label, starts)
    n, some = np.add.reduceat(c, starts), np.add.reduceat(c * label, starts)
    if spec.task == "classify":
        n, some = weights[0] * (n - some) + weights[1] * some, weights[1] * some
    return np.where(n > 0, some / np.where(n > 0, n, 1), 0.0), pure


def _pieces(sizes: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of nodes of these ``sizes``, in runs of at most ``most`` nodes and, but for a
    larger node alone, ``PIECE_ROWS`` rows."""
    out, ends, lo = [], np.cumsum(sizes), 0
    while lo < len(sizes):
        before = ends[lo] - sizes[lo]
        hi = min(max(int(np.searchsorted(ends, before + PIECE_ROWS, "right")), lo + 1), lo + most)
        out.append(np.arange(lo, min(hi, len(sizes))))
        lo = hi
    return out


class _Growing:
    """A tree under growth; nodes are numbered as they appear, siblings together."""

    def __init__(self, number: int, rows: int):
        self.number = number
        self.feature, self.cut, self.left, self.right, self.value, self.path = [-1], [0], [0], [0], [0.0], [1]
        self.open, self.handed = ([0], []) if rows > LOCAL_ROWS else ([], [0])

    def tree(self) -> Tree:
        return Tree(np.array(self.feature, np.int16), np.array(self.cut, np.int16), np.array(self.left, np.int32), np.array(self.right, np.int32), np.array(self.value))

    def split(self, node: int, feature: int, cut: int, sizes: tuple[int, int]) -> list[int]:
        """Cut a node; returns the children that are still too large for one task."""
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        large = []
        for side, size in enumerate(sizes):
            (large if size > LOCAL_ROWS else self.handed).append(len(self.feature))
            for row, x in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0), (self.path, 2 * self.path[node] + side)):
                row.append(x)
        return large

    def joined(self, below: dict[int, Tree]) -> Tree:
        """The tree with the trees ``below`` its handed nodes."""
        whole, size = [self.tree()], len(self.feature)
        for node, sub in below.items():
            shift = lambda side, inner: np.where(inner, side + (size - 1), 0).astype(np.int32)  # noqa: E731, B023
            moved = Tree(sub.feature, sub.cut, shift(sub.left, sub.feature >= 0), shift(sub.right, sub.feature >= 0), sub.value)
            for name in ("feature", "cut", "left", "right", "value"):
                getattr(whole[0], name)[node] = getattr(moved, name)[0]
            whole.append(Tree(*(getattr(moved, name)[1:] for name in ("feature", "cut", "left", "right", "value"))))
            size += len(sub.feature) - 1
        return Tree(*(np.concatenate([getattr(t, name) for t in whole]) for name in ("feature", "cut", "left", "right", "value")))


def _partition(right: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts the rows of every node, which lie node after node, with those of its
    left child first, and the sizes of the children."""
    to_left, to_right = np.flatnonzero(~right), np.flatnonzero(right)
    ends = np.cumsum(sizes)
    before = np.searchsorted(to_right, np.concatenate([[0], ends]))  # rows to the right before each node
    n_right = np.diff(before)
    n_left = sizes - n_right
    order = np.empty(len(right), np.intp)
    order[np.arange(len(to_left)) + np.repeat(before[:-1], n_left)] = to_left
    order[np.arange(len(to_right)) + np.repeat(ends - n_right - before[:-1], n_right)] = to_right
    return order, np.stack([n_left, n_right], axis=1).ravel()


def _taken(rows: np.ndarray, x: np.ndarray, y: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """These rows of the records and columns."""
    whole = x.view(np.dtype((np.void, x.shape[1]))).ravel().take(rows)
    return whole.view(np.uint8).reshape(-1, x.shape[1]), y.take(rows), count.take(rows)


def _records(bins: np.ndarray, spec: ForestSpec) -> tuple[np.ndarray, JointBins | None]:
    """The bins of every row and, of many rows of a regression, behind them its joint codes, if
    these are fewer than the features that a node draws."""
    features, n = bins.shape
    joint = JointBins(bins) if spec.task == "regress" and n >= JOINT_ROWS else None
    if not joint or len(joint.groups) >= spec.drawn(features):
        return np.ascontiguousarray(bins.T), None
    first = -(-features // 2) * 2
    x = np.zeros((n, -(-(first + 2 * len(joint.groups)) // 16) * 16), np.uint8)
    x[:, :features] = bins.T
    wide = x.view(np.uint16)
    for i, code in enumerate(joint.codes):
        wide[:, first // 2 + i] = code
    joint.codes = None  # they lie in the records
    return x, joint


def _joint_sums(joint: JointBins, x: np.ndarray, y: np.ndarray, count: np.ndarray, drawn: np.ndarray, spec: ForestSpec) -> np.ndarray:
    """``cell_sums`` of the rows of one node by its joint codes."""
    features = sum(map(len, joint.groups))
    c = count.astype(float)
    first, packed = -(-features // 2), c * PACK + 1
    codes = [x.view(np.uint16)[:, first + i] for i in range(len(joint.groups))]
    both = joint.sums(features, [packed, c * y], codes, spec.max_bins)[drawn]
    sums = np.empty((*both.shape[:2], 3))
    sums[..., 0] = np.floor(both[..., 0] / PACK)
    sums[..., 1] = both[..., 1]
    sums[..., 2] = both[..., 0] - sums[..., 0] * PACK
    return sums


def grown_below(bins: np.ndarray, y: np.ndarray, count: np.ndarray, path: int, tree: int, weights: tuple[float, float], spec: ForestSpec) -> Tree:
    """The tree below the node at ``path`` from its sampled rows, level by level."""
    features = len(bins)
    most = max(1, LEVEL_CELLS // 4 // (spec.drawn(features) * spec.max_bins * 3))
    x, joint = _records(bins, spec)  # a record a row, kept in the order of the nodes
    sizes, paths, base, levels = np.array([len(y)]), np.array([path]), 0, []
    for depth in range(int(path).bit_length() - 1, spec.depth + 1):
        m = len(paths)
        feature, cut, value, pure = np.full(m, -1, np.int16), np.zeros(m, np.int16), np.zeros(m), np.ones(m, bool)
        ends = np.cumsum(sizes)  # no child is empty
        if len(y):
            value, pure = leaf_values(y, count, slice(None), ends, weights, spec)
        # a node that cannot be cut needs no sums
        open_ = np.flatnonzero(~pure & (sizes >= 2 * spec.min_leaf)) if depth < spec.depth else np.zeros(0, np.int64)
        drawn = drawn_features(spec, tree, paths[open_], features)
        own = (sizes[open_] >= JOINT_ROWS) if joint else np.zeros(len(open_), bool)
        pieces = [np.array([i]) for i in np.flatnonzero(own)]
        rest = np.flatnonzero(~own)
        for piece in pieces + [rest[p] for p in _pieces(sizes[open_[rest]], most)]:
            some, nodes = drawn[piece], open_[piece]
            near = slice(int(ends[nodes[0]] - sizes[nodes[0]]), int(ends[nodes[-1]]))
            held = x[near], y[near], count[near]
            if nodes[-1] - nodes[0] >= len(nodes):  # others lie between
                keep = np.repeat(np.isin(np.arange(nodes[0], nodes[-1] + 1), nodes), sizes[nodes[0]: nodes[-1] + 1])
                held = _taken(np.flatnonzero(keep), *held)
            if own[piece[0]]:
                sums = _joint_sums(joint, *held, some[0], spec)[None]
            else:
                sums = cell_sums(held[0].T, held[1], held[2], slice(None), np.repeat(np.arange(len(nodes)), sizes[nodes]), some, spec)
            _, j, c, _ = best_cuts(sums, weights, spec)
            feature[nodes] = np.where(j >= 0, some[np.arange(len(some)), j], -1)
            cut[nodes] = np.where(j >= 0, c, 0)
        inner = feature >= 0
        place = np.cumsum(inner) - 1
        base += m
        left = np.where(inner, base + 2 * place, 0).astype(np.int32)
        levels.append(Tree(feature, cut, left, np.where(inner, left + 1, 0).astype(np.int32), value))
        if not inner.any():
            break
        if not inner.all():
            x, y, count = _taken(np.flatnonzero(np.repeat(inner, sizes)), x, y, count)
            sizes = sizes[inner]
        order, sizes = _partition(_to_right(x, feature[inner], cut[inner], sizes), sizes)
        x, y, count = _taken(order, x, y, count)
        if joint and sizes.max(initial=0) < JOINT_ROWS:
            x, joint = np.ascontiguousarray(x[:, :features]), None
        paths = np.stack([2 * paths[inner], 2 * paths[inner] + 1], axis=1).ravel()
    return Tree(*(np.concatenate([getattr(t, name) for t in levels]) for name in ("feature", "cut", "left", "right", "value")))


def _to_right(x: np.ndarray, feature, cut, sizes) -> np.ndarray:
    """Whether each row, which lie node after node, goes to the right at its node's cut."""
    if len(x) < RUN_ROWS * len(sizes):
        place = np.arange(len(x)) * x.shape[1] + np.repeat(feature.astype(np.intp), sizes)
        return x.ravel().take(place) > np.repeat(cut, sizes)
    out, a = np.empty(len(x), bool), 0
    for f, c, size in zip(feature.tolist(), cut.tolist(), sizes.tolist()):
        np.greater(x[a:a + size, f], c, out=out[a:a + size])
        a += size
    return out


def _passes(growing: list[_Growing], spec: ForestSpec, features: int) -> list[dict[int, np.ndarray]]:
    """The open nodes of a level, dealt to passes of bounded sums."""
    most = max(1, LEVEL_CELLS // (spec.drawn(features) * spec.max_bins * 3))
    out, room = [], 0
    for g in growing:
        nodes = list(g.open)
        while nodes:
            if not room:
                out.append({})
                room = most
            out[-1][g.number] = np.array(nodes[:room])
            nodes, room = nodes[room:], room - min(room, len(nodes))
    return out


def _grow_handed(blocks: DataFrame, growing: list[_Growing], features: int, n: int, weights, spec: ForestSpec) -> dict[int, dict[int, Tree]]:
    """The trees below all handed nodes: a block's rows go to the task of their (tree, node)."""
    trees = {g.number: (g.tree(), np.array(g.handed)) for g in growing if g.handed}
    paths = {(g.number, node): g.path[node] for g in growing for node in g.handed}
    kind = np.uint8 if spec.task == "classify" else np.float64

    def send(batches):
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for block in batch.column("block"):
                bins, y, key = pickle.loads(block.as_py())
                y = (y > 0).astype(kind) if spec.task == "classify" else y.astype(kind)
                place += 1
                for t, (tree, nodes) in trees.items():
                    count = sample_counts(key, t)
                    at, rows = _inside(tree, nodes, bins, count)
                    rows = rows[np.argsort(at, kind="stable")]
                    ends = np.cumsum(np.bincount(at, minlength=len(nodes)))
                    cuts = [r for r in np.split(rows, ends[:-1])]
                    bodies = [bins[:, r].tobytes() + count[r].astype(np.uint8).tobytes() + y[r].tobytes() for r in cuts]
                    k = len(nodes)
                    batch_out = [pa.array([t] * k, pa.int32()), pa.array(nodes, pa.int32()), pa.array([part] * k, pa.int32()), pa.array([place] * k, pa.int32()),
                                 pa.array([len(r) for r in cuts], pa.int32()), pa.array(bodies, pa.binary())]
                    yield pa.RecordBatch.from_arrays(batch_out, ["tree", "node", "part", "place", "n", "body"])

    def grow(group: pa.Table) -> pa.Table:
        group = group.sort_by([("part", "ascending"), ("place", "ascending")])  # sums in one order, whatever came first
        t, node = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
        bins, count, y = [], [], []
        for size, body in zip(group.column("n").to_pylist(), group.column("body")):
            raw = body.as_buffer()
            bins.append(np.frombuffer(raw, np.uint8, features * size).reshape(features, size))
            count.append(np.frombuffer(raw, np.uint8, size, features * size))
            y.append(np.frombuffer(raw, np.uint8, offset=(features + 1) * size).view(kind) if not (features + 1) * size % 8 or kind == np.uint8
                     else np.frombuffer(bytes(raw)[(features + 1) * size:], kind))
        tree = grown_below(np.concatenate(bins, axis=1), np.concatenate(y), np.concatenate(count), paths[t, node], t, weights[t], spec)
        return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([node], pa.int32()), "body": pa.array([pickle.dumps(tree)], pa.binary())})

    # far more places than groups: few tasks hold several, and the others do not wait for them
    total = n * len(trees) * (features + 1 + np.dtype(kind).itemsize)
    tasks = min(2 * len(paths) + 1, max(MOST_TASKS, total // TASK_BYTES))
    sent = blocks.mapInArrow(send, "tree int, node int, part int, place int, n int, body binary").repartition(tasks, "tree", "node")
    out: dict[int, dict[int, Tree]] = {}
    for r in sent.groupBy("tree", "node").applyInArrow(grow, "tree int, node int, body binary").collect():  # the model
        out.setdefault(r["tree"], {})[r["node"]] = pickle.loads(r["body"])
    return out


def _grow_whole(blocks: DataFrame, spec: ForestSpec) -> tuple[list[Tree], list[tuple[float, float]]]:
    """All trees, each in one task, which holds the binned rows and draws the tree's sample."""
    tasks = min(spec.trees, DEALT * blocks.sparkSession.sparkContext.defaultParallelism)
    kind = np.uint8 if spec.task == "classify" else np.float64

    def grow(batches):
        parts = {}
        for batch in batches:
            mine = batch.column("task")[0].as_py() if batch.num_rows else None
            for place, block in zip(batch.column("place").to_pylist(), batch.column("block")):
                bins, y, key = pickle.loads(block.as_py())
                parts[place] = np.ascontiguousarray(bins.T), ((y > 0) if kind == np.uint8 else y).astype(kind), key.astype(np.int32)
        if not parts:
            return
        x, y, key = (np.concatenate(c) for c in zip(*(parts.pop(p) for p in sorted(parts))))  # sums in one order, whatever came first
        for t in range(mine, spec.trees, tasks):
            count = sample_counts(key, t)
            rows = np.flatnonzero(count)
            held, label, c = _taken(rows, x, y, count)
            weights = _weights(float(c.sum()), float(c.take(np.flatnonzero(label)).sum())) if _weighed(spec) else (1.0, 1.0)
            tree = grown_below(held.T, label, c, 1, t, weights, spec)
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([pickle.dumps((tree, weights))], pa.binary())], ["tree", "body"])

    sent = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))).repartitionById(tasks, F.col("task"))
    got = {r["tree"]: pickle.loads(r["body"]) for r in sent.mapInArrow(grow, "tree int, body binary").collect()}  # the model
    return [got[t][0] for t in range(spec.trees)], [got[t][1] for t in range(spec.trees)]


def _weighed(spec: ForestSpec) -> bool:
    return spec.task == "classify" and spec.balanced


def _weights(n: float, p: float) -> tuple[float, float]:
    """(weight of class 0, weight of class 1) of n rows of which p are positive."""
    return n / (2 * (n - p)) if n > p else 1.0, n / (2 * p) if p else 1.0


def tree_weights(state, spec: ForestSpec) -> list[tuple[float, float]]:
    """(weight of class 0, weight of class 1) of every tree, from its own sample."""
    if not _weighed(spec):
        return [(1.0, 1.0)] * spec.trees
    trees = spec.trees
    got = state.map(lambda b: class_weights(b, trees)).treeReduce(lambda a, b: a + b, reduce_depth(state))
    return [_weights(n, p) for n, p in got.tolist()]


def block_table(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """Pickled (bins, y, key) blocks of ``rows`` (features, label, row_key) and their places,
    written once."""

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        for place, b in enumerate(batches):
            if b.num_rows:
                x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                y, key = (b.column(c).to_numpy(zero_copy_only=False) for c in ("label", "row_key"))
                yield pa.RecordBatch.from_arrays([pa.array([first + place]), pa.array([pickle.dumps((binned(x, edges), y, key))], pa.binary())], ["place", "block"])

    key = F.pmod(F.col("row_key"), F.lit(PRIME)).cast("long").alias("row_key")
    return materialize(rows.select("features", "label", key).mapInArrow(run, "place long, block binary"))


def opened(blocks: DataFrame):
    return blocks.rdd.map(lambda r: pickle.loads(r["block"]))


def sampled_blocks(rows: DataFrame, edges: list[np.ndarray]):
    """The blocks of ``rows`` as an RDD."""
    return opened(block_table(rows, edges))


def train(rows: DataFrame, spec: ForestSpec) -> Forest:
    """``rows``: features array<double>, label, row_key (an integer that tells rows apart)."""
    features, n = len(rows.first()["features"]), rows.count()
    edges = collected_edges(bin_edges(rows, spec.max_bins), features)
    blocks = block_table(rows, edges)
    if n * SAMPLED <= LOCAL_ROWS:
        return Forest(spec, edges, *_grow_whole(blocks, spec))
    state = opened(blocks).persist(StorageLevel.MEMORY_AND_DISK)
    weights = tree_weights(state, spec)
    growing = [_Growing(t, n) for t in range(spec.trees)]
    for level in range(spec.depth + 1):
        fresh: dict[int, list[int]] = {}
        trees = {g.number: g.tree() for g in growing}
        for part in _passes(growing, spec, features):
            wanted = {t: (nodes, drawn_features(spec, t, [growing[t].path[i] for i in nodes], features)) for t, nodes in part.items()}
            held = {t: trees[t] for t in wanted}
            sums = state.map(lambda b, held=held, wanted=wanted: node_sums(b, held, wanted, spec)).treeReduce(_add, reduce_depth(state))
            for t, (nodes, drawn) in wanted.items():
                value, place, cut, left = best_cuts(sums[t], weights[t], spec)
                rows_in = sums[t][:, 0, :, 2].sum(axis=1)
                for i, node in enumerate(nodes.tolist()):
                    growing[t].value[node] = float(value[i])
                    if level < spec.depth and place[i] >= 0:
                        sizes = (int(left[i]), int(rows_in[i] - left[i]))
                        fresh.setdefault(t, []).extend(growing[t].split(node, int(drawn[i, place[i]]), int(cut[i]), sizes))
        for g in growing:
            g.open = fresh.get(g.number, [])
        if not any(g.open for g in growing):
            break
    state.unpersist()
    below = _grow_handed(blocks, growing, features, n, weights, spec) if any(g.handed for g in growing) else {}
    return Forest(spec, edges, [g.joined(below.get(g.number, {})) for g in growing], weights)


@dataclass
class Forest:
    spec: ForestSpec
    edges: list[np.ndarray]
    trees: list[Tree]
    weights: list[tuple[float, float]]

    def mean(self, x: np.ndarray) -> np.ndarray:
        """Mean over the trees of the leaf's share of positives (or mean label)."""
        bins = binned(x, self.edges)
        out = np.zeros(len(x))
        for t in self.trees:
            out += t.value[t.leaves(bins)]
        return out / max(1, len(self.trees))


# --- pyspark.ml ------------------------------------------------------------------------
class SampledForest(Estimator):
    """Estimator over ``features`` (vector) and ``label``; the columns ``keys`` tell rows apart."""

    def __init__(self, spec: ForestSpec, keys: tuple[str, ...] = ("customer_id", "snapshot_date")):
        super().__init__()
        self.spec, self.keys = spec, keys

    def _fit(self, dataset: DataFrame) -> SampledForestModel:
        ship_package(dataset.sparkSession)
        rows = dataset.select(vector_to_array("features").alias("features"), F.col("label").cast("double").alias("label"),
                              row_key(*[F.col(k) for k in self.keys if k in dataset.columns]).alias("row_key")).persist()
        try:
            return SampledForestModel(train(rows, self.spec))
        finally:
            rows.unpersist()


def row_key(*columns):
    """An integer from the id columns: the first times a constant, plus the days of a date."""
    first, *others = columns
    out = F.pmod(first.cast("long"), F.lit(PRIME)) * 1_000_003
    for c in others:
        out = out + F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date"))
    return F.pmod(out, F.lit(PRIME))


class SampledForestModel(Model, MLWritable, MLReadable):
    """Adds ``prediction``, and ``probability`` for a classifier."""

    def __init__(self, fitted: Forest):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        fitted = dataset.sparkSession.sparkContext.broadcast(self.fitted)

        @F.pandas_udf("double")
        def mean(x: pd.Series) -> pd.Series:
            return pd.Series(fitted.value.mean(np.stack(x.to_numpy())) if len(x) else np.zeros(0))

        score = mean(vector_to_array("features"))
        if self.fitted.spec.task == "regress":
            return dataset.withColumn("prediction", score)
        out = dataset.withColumn("_p", score)
        return (out.withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))))
                .withColumn("prediction", (F.col("_p") > 0.5).cast("double")).drop("_p"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: SampledForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        f, spark = self.model.fitted, self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={
            "spec": asdict(f.spec), "features": len(f.edges), "weights": [list(w) for w in f.weights]})
        save_trees(spark, path, f.trees, f.edges)


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> SampledForestModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        trees, edges = load_trees(self.sparkSession, path, meta["features"])
        model = self.cls(Forest(ForestSpec(**meta["spec"]), edges, trees, [tuple(w) for w in meta["weights"]]))
        model._resetUid(meta["uid"])
        return model
