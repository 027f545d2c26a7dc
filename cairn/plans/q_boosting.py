"""The first steps of the tree learners, checked by SQL over the churn training rows: bins,
gradient sums and gains of the first boosted tree's root, and each forest tree's sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..constants import CHURN_HORIZON_DAYS, CHURN_TRAIN_CUTOFFS, FEATURE_COLUMNS
from ..operators import boosting, forest
from ..operators.models import ClassifierSpec, forest_spec
from ..session import materialize, ship_package
from . import sql_parts as S
from .catalog import register
from .q_models import _round_all
from .q_trained import chain

_SPEC = ClassifierSpec().boosting
_BINS = _SPEC.max_bins
_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(CAST(COALESCE({c}, 0) AS DOUBLE), 6) AS v, y, w FROM tw" for c in FEATURE_COLUMNS)


@register("boosting_root_histogram", S.snapshot_sql(CHURN_TRAIN_CUTOFFS, churn_h=CHURN_HORIZON_DAYS, name="tr") + f"""
, tw AS (SELECT *, CAST(churn_90d AS DOUBLE) AS y,
    CAST(COUNT(*) OVER () AS DOUBLE) / (2.0 * COUNT(*) OVER (PARTITION BY churn_90d)) AS w FROM tr)
, base AS (SELECT SUM(w * y) / SUM(w) AS p FROM tw)
, lng AS ({_LONG})
, runs AS (SELECT feature, v, COUNT(*) AS c FROM lng GROUP BY feature, v)
, pre AS (SELECT *, SUM(c) OVER (PARTITION BY feature ORDER BY v) - c AS b0, SUM(c) OVER (PARTITION BY feature) AS n,
    COUNT(*) OVER (PARTITION BY feature) AS d, LEAD(v) OVER (PARTITION BY feature ORDER BY v) AS nxt FROM runs)
, ks AS (SELECT UNNEST(RANGE(1, {_BINS})) AS k)
, edges AS (
  SELECT feature, (v + nxt) / 2 AS e FROM pre WHERE d <= {_BINS} AND nxt IS NOT NULL
  UNION
  SELECT lo.feature, (lo.v + hi.v) / 2 FROM ks
  JOIN pre lo ON lo.d > {_BINS} AND (lo.n - 1) * k // {_BINS} BETWEEN lo.b0 AND lo.b0 + lo.c - 1
  JOIN pre hi ON hi.feature = lo.feature AND ((lo.n - 1) * k + {_BINS - 1}) // {_BINS} BETWEEN hi.b0 AND hi.b0 + hi.c - 1)
, placed AS (SELECT r.feature, r.v, COUNT(e.e) AS bin FROM runs r LEFT JOIN edges e ON e.feature = r.feature AND e.e < r.v GROUP BY r.feature, r.v)
, sums AS (SELECT l.feature, p.bin, COUNT(*) AS n, SUM(l.w * (base.p - l.y)) AS g, SUM(l.w * base.p * (1 - base.p)) AS h
  FROM lng l JOIN placed p ON p.feature = l.feature AND p.v = l.v, base GROUP BY l.feature, p.bin)
, cum AS (SELECT *, SUM(n) OVER a AS nl, SUM(g) OVER a AS gl, SUM(h) OVER a AS hl, SUM(n) OVER t AS nt, SUM(g) OVER t AS gt, SUM(h) OVER t AS ht
  FROM sums WINDOW a AS (PARTITION BY feature ORDER BY bin), t AS (PARTITION BY feature))
SELECT feature, CAST(bin AS INTEGER) AS bin, CAST(n AS BIGINT) AS training_rows, ROUND(g, 6) AS gradient, ROUND(h, 6) AS hessian,
  CASE WHEN LEAST(nl, nt - nl) >= {_SPEC.min_leaf} AND LEAST(hl, ht - hl) >= {boosting.MIN_HESSIAN} THEN
    ROUND(gl * gl / (hl + {_SPEC.l2}) + (gt - gl) * (gt - gl) / (ht - hl + {_SPEC.l2}) - gt * gt / (ht + {_SPEC.l2}), 6) END AS gain
FROM cum
""")
def boosting_root_histogram(spark, sf_dir):
    """M5: bins at exact quantiles, sums of gradient and hessian per (feature, bin) and the
    gain of a cut after each bin, for the root of the first tree."""
    train, _ = chain(spark, sf_dir).churn_data
    ship_package(spark)
    rows = materialize(train.select(F.array(*[F.round(c, 6) for c in FEATURE_COLUMNS]).alias("features"), "label", "weight"))
    edges = boosting.collected_edges(boosting.bin_edges(rows, _BINS), len(FEATURE_COLUMNS))
    sums = boosting.root_sums(rows, edges, _SPEC)
    gains = boosting.split_gains(sums, _SPEC)
    found = [(FEATURE_COLUMNS[f], b, int(sums[f, b, 2]), float(sums[f, b, 0]), float(sums[f, b, 1]),
              float(gains[f, b]) if np.isfinite(gains[f, b]) else None) for f, b in zip(*np.nonzero(sums[..., 2]))]
    # features x bins rows
    return _round_all(spark.createDataFrame(
        [(x[0], int(x[1]), *x[2:]) for x in found], "feature string, bin int, training_rows long, gradient double, hessian double, gain double"))


_FOREST = forest_spec(ClassifierSpec())
_P = forest.PRIME
_COUNT = " + ".join(f"(CASE WHEN h >= {e} THEN 1 ELSE 0 END)" for e in forest.POISSON_EDGES.tolist())


@register("forest_tree_weights", S.snapshot_sql(CHURN_TRAIN_CUTOFFS, churn_h=CHURN_HORIZON_DAYS, name="tr") + f"""
, k AS (SELECT churn_90d AS y, ((customer_id % {_P}) * 1000003 + date_diff('day', DATE '1970-01-01', snapshot_date)) % {_P} AS key FROM tr)
, t AS (SELECT UNNEST(RANGE(0, {_FOREST.trees})) AS tree)
, h1 AS (SELECT tree, y, (key + (tree + 1) * 48271) % {_P} AS h FROM k, t)
, h2 AS (SELECT tree, y, (h * h + 7919 * h) % {_P} AS h FROM h1)
, h3 AS (SELECT tree, y, (h * h + 104729 * h + tree) % {_P} AS h FROM h2)
, c AS (SELECT tree, y, {_COUNT} AS n FROM h3)
, s AS (SELECT tree, SUM(n) AS drawn, SUM(n * y) AS positives FROM c GROUP BY tree)
SELECT CAST(tree AS INTEGER) AS tree, CAST(drawn AS BIGINT) AS drawn_rows, CAST(positives AS BIGINT) AS positive_rows,
  ROUND(drawn / (2.0 * (drawn - positives)), 6) AS weight_0, ROUND(drawn / (2.0 * positives), 6) AS weight_1 FROM s
""")
def forest_tree_weights(spark, sf_dir):
    """M4, M6: rows that each tree of the forest draws, and the class weights of its own
    sample."""
    train, _ = chain(spark, sf_dir).churn_data
    ship_package(spark)
    rows = materialize(train.select(F.array(*[F.col(c) for c in FEATURE_COLUMNS]).alias("features"), "label",
                                    forest.row_key(F.col("customer_id"), F.col("snapshot_date")).alias("row_key")))
    edges = boosting.collected_edges(boosting.bin_edges(rows, _FOREST.max_bins), len(FEATURE_COLUMNS))
    state = forest.sampled_blocks(rows, edges)
    trees = _FOREST.trees
    drawn = state.map(lambda b: forest.class_weights(b, trees)).treeReduce(lambda a, b: a + b)
    found = [(t, int(n), int(p), *w) for t, ((n, p), w) in enumerate(zip(drawn.tolist(), forest.tree_weights(state, _FOREST)))]
    return _round_all(spark.createDataFrame(found, "tree int, drawn_rows long, positive_rows long, weight_0 double, weight_1 double"))
