"""Model-quality metrics as DataFrame aggregates (no collect of rows).

Inputs are scored frames with a binary label ``y`` (0/1), a score ``p`` and an id.
Orders are total: ties in the score are broken by the id.

A scored frame is sorted once, into one row per distinct score (``ScoreRuns``: rows and
positives of the score and of all higher ones).  Every metric of a classifier is an
aggregate of these runs.  Only where a cut falls inside a run of equal scores are the rows
of that score looked at, in the order of their ids.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import CLASSIFIER_SELECTION_WEIGHTS, REGRESSOR_SELECTION_WEIGHTS, THRESHOLD_GRID
from ..functions.ranking import avg_rank_pcts, materialize, ordered_running, value_prefix

# --- fixed values: grids in numpy's linspace arithmetic ------------------------------
THRESHOLDS = [float(x) for x in np.linspace(*THRESHOLD_GRID)]
LIFT_CHECKPOINTS = [float(x) for x in np.linspace(0.1, 1.0, 10)]


def _ge_count(p: Column, grid: list[float]) -> Column:
    """Number of grid points t with t <= p (binary CASE tree)."""

    def build(lo: int, hi: int) -> Column:  # answer in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2  # is grid[mid-1] <= p ?
        return F.when(p >= F.lit(grid[mid - 1]), build(mid, hi)).otherwise(build(lo, mid - 1))

    return build(0, len(grid))


class ScoreRuns:
    """One row per distinct score of a frame, highest first: p, rows, positives, above (rows
    with a higher score) and above_y (their positives); n and positives of the whole frame.
    Rows without a score have no place and are left out."""

    def __init__(self, scored: DataFrame, y: str = "y", p: str = "p", id_col: str = "customer_id"):
        self.id_col = id_col
        self.rows = scored.select(id_col, F.col(y).cast("long").alias("y"), F.col(p).cast("double").alias("p"))
        runs = value_prefix(self.rows, "p", sums=["y"], ascending=False)
        self.runs = materialize(runs.select("p", F.col("_cnt").alias("rows"), F.col("_s_y").alias("y"), F.col("_before").alias("above"),
                                            F.col("_sb_y").alias("above_y")))
        total = self.runs.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))).first()
        self.n, self.positives = int(total[0]), int(total[1])

    def positives_among(self, cuts: list[int], ascending: bool = False) -> list[int]:
        """Positives among the first ``k`` rows, for every ``k`` of ``cuts``, in the order of
        falling (or rising) scores and rising ids.  The cuts are few: a parameter's worth."""
        before = F.lit(self.n) - F.col("above") - F.col("rows") if ascending else F.col("above")
        before_y = F.lit(self.positives) - F.col("above_y") - F.col("y") if ascending else F.col("above_y")
        inside = sorted({k for k in cuts if 0 < k < self.n})
        known = {k: 0 if k <= 0 else self.positives for k in cuts}
        if inside:
            held = self.runs.withColumn("k", F.explode(F.filter(F.array(*[F.lit(k) for k in inside]), lambda k: (k > before) & (k <= before + F.col("rows")))))
            open_ = []
            for r in held.select("k", "p", "rows", "y", before.alias("b"), before_y.alias("by")).collect():  # one row per cut
                known[r.k] = r.by + r.y
                if r.k < r.b + r.rows and 0 < r.y < r.rows:
                    open_.append((r.k, r.p, r.k - r.b, r.by))
                elif r.k < r.b + r.rows:
                    known[r.k] = r.by + (r.k - r.b if r.y else 0)
            if open_:
                same = self.rows.where(F.col("p").isin(*{p for _, p, _, _ in open_}))
                placed = ordered_running(same, [(self.id_col, True)], self.id_col, sums=["y"], partition_by=["p"])
                wanted = {(p, at): (k, by) for k, p, at, by in open_}
                cut = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(at).alias("at")) for p, at in wanted])
                for r in placed.where(F.exists(cut, lambda c: (c["p"] == F.col("p")) & (c["at"] == F.col("_rn")))).select("p", "_rn", "_run_y").collect():
                    k, by = wanted[r.p, r._rn]
                    known[k] = by + r._run_y
        return [known[k] for k in cuts]

    def spread(self, ends: list[int]) -> DataFrame:
        """(bin, rows, score_sum): rows of rising score dealt to bins that end at ``ends``."""
        low = F.lit(self.n) - F.col("above") - F.col("rows")
        starts = [0, *ends[:-1]]
        parts = F.array(*[F.struct(F.lit(i).alias("bin"), (F.least(low + F.col("rows"), F.lit(e)) - F.greatest(low, F.lit(s))).alias("n"))
                          for i, (s, e) in enumerate(zip(starts, ends))])
        dealt = self.runs.select("p", F.explode(F.filter(parts, lambda x: x["n"] > 0)).alias("_x"))
        return dealt.groupBy(F.col("_x.bin").alias("bin")).agg(F.sum("_x.n").alias("rows"), F.sum(F.col("p") * F.col("_x.n")).alias("score_sum"))


def _runs(scored: DataFrame | ScoreRuns, y: str = "y", p: str = "p", id_col: str = "customer_id") -> ScoreRuns:
    return scored if isinstance(scored, ScoreRuns) else ScoreRuns(scored, y, p, id_col)


def f1_threshold_table(scored: DataFrame | ScoreRuns, y: str = "y", p: str = "p", grid: list[float] = THRESHOLDS) -> DataFrame:
    """F1, precision and recall at every grid threshold (prediction = p >= t).

    Rows (or runs) are folded into len(grid)+1 cells by a pure function of p (map-side
    combined); suffix sums over the cells give the confusion counts per threshold.
    """
    if isinstance(scored, ScoreRuns):
        rows = scored.runs.select(F.col("p"), "rows", F.col("y").alias("_y"))
    else:
        rows = scored.select(F.col(p).alias("p"), F.lit(1).alias("rows"), F.col(y).alias("_y"))
    spark = rows.sparkSession
    counts = rows.groupBy(_ge_count(F.col("p"), grid).alias("_cell")).agg(F.sum("rows").alias("_c"), F.sum("_y").alias("_tp"))
    # dense cell spine 0..len(grid): at most len(grid) + 1 rows
    cells = spark.range(len(grid) + 1).select(F.col("id").cast("int").alias("_cell"))
    cells = cells.join(F.broadcast(counts), "_cell", "left").fillna(0, subset=["_c", "_tp"])
    # cell c holds rows with exactly c grid points <= p: positive for t_j iff c > j
    after = Window.orderBy(F.col("_cell").desc()).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    cells = cells.select(
        (F.col("_cell") - 1).alias("j"),
        F.sum("_c").over(after).alias("pred_pos"),
        F.sum("_tp").over(after).alias("tp"),
        F.sum("_tp").over(everything).alias("positives"),
    )
    spine = spark.createDataFrame([(j, t) for j, t in enumerate(grid)], "j int, threshold double")
    per = spine.join(cells, "j")
    return per.select(
        "j",
        "threshold",
        "tp",
        "pred_pos",
        "positives",
        F.when(F.col("pred_pos") + F.col("positives") > 0,
               2.0 * F.col("tp") / (F.col("pred_pos") + F.col("positives"))).otherwise(0.0).alias("f1"),
        F.when(F.col("pred_pos") > 0, F.col("tp") / F.col("pred_pos")).otherwise(0.0).alias("precision"),
        F.when(F.col("positives") > 0, F.col("tp") / F.col("positives")).otherwise(0.0).alias("recall"),
    )


def optimal_f1_threshold(scored: DataFrame | ScoreRuns, y: str = "y", p: str = "p") -> DataFrame:
    """One row: best-F1 grid threshold, first grid point wins ties."""
    table = f1_threshold_table(scored, y, p)
    return table.agg(F.max_by("threshold", F.struct(F.col("f1"), -F.col("j"))).alias("threshold"),
                     F.max("f1").alias("f1"))


def classification_metrics(scored: DataFrame | ScoreRuns, threshold: float, y: str = "y", p: str = "p",
                           id_col: str = "customer_id") -> DataFrame:
    """One row: roc_auc, pr_auc, brier_score, f1, precision, recall, lift_at_10pct,
    recall_at_20pct, threshold (E1-E5)."""
    s = _runs(scored, y, p, id_col)
    n, pos, neg = s.n, s.positives, s.n - s.positives
    q, m, t = F.col("p"), F.col("rows"), F.col("y")
    pred = q >= F.lit(threshold)
    below = F.lit(n) - F.col("above") - m
    top = [max(1, int(n * 0.10)), max(1, int(n * 0.20))]
    top10, top20 = s.positives_among(top)
    size10 = min(top[0], n)
    # Mann-Whitney on average ranks; E2: steps over distinct scores, descending
    auc = (F.sum(t * (below + (m + 1) / 2.0)) - F.lit(pos * (pos + 1) / 2.0)) / F.lit(float(pos * neg)) if pos and neg else F.lit(None).cast("double")
    ap = F.sum((t / F.lit(pos)) * ((F.col("above_y") + t) / (F.col("above") + m))) if pos else F.lit(0.0)
    tp, pp = F.coalesce(F.sum(F.when(pred, t)), F.lit(0)), F.coalesce(F.sum(F.when(pred, m)), F.lit(0))
    return s.runs.agg(
        auc.alias("roc_auc"), ap.alias("pr_auc"),
        (F.sum(m * q * q - 2 * q * t + t) / F.lit(float(max(n, 1)))).alias("brier_score"), tp.alias("_tp"), pp.alias("_pp")).select(
        "roc_auc", "pr_auc", "brier_score",
        F.when(F.col("_pp") + pos > 0, 2.0 * F.col("_tp") / (F.col("_pp") + pos)).otherwise(0.0).alias("f1"),
        F.when(F.col("_pp") > 0, F.col("_tp") / F.col("_pp")).otherwise(0.0).alias("precision"),
        (F.col("_tp") / F.lit(pos) if pos else F.lit(0.0)).alias("recall"),
        F.lit((top10 / size10) / (pos / n) if pos else 0.0).alias("lift_at_10pct"),
        F.lit(top20 / max(1, pos)).alias("recall_at_20pct"), F.lit(threshold).alias("threshold"))


def calibration_table(scored: DataFrame | ScoreRuns, bins: int = 10, y: str = "y", p: str = "p",
                      id_col: str = "customer_id") -> DataFrame:
    """Equal-frequency bins on the first-rank of p (qcut semantics, not ntile)."""
    s = _runs(scored, y, p, id_col)
    if not s.n:
        return s.runs.select(F.lit(0).alias("decile"), F.col("rows").alias("customers"), F.col("p").alias("mean_predicted_probability"), F.col("p").alias("observed_churn_rate"))
    # bin d holds first-ranks up to 1 + floor((d + 1) * (n - 1) / bins)
    ends = [1 + (d + 1) * (s.n - 1) // bins for d in range(bins)]
    upto = s.positives_among(ends, ascending=True)
    each = F.array(*[F.lit(b - a) for a, b in zip([0, *upto[:-1]], upto)])
    return s.spread(ends).select(
        F.col("bin").alias("decile"), F.col("rows").alias("customers"),
        (F.col("score_sum") / F.col("rows")).alias("mean_predicted_probability"),
        (F.element_at(each, F.col("bin") + 1) / F.col("rows")).alias("observed_churn_rate"))


def lift_table(scored: DataFrame | ScoreRuns, y: str = "y", p: str = "p", id_col: str = "customer_id") -> DataFrame:
    """Cumulative gain and lift at 10 population checkpoints (order p desc, id asc)."""
    s = _runs(scored, y, p, id_col)
    cuts = [min(s.n, max(1, math.ceil(c * s.n))) for c in LIFT_CHECKPOINTS] if s.n else []
    rows = [(c, got / max(1, s.positives), k / s.n) for c, k, got in zip(LIFT_CHECKPOINTS, cuts, s.positives_among(cuts) if cuts else [])]
    return s.runs.sparkSession.createDataFrame([(c, g, g / share) for c, g, share in rows], "population_pct double, cumulative_gain double, cumulative_lift double")


def regression_metrics(scored: DataFrame, y: str = "y", yhat: str = "yhat", id_col: str = "customer_id") -> DataFrame:
    """Mae, rmse, r2, spearman_correlation on predictions clipped at 0, and
    normalized_mae = mae / max(1, mean y)."""
    base = scored.select(id_col, F.col(y).cast("double").alias("y"),
                         F.greatest(F.col(yhat).cast("double"), F.lit(0.0)).alias("yhat"))
    ranked = avg_rank_pcts(base, {"y": "_ry", "yhat": "_rp"})
    agg = ranked.agg(
        F.avg(F.abs(F.col("yhat") - F.col("y"))).alias("mae"),
        F.sqrt(F.avg((F.col("yhat") - F.col("y")) ** 2)).alias("rmse"),
        F.sum((F.col("yhat") - F.col("y")) ** 2).alias("_sse"),
        F.avg("y").alias("_ybar"),
        F.var_pop("y").alias("_var"),
        F.count(F.lit(1)).alias("_n"),
        F.corr("_ry", "_rp").alias("_rho"),
    )
    sst = F.col("_var") * F.col("_n")  # keeps its digits on long tables
    return agg.select(
        "mae",
        "rmse",
        F.when(sst > 0, F.lit(1.0) - F.col("_sse") / sst).otherwise(0.0).alias("r2"),
        F.coalesce(F.when(~F.isnan("_rho"), F.col("_rho")), F.lit(0.0)).alias("spearman_correlation"),
        (F.col("mae") / F.greatest(F.lit(1.0), F.col("_ybar"))).alias("normalized_mae"),
    )


def selection_score_classifier(roc_auc: Column, pr_auc: Column, brier: Column) -> Column:
    a, b, c = (F.lit(w) for w in CLASSIFIER_SELECTION_WEIGHTS)
    return a * roc_auc + b * pr_auc + c * (F.lit(1.0) - brier)


def selection_score_regressor(nmae: Column, spearman: Column, r2: Column) -> Column:
    a, b, c = (F.lit(w) for w in REGRESSOR_SELECTION_WEIGHTS)
    return a * (F.lit(1.0) - F.least(nmae, F.lit(1.0))) + b * F.greatest(spearman, F.lit(0.0)) + c * F.greatest(r2, F.lit(0.0))
