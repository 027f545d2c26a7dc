"""Attribution of a churn model's scores to features, as Spark jobs.

``antithetic_attribution`` explains every row by one walk: features switch from the
background to the row's value in an order of the row's own, and back off in the same order,
which is the reverse order of switching on.  A state's value is the mean score over all
background rows, and a feature gets half of what it changes on either way.  All states of
all rows are scored in one pass.

``permutation_attribution`` starts from one median row instead and averages many orders.
For every explained row and permutation, features switch from the baseline (the
column-wise median of a background sample) to the row's value one at a time; the
score change at each step is credited to the switched feature and averaged over
the permutations.  Rows x permutations x (features + 1) steps are generated by
``explode`` (the permutation count and the explained rows are bounded parameters),
scored by one ``transform``, differenced by ``lag`` inside (row, permutation).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import FEATURE_COLUMNS

SEED = 5
#: contributions are ranked and given a direction at this precision: sums in another order differ below it
DIGITS = 12


def permutations(n_features: int, count: int, seed: int = SEED) -> list[list[int]]:
    rng = np.random.default_rng(seed)
    return [[int(i) for i in rng.permutation(n_features)] for _ in range(count)]


def baseline_medians(background: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """One row of column-wise medians (linear interpolation)."""
    return background.agg(*[F.percentile(F.col(f).cast("double"), 0.5).alias(f) for f in features])


def seeded_sample(df: DataFrame, n: int, id_cols: Sequence[str] = ("customer_id",), seed: int = SEED) -> DataFrame:
    """Repeatable sample of ``n`` rows, those whose ids hash lowest; the limit is the feature."""
    key = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols], F.lit(str(seed))))
    return df.orderBy(key, *id_cols).limit(n)


def most_dormant(df: DataFrame, n: int, id_col: str = "customer_id") -> DataFrame:
    """The explained cohort, longest without an order first; the limit is the feature."""
    return df.orderBy(F.col("recency_days").desc(), F.col(id_col)).limit(n)


def antithetic_attribution(score: Callable[[DataFrame], DataFrame], rows: DataFrame, background: DataFrame,
                           id_col: str = "customer_id", features: Sequence[str] = FEATURE_COLUMNS, seed: int = SEED) -> DataFrame:
    """(id, feature, feature_value, shap_value, base_value, churn_probability).

    ``score(df)`` must return ``df`` plus a double column ``p``.  ``rows`` and
    ``background`` are of bounded size (parameters of the caller): 2 x features states
    times the background rows are scored for each row.
    """
    feats = list(features)
    m = len(feats)
    held = background.agg(F.collect_list(F.struct(*[F.col(f).cast("double").alias(f) for f in feats])).alias("b"))
    x = rows.select(id_col, *[F.col(f).cast("double").alias(f) for f in feats])
    drawn = F.array_sort(F.array(*[F.struct(F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(f"{i}|{seed}"))).alias("h"), F.lit(i).alias("i"))
                                   for i in range(m)]))
    x = x.withColumn("_order", F.transform(drawn, lambda d: d["i"]))
    x = x.withColumn("_pos", F.array(*[F.array_position("_order", F.lit(i)).cast("int") - 1 for i in range(m)]))
    x = x.withColumn("_back", held.scalar())
    # state s: the first s features of the order are on; from m on, the first s - m are off again
    steps = x.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(2 * m - 1)))).withColumn("_b", F.explode("_back"))
    on = lambda i: F.when(F.col("_s") <= m, F.col("_pos")[i] < F.col("_s")).otherwise(F.col("_pos")[i] >= F.col("_s") - m)
    mixed = steps.select(id_col, "_s", *[F.when(on(i), F.col(f)).otherwise(F.col("_b")[f]).alias(f) for i, f in enumerate(feats)])
    states = score(mixed).groupBy(id_col, "_s").agg(F.avg("p").alias("_v"))
    walks = states.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("_s", "_v"))), lambda v: v["_v"]).alias("_v"))
    v, q = F.col("_v"), F.col("_q")
    last = F.when(q == m - 1, v[0]).otherwise(F.get(v, q + m + 1))
    out = x.select(id_col, *feats, "_pos").join(walks, id_col).select(
        id_col, "_v", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("feature_value"), F.col("_pos")[i].alias("q"))
                                          for i, f in enumerate(feats)])).alias("_f")).withColumn("_q", F.col("_f.q"))
    return out.select(id_col, "_f.feature", "_f.feature_value",
                      ((F.get(v, q + 1) - F.get(v, q) + F.get(v, q + m) - last) / 2).alias("shap_value"),
                      v[0].alias("base_value"), v[m].alias("churn_probability"))


def permutation_attribution(score: Callable[[DataFrame], DataFrame], rows: DataFrame, baseline: DataFrame,
                            n_permutations: int = 48, id_col: str = "customer_id",
                            features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """(id, feature, feature_value, shap_value, base_value, probability).

    ``score(df)`` must return ``df`` plus a double column ``p``.
    """
    feats = list(features)
    perms = permutations(len(feats), n_permutations)
    # position of feature f in permutation k
    positions = [[perm.index(f) for f in range(len(feats))] for perm in perms]
    base_cols = [F.col(f"_b_{f}") for f in feats]
    b = baseline.select(*[F.col(f).alias(f"_b_{f}") for f in feats])
    x = rows.select(id_col, *[F.col(f).cast("double").alias(f) for f in feats])
    # baseline values as scalar subqueries (one aggregate row), no join
    x = x.withColumns({f"_b_{f}": b.select(F.col(f"_b_{f}")).scalar() for f in feats})
    perm_arr = F.array(*[F.struct(F.lit(k).alias("k"), F.array(*[F.lit(p) for p in pos]).alias("pos"))
                         for k, pos in enumerate(positions)])
    steps = x.select("*", F.explode(perm_arr).alias("_perm")).select(
        "*", F.col("_perm.k").alias("_k"), F.col("_perm.pos").alias("_pos"),
        F.explode(F.sequence(F.lit(0), F.lit(len(feats)))).alias("_s"))
    # at step s, feature f carries the row value iff its position < s
    mixed = steps.select(
        id_col, "_k", "_s", "_pos",
        *[F.when(F.col("_pos")[i] < F.col("_s"), F.col(f)).otherwise(base_cols[i]).alias(f"_m_{f}")
          for i, f in enumerate(feats)],
    )
    to_score = mixed.select(id_col, "_k", "_s", "_pos", *[F.col(f"_m_{f}").alias(f) for f in feats])
    scored = score(to_score)
    w = Window.partitionBy(id_col, "_k").orderBy("_s")
    diffs = scored.select(
        id_col, "_k", "_s", "_pos", "p",
        (F.col("p") - F.lag("p").over(w)).alias("_d"),
    )
    # the feature switched at step s is the one with position s - 1
    switched = F.array_position(F.col("_pos"), F.col("_s") - 1) - 1
    credited = diffs.filter(F.col("_s") > 0).select(id_col, switched.alias("_fi"), "_d")
    names = F.array(*[F.lit(f) for f in feats])
    phi = credited.groupBy(id_col, "_fi").agg((F.sum("_d") / F.lit(float(n_permutations))).alias("shap_value"))
    ends = scored.filter(F.col("_k") == 0).groupBy(id_col).agg(
        F.max(F.when(F.col("_s") == 0, F.col("p"))).alias("base_value"),
        F.max(F.when(F.col("_s") == len(feats), F.col("p"))).alias("churn_probability"))
    values = x.select(id_col, F.array(*[F.col(f) for f in feats]).alias("_vals"))
    return phi.join(ends, id_col).join(values, id_col).select(
        id_col,
        F.element_at(names, F.col("_fi").cast("int") + 1).alias("feature"),
        F.element_at(F.col("_vals"), F.col("_fi").cast("int") + 1).alias("feature_value"),
        "shap_value", "base_value", "churn_probability",
    )


def global_importance(phi: DataFrame) -> DataFrame:
    """Mean |phi|, mean phi and share of the total mean |phi| per feature."""
    g = phi.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"),
                                   F.avg("shap_value").alias("mean_shap"))
    return g.withColumn("importance_share",
                        F.col("mean_abs_shap") / F.sum("mean_abs_shap").over(Window.partitionBy()))  # 16 rows


def local_reasons(phi: DataFrame, k: int = 5, id_col: str = "customer_id") -> DataFrame:
    """Top-k features by |phi| per row with rank and direction."""
    w = Window.partitionBy(id_col).orderBy(F.round(F.abs("shap_value"), DIGITS).desc(), F.col("feature"))
    return phi.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).withColumn(
        "direction", F.when(F.round("shap_value", DIGITS) > 0, "Increases risk").otherwise("Decreases risk"))


def additivity_error(phi: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """Mean |base + sum(phi) - p| over the explained rows."""
    per = phi.groupBy(id_col).agg(F.sum("shap_value").alias("_s"), F.first("base_value").alias("_b"),
                                  F.first("churn_probability").alias("_p"))
    return per.agg(F.avg(F.abs(F.col("_b") + F.col("_s") - F.col("_p"))).alias("additivity_mean_absolute_error"),
                   F.count(F.lit(1)).alias("sample_size"))
