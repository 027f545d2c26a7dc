"""Global ranks, percentiles and running sums without a single-partition window.

``Window.orderBy`` with no ``partitionBy`` plans ``Exchange SinglePartition``: every
row of the table passes through one task.  The helpers below keep the work spread:

1. Pre-aggregate by the ordering value (map-side combine), so a hot value collapses
   to one row before any shuffle.
2. Cut the value axis into buckets whose edges come from ``approxQuantile`` over the
   distinct values; the edges are literals, so the bucket is a pure function of the
   value and equal values always share a bucket.
3. Per-bucket totals (at most ``nb + 1`` rows per partition group) give prefix
   offsets; a window *partitioned by bucket* finishes the prefix inside each bucket.

The bucket edges only balance the work: any edges give the exact same answer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions

_UNBOUNDED = Window.unboundedPreceding
#: buckets of the ordered axis: enough to spread the work, few enough for a small CASE tree,
#: whatever the number of shuffle partitions
MIN_BUCKETS, MAX_BUCKETS = 8, 200
ID_SAMPLE = 4096   # ids that place the edges of the id buckets
HOT_SALTS = 16     # ways to split the join of ranks on a value that very many rows share


def quantile_edges(df: DataFrame, column: str, buckets: int, rel_error: float = 0.001) -> list[float]:
    """Sorted distinct cut points that split ``column`` into about ``buckets`` equal parts.

    Runs one small job; only ``buckets - 1`` numbers reach the driver.
    """
    return multi_quantile_edges(df, [column], buckets, rel_error)[column]


def multi_quantile_edges(df: DataFrame, columns: Sequence[str], buckets: int,
                         rel_error: float = 0.001) -> dict[str, list[float]]:
    """``quantile_edges`` for several columns in one job."""
    if buckets <= 1:
        return {c: [] for c in columns}
    probs = [i / buckets for i in range(1, buckets)]
    raw = raw_quantiles(df, columns, buckets, rel_error)
    return {c: sorted(set(vs)) for c, vs in raw.items()}


def raw_quantiles(df: DataFrame, columns: Sequence[str], buckets: int,
                  rel_error: float = 0.001) -> dict[str, list[float]]:
    """The ``buckets - 1`` quantiles per column, duplicates kept (a value repeated at
    several quantiles holds at least ~1/buckets of the rows)."""
    if buckets <= 1:
        return {c: [] for c in columns}
    probs = [i / buckets for i in range(1, buckets)]
    cols = list(dict.fromkeys(columns))
    values = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).approxQuantile(cols, probs, rel_error)
    return {c: [v for v in vs if v is not None and not math.isnan(v)] for c, vs in zip(cols, values)}


def hot_values(quantiles: Sequence[float]) -> list[float]:
    """Values that occupy two or more consecutive quantiles."""
    return sorted({a for a, b in zip(quantiles, quantiles[1:]) if a == b})


def bucket_expr(column: Column, edges: Sequence[float]) -> Column:
    """Index of the first edge >= value (0..len(edges)), as a balanced CASE tree.

    Edges may be of any ordered type.  Depth is log2(len(edges)); it stays inside
    whole-stage codegen.
    """
    edges = list(edges)

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(column <= F.lit(edges[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    return build(0, len(edges)).cast("int")


def _buckets(df: DataFrame, nb: int | None) -> int:
    return nb or min(MAX_BUCKETS, max(MIN_BUCKETS, shuffle_partitions(df.sparkSession)))


def id_edges(df: DataFrame, column: str, buckets: int) -> list:
    """Cut points of an id column of any ordered type, from a bounded sample (the ids whose
    hashes are smallest).  They only balance the work."""
    rows = (df.select(column).where(F.col(column).isNotNull()).orderBy(F.xxhash64(column)).limit(ID_SAMPLE)
            .agg(F.sort_array(F.collect_set(column)).alias("ids")).first())
    ids = rows["ids"]
    return [ids[i * len(ids) // buckets] for i in range(1, buckets) if ids[i * len(ids) // buckets] != ids[0]] if ids else []


def value_prefix(
    df: DataFrame,
    value: str,
    sums: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    ascending: bool = True,
    nb: int | None = None,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """One row per (partition_by..., value) with counts and prefix sums in value order.

    Columns: partition_by, value, ``_cnt`` (rows with this value), ``_before``
    (rows strictly before it), ``_n`` (rows in the partition group), and for each
    ``s`` in ``sums``: ``_s_<s>``, ``_sb_<s>`` (before) and ``_st_<s>`` (group total).
    Rows with a null value have no place in the order and are left out, also of ``_n``.
    """
    part = list(partition_by)
    nb = _buckets(df, nb)
    df = df.where(F.col(value).isNotNull())
    agg = [F.count(F.lit(1)).alias("_cnt")] + [F.sum(s).alias(f"_s_{s}") for s in sums]
    distinct = df.groupBy(*part, value).agg(*agg)
    if edges is None:
        distinct = materialize(distinct)  # read for the edges, the totals and the prefix
        edges = quantile_edges(distinct, value, nb)
    bucket = bucket_expr(F.col(value), edges)
    if not ascending:
        bucket = F.lit(len(edges)) - bucket
    distinct = distinct.withColumn("_b", bucket)

    totals = distinct.groupBy(*part, "_b").agg(
        F.sum("_cnt").alias("_bc"), *[F.sum(f"_s_{s}").alias(f"_bs_{s}") for s in sums]
    )
    # at most (nb + 1) rows per partition group: a tiny table
    before = Window.partitionBy(*part).orderBy("_b").rowsBetween(_UNBOUNDED, -1)
    whole = Window.partitionBy(*part)
    totals = totals.select(
        *part,
        "_b",
        F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_boff"),
        F.sum("_bc").over(whole).alias("_n"),
        *[F.coalesce(F.sum(f"_bs_{s}").over(before), F.lit(0)).alias(f"_bsoff_{s}") for s in sums],
        *[F.sum(f"_bs_{s}").over(whole).alias(f"_st_{s}") for s in sums],
    )
    if not part:
        totals = F.broadcast(totals)  # bounded by nb + 1 rows
    joined = distinct.join(totals, on=[*part, "_b"])
    order = F.col(value).asc() if ascending else F.col(value).desc()
    inside = Window.partitionBy(*part, "_b").orderBy(order).rowsBetween(_UNBOUNDED, -1)
    return joined.select(
        *part,
        value,
        "_cnt",
        (F.col("_boff") + F.coalesce(F.sum("_cnt").over(inside), F.lit(0))).alias("_before"),
        "_n",
        *[F.col(f"_s_{s}") for s in sums],
        *[(F.col(f"_bsoff_{s}") + F.coalesce(F.sum(f"_s_{s}").over(inside), F.lit(0))).alias(f"_sb_{s}") for s in sums],
        *[F.col(f"_st_{s}") for s in sums],
    )


def avg_rank_pct(
    df: DataFrame,
    value: str,
    out: str,
    partition_by: Sequence[str] = (),
    nb: int | None = None,
) -> DataFrame:
    """Percentile of the *average* rank: ``(rank + (ties - 1)/2) / n``.

    Same as ``Series.rank(method="average", pct=True)``; not ``percent_rank`` or
    ``cume_dist``.  Null values get a null percentile.
    """
    return avg_rank_pcts(df, {value: out}, partition_by, nb)


def avg_rank_pcts(
    df: DataFrame,
    columns: dict[str, str],
    partition_by: Sequence[str] = (),
    nb: int | None = None,
) -> DataFrame:
    """``avg_rank_pct`` for several columns over one materialized input."""
    part = list(partition_by)
    df = materialize(df)
    # one job for every column's edges (over rows; any edges give exact results)
    quantiles = raw_quantiles(df, list(columns), _buckets(df, nb))
    salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(HOT_SALTS)).cast("int"))
    for value, out in columns.items():
        raw = quantiles[value]
        ranked = value_prefix(df, value, partition_by=part, nb=nb, edges=sorted(set(raw))).select(
            *part,
            value,
            ((F.col("_before") + (F.col("_cnt") + F.lit(1)) / F.lit(2)) / F.col("_n")).alias(out),
        )
        # rows of a value that very many share are dealt over several keys
        is_hot = F.coalesce(F.col(value).cast("double").isin(hot_values(raw)), F.lit(False)) if hot_values(raw) else F.lit(False)
        every = F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))
        ranked = ranked.withColumn("_way", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
        salted = (salted.withColumn("_way", F.when(is_hot, F.col("_salt")).otherwise(F.lit(0)))
                  .join(ranked, on=[*part, value, "_way"], how="left").drop("_way"))
    return salted.select(*df.columns, *columns.values())


def avg_rank(df: DataFrame, value: str, out: str, partition_by: Sequence[str] = (), nb: int | None = None) -> DataFrame:
    """Average rank (1-based, ties averaged) and group size ``<out>_n``."""
    part = list(partition_by)
    df = materialize(df)
    ranked = value_prefix(df, value, partition_by=part, nb=nb).select(
        *part,
        value,
        (F.col("_before") + (F.col("_cnt") + F.lit(1)) / F.lit(2)).alias(out),
        F.col("_n").alias(f"{out}_n"),
    )
    return df.join(ranked, on=[*part, value], how="left")


def ordered_running(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    id_col: str,
    sums: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    nb: int | None = None,
) -> DataFrame:
    """Row number ``_rn`` (1-based) and inclusive running sums ``_run_<s>`` in the total
    order ``order..., id_col asc`` (within ``partition_by`` groups), plus ``_n``.

    A hot ordering value is split by id buckets (and, with two or more keys, by the
    second key), so no group of equal values is sorted in one task.
    """
    part = list(partition_by)
    keys = [k for k, _ in order]
    nb = _buckets(df, nb)
    df = materialize(df)
    first, first_asc = order[0]
    raw = raw_quantiles(df, [first], nb)
    tagged = df.withColumn("_ib", bucket_expr(F.col(id_col), id_edges(df, id_col, nb)))

    groups = tagged.groupBy(*part, *keys, "_ib").agg(
        F.count(F.lit(1)).alias("_gc"), *[F.sum(s).alias(f"_gs_{s}") for s in sums]
    )
    # A first-key value holding >= ~1/nb of the rows gets a bucket of its own (edges
    # just below and at it) ...
    hot = hot_values(raw[first])
    edges = sorted(set(raw[first]) | {math.nextafter(v, -math.inf) for v in hot})
    bucket = bucket_expr(F.col(first), edges)
    if not first_asc:
        bucket = F.lit(len(edges)) - bucket
    # ... which is split further by the second key, so equal first keys with many
    # distinct second keys are not ordered in one task.  Sub-buckets only subdivide
    # single-value buckets, so the bucket order stays the total order.
    width = 1
    if hot and len(order) > 1:
        second, second_asc = order[1]
        is_hot = F.coalesce(F.col(first).cast("double").isin(hot), F.lit(False))
        sub_edges = quantile_edges(groups.filter(is_hot), second, nb)
        width = len(sub_edges) + 1
        sub = bucket_expr(F.col(second), sub_edges)
        if not second_asc:
            sub = F.lit(width - 1) - sub
        bucket = bucket * F.lit(width) + F.when(is_hot, sub).otherwise(F.lit(0))
    # nulls come first in ascending and last in descending order, in a bucket of their own
    null_bucket = F.lit(-1) if first_asc else F.lit((len(edges) + 1) * width)
    groups = groups.withColumn("_b", F.when(F.col(first).isNull(), null_bucket).otherwise(bucket).cast("long"))

    totals = groups.groupBy(*part, "_b").agg(
        F.sum("_gc").alias("_bc"), *[F.sum(f"_gs_{s}").alias(f"_bs_{s}") for s in sums]
    )
    before = Window.partitionBy(*part).orderBy("_b").rowsBetween(_UNBOUNDED, -1)
    whole = Window.partitionBy(*part)
    totals = totals.select(
        *part,
        "_b",
        F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_boff"),
        F.sum("_bc").over(whole).alias("_n"),
        *[F.coalesce(F.sum(f"_bs_{s}").over(before), F.lit(0)).alias(f"_bsoff_{s}") for s in sums],
    )
    if not part:
        totals = F.broadcast(totals)  # bounded by (nb + 1 + hot values) x sub-buckets rows
    groups = groups.join(totals, on=[*part, "_b"])
    sort = [F.col(k).asc() if asc else F.col(k).desc() for k, asc in order] + [F.col("_ib").asc()]
    inside = Window.partitionBy(*part, "_b").orderBy(*sort).rowsBetween(_UNBOUNDED, -1)
    groups = groups.select(
        *part,
        *keys,
        "_ib",
        "_n",
        (F.col("_boff") + F.coalesce(F.sum("_gc").over(inside), F.lit(0))).alias("_goff"),
        *[(F.col(f"_bsoff_{s}") + F.coalesce(F.sum(f"_gs_{s}").over(inside), F.lit(0))).alias(f"_gsoff_{s}") for s in sums],
    )
    names = [*part, *keys, "_ib"]
    right = groups.select(*[F.col(c).alias(f"_g_{c}") for c in names], *[c for c in groups.columns if c not in names])
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    joined = tagged.join(right, same).drop(*[f"_g_{c}" for c in names])
    within = Window.partitionBy(*part, *keys, "_ib").orderBy(F.col(id_col).asc()).rowsBetween(_UNBOUNDED, 0)
    out = joined.withColumn("_rn", F.col("_goff") + F.count(F.lit(1)).over(within))
    for s in sums:
        out = out.withColumn(f"_run_{s}", F.col(f"_gsoff_{s}") + F.sum(s).over(within))
    return out.drop("_ib", "_goff", *[f"_gsoff_{s}" for s in sums])


def qcut_rank_bin(rn: Column, n: Column, q: int) -> Column:
    """Equal-frequency bin of a first-rank ``rn`` in 1..n, as ``pd.qcut(rank, q)`` labels.

    Integer arithmetic: bin = max(0, ceil((rn - 1) * q / (n - 1)) - 1); n = 1 -> 0.
    """
    num = (rn - F.lit(1)) * F.lit(q)
    den = n - F.lit(1)
    ceil_div = F.when(den > 0, F.floor((num + den - F.lit(1)) / den)).otherwise(F.lit(0))
    return F.greatest(F.lit(0), ceil_div - F.lit(1)).cast("int")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    partition_by: Sequence[str] = (),
    nb: int | None = None,
) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy / ``quantile_cont`` semantics) per
    group, without holding a group's values in one task.

    The distributed prefix counts locate, for each probability, the sorted positions
    floor(q * (n - 1)) and ceil(q * (n - 1)); only the few distinct values covering
    those positions survive a filter.  Returns (partition_by..., ``_q`` array of doubles).
    """
    part = list(partition_by)
    d = value_prefix(df.select(*part, F.col(value).cast("double").alias(value)), value, partition_by=part, nb=nb)
    pos = [F.lit(float(q)) * (F.col("_n") - 1) for q in probs]
    targets = F.array(*[F.floor(p) for p in pos] + [F.ceil(p) for p in pos])
    covers = F.exists(targets, lambda i: (i >= F.col("_before")) & (i < F.col("_before") + F.col("_cnt")))
    # at most 2 * len(probs) rows per group survive
    hits = d.filter(covers).groupBy(*part).agg(
        F.first("_n").alias("_n"),
        F.collect_list(F.struct(F.col("_before").alias("b"), F.col("_cnt").alias("c"), F.col(value).alias("v")))
        .alias("_runs"),
    )

    def at(i):
        found = F.filter(F.col("_runs"), lambda r: (i >= r["b"]) & (i < r["b"] + r["c"]))
        return found[0]["v"]

    qs = []
    for p in pos:
        lo, hi = at(F.floor(p)), at(F.ceil(p))
        qs.append(lo + (p - F.floor(p)) * (hi - lo))
    return hits.select(*part, F.array(*qs).alias("_q"))
