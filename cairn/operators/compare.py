"""Comparison of whole sets of tables, as multisets of rows with numeric tolerance.

Every row has a 128-bit digest over all its columns.  A table is cut into buckets by the
hash of its key; a bucket's digest is the sum of its rows' digests, so it does not depend
on the order of rows and counts repeated ones, and a table's digest is the sum of its
buckets'.  Only buckets whose digests differ are looked at again: there, rows that occur
equally often on both sides cancel out in one aggregation, and what is left is paired
within its key in the order of its numbers and compared column by column.

Columns are compared by kind: numbers (float, double, decimal) as doubles within
``max(rel_tol * max(|a|, |b|), abs_tol)``, everything else exactly, text included; null
equals null, and NaN equals NaN.  Rows of one key need not be unique.  Without ``keys`` the
columns that are no numbers form the key.  Tables have no order of their own; where the
order is part of the content, ``ranked`` adds each row's place in it as a column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import ordered_running
from ..session import materialize, release
from ..sources.files import type_map

REL_TOL, ABS_TOL = 1e-9, 1e-12
BUCKET_ROWS = 1000
MAX_BUCKETS = 1 << 20
SCHEMA = ("table string, status string, left_rows long, right_rows long, schema_difference string, unequal_buckets long, "
          "equal_rows long, close_rows long, changed_rows long, missing_left long, missing_right long, "
          "first_key string, first_column string, first_left string, first_right string")


def ranked(df: DataFrame, order: Sequence[tuple[str, bool]], id_col: str, out: str = "row_position") -> DataFrame:
    """``df`` with each row's place in the total order ``order``, ``id_col`` (True: ascending)."""
    return ordered_running(df, order, id_col).select(*df.columns, F.col("_rn").alias(out))


def _schema_difference(left: DataFrame, right: DataFrame) -> str | None:
    kinds = type_map(left), type_map(right)
    found = [f"{c}: missing in {'left' if c in kinds[1] else 'right'}" for c in sorted(kinds[0].keys() ^ kinds[1].keys())]
    found += [f"{c}: {k} and {kinds[1][c]}" for c, k in kinds[0].items() if c in kinds[1] and kinds[1][c] != k]
    return "; ".join(found) or None


def _plain(df: DataFrame, columns: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """``columns`` by place (c0, c1, ...) in one type per kind."""
    def plain(c: str) -> Column:
        col = df[f"`{c}`"]
        if kinds[c] == "double":  # one zero; NaN as it is
            return F.when(col.cast("double") == 0, F.lit(0.0)).otherwise(col.cast("double"))
        return col.cast("long") if kinds[c] == "int" else col.cast("string")

    return df.select(*[plain(c).alias(f"c{i}") for i, c in enumerate(columns)])


def _digest(columns: Sequence[str], seed: int) -> Column:
    """A null keeps its place: hashes alone would skip it."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))]) if columns else F.lit(0).cast("long")


def _sums() -> list[Column]:
    """Sums of the halves of both digests: exact in longs up to 2**31 rows of a bucket."""
    half = [F.shiftright("h1", 32), F.col("h1").bitwiseAND(0xFFFFFFFF), F.shiftright("h2", 32), F.col("h2").bitwiseAND(0xFFFFFFFF)]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(half)]]


def bucket_digests(rows: DataFrame) -> DataFrame:
    """bucket, n, s0..s3 of ``rows`` (bucket, h1, h2)."""
    return rows.groupBy("bucket").agg(*_sums())


def differs(a: Column, b: Column, number: bool, rel_tol: float = REL_TOL, abs_tol: float = ABS_TOL) -> Column:
    """True where two values differ: numbers beyond tolerance, other values at all."""
    if not number:
        return ~a.eqNullSafe(b)
    limit = F.greatest(F.lit(rel_tol) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))
    near = a.eqNullSafe(b) | (F.isnan(a) & F.isnan(b)) | (~F.isnan(a) & ~F.isnan(b) & (F.abs(a - b) <= limit))
    return ~F.coalesce(near, F.lit(False))


def compare_tables(name: str, left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None,
                   rel_tol: float = REL_TOL, abs_tol: float = ABS_TOL) -> DataFrame:
    """One row (``SCHEMA``) for a pair of tables.  ``close_rows`` differ within tolerance;
    the first difference is that of the smallest key (as text)."""
    spark = left.sparkSession
    wrong = _schema_difference(left, right)
    if wrong:
        return spark.createDataFrame([(name, "DIFFERENT", left.count(), right.count(), wrong, *[None] * 10)], SCHEMA)
    kinds, columns = type_map(left), left.columns
    number = [kinds[c] == "double" for c in columns]
    key = [f"c{columns.index(c)}" for c in keys] if keys is not None else [f"c{i}" for i, n in enumerate(number) if not n]
    every = [f"c{i}" for i in range(len(columns))]
    numbers = [c for c, n in zip(every, number) if n]
    sides = []
    for df in (left, right):
        rows = _plain(df, columns, kinds)
        sides.append(rows.withColumns({"h1": _digest(every, 1), "h2": _digest(every, 2), "k1": _digest(key, 3), "k2": _digest(key, 4)}))
    # a side is computed for its digests only, and once more if they differ
    buckets = max(1, min(MAX_BUCKETS, left.count() // BUCKET_ROWS))
    sides = [s.withColumn("bucket", F.pmod("k1", F.lit(buckets))) for s in sides]
    a, b = (bucket_digests(s).select("bucket", F.struct("n", *[f"s{i}" for i in range(4)]).alias(f"d{i}")) for i, s in enumerate(sides))
    digests = materialize(a.join(b, "bucket", "full_outer"))
    unequal = digests.where(~F.col("d0").eqNullSafe(F.col("d1"))).select("bucket")
    *counts, open_buckets = digests.agg(*[F.coalesce(F.sum(f"d{i}.n"), F.lit(0)) for i in range(2)],
                                        F.count_if(~F.col("d0").eqNullSafe(F.col("d1")))).first()
    release(spark)
    if not open_buckets:
        return spark.createDataFrame([(name, "EQUAL", *counts, None, 0, counts[0], 0, 0, 0, 0, None, None, None, None)], SCHEMA)
    # rows that occur equally often on both sides cancel out
    signed = [s.join(unequal, "bucket", "left_semi").withColumn("sign", F.lit(x)) for s, x in zip(sides, (1, -1))]
    net = materialize(signed[0].unionByName(signed[1]).groupBy("h1", "h2", "k1", "k2", *every).agg(F.sum("sign").alias("net")).where("net <> 0"))
    rest = [net.where(cond).withColumn("copy", F.explode(F.sequence(F.lit(1), F.abs("net").cast("int")))) for cond in ("net > 0", "net < 0")]
    order = [(c, True) for c in numbers] or [("h1", True)]
    placed = []
    for i, r in enumerate(rest):
        r = ordered_running(r, order, "h2", partition_by=["k1", "k2"])
        placed.append(r.select("k1", "k2", "_rn", *[F.col(c).alias(f"{'lr'[i]}_{c}") for c in every], F.lit(True).alias("lr"[i])))
    pairs = placed[0].join(placed[1], ["k1", "k2", "_rn"], "full_outer")
    both = F.col("l").isNotNull() & F.col("r").isNotNull()
    found = F.filter(F.array(*[
        F.when(differs(F.col(f"l_{c}"), F.col(f"r_{c}"), n, rel_tol, abs_tol), F.struct(
            F.lit(columns[i]).alias("column"), F.col(f"l_{c}").cast("string").alias("left"), F.col(f"r_{c}").cast("string").alias("right")))
        for i, (c, n) in enumerate(zip(every, number))]), lambda x: x.isNotNull())
    text = F.concat_ws("|", *[F.coalesce(F.col(f"l_{c}").cast("string"), F.col(f"r_{c}").cast("string"), F.lit("")) for c in key])
    pairs = pairs.select(both.alias("both"), F.col("l").isNull().alias("no_left"), F.when(both, F.get(found, F.lit(0))).alias("diff"), text.alias("key"), "_rn")
    pairs = pairs.withColumn("bad", ~F.col("both") | F.col("diff").isNotNull())
    first = F.min_by(F.struct("key", "diff"), F.when(F.col("bad"), F.struct("key", "_rn", "no_left"))).alias("first")
    left_over = net.agg(F.coalesce(F.sum(F.when(F.col("net") > 0, F.col("net"))), F.lit(0))).scalar()
    out = pairs.agg(F.count_if(F.col("both") & F.col("diff").isNull()).alias("close"), F.count_if(F.col("both") & F.col("diff").isNotNull()).alias("changed"),
                    F.count_if("no_left").alias("ml"), F.count_if(~F.col("both") & ~F.col("no_left")).alias("mr"), F.count_if("bad").alias("bad"), first)
    return out.select(
        F.lit(name).alias("table"), F.when(F.col("bad") > 0, "DIFFERENT").otherwise("EQUAL").alias("status"),
        F.lit(counts[0]).cast("long").alias("left_rows"), F.lit(counts[1]).cast("long").alias("right_rows"),
        F.lit(None).cast("string").alias("schema_difference"), F.lit(open_buckets).cast("long").alias("unequal_buckets"),
        (F.lit(counts[0]) - left_over).cast("long").alias("equal_rows"), F.col("close").alias("close_rows"), F.col("changed").alias("changed_rows"),
        F.col("ml").alias("missing_left"), F.col("mr").alias("missing_right"), F.col("first.key").alias("first_key"),
        F.col("first.diff.column").alias("first_column"), F.col("first.diff.left").alias("first_left"), F.col("first.diff.right").alias("first_right"))


def compare_marts(left: Mapping[str, DataFrame], right: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None,
                  rel_tol: float = REL_TOL, abs_tol: float = ABS_TOL) -> DataFrame:
    """One row per table of either set, by name; a table that one set lacks is MISSING."""
    out = None
    for name in sorted(left.keys() | right.keys()):
        if name in left and name in right:
            row = compare_tables(name, left[name], right[name], (keys or {}).get(name), rel_tol, abs_tol)
        else:
            held = left[name] if name in left else right[name]
            counts = (held.count(), None) if name in left else (None, held.count())
            row = held.sparkSession.createDataFrame([(name, "MISSING", *counts, f"missing in {'right' if name in left else 'left'}", *[None] * 10)], SCHEMA)
        out = row if out is None else out.unionByName(row)
    return out


def compare_records(left, right, ignored: Sequence[str] = (), rel_tol: float = REL_TOL, abs_tol: float = ABS_TOL) -> list[str]:
    """Paths at which two nested metadata records differ (numbers within tolerance)."""
    def flat(x, path=""):
        if isinstance(x, Mapping):
            for k in x:
                if k not in ignored:
                    yield from flat(x[k], f"{path}.{k}")
            yield path, {"keys": len([k for k in x if k not in ignored])}
        elif isinstance(x, (list, tuple)):
            for i, v in enumerate(x):
                yield from flat(v, f"{path}[{i}]")
            yield path, {"items": len(x)}
        else:
            yield path, x

    def same(a, b):
        if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool) and not isinstance(b, bool):
            return a == b or (a != a and b != b) or abs(a - b) <= max(rel_tol * max(abs(a), abs(b)), abs_tol)
        return type(a) is type(b) and a == b

    a, b = dict(flat(left)), dict(flat(right))
    return sorted(p or "." for p in a.keys() | b.keys() if p not in a or p not in b or not same(a[p], b[p]))
