"""Hard negatives by Kronecker-packed products, exact in integers.

Every component x becomes floor(scale * x).  With all components in [-M, M], adding M
makes them non-negative, so a product of two biased vectors of D components is below
2**W for W = bits(D * (2M)**2).  The components of several candidates are therefore laid
side by side in fields of W bits of one wide integer, the integer is multiplied once per
component of an anchor, and the sums unpack into the candidates' biased scores; taking
off the bias terms gives the exact inner products:

    sum (a+M)(c+M)  =  sum a*c + M*sum a + M*sum c + D*M*M

Wide integers of up to 53 bits are held in doubles, which are exact there in any order of
summation, so the multiplication is a matrix product.  Where a field needs more than 53
bits, Python's integers carry the fields.

The vectors are written once as packed integers.  Anchors are taken in waves of about
``anchor_block`` rows, whose vectors (and later positives) are all that is sent to the
tasks; each wave meets all rows in two passes without a shuffle of them.  The first keeps
the best rows of the anchor's label in each task, the second, for every positive, the
best rows of other labels in its range of scores; the lists of the tasks are merged by a
window.  A list has ``positives`` or ``negatives`` entries whatever the data, and equal
vectors are told apart by vec_id, so that a vector held by a third of the rows adds none.

Defined cases: rows with a null id or label, a null vector, or a null or non-finite
component take no part; a shorter vector counts as filled up with zeros; rows of equal
vec_id are rows of their own, each an anchor or candidate by itself; an anchor without
positives, and an empty table, give no rows; further columns are not looked at.  vec_id
must be of an integer type, labels may be of any type.  Products that do not fit 64 bits
are refused with an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: a negative's score lies between these percentages of the positive's
LOW, HIGH = 30, 90
ANCHOR_BLOCK = 16_384
#: candidates of a block, and anchors multiplied with it at once
ROWS_STEP, ANCHOR_STEP = 8192, 256
_NONE = np.iinfo(np.int64).min


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding (doubles) of the rows that take part."""
    finite = F.forall(F.col("embedding"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite))


def field_bits(dims: int, most: int) -> int:
    return max(1, (dims * (2 * most) ** 2).bit_length())


def packed_product(anchors: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Exact inner products (anchors x rows) of integer matrices with components in [-most, most]."""
    dims, bits = anchors.shape[1], field_bits(anchors.shape[1], most)
    bias = most * (anchors.sum(1, dtype=np.int64)[:, None] + rows.sum(1, dtype=np.int64)[None, :]) if bits <= 53 else None
    fields = max(1, 53 // bits)
    wide = np.float64 if bits <= 53 else object
    if wide is object:
        fields = 4
    n = len(rows)
    words = -(-n // fields)
    laid = np.zeros((words * fields, dims), np.int64)
    laid[:n] = rows
    laid = (laid.astype(wide) + most).reshape(words, fields, dims)
    packed = laid[:, 0].copy()
    for j in range(1, fields):
        packed += laid[:, j] * (1 << (bits * j) if wide is object else float(1 << (bits * j)))
    sums = (anchors.astype(wide) + most) @ packed.T
    if wide is object:
        mask = (1 << bits) - 1
        out = np.stack([(sums >> (bits * j)) & mask for j in range(fields)], axis=2).reshape(len(anchors), -1)[:, :n]
        own = [[sum(int(x) for x in v) for v in m] for m in (anchors, rows)]
        return (out - most * (np.array(own[0], object)[:, None] + np.array(own[1], object)[None, :])
                - dims * most * most).astype(np.int64)
    sums = sums.astype(np.int64)
    mask = (1 << bits) - 1
    out = np.stack([(sums >> (bits * j)) & mask for j in range(fields)], axis=2).reshape(len(anchors), -1)[:, :n]
    return out - bias - dims * most * most


def best(score: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the ``k`` valid rows of each anchor with the highest scores; rows
    come in the order that breaks ties."""
    n = score.shape[1]
    if n > k and valid.any():
        low, high = int(score[valid].min()), int(score[valid].max())
        if (high - low + 1) * n < 1 << 62:
            # score and place in one number: no two rows are equal
            key = np.where(valid, (score - low) * n + np.arange(n - 1, -1, -1), -1)
            at = np.argpartition(key, n - k, axis=1)[:, n - k:]
        else:
            at = np.argsort(np.where(valid, -score, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :k]
        a = np.repeat(np.arange(len(score)), k)
        j = at.ravel()
        keep = valid[a, j]
        return a[keep], j[keep]
    return np.nonzero(valid)


class Lists:
    """The best ``k`` (score, id, row) of every list so far; list numbers are from 0."""

    def __init__(self, k: int):
        self.k = k
        self.of, self.score, self.vec_id, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, of, score, vec_id, row) -> None:
        of, score = np.concatenate([self.of, of]), np.concatenate([self.score, score])
        vec_id, row = np.concatenate([self.vec_id, vec_id]), np.concatenate([self.row, row])
        order = np.lexsort((row, vec_id, -score, of))
        of = of[order]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
        place = np.arange(len(of)) - np.repeat(first, np.diff(np.r_[first, len(of)]))
        order, of = order[place < self.k], of[place < self.k]
        self.of, self.score, self.vec_id, self.row = of, score[order], vec_id[order], row[order]

    def floor(self, lists: int) -> np.ndarray:
        """Score that a further entry of each list has to reach."""
        out = np.full(lists, _NONE, np.int64)
        counts = np.bincount(self.of, minlength=lists)
        full = np.flatnonzero(counts >= self.k)
        ends = np.cumsum(counts)
        out[full] = self.score[ends[full] - 1]
        return out


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    flat = batch.column("parts")
    lens = np.diff(flat.offsets.to_numpy())
    out = np.zeros((len(flat), dims), np.int64)
    out[np.repeat(np.arange(len(flat)), lens), np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def packed_rows(vectors: DataFrame, scale: int) -> tuple[DataFrame, int, int]:
    """(table of row, vec_id, tag, parts; components of the longest vector; largest |component|).
    tag: 64-bit code of the label; row: a number of its own for each row."""
    parts = F.transform("embedding", lambda x: F.floor(x * float(scale)))
    rows = materialize(usable(vectors).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.xxhash64("label").alias("tag"), parts.alias("parts"),
        F.array_max(F.transform("embedding", lambda x: F.abs(F.floor(x * float(scale)).cast("double")))).alias("size")))
    dims, most = rows.agg(F.max(F.size("parts")), F.max("size")).first()
    dims, most = dims or 0, int(most or 0)
    if dims * most * most >= 1 << 62:
        raise ValueError(f"products of vectors of {dims} components of up to {most} do not fit 64 bits")
    return rows.drop("size"), dims, most


def _scored_batches(batches, wave, dims: int, most: int):
    """Blocks of rows in the order of vec_id: (vec_ids, rows, tags, function scoring a range of anchors)."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_STEP):
            batch = whole.slice(at, ROWS_STEP)
            ids, row, tag = (batch.column(c).to_numpy() for c in ("vec_id", "row", "tag"))
            order = np.lexsort((row, ids))
            matrix = _matrix(batch, dims)[order]
            yield ids[order], row[order], tag[order], lambda lo, hi, m=matrix: packed_product(wave["parts"][lo:hi], m, most)


def _lists_out(lists: Lists, wave, per: int):
    yield pa.RecordBatch.from_arrays(
        [pa.array(wave["row"][lists.of // per]), pa.array((lists.of % per).astype(np.int32)), pa.array(lists.vec_id), pa.array(lists.row), pa.array(lists.score)],
        ["anchor", "positive", "vec_id", "row", "score"])


_LIST_SCHEMA = "anchor long, positive int, vec_id long, row long, score long"


def _first(lists: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of every (anchor, positive) over all tasks, numbered from 1."""
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "vec_id", "row")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _positives(rows: DataFrame, wave, dims: int, most: int, k: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(wave)

    def run(batches):
        w, lists = sent.value, Lists(k)
        n = len(w["row"])
        for ids, row, tag, scores in _scored_batches(batches, w, dims, most):
            floor = lists.floor(n)
            for lo in range(0, n, ANCHOR_STEP):
                hi = min(n, lo + ANCHOR_STEP)
                s = scores(lo, hi)
                valid = (tag[None, :] == w["tag"][lo:hi, None]) & (row[None, :] != w["row"][lo:hi, None]) & (s >= floor[lo:hi, None])
                a, j = best(s, valid, k)
                if len(a):
                    lists.add(a + lo, s[a, j], ids[j], row[j])
        if len(lists.of):
            yield from _lists_out(lists, w, 1)

    return _first(rows.mapInArrow(run, _LIST_SCHEMA), k)


def _negatives(rows: DataFrame, wave, dims: int, most: int, per: int, k: int, low: int, high: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(wave)

    def run(batches):
        w, lists = sent.value, Lists(k)
        n = len(w["row"])
        for ids, row, tag, scores in _scored_batches(batches, w, dims, most):
            floor = lists.floor(n * per).reshape(n, per)
            for lo in range(0, n, ANCHOR_STEP):
                hi = min(n, lo + ANCHOR_STEP)
                s = scores(lo, hi)
                other = tag[None, :] != w["tag"][lo:hi, None]
                for p in range(per):
                    least, highest = (np.maximum(w["least"][lo:hi, p], floor[lo:hi, p])[:, None], w["highest"][lo:hi, p, None])
                    a, j = best(s, other & (s >= least) & (s <= highest), k)
                    if len(a):
                        lists.add((a + lo) * per + p, s[a, j], ids[j], row[j])
        if len(lists.of):
            yield from _lists_out(lists, w, per)

    return _first(rows.mapInArrow(run, _LIST_SCHEMA), k)


def _wave(anchors: DataFrame, dims: int) -> dict:
    got = anchors.select("row", "vec_id", "tag", "parts").toArrow().combine_chunks()
    batch = got.to_batches()[0]
    return {"row": got["row"].to_numpy(), "vec_id": got["vec_id"].to_numpy(), "tag": got["tag"].to_numpy(), "parts": _matrix(batch, dims)}


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, scale: int = SCALE, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label, embedding; ``is_anchor`` is a condition on vec_id.
    """
    spark = vectors.sparkSession
    rows, dims, most = packed_rows(vectors, scale)
    anchors = rows.where(is_anchor)
    waves = -(-anchors.count() // anchor_block)
    found = []
    for i in range(waves):
        # row numbers are hashed, so a wave has about anchor_block rows
        wave = _wave(anchors.where(F.pmod(F.xxhash64("row"), F.lit(waves)) == i), dims)
        if not len(wave["row"]):
            continue
        pos = materialize(_positives(rows, wave, dims, most, positives))
        held = pos.select("anchor", "rank", "score").toArrow()  # positives * the wave's anchors at most
        n = len(wave["row"])
        order = np.argsort(wave["row"])
        at = order[np.searchsorted(wave["row"], held["anchor"].to_numpy(), sorter=order)]
        # an empty range where there is no such positive, or the range of its score is empty
        wave["least"], wave["highest"] = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)
        place, score = held["rank"].to_numpy().astype(np.int64) - 1, held["score"].to_numpy()
        # 100 * s >= low * p and 100 * s <= high * p, in whole numbers
        wave["least"][at, place] = [-(-low * int(p) // 100) for p in score]
        wave["highest"][at, place] = [high * int(p) // 100 for p in score]
        neg = _negatives(rows, wave, dims, most, positives, negatives, low, high)
        names = spark.createDataFrame(pa.table({"anchor": wave["row"], "anchor_id": wave["vec_id"]}))
        of = pos.select("anchor", (F.col("rank") - 1).alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        found.append(materialize(
            neg.select("anchor", "positive", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(of, ["anchor", "positive"]).join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")))
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def with_shifted_labels(vectors: DataFrame) -> DataFrame:
    """Labels of the rows whose vec_id is divisible by 7 moved on by one, modulo 10."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


ORACLE_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.v, c.v), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0)))::BIGINT AS score
  FROM rows a JOIN rows c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""
