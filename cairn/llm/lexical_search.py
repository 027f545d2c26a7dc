"""Ranked lexical search by pipelined term partitioning.

One pass over the documents writes, for every block of at most ``block_rows`` documents,
one posting run per term of the items (places, counts and lengths as packed integers) and
one row per document.  The terms are shared among successive owner stages by how common
they are, rarest first.  A bundle is up to ``2**bundle_bits`` items on one block of
documents; it carries a sparse accumulator of integer scores per item.  It visits the
stages in turn: each is a cogroup of the bundles with the runs of the stage's terms, which
adds the contributions of its terms and hands the bundle on.  The commonest terms come
last, so that no full accumulator is handed on: the last stage gives the best ``top`` of
every item and block (ties by id).  The lists of the blocks are merged by rank, and ids
are attached at the end.

A block bounds what a task holds, however common a term is, and a term of every document
has one run per block.

The number of terms sent to the tasks as a filter and the broadcast of the terms are
bounded by ``filter_limit``; a larger vocabulary goes through shuffles by the same joins.
Weights and lengths cover all documents.

Defined cases: null and empty texts have no terms and are never found; rows of equal
doc_id are documents of their own; documents without id come last among equal scores;
rows of equal item_id are one item with the terms of all, also those without id; items
without terms, and empty tables, give no rows.  Ids may be of any ordered type.  Further
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import materialize

TOP = 50
BLOCK_ROWS = 16_384  # at most 65,536: places are 16-bit
#: postings after which a block is closed before it has that many documents
BLOCK_POSTINGS = 4_000_000
BUNDLE_BITS = 8
#: items numbered by one task
NUMBERED = 1 << 16
FILTER_LIMIT = 500_000
#: a term's owner is the first stage whose share of the documents it does not exceed; the last takes the rest
STAGE_SHARES = (0.002, 0.02, 0.15)


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, code, term) of the items."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for w in tb.iter_words(batch.column("text"), tb.ALNUM_LOWER_TABLE):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(pa.array(w.doc() + w.lo)), pa.array(w.codes().view(np.int64)),
                     pa.array([w.text(i) for i in range(len(w))], pa.binary()).cast(pa.string())], ["item_id", "code", "term"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, code long, term string").distinct()


class _Block:
    """Postings and documents of a block under construction."""

    def __init__(self):
        self.docs, self.lens, self.posts, self.words, self.size = [], [], [], {}, 0

    def add(self, ids: pa.Array, w: tb.Words, wanted: np.ndarray | None) -> None:
        base, counts = sum(map(len, self.lens)), w.counts()
        codes, at = w.codes(), np.arange(len(w))
        if wanted is not None:
            place = np.minimum(np.searchsorted(wanted, codes), max(len(wanted) - 1, 0))
            at = np.flatnonzero(wanted[place] == codes) if len(wanted) else at[:0]
        uniq, first, inv = np.unique(codes[at], return_index=True, return_inverse=True)
        for code, i in zip(uniq.tolist(), at[first].tolist()):
            if code not in self.words:
                self.words[code] = w.text(i)
        doc = np.searchsorted(w.first, at, "right") - 1
        key, tf = np.unique(doc * max(len(uniq), 1) + inv.ravel(), return_counts=True)
        doc, inv = np.divmod(key, max(len(uniq), 1))
        self.posts.append((uniq[inv], base + doc, tf, counts[doc]))
        self.docs.append(ids)
        self.lens.append(counts)
        self.size += len(tf)

    def rows(self, block: int, schema: pa.Schema):
        """A row per document (term null), then a row per term."""
        ids, n = pa.concat_arrays(self.docs), np.concatenate(self.lens)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()  # places are in the order of ids
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        ids, n = ids.take(pa.array(order)), n[order]
        nulls = lambda kind: pa.nulls(len(ids), kind)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), block)), ids, pa.array(np.arange(len(ids)), pa.int32()), pa.array(n),
             nulls(pa.int64()), nulls(pa.string()), nulls(pa.binary()), nulls(pa.binary()), nulls(pa.binary())], schema=schema)
        code, doc, tf, length = (np.concatenate([p[i] for p in self.posts]) for i in range(4))
        doc = place[doc]
        order = np.lexsort((doc, code))
        code, doc, tf, length = code[order], doc[order].astype(np.uint16), tf[order].astype(np.int32), length[order].astype(np.int32)
        start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
        end = np.r_[start[1:], len(code)] if len(code) else start
        pack = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(start, end)], pa.binary())
        nulls = lambda kind: pa.nulls(len(start), kind)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(start), block)), nulls(ids.type), nulls(pa.int32()), pa.array(end - start),
             pa.array(code[start].view(np.int64)), pa.array([self.words[c] for c in code[start].tolist()], pa.binary()).cast(pa.string()),
             pack(doc), pack(tf), pack(length)], schema=schema)


def posting_runs(docs: DataFrame, wanted: np.ndarray | None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of documents (block, doc_id, place, n; term null) and of posting runs (block,
    code, term, n postings, places, tfs, lens), in one written table.

    A block lies in one task's share of the table, so its number is that of the task and a
    counter; the numbers hold because the table is written before it is used."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(wanted)

    def run(batches):
        block, number = _Block(), TaskContext.get().partitionId() << 24
        schema = None
        for batch in batches:
            ids = batch.column("doc_id")
            schema = schema or pa.schema([
                ("block", pa.int64()), ("doc_id", ids.type), ("place", pa.int32()), ("n", pa.int64()), ("code", pa.int64()),
                ("term", pa.string()), ("places", pa.binary()), ("tfs", pa.binary()), ("lens", pa.binary())])
            for part in range(0, batch.num_rows, block_rows):
                piece = batch.slice(part, block_rows)
                for w in tb.iter_words(piece.column("text"), tb.ALNUM_LOWER_TABLE):
                    held = sum(map(len, block.lens))
                    if held and (held + w.hi - w.lo > block_rows or block.size > BLOCK_POSTINGS):
                        yield from block.rows(number, schema)
                        block, number = _Block(), number + 1
                    block.add(piece.column("doc_id").slice(w.lo, w.hi - w.lo), w, sent.value)
        if block.docs:
            yield from block.rows(number, schema)

    return materialize(docs.select("doc_id", "text").mapInArrow(
        run, f"block long, doc_id {kind}, place int, n long, code long, term string, places binary, tfs binary, lens binary"))


def part(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """The share of a term's weight that a document gets, in millionths."""
    m = 50 + 50 * n.astype(np.int64) * docs // max(total, 1)
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def best_places(score: np.ndarray, top: int) -> np.ndarray:
    """Ascending places of the ``top`` highest scores above 0, smaller places first among equals."""
    found = np.flatnonzero(score > 0)
    if len(found) > top:
        own = score[found]
        least = np.partition(own, len(own) - top)[len(own) - top]
        above = own > least
        equal = np.flatnonzero(own == least)[: top - int(above.sum())]
        above[equal] = True
        found = found[above]
    return found


_BUNDLE = "bundle long, block long, item int, places binary, scores binary"
_BUNDLE_ARROW = pa.schema([("bundle", pa.int64()), ("block", pa.int64()), ("item", pa.int32()), ("places", pa.binary()), ("scores", pa.binary())])


def _stage(bundles: DataFrame, runs: DataFrame, docs: int, total: int, top: int | None) -> DataFrame:
    """Bundles after the terms of one owner; held to the best ``top`` of each item, if given.
    ``runs``: bundle, block, items (places in the bundle), weight, places, tfs, lens."""

    def visit(key, left: pa.Table, right: pa.Table) -> pa.Table:
        bundle, block = (k.as_py() for k in key)
        came = [(i, np.frombuffer(p, np.uint16), np.frombuffer(s, np.int64))
                for i, p, s in zip(*(left[c].to_pylist() for c in ("item", "places", "scores")))]
        new = [(i, w, np.frombuffer(p, np.uint16), np.frombuffer(t, np.int32), np.frombuffer(n, np.int32))
               for i, w, p, t, n in zip(*(right[c].to_pylist() for c in ("items", "weight", "places", "tfs", "lens")))]
        size = 1 + max(int(x[k][-1]) for rows, k in ((came, 1), (new, 2)) for x in rows)  # places ascend
        scores: dict[int, np.ndarray] = {}
        for item, places, held in came:
            scores[item] = np.zeros(size, np.int64)
            scores[item][places] = held
        for items, weight, places, tf, n in new:
            more = weight * part(tf, n, docs, total)
            for item in items:
                if item not in scores:
                    scores[item] = np.zeros(size, np.int64)
                scores[item][places] += more
        out = []
        for item in sorted(scores):
            at = np.flatnonzero(scores[item]) if top is None else best_places(scores[item], top)
            if len(at):
                out.append((bundle, block, item, at.astype(np.uint16).tobytes(), scores[item][at].tobytes()))
        return pa.table(dict(zip(_BUNDLE_ARROW.names, zip(*out) if out else [[]] * 5)), schema=_BUNDLE_ARROW)

    return bundles.groupBy("bundle", "block").cogroup(runs.groupBy("bundle", "block")).applyInArrow(visit, _BUNDLE)


def _unpacked(bundles: DataFrame) -> DataFrame:
    """bundle, block, item, place, score of the entries of the accumulators."""

    def run(batches):
        for batch in batches:
            places = [np.frombuffer(x, np.uint16) for x in batch.column("places").to_pylist()]
            scores = [np.frombuffer(x, np.int64) for x in batch.column("scores").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(places)), [len(p) for p in places]))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in ("bundle", "block", "item")),
                     pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(scores))],
                    ["bundle", "block", "item", "place", "score"])

    return bundles.mapInArrow(run, "bundle long, block long, item int, place int, score long")


def owner(df: Column, docs: int, shares: tuple[float, ...] = STAGE_SHARES) -> Column:
    """Number of the stage that owns a term found in ``df`` documents."""
    out = F.lit(len(shares))
    for i in reversed(range(len(shares))):
        out = F.when(df <= shares[i] * docs, F.lit(i)).otherwise(out)
    return out


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_rows: int = BLOCK_ROWS,
                  bundle_bits: int = BUNDLE_BITS, filter_limit: int = FILTER_LIMIT,
                  shares: tuple[float, ...] = STAGE_SHARES) -> DataFrame:
    """item_id, rank, doc_id, score of the ``top`` best documents of every item."""
    terms = materialize(item_terms(items))
    names = terms.select("item_id").distinct()
    number = materialize(names.coalesce(1 + names.count() // NUMBERED).withColumn("number", F.monotonically_increasing_id()))
    number = number.select("item_id", F.shiftright("number", bundle_bits).alias("bundle"),
                           F.col("number").bitwiseAND((1 << bundle_bits) - 1).cast("int").alias("item"))
    of = number.withColumnRenamed("item_id", "_id")
    pairs = terms.join(of, F.col("item_id").eqNullSafe(F.col("_id"))).select("code", "term", "bundle", "item")
    # terms of bounded number are sent to the tasks; others meet the runs in a shuffle
    codes = terms.select("code").distinct().limit(filter_limit + 1).toArrow()["code"].to_numpy()
    small = len(codes) <= filter_limit and terms.count() <= filter_limit
    table = posting_runs(docs, np.sort(codes.view(np.uint64)) if small else None, block_rows)
    documents, runs = table.where(F.col("term").isNull()), table.where(F.col("term").isNotNull())
    n_docs, total = documents.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()

    def with_runs(right, *columns):
        return runs.select("code", "term", *columns).join(F.broadcast(right) if small else right, ["code", "term"])

    count = with_runs(terms.select("code", "term").distinct(), "n").groupBy("code", "term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    known = materialize(pairs.join(count, ["code", "term"]).groupBy("code", "term", "bundle").agg(
        F.collect_list("item").alias("items"), F.max(weight).alias("weight"), F.max(owner(F.col("df"), n_docs, shares)).alias("stage"))
        .where("weight > 0"))
    bundles = docs.sparkSession.createDataFrame([], _BUNDLE)
    for stage in range(len(shares) + 1):
        own = known.where(F.col("stage") == stage).drop("stage")
        bundles = _stage(bundles, with_runs(own, "block", "places", "tfs", "lens"), n_docs, total,
                         top if stage == len(shares) else None)
    by_score = Window.partitionBy("bundle", "item").orderBy(F.desc("score"))
    near = materialize(_unpacked(bundles).withColumn("_rank", F.rank().over(by_score)).where(F.col("_rank") <= top).drop("_rank"))
    by_id = Window.partitionBy("bundle", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "block", "place")
    ranked = (near.join(documents.select("block", "place", "doc_id"), ["block", "place"])
              .withColumn("rank", F.row_number().over(by_id)).where(F.col("rank") <= top))
    return ranked.join(number, ["bundle", "item"]).select("item_id", "rank", "doc_id", "score")


ORACLE_SQL = """
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL
), tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lens AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id
), totals AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM lens
), norms AS (
  SELECT doc_id, 50 + (50 * n * docs) // len AS m FROM lens, totals
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs, totals GROUP BY term, docs
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
), scored AS (
  SELECT item_id, t.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM wanted JOIN tfs t USING (term) JOIN weights USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, t.doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""
