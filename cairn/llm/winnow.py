"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item, or the whole item if it is
shorter.  With k-grams of words and the minimum k-gram hash of every ``window - k + 1``
consecutive k-grams kept on both sides (all of them on a tie), two texts that share a
window share a kept k-gram inside it.  Kept k-grams of documents are joined with those
of the items, each hit is extended word by word to both sides, and a run of equal words
at least a window long marks the document's words as hit.  Comparison is on the words
themselves, so a hash collision cannot mark anything.

Items shorter than a window form one class for each length, with k and the sliding
window derived from that length; documents are winnowed once for each class that occurs.

Defined cases: null and empty texts have no words; items without words match nothing;
rows of equal doc_id are separate documents in the counts (each row gets its own result)
and rows of equal item_id are one item with the windows of all; items without id mark
words, but are not counted among the items; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import materialize

WINDOW = 10
#: fingerprints of the benchmark that may be sent to every task as a filter (8 bytes each)
FILTER_LIMIT = 500_000
ROW_STEP = 1 << 40


def gram_size(length: int) -> int:
    """k for spans of ``length`` words; the rest of the span is the sliding window."""
    return (length + 1) // 2


def kept_grams(w: tb.Words, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, code) of the k-grams that winnowing keeps for spans of ``length`` words."""
    k = gram_size(length)
    slide = length - k + 1
    h = tb.gram_codes(codes, k)
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = h[:n].copy()
    for j in range(1, slide):
        np.minimum(low, h[j: j + n], out=low)
    doc = w.doc()
    inside = doc[:n] == doc[length - 1:]  # the span lies in one text
    keep = np.zeros(len(h), bool)
    for j in range(slide):
        keep[j: j + n] |= inside & (h[j: j + n] == low)
    at = np.flatnonzero(keep)
    return at, h[at]


def _context(w: tb.Words, first: int, last: int, lo: int, hi: int) -> bytes:
    """Words lo .. hi-1, held to the text's own words first .. last-1, joined by spaces."""
    lo, hi = max(lo, first), min(hi, last)
    return b" ".join(w.raw[w.start[lo]: w.end[hi - 1]].split())


def _gram_rows(w, codes, length, wanted=None):
    """Kept grams of a chunk with their surroundings: every window of ``length`` words that
    holds the gram lies inside.  Columns: text, first word in the text, code, words before
    the gram in the context, context."""
    at, h = kept_grams(w, codes, length)
    if wanted is not None and len(at):
        place = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
        found = wanted[place] == h
        at, h = at[found], h[found]
    k = gram_size(length)
    doc = np.searchsorted(w.first, at, "right") - 1
    begin, stop = w.first[doc], w.first[doc + 1]
    reach = length - k
    text = [_context(w, b, s, a - reach, a + k + reach) for a, b, s in zip(at.tolist(), begin.tolist(), stop.tolist())]
    return doc, at - begin, h, np.minimum(reach, at - begin), text


def item_grams(items: DataFrame, window: int) -> DataFrame:
    """length, code, item_id, before, context of the kept k-grams of every item."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for w in tb.iter_words(batch.column("text"), tb.ALNUM_LOWER_TABLE):
                codes, n = w.codes(), w.counts()
                for length in np.unique(np.minimum(n, window)).tolist():
                    if not length:
                        continue
                    doc, _, h, before, text = _gram_rows(w, codes, length)
                    # items of one class only: longer texts have spans of this length too
                    own = np.flatnonzero(np.minimum(n, window)[doc] == length)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), length), pa.int32()), pa.array(h[own].view(np.int64)),
                         batch.column("item_id").take(pa.array(doc[own] + w.lo)), pa.array(before[own], pa.int32()),
                         pa.array([text[i] for i in own], pa.binary())],
                        ["length", "code", "item_id", "before", "context"])

    return items.select("item_id", "text").mapInArrow(
        run, f"length int, code long, item_id {kind}, before int, context binary")


def document_grams(docs: DataFrame, lengths: list[int], wanted: dict | None) -> DataFrame:
    """One row per document: row (its number), doc_id, n_words and grams, the kept k-grams
    whose codes are in ``wanted`` (all, if that is None)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(wanted)
    gram = "struct<length:int,code:long,word:int,before:int,context:binary>"
    arrow = pa.struct([("length", pa.int32()), ("code", pa.int64()), ("word", pa.int32()), ("before", pa.int32()),
                       ("context", pa.binary())])

    def run(batches):
        row = TaskContext.get().partitionId() * ROW_STEP
        for batch in batches:
            for w in tb.iter_words(batch.column("text"), tb.ALNUM_LOWER_TABLE):
                codes, cols = w.codes(), [[], [], [], [], [], []]
                for length in lengths:
                    doc, word, h, before, text = _gram_rows(w, codes, length, None if sent.value is None else sent.value[length])
                    for col, x in zip(cols, (doc, np.full(len(doc), length), h.view(np.int64), word, before)):
                        col.append(x)
                    cols[5] += text
                doc, length, code, word, before = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols[:5])
                order = np.argsort(doc, kind="stable")
                bounds = np.searchsorted(doc[order], np.arange(w.hi - w.lo + 1))
                flat = pa.StructArray.from_arrays(
                    [pa.array(length[order], pa.int32()), pa.array(code[order], pa.int64()), pa.array(word[order], pa.int32()),
                     pa.array(before[order], pa.int32()), pa.array([cols[5][i] for i in order], pa.binary())], fields=list(arrow))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(w.hi - w.lo)), batch.column("doc_id").slice(w.lo, w.hi - w.lo),
                     pa.array(w.counts()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)],
                    ["row", "doc_id", "n_words", "grams"])
                row += w.hi - w.lo

    return docs.select("doc_id", "text").mapInArrow(run, f"row long, doc_id {kind}, n_words long, grams array<{gram}>")


def _extend(hits: DataFrame) -> DataFrame:
    """Run of equal words around each joined k-gram: row, item_context_id, lo, hi (document
    words) of the runs that hold a window."""

    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("length", "word", "before", "context", "item_before", "item_context")]
            picked, lows, highs = [], [], []
            for n, (length, word, before, mine, item_before, theirs) in enumerate(zip(*cols)):
                a, b, k = mine.split(b" "), theirs.split(b" "), gram_size(length)
                if a[before: before + k] != b[item_before: item_before + k]:
                    continue
                lo = 0
                while lo < min(before, item_before) and a[before - lo - 1] == b[item_before - lo - 1]:
                    lo += 1
                hi, most = k, min(len(a) - before, len(b) - item_before)
                while hi < most and a[before + hi] == b[item_before + hi]:
                    hi += 1
                if lo + hi >= length:
                    picked.append(n)
                    lows.append(word - lo)
                    highs.append(word + hi)
            take = pa.array(picked, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(take), batch.column("item_context_id").take(take), pa.array(lows, pa.int64()), pa.array(highs, pa.int64())],
                ["row", "item_context_id", "lo", "hi"])

    return hits.mapInArrow(run, "row long, item_context_id long, lo long, hi long")


def contaminated_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                       filter_limit: int = FILTER_LIMIT) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): row, doc_id, n_words of every document; row, item_id, lo, hi of
    the runs of words that it shares with an item."""
    grams = materialize(item_grams(items, window))
    codes = grams.select("length", "code").distinct()
    # a benchmark of bounded size is sent to the tasks as a filter of their k-grams; a
    # larger one is not, and the join below does the same work in a shuffle
    held = codes.limit(filter_limit + 1).toArrow()
    small = held.num_rows <= filter_limit
    lengths = sorted(r.length for r in grams.select("length").distinct().collect())  # at most ``window``
    wanted = None
    if small:
        of, code = held.column("length").to_numpy(), held.column("code").to_numpy()
        wanted = {n: np.sort(code[of == n].view(np.uint64)) for n in lengths}
    rows = materialize(document_grams(docs, lengths, wanted))
    found = rows.select("row", F.explode("grams").alias("g")).select("row", "g.*")
    # a gram with its surroundings that many items share is joined and extended once; the
    # items are attached to the runs that hold
    of = ["length", "code", "before", "context"]
    contexts = materialize(grams.select(*of).distinct().withColumn("item_context_id", F.monotonically_increasing_id()))
    members = materialize(grams.join(contexts, of).select("item_context_id", "item_id").distinct())
    item = contexts.select("length", "code", "item_context_id", F.col("before").alias("item_before"), F.col("context").alias("item_context"))
    held = materialize(_extend(found.join(item, ["length", "code"])).distinct())
    spans = held.join(members, "item_context_id").select("row", "item_id", "lo", "hi").distinct()
    return rows.select("row", "doc_id", "n_words"), materialize(spans)


def covered(spans: DataFrame) -> DataFrame:
    """row, runs (disjoint ascending [lo, hi) pairs), n_hit.  A document has at most as many
    different spans as words times window positions, so its list is bounded by its length."""
    merged = F.aggregate(
        F.array_sort(F.collect_set(F.struct("lo", "hi"))), F.array().cast("array<struct<lo:bigint,hi:bigint>>"),
        lambda acc, x: F.when(F.get(acc, F.size(acc) - 1)["hi"] >= x["lo"],
                              F.concat(F.slice(acc, 1, F.size(acc) - 1),
                                       F.array(F.struct(F.get(acc, F.size(acc) - 1)["lo"].alias("lo"),
                                                        F.greatest(F.get(acc, F.size(acc) - 1)["hi"], x["hi"]).alias("hi")))))
        .otherwise(F.concat(acc, F.array(x))))
    return spans.groupBy("row").agg(merged.alias("runs")).withColumn(
        "n_hit", F.aggregate("runs", F.lit(0).cast("long"), lambda s, x: s + x["hi"] - x["lo"]))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  filter_limit: int = FILTER_LIMIT) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, spans = contaminated_spans(docs, items, window, filter_limit)
    hit = covered(spans.select("row", "lo", "hi")).select("row", "n_hit")
    names = (spans.select("row", F.col("item_id").cast("string").alias("item")).where("item IS NOT NULL").distinct()
             .groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    out = rows.join(hit, "row", "left").join(names, "row", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>"))), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
