"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has one bit per position: set if it is set in more than half of the 64-bit
hashes of the text's word shingles.  Fingerprints are cut into ``distance + 2`` blocks.
Two that differ in at most ``distance`` bits agree in two blocks at least, so they meet
under one of the block-pair keys and their Hamming distance is checked there.

Only distinct fingerprints are compared.  A key with more than ``bucket_limit`` of them
is not expanded into pairs: its fingerprints are grouped by every value within half the
distance of them instead.  For a distance of 2 that is each value itself and its 64
one-bit neighbours; fingerprints that share such a value differ in at most 2 bits, and any
two that differ in at most 2 bits share one.  A value has at most 65 such fingerprints, so
this path is exact and its groups are bounded.  Components are then found over links.

Defined cases: null and empty texts have fingerprint zero and link like any other; rows
of equal doc_id are all kept; rows without doc_id take part, but never name a component.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import materialize
from .components import components

SHINGLE_WORDS = 3
DISTANCE = 2
SEED = 42
BUCKET_LIMIT = 64


def fingerprint_chunk(w: tb.Words, shingle: int) -> np.ndarray:
    """Fingerprints of the texts of one chunk as unsigned integers."""
    inside = w.bytes != 0x20
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # one space after each word
    text = w.bytes[keep].tobytes()
    at = np.cumsum(keep) - keep  # place of each kept byte
    start, end = at[w.start], at[w.end - 1] + 1
    n = w.counts()
    grams = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), grams)
    first = w.first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(grams) - grams, grams)
    last = first + np.minimum(n, shingle)[doc] - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[a:b], SEED) for a, b in zip(start[first].tolist(), end[last].tolist())), np.uint64, len(doc))
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(grams)
    if len(full):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (np.cumsum(grams) - grams)[full], axis=0, dtype=np.int32)
        major = (2 * ones > grams[full][:, None]).astype(np.uint8)
        out[full] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row; no shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            parts = [fingerprint_chunk(w, shingle) for w in tb.iter_words(batch.column("text"), tb.WHITE_LOWER_TABLE)]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def links(fps: DataFrame, distance: int = DISTANCE, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fps`` (fp) that connect exactly
    those within ``distance`` bits; within a crowded bucket the links form stars."""
    if distance != 2:
        raise ValueError("the neighbourhood of crowded buckets is laid out for a distance of 2")
    width = 64 // (distance + 2)
    mask = (1 << width) - 1
    block = [F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask)) for i in range(distance + 2)]
    keys = [F.struct(F.lit(k).alias("k"), F.shiftleft(block[i], width).bitwiseOR(block[j]).alias("v"))
            for k, (i, j) in enumerate(combinations(range(distance + 2), 2))]
    keyed = materialize(fps.select("fp", F.explode(F.array(*keys)).alias("key")).select("key.k", "key.v", "fp"))
    crowded = materialize(keyed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bucket_limit))
    calm = keyed.join(crowded, ["k", "v"], "left_anti")
    a, b = calm.withColumnRenamed("fp", "a"), calm.withColumnRenamed("fp", "b")
    near = (a.join(b, ["k", "v"]).where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
            .select("a", "b"))
    hot = keyed.join(crowded, ["k", "v"], "left_semi").select("fp").distinct()
    around = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)])
    stars = (hot.select("fp", F.explode(around).alias("_flip")).groupBy(F.col("fp").bitwiseXOR(F.col("_flip")).alias("_z"))
             .agg(F.collect_set("fp").alias("_s")).where(F.size("_s") > 1)
             .select(F.array_min("_s").alias("a"), F.explode("_s").alias("b")).where("a <> b"))
    return near.union(stars).distinct()


def simhash_components(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = DISTANCE,
                       bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest reachable doc_id) per row."""
    marked = materialize(fingerprints(docs, shingle))
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("_first")))
    roots = components(links(distinct.select("fp"), distance, bucket_limit))
    rooted = materialize(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                         .select("fp", "_first", F.coalesce("root", "fp").alias("_root")))
    named = materialize(rooted.groupBy("_root").agg(F.min("_first").alias("component_id")))
    names = materialize(rooted.join(named, "_root").select("fp", "component_id"))
    # many rows may share a fingerprint: both sides are written tables, so a hot one can be split
    return marked.join(names, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
