"""Token-id files: one concatenated id array per shard, document boundaries in Elias-Fano code.

Shard file: magic, header (id width, documents, ids, documents without doc_id), the ids
(little-endian, 2 bytes each when the vocabulary allows it, else 4), the code of the
documents' cumulative ends, the code of the ascending doc_ids.  Document i of a shard is
``ids[end(i-1): end(i)]`` with both ends from the select structure.

Defined cases: null and empty texts give the end id alone; rows without doc_id come
first; rows of equal doc_id are all kept, ordered by a hash of their text; negative
doc_ids are shifted by the shard's smallest one; an empty table writes no shard.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from . import vocab
from .common import materialize, read_blobs, work_path, write_blobs
from .elias_fano import EliasFano

MAGIC = b"EFTOKEN1"
_HEAD = struct.Struct("<BQQQq")  # id width, documents, ids, documents without id, smallest doc_id
SHARD_IDS = 2_000_000
#: shards of one partition have consecutive numbers from partition * SHARD_STEP
SHARD_STEP = 1_000_000


def pack_shard(doc_ids: list, ids: np.ndarray, lens: np.ndarray, width: int) -> bytes:
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    return b"".join([
        MAGIC, _HEAD.pack(width, len(doc_ids), len(ids), len(doc_ids) - len(known), base),
        ids.astype(f"<u{width}").tobytes(), EliasFano.build(np.cumsum(lens)).to_bytes(),
        EliasFano.build(known - base).to_bytes()])


class Shard:
    """A shard file's content; ids are views into it."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a token-id shard")
        self.width, self.n_docs, n_ids, self.n_null, self.base = _HEAD.unpack_from(view, 8)
        at = 8 + _HEAD.size
        self.ids = np.frombuffer(view, f"<u{self.width}", n_ids, at)
        at += n_ids * self.width
        self.ends, size = EliasFano.from_bytes(view[at:])
        self.keys, _ = EliasFano.from_bytes(view[at + size:])

    def doc_ids(self) -> list:
        return [None] * self.n_null + (self.keys.values() + self.base).tolist()

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        ends = self.ends.values()
        return np.concatenate([[0], ends[:-1]]).astype(np.int64), ends

    def document(self, i: int) -> np.ndarray:
        lo = int(self.ends.select([i - 1])[0]) if i else 0
        return self.ids[lo: int(self.ends.select([i])[0])]


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int,
                      shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into shard files at ``path``."""

    def encode(batches):
        tok = vocab.tokenizer(tokenizer_path)
        width = 2 if max(tok.size - 1, end_id) < 1 << 16 else 4
        blob = TaskContext.get().partitionId() * SHARD_STEP
        keys, ids, lens, held = [], [], [], 0

        def flush():
            body = pack_shard(keys, np.concatenate(ids), np.concatenate(lens), width)
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.int64()), pa.array([body], pa.binary())], ["blob", "body"])

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for lo, flat, per_doc in tok.encode(batch.column("text"), end_id, min(tb.CHUNK_BYTES, shard_ids)):
                keys += doc_ids[lo: lo + len(per_doc)]
                ids.append(flat)
                lens.append(per_doc)
                held += len(flat)
                if held >= shard_ids:
                    yield flush()
                    keys, ids, lens, held, blob = [], [], [], 0, blob + 1
        if keys:
            yield flush()

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    write_blobs(ordered.mapInArrow(encode, "blob long, body binary"), path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the shard files: blob, i (place in the shard), doc_id, first (ids
    before it in the shard), n_tokens, ids_crc32 (of its ids as 32-bit integers)."""

    def decode(batches):
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                shard = Shard(data.as_buffer())
                lo, hi = shard.bounds()
                blob = int(name.rsplit("blob=", 1)[1].split("/")[0])
                crc = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(lo.tolist(), hi.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lo), blob)), pa.array(np.arange(len(lo))), pa.array(shard.doc_ids(), pa.int64()),
                     pa.array(lo), pa.array(hi - lo), pa.array(crc, pa.int64())],
                    ["blob", "i", "doc_id", "first", "n_tokens", "ids_crc32"])

    return read_blobs(spark, path).mapInArrow(
        decode, "blob long, i long, doc_id long, first long, n_tokens long, ids_crc32 long")


def with_global_start(rows: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before, over all shards.  Shard totals are
    summed in two levels, so the only whole-table window has one row per writing task."""
    part = F.floor(F.col("blob") / F.lit(SHARD_STEP))
    shards = rows.groupBy("blob").agg(F.sum("n_tokens").alias("_n")).withColumn("_part", part)
    parts = shards.groupBy("_part").agg(F.sum("_n").alias("_pn"))
    w_all = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    w_in = Window.partitionBy("_part").orderBy("blob").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_pn").over(w_all), F.lit(0)).alias("_base"))
    shards = shards.withColumn("_in", F.coalesce(F.sum("_n").over(w_in), F.lit(0))).join(parts, "_part")
    return (rows.join(shards.select("blob", (F.col("_base") + F.col("_in")).alias("_at")), "blob")
            .withColumn("start", F.col("_at") + F.col("first")).drop("_at"))


def token_offsets(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the token files of ``docs``, read them back, and return doc_id, start,
    n_tokens, ids_crc32 per document."""
    spark = docs.sparkSession
    path = work_path(spark, "token_files")
    write_token_files(docs, path, tokenizer_path or vocab.default_path(), end_id)
    rows = materialize(read_token_files(spark, path))
    return with_global_start(rows).select("doc_id", "start", "n_tokens", "ids_crc32")
