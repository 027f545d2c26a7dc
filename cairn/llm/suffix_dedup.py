"""Exact repeats of ``length`` bytes across documents, by suffix arrays of shards.

A byte is removed if it lies in a string of ``length`` bytes that also starts in a
document with a smaller doc_id.  Strings are judged on the input; overlaps count.

1. Texts are written in chunks of about half a MB (compressed), the unit of all later steps.
   A copy of a whole text loses everything and takes no further part.
2. The string at each place has an anchor: of the ``gram``-byte grams inside it, the one
   whose hash is smallest, the leftmost on a tie.  Equal strings have equal anchors, and
   about one place in fourteen is an anchor.  Each chunk sends its anchors' hashes to
   buckets, which answer with one flag each: met in one document only, shared, or crowded
   (its runs of places would fill half a shard).  Places of unshared anchors cannot repeat.
3. Runs of places under a shared anchor are sent, with their bytes, to the shard of the
   anchor, equal runs of a chunk once, under the smallest doc_id (the others repeat it, and
   need no answer); a crowded anchor would fill its shard, so there each string goes to the shard
   of its own hash, once per chunk.  A shard's segments are joined into one text whose
   suffixes are sorted by induction (``induced_sort``); places whose first ``length``
   bytes are equal are neighbours then, and the smallest doc_id of each such run decides.
4. The verdicts go back to their chunks, which cut the texts.

Shards are of bounded size and all of them lie in Spark's shuffle files, not in memory:
a corpus of any size is sorted shard by shard.  Within a shard the queues of the
induction are in memory, and seeds are ranked by doubling up to ``length`` bytes in
place of a full recursion, since longer prefixes cannot change a verdict.

Defined cases: null and empty texts have no bytes; rows of equal doc_id never remove
each other's bytes; a row without doc_id is kept whole and removes nothing.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textbytes as tb
from .common import materialize
from .induced_sort import suffix_order

LENGTH, GRAM = 50, 24
CHUNK_BYTES = 1 << 19
CHUNK_STEP = 1 << 32
BUCKET_HASHES = 500_000
SHARD_BYTES = 8 << 20
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _squeeze(data) -> bytes:
    raw = memoryview(data).cast("B")
    return struct.pack("<Q", len(raw)) + (pa.compress(raw, codec="zstd", asbytes=True) if len(raw) else b"")


def _unsqueeze(data) -> memoryview:
    view = memoryview(data)
    (size,) = struct.unpack_from("<Q", view)
    return memoryview(pa.decompress(view[8:], decompressed_size=size, codec="zstd")) if size else memoryview(b"")


def write_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, carry: tuple[str, ...] = (), bucket_by: str | None = None) -> DataFrame:
    """chunk, ids, lens, digests (one entry per text), body (the texts' bytes, compressed),
    carried (one struct per text with the columns ``carry``)."""
    extra = pa.struct([(c, to_arrow_type(docs.schema[c].dataType)) for c in carry] or [("_none", pa.int8())])

    def run(batches):
        chunk = TaskContext.get().partitionId() * CHUNK_STEP
        for batch in batches:
            offsets, data = tb.buffers(batch.column("text"))
            for lo, hi in tb.chunk_ranges(offsets, chunk_bytes):
                marks = [hashlib.sha256(data[offsets[i]: offsets[i + 1]]).digest() for i in range(lo, hi)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk]), pa.array([batch.column("doc_id").slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                     pa.array([np.diff(offsets[lo: hi + 1])], pa.list_(pa.int64())), pa.array([marks], pa.list_(pa.binary())),
                     pa.array([_squeeze(data[offsets[lo]: offsets[hi]])], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), pa.StructArray.from_arrays(
                         [batch.column(c).slice(lo, hi - lo).cast(extra.field(c).type) for c in carry]
                         or [pa.nulls(hi - lo, pa.int8())], fields=list(extra)))],
                    ["chunk", "ids", "lens", "digests", "body", "carried"])
                chunk += 1

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(f"`{c}`") for c in carry])
    kinds = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in carry) or "_none: tinyint"
    return materialize(keyed.mapInArrow(
        run, "chunk long, ids array<long>, lens array<long>, digests array<binary>, body binary, "
             f"carried array<struct<{kinds}>>"), bucket_by=bucket_by)


class Chunk:
    """A chunk's bytes and, on demand, its string anchors."""

    def __init__(self, ids, lens, body, length: int, gram: int):
        self.ids, self.lens, self.length, self.gram = ids, np.asarray(lens, np.int64), length, gram
        self.data = np.frombuffer(_unsqueeze(body), np.uint8)
        self.at = np.cumsum(self.lens) - self.lens
        self.doc = np.repeat(np.arange(len(self.lens)), self.lens)
        self._total = None

    def window_codes(self, k: int) -> np.ndarray:
        """Code of the k bytes from each place on."""
        n = len(self.data)
        if n < k:
            return np.zeros(0, np.uint64)
        total = self.totals()
        return tb.mix((total[k:] - total[:-k]) * tb.powers(n + 1)[1][: n - k + 1])

    def totals(self) -> np.ndarray:
        if self._total is None:
            up, _ = tb.powers(len(self.data) + 1)
            self._total = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(tb._BYTE_CODE[self.data] * up[:-1], out=self._total[1:], dtype=np.uint64)
        return self._total

    def repeats(self, first, size, hashes, ids) -> np.ndarray:
        """Which of the segments (first place, bytes, anchor hash, doc_id) equal one of the same
        anchor with a smaller doc_id."""
        again = np.zeros(len(first), bool)
        if len(first) < 2:
            return again
        total = self.totals()
        code = tb.mix((total[first + size] - total[first]) * tb.powers(len(self.data) + 1)[1][first])
        order = np.lexsort((ids, code, size, hashes))
        same = np.concatenate([[False], (hashes[order][1:] == hashes[order][:-1]) & (size[order][1:] == size[order][:-1])
                               & (code[order][1:] == code[order][:-1])])
        least = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        for i, a in zip(order[same].tolist(), least[same].tolist()):
            n = size[i]
            again[i] = ids[a] < ids[i] and np.array_equal(self.data[first[a]: first[a] + n], self.data[first[i]: first[i] + n])
        return again

    def runs(self, skip: np.ndarray):
        """(first place, places, anchor hash) of the runs of places that share an anchor,
        without the texts marked in ``skip``."""
        none = np.zeros(0, np.int64)
        n = len(self.data) - self.length + 1
        if n <= 0:
            return none, none, np.zeros(0, np.uint64)
        h = self.window_codes(self.gram)
        low = (h & _HIGH) | np.arange(len(h), dtype=np.uint64)
        width, span = self.length - self.gram + 1, 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[: span - width], low[width - span:])
        place = np.flatnonzero((self.doc[:n] == self.doc[self.length - 1:]) & ~skip[self.doc[:n]])
        anchor = (low[place] & ~_HIGH).astype(np.int64)
        if not len(place):
            return none, none, np.zeros(0, np.uint64)
        # an anchor belongs to one text, so a new text starts a new run
        head = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        return place[head], np.diff(np.append(head, len(place))), h[anchor[head]]


def _unique_hashes(chunk: Chunk, first, hashes):
    """Sorted distinct anchor hashes, whether each occurs in several texts of the chunk, and
    its runs."""
    order = np.argsort(hashes, kind="stable")
    h, doc = hashes[order], chunk.doc[first[order]]
    head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    if not len(head):
        return h, np.zeros(0, bool), np.zeros(0, np.int64)
    return h[head], np.minimum.reduceat(doc, head) != np.maximum.reduceat(doc, head), np.diff(np.append(head, len(h)))


def _bucket_cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    edges = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def _flag_anchors(chunks: DataFrame, length: int, gram: int, buckets: int, crowded: int) -> DataFrame:
    """chunk, bucket, flags (0 alone, 1 shared, 2 crowded, for the chunk's sorted distinct
    anchor hashes that fall into the bucket).  Crowded: more than ``crowded`` runs in all."""

    def many(runs):  # place and number, where there is more than one run
        at = np.flatnonzero(runs > 1)
        return np.stack([at, runs[at]]).astype("<u4").tobytes()

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["ids"], row["lens"], row["body"], length, gram)
                first, _, hashes = c.runs(np.zeros(len(c.lens), bool))
                own, several, runs = _unique_hashes(c, first, hashes)
                cuts = _bucket_cuts(own, buckets)
                used = np.flatnonzero(np.diff(cuts))
                # the low 40 bits: with the bucket they are 47 and more, and a chance match only
                # makes a place a candidate
                low = own.view(np.uint8).reshape(-1, 8)[:, :5]
                bodies = [struct.pack("<Q", cuts[b + 1] - cuts[b]) + low[cuts[b]: cuts[b + 1]].tobytes()
                          + np.packbits(several[cuts[b]: cuts[b + 1]]).tobytes() + many(runs[cuts[b]: cuts[b + 1]]) for b in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([row["chunk"]] * len(used), pa.int64()), pa.array(bodies, pa.binary())],
                    ["bucket", "chunk", "body"])

    def answer(table: pa.Table) -> pa.Table:
        hashes, several, sizes, runs = [], [], [], []
        for body in table.column("body"):
            view = memoryview(body.as_buffer())
            (n,) = struct.unpack_from("<Q", view)
            sizes.append(n)
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :5] = np.frombuffer(view, np.uint8, 5 * n, 8).reshape(n, 5)
            hashes.append(wide.view("<u8").ravel())
            several.append(np.unpackbits(np.frombuffer(view, np.uint8, -(-n // 8), 8 + 5 * n), count=n))
            at, number = np.frombuffer(view, np.uint8, offset=8 + 5 * n + -(-n // 8)).copy().view("<u4").reshape(2, -1)
            runs.append(np.ones(n, np.int64))
            runs[-1][at] = number
        h, multi = np.concatenate(hashes), np.concatenate(several).astype(np.int64)
        _, group, met = np.unique(h, return_inverse=True, return_counts=True)
        shared = (met > 1) | (np.bincount(group, multi, len(met)) > 0)
        load = np.bincount(group, np.concatenate(runs), len(met))
        flags = (shared.astype(np.uint8) + (shared & (load > crowded)))[group]
        parts = np.split(flags, np.cumsum(sizes)[:-1])
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "flags": pa.array([_squeeze(p) if p.any() else None for p in parts], pa.binary())})

    sent = chunks.select("chunk", "ids", "lens", "body").mapInArrow(send, "bucket int, chunk long, body binary")
    return materialize(sent.groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, flags binary").where("flags IS NOT NULL"))


def _copies(chunks: DataFrame) -> DataFrame:
    """chunk, copies (places in the chunk of texts that equal one of a smaller doc_id)."""
    keys = materialize(chunks.select("chunk", F.posexplode(F.arrays_zip("ids", "digests")).alias("i", "x"))
                       .select("chunk", "i", F.col("x.ids").alias("id"), F.col("x.digests").alias("digest")).where("id IS NOT NULL"))
    firsts = materialize(keys.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("_last"))
                         .where("first < _last").select("digest", "first"))
    # written tables on both sides: a text with very many copies can be split
    again = materialize(keys.join(firsts, "digest").where("id > first").select("chunk", "i"))
    return again.groupBy("chunk").agg(F.collect_list("i").alias("copies"))


def _skipped(row, n: int) -> np.ndarray:
    """Texts that take no part: copies and rows without doc_id."""
    skip = np.array([x is None for x in row["ids"]], bool) if n else np.zeros(0, bool)
    if row["copies"]:
        skip[np.array(row["copies"])] = True
    return skip


_HEAD = "<qQQ"  # chunk, segments, bytes


def _segments(chunks: DataFrame, length: int, gram: int, buckets: int, shards: int) -> DataFrame:
    """shard, body: the places under shared anchors, with their bytes.  A segment is (place,
    text, places, part of the anchor's hash, doc_id); crowded ones hold one place and are
    marked by a negative count."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["ids"], row["lens"], row["body"], length, gram)
                every = np.zeros(len(c.lens), bool)
                first, count, hashes = c.runs(every)
                own, _, _ = _unique_hashes(c, first, hashes)
                cuts, flags = _bucket_cuts(own, buckets), np.zeros(len(own), np.uint8)
                for x in row["flags"]:
                    flags[cuts[x["bucket"]]: cuts[x["bucket"] + 1]] = np.frombuffer(_unsqueeze(x["flags"]), np.uint8)
                skip = _skipped(row, len(c.lens))
                flag = flags[np.searchsorted(own, hashes)] * ~skip[c.doc[first]]
                ids = np.array([0 if x is None else x for x in row["ids"]], np.int64)
                plain = np.flatnonzero(flag == 1)
                again = c.repeats(first[plain], count[plain] + length - 1, hashes[plain], ids[c.doc[first[plain]]])
                known, plain = plain[again], plain[~again]
                place, places, shard = first[plain], count[plain], tb.mix(hashes[plain]) % np.uint64(shards)
                anchor = hashes[plain] & np.uint64(0xFFFFFFFF)
                crowd = np.flatnonzero(flag == 2)
                if len(crowd):
                    n = count[crowd]
                    each = np.repeat(first[crowd], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    code = c.window_codes(length)[each]
                    order = np.lexsort((ids[c.doc[each]], code))  # the smallest doc_id of each string
                    head = np.concatenate([[True], code[order][1:] != code[order][:-1]])
                    each, code = each[order[head]], code[order[head]]
                    place, places = np.append(place, each), np.append(places, np.full(len(each), -1))
                    shard = np.append(shard, tb.mix(code) % np.uint64(shards))
                    anchor = np.append(anchor, np.zeros(len(each), np.uint64))
                order = np.argsort(shard, kind="stable")
                place, places, anchor, shard = place[order], places[order], anchor[order], shard[order].astype(np.int64)
                size = np.abs(places) + length - 1
                end = np.cumsum(size)
                text = c.data[np.arange(end[-1] if len(end) else 0) + np.repeat(place - (end - size), size)]
                doc = c.doc[place]
                head = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else []
                bodies = []
                for a, b in zip(head, np.append(head[1:], len(shard)) if len(shard) else ()):
                    lo, hi = end[a] - size[a], end[b - 1]
                    raw = b"".join([struct.pack(_HEAD, row["chunk"], b - a, hi - lo), (place[a:b] - c.at[doc[a:b]]).astype("<u4").tobytes(),
                                    doc[a:b].astype("<u4").tobytes(), places[a:b].astype("<i4").tobytes(),
                                    anchor[a:b].astype("<u4").tobytes(),
                                    ids[doc[a:b]].astype("<i8").tobytes(), text[lo:hi].tobytes()])
                    bodies.append(_squeeze(raw))
                to = shard[head].tolist() if len(shard) else []
                if len(known):  # verdicts already, passed on as a body without segments
                    own = c.doc[first[known]]
                    verdict = np.stack([own, first[known] - c.at[own], count[known], np.zeros_like(own), np.zeros_like(own)])
                    bodies.append(_squeeze(struct.pack(_HEAD, row["chunk"], 0, 0) + verdict.astype("<i8").tobytes()))
                    to.append(int(tb.mix(np.array([row["chunk"]], np.uint64))[0] % np.uint64(shards)))
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(bodies, pa.binary())],
                                                 ["shard", "body"])

    return chunks.mapInArrow(run, "shard int, body binary")


def smallest_ids(parts: list[bytes], ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For byte segments and the smallest doc_id each occurs in: the smallest doc_id that the
    ``length`` bytes from each place on occur in, and the number of places of the segments
    before each segment.  Places are those with ``length`` bytes left in their segment."""
    size = np.array([len(p) for p in parts], np.int64)
    raw = np.frombuffer(b"\0".join(parts) + b"\0\0", np.uint8)
    at = np.cumsum(size + 1) - size - 1
    text = raw.astype(np.uint16) + 2
    text[at + size] = 1  # the end of a segment
    text[-1] = 0
    places = size - length + 1
    before = np.cumsum(places) - places
    number = np.full(len(text), -1, np.int64)  # of each place among all places
    index = np.arange(places.sum()) + np.repeat(at - before, places)
    number[index] = np.arange(len(index))
    order = suffix_order(text, length)
    order = order[number[order] >= 0].astype(np.int64)
    new = np.ones(len(order), bool)
    windows = np.lib.stride_tricks.sliding_window_view(text, length)
    for lo in range(1, len(order), 65_536):
        hi = min(len(order), lo + 65_536)
        new[lo:hi] = (windows[order[lo:hi]] != windows[order[lo - 1: hi - 1]]).any(axis=1)
    owner = np.repeat(ids, places)[number[order]]
    head = np.flatnonzero(new)
    best = np.empty(len(order), np.int64)
    if len(head):
        best[number[order]] = np.repeat(np.minimum.reduceat(owner, head), np.diff(np.append(head, len(order))))
    return best, before


def _decide(table: pa.Table, length: int) -> pa.Table:
    """Verdicts of one shard: chunk, body (text, place, places, crowded's smallest doc_id or
    -1) for runs of places whose string starts in a smaller document."""
    heads, cols, texts, ready = [], [[np.zeros(0, np.int64)] for _ in range(5)], [], []
    for body in table.column("body"):
        view = _unsqueeze(body.as_buffer())
        chunk, n, size = struct.unpack_from(_HEAD, view)
        at = struct.calcsize(_HEAD)
        if not n:
            ready.append((chunk, _squeeze(view[at:])))
            continue
        for col, kind in zip(cols, ("<u4", "<u4", "<i4", "<u4", "<i8")):
            col.append(np.frombuffer(view, kind, n, at).astype(np.int64))
            at += n * np.dtype(kind).itemsize
        heads.append((chunk, n))
        texts.append(view[at: at + size])
    place, doc, places, anchor, ids = (np.concatenate(c) for c in cols)
    size = np.abs(places) + length - 1
    seen: dict[bytes, int] = {}
    which, k = np.empty(len(size), np.int64), 0
    for text, (_, n) in zip(texts, heads):
        raw, at = bytes(text), 0
        for s in size[k: k + n].tolist():
            which[k] = seen.setdefault(raw[at: at + s], len(seen))
            at, k = at + s, k + 1
    own = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(own, which, ids)
    count = np.abs(places)
    segment = np.repeat(np.arange(len(count)), count)
    least = own[which][segment]
    # an anchor with one content only, and a crowded string, are settled by that content;
    # where contents differ, their places are sorted
    kind = np.zeros(len(seen), np.uint64)
    kind[which] = np.where(places < 0, 1 << 32, anchor).astype(np.uint64)
    _, group, contents = np.unique(kind, return_inverse=True, return_counts=True)
    mixed = (contents[group] > 1) & (kind < 1 << 32)
    if mixed.any():
        chosen = np.flatnonzero(mixed)
        parts = list(seen)
        best, before = smallest_ids([parts[i] for i in chosen], own[chosen], length)
        at = np.zeros(len(seen), np.int64)
        at[chosen] = before
        flat = np.arange(count.sum()) + np.repeat(at[which] - (np.cumsum(count) - count), count)
        sort = mixed[which][segment]
        least[sort] = best[flat[sort]]
    crowd = places[segment] < 0
    hit = crowd | (least < ids[segment])
    # runs of hit places in a segment
    start = hit & np.concatenate([[True], ~hit[:-1] | (segment[1:] != segment[:-1])]) if len(hit) else hit
    run = np.cumsum(start)[hit] - 1
    n_run = np.bincount(run, minlength=int(start.sum())) if len(run) else np.zeros(0, np.int64)
    at = np.flatnonzero(start)
    seg = segment[at]
    from_chunk = np.repeat(np.arange(len(heads)), [n for _, n in heads])[seg]
    out = np.stack([doc[seg], place[seg] + at - (np.cumsum(count) - count)[seg], n_run, np.where(crowd[at], 1, 0), least[at]])
    cut = np.searchsorted(from_chunk, np.arange(len(heads) + 1))
    rows = [(heads[i][0], _squeeze(out[:, cut[i]: cut[i + 1]].astype("<i8").tobytes()))
            for i in range(len(heads)) if cut[i] < cut[i + 1]] + ready
    return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int64()), "body": pa.array([r[1] for r in rows], pa.binary())})


def _cut(chunk: Chunk, row, length: int) -> np.ndarray:
    """Which bytes of the chunk are removed."""
    edge = np.zeros(len(chunk.data) + 1, np.int64)
    if row["verdicts"]:
        parts = [np.frombuffer(_unsqueeze(v), "<i8").reshape(5, -1) for v in row["verdicts"]]
        doc, place, count, crowd, least = np.concatenate(parts, axis=1)
        at, plain = chunk.at[doc] + place, crowd == 0
        np.add.at(edge, at[plain], 1)
        np.add.at(edge, at[plain] + count[plain] + length - 1, -1)
        if not plain.all():  # every place of the chunk with one of these strings
            code = chunk.window_codes(length)
            mark = code[at[~plain]]
            order = np.argsort(mark)
            mark, least = mark[order], least[~plain][order]
            n = len(code)
            ids = np.array([np.iinfo(np.int64).min if x is None else x for x in row["ids"]], np.int64)
            near = np.minimum(np.searchsorted(mark, code), len(mark) - 1)
            hit = (mark[near] == code) & (chunk.doc[:n] == chunk.doc[length - 1:]) & (ids[chunk.doc[:n]] > least[near])
            hit = np.flatnonzero(hit)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    if row["copies"]:
        copy = np.zeros(len(chunk.lens), bool)
        copy[np.array(row["copies"])] = True
        gone |= (copy & (chunk.lens >= length))[chunk.doc]
    return gone


def judged_chunks(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES,
                  crowded: int | None = None, bucket_hashes: int = BUCKET_HASHES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Chunks with copies and verdicts, ready to be cut.  An anchor of more than ``crowded``
    runs (by default, as many as fill half a shard) is split."""
    if crowded is None:
        crowded = shard_bytes // (2 * (length + (length - gram) // 2 + 24))
    chunks = write_chunks(docs, chunk_bytes)
    total = chunks.select(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    anchors = total * 2 // (length - gram + 2)
    buckets = max(1, -(-anchors // bucket_hashes))
    shards = max(1, -(-anchors * (length + (length - gram) // 2) // 4 // shard_bytes))
    flags = _flag_anchors(chunks, length, gram, buckets, crowded)
    copies = materialize(_copies(chunks))
    marked = (chunks.drop("digests", "carried").join(flags.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "flags")).alias("flags")), "chunk")
              .join(copies, "chunk", "left"))
    sent = _segments(marked, length, gram, buckets, shards)
    verdicts = materialize(sent.groupBy("shard").applyInArrow(lambda t: _decide(t, length), "chunk long, body binary"))
    return (chunks.drop("digests", "carried").join(verdicts.groupBy("chunk").agg(F.collect_list("body").alias("verdicts")), "chunk", "left")
            .join(copies, "chunk", "left"))


def removed_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **sizes) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["ids"], row["lens"], row["body"], length, gram)
                gone = _cut(c, row, length)
                total = np.concatenate([[0], np.cumsum(gone)])
                start = gone.copy()
                start[1:] &= ~gone[:-1] | (c.doc[1:] != c.doc[:-1])
                spans = np.concatenate([[0], np.cumsum(start)])
                end = c.at + c.lens
                removed = total[end] - total[c.at]
                marks = [hashlib.sha256((c.data[a:b][~gone[a:b]] if r else c.data[a:b]).tobytes()).hexdigest()
                         for a, b, r in zip(c.at.tolist(), end.tolist(), removed.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(c.lens), pa.array(removed.astype(np.int64)),
                     pa.array((spans[end] - spans[c.at]).astype(np.int64)), pa.array(marks)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return judged_chunks(docs, length, gram, **sizes).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
