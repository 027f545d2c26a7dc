"""Best-fit packing of token sequences by exact complements.

A sequence holds ``capacity`` tokens.  Only the number of pieces of each length matters
for the plan, so it is made from a histogram of at most ``capacity`` entries: for the
longest length left, the gap is filled exactly by one, two or three other lengths if the
counts allow it (sums are looked up in a bit index of the available lengths), else by the
longest that fits, after which the rest of the gap is tried again.  Such a pattern is
used as often as the counts allow, so the plan has a bounded number of patterns whatever
the number of pieces.  Pieces are then numbered within their length and each number
range is mapped to a pattern's place.  No piece passes through the driver.

Defined cases: null and empty texts are one piece with the end id; repeated rows and
rows without doc_id are packed like any other; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vocab
from .common import materialize

CAPACITY = 4096
#: ranks within a length stay below 2**RANK_BITS in the combined lookup key
RANK_BITS = 45


class _Lengths:
    """Available lengths with counts, and a bit index in both directions."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.cap, self.n = capacity, [0] * (capacity + 1)
        self.bits = self.mirror = 0  # bit x, bit capacity - x: length x is available
        for length, count in histogram.items():
            self.add(length, count)

    def add(self, length: int, count: int) -> None:
        self.n[length] += count
        if self.n[length] > 0:
            self.bits |= 1 << length
            self.mirror |= 1 << (self.cap - length)
        else:
            self.bits &= ~(1 << length)
            self.mirror &= ~(1 << (self.cap - length))

    def longest(self, at_most: int) -> int:
        """The longest available length of at most ``at_most``, 0 if there is none."""
        return max(0, (self.bits & ((1 << (at_most + 1)) - 1)).bit_length() - 1)

    def pair(self, total: int, at_most: int) -> list[int]:
        both = self.bits & (self.mirror >> (self.cap - total)) & ((1 << (at_most + 1)) - 1)
        if total % 2 == 0 and self.n[total // 2] < 2:
            both &= ~(1 << (total // 2))
        a = both.bit_length() - 1
        return [a, total - a] if a > 0 else []

    def exact(self, gap: int) -> list[int]:
        """One, two or three available lengths that sum to ``gap``, longest first."""
        if self.n[gap]:
            return [gap]
        if found := self.pair(gap, gap - 1):
            return found
        a = self.longest(gap - 2)
        while a * 3 >= gap:
            self.add(a, -1)
            found = self.pair(gap - a, min(a, gap - a - 1))
            self.add(a, 1)
            if found:
                return [a, *found]
            a = self.longest(a - 1)
        return []


def plan_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths, copies) of each pattern; together they use up the histogram."""
    left, plan = _Lengths(histogram, capacity), []
    while left.bits:
        pattern = [left.longest(capacity)]
        left.add(pattern[0], -1)
        gap = capacity - pattern[0]
        while gap > 0:
            more = left.exact(gap) or [x for x in (left.longest(gap),) if x]
            if not more:
                break
            for x in more:
                left.add(x, -1)
            pattern += more
            gap -= sum(more)
        use = Counter(pattern)
        again = min(left.n[x] // k for x, k in use.items())
        for x, k in use.items():
            left.add(x, -again * k)
        plan.append((pattern, 1 + again))
    return plan


def place_table(plan: list[tuple[list[int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted lookup arrays (key, first sequence, offset): the ranks of one length from
    ``key`` on go to consecutive sequences at that offset."""
    taken, rows, sequence = Counter(), [], 0
    for pattern, copies in plan:
        offset = 0
        for length in pattern:
            rows.append(((length << RANK_BITS) + taken[length], sequence, offset))
            taken[length] += copies
            offset += length
        sequence += copies
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 3)
    return cols[:, 0].copy(), cols[:, 1].copy(), cols[:, 2].copy()


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, with the task that made it
    (part) and its number among that task's pieces of the same length (rank)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        tok = vocab.tokenizer(tokenizer_path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for lo, flat, lens in tok.encode(batch.column("text"), end_id):
                n = -(-lens // capacity)
                row = np.repeat(np.arange(len(lens)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                size = np.minimum(capacity, lens[row] - start)
                at = (np.cumsum(lens) - lens)[row] + start
                data = flat.astype("<u4")
                crc = [zlib.crc32(data[a:b]) for a, b in zip(at.tolist(), (at + size).tolist())]
                order = np.argsort(size, kind="stable")  # equal lengths together, in row order
                by = size[order]
                head = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
                runs = np.diff(np.append(head, len(by)))
                rank = np.empty(len(by), np.int64)
                rank[order] = np.arange(len(by)) - np.repeat(head, runs) + seen[by]
                seen[by[head]] += runs
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, len(lens)).take(pa.array(row)), pa.array(piece, pa.int32()),
                     pa.array(start), pa.array(size), pa.array(crc, pa.int64()),
                     pa.array(np.full(len(row), part), pa.int32()), pa.array(rank)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with length, part and rank (rank numbers the
    pieces of one length within a part without gaps)."""
    spark = pieces.sparkSession
    counts = materialize(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("_n")))
    # bounded by the capacity: one row per length
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}
    lookup = spark.sparkContext.broadcast(place_table(plan_patterns(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(counts.select("length", "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    numbered = pieces.join(bases, ["length", "part"])

    def place(batches):
        key, sequence, offset = lookup.value
        for batch in batches:
            rank = batch.column("_base").to_numpy() + batch.column("rank").to_numpy()
            want = (batch.column("length").to_numpy() << RANK_BITS) + rank
            at = np.searchsorted(key, want, "right") - 1
            cols = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(sequence[at] + want - key[at]), pa.array(offset[at])], [*columns, "sequence_id", "offset"])

    columns = [c for c in pieces.columns if c not in ("part", "rank", "sequence_id", "offset")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in columns)
    return numbered.mapInArrow(place, schema + ", sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 1,
                     capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialize(token_pieces(docs, tokenizer_path or vocab.default_path(), end_id, capacity))
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
