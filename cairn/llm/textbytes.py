"""Words of UTF-8 text as numpy arrays, for use inside Arrow tasks.

A batch of texts is taken in chunks of a few MB.  The texts of a chunk are joined with
one space, so no word spans two texts; a 256-entry byte table lower-cases A-Z and turns
every separator into a space.  Word boundaries and 64-bit word codes then come from a
handful of array operations, without a Python loop over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_MULT = 0x9E3779B97F4A7C15  # odd, so that powers can be inverted modulo 2**64
_BYTE_CODE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

WHITE = bytes([0x20, *range(0x09, 0x0E)])


def byte_table(separators: bytes, lower: bool) -> bytes:
    """Translation table: separators become a space, A-Z lower case if ``lower``."""
    out = list(range(256))
    if lower:
        for c in range(ord("A"), ord("Z") + 1):
            out[c] = c + 32
    for c in separators:
        out[c] = 0x20
    return bytes(out)


#: words are runs of anything but ASCII white space
WHITE_TABLE = byte_table(WHITE, lower=False)
WHITE_LOWER_TABLE = byte_table(WHITE, lower=True)
#: words are runs of ASCII letters, digits and everything beyond ASCII
ALNUM_LOWER_TABLE = byte_table(
    bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)), lower=True)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        for key, factor in (("up", _MULT), ("down", pow(_MULT, -1, 1 << 64))):
            row = np.full(max(n + n // 4, 1 << 16), factor, np.uint64)
            row[0] = 1
            _powers[key] = np.cumprod(row, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the whole 64-bit word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, memoryview]:
    """(offsets, bytes) of a string or binary array; nulls count as empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.binary() if not pa.types.is_large_string(texts.type) and not pa.types.is_large_binary(texts.type)
                       else pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(1, np.int64), memoryview(b"")
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    return offsets, memoryview(data if data is not None else b"")


def chunk_ranges(offsets: np.ndarray, max_bytes: int = CHUNK_BYTES):
    """Ranges of rows with at most ``max_bytes`` of text each, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


class Words:
    """The words of rows ``lo .. hi-1`` of a batch.

    raw     translated bytes of the chunk (separators are spaces)
    doc_at  byte offset of each text in raw
    start, end  byte span of each word in raw
    first   first word of each text, with the number of words as the last entry
    """

    def __init__(self, offsets, data, lo, hi, table):
        joined = b" ".join([data[offsets[i]: offsets[i + 1]] for i in range(lo, hi)])
        self.joined = joined
        self.raw = joined.translate(table)
        self.lo, self.hi = lo, hi
        self.doc_at = offsets[lo:hi] - offsets[lo] + np.arange(hi - lo)
        self.bytes = np.frombuffer(self.raw, np.uint8)
        inside = np.zeros(len(self.raw) + 2, np.int8)
        inside[1:-1] = self.bytes != 0x20
        step = np.diff(inside)
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        self.first = np.append(np.searchsorted(self.start, self.doc_at), len(self.start))

    def __len__(self):
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Index of the text (from 0 in this chunk) of each word."""
        return np.repeat(np.arange(self.hi - self.lo), self.counts())

    def codes(self) -> np.ndarray:
        """A 64-bit code of each word's bytes, never 0."""
        up, down = powers(len(self.raw) + 1)
        total = np.zeros(len(self.raw) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[self.bytes] * up[:-1], out=total[1:], dtype=np.uint64)
        h = mix((total[self.end] - total[self.start]) * down[self.start])
        h[h == 0] = 1
        return h

    def text(self, i: int) -> bytes:
        return self.raw[self.start[i]: self.end[i]]


def iter_words(texts: pa.Array, table: bytes, max_bytes: int = CHUNK_BYTES):
    offsets, data = buffers(texts)
    for lo, hi in chunk_ranges(offsets, max_bytes):
        yield Words(offsets, data, lo, hi, table)


def gram_codes(codes: np.ndarray, k: int) -> np.ndarray:
    """Codes of the k consecutive words from each position; the last k-1 positions of the
    array are left out.  Callers mask grams that cross a text boundary."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + codes[j: j + n]
    return mix(out)


class WordTable:
    """Word code -> row number, an open-addressing table filled as new words appear.

    ``learn(words)`` is called with the bytes of new words and stores their values at
    the next rows.  The table holds at most ``limit`` words; beyond that it starts
    afresh (``forget`` is called), so memory is bounded whatever the vocabulary.
    """

    def __init__(self, learn, forget, limit: int = 2_000_000):
        self.learn, self.forget, self.limit = learn, forget, limit
        self._reset(16)

    def _reset(self, bits: int) -> None:
        self.bits, self.rows = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.vals = np.zeros(1 << bits, np.int32)

    def _slot(self, h):
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each code, -1 if unknown."""
        out = np.full(len(h), -1, np.int32)
        slot, todo = self._slot(h), np.arange(len(h))
        mask = len(self.keys) - 1
        while len(todo):
            key = self.keys[slot]
            want = h if len(todo) == len(h) else h[todo]
            hit = key == want
            out[todo[hit]] = self.vals[slot[hit]]
            more = ~hit & (key != 0)
            todo, slot = todo[more], (slot[more] + 1) & mask
        return out

    def _put(self, h: np.ndarray, rows: np.ndarray) -> None:
        mask = len(self.keys) - 1
        slot = self._slot(h)
        while len(h):
            free = np.flatnonzero(self.keys[slot] == 0)
            _, pick = np.unique(slot[free], return_index=True)
            at = free[pick]
            self.keys[slot[at]], self.vals[slot[at]] = h[at], rows[at]
            rest = np.ones(len(h), bool)
            rest[at] = False
            h, rows, slot = h[rest], rows[rest], (slot[rest] + 1) & mask

    def lookup(self, words: Words, codes: np.ndarray) -> np.ndarray:
        """Row of each word; new words are learned first."""
        rows = self.find(codes)
        miss = np.flatnonzero(rows < 0)
        if not len(miss):
            return rows
        new, where = np.unique(codes[miss], return_index=True)
        if self.rows + len(new) > self.limit and self.rows:
            self._reset(16)
            self.forget()
            return self.lookup(words, codes)
        if (self.rows + len(new)) * 2 > len(self.keys):
            keys, vals = self.keys, self.vals
            held, n = np.flatnonzero(keys), self.rows
            bits = int(np.ceil(np.log2((n + len(new)) * 4)))
            self._reset(max(bits, self.bits))
            self._put(keys[held], vals[held])
            self.rows = n
        at = miss[where]
        self.learn([words.text(i) for i in at])
        self._put(new, np.arange(self.rows, self.rows + len(new), dtype=np.int32))
        self.rows += len(new)
        rows[miss] = self.find(codes[miss])
        return rows


class Ragged:
    """Append-only rows of small integers in one growing pool."""

    def __init__(self, dtype):
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.pool, self.at, self.n = np.zeros(1 << 16, self.dtype), np.zeros(1 << 14, np.int64), 0

    def extend(self, flat: np.ndarray, lens: np.ndarray) -> None:
        ends = self.at[self.n] + np.cumsum(lens)
        need, rows = int(self.at[self.n]) + len(flat), self.n + len(lens) + 1
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.at[self.n]], np.zeros(need * 2 - int(self.at[self.n]), self.dtype)])
        if rows > len(self.at):
            self.at = np.concatenate([self.at[: self.n + 1], np.zeros(rows * 2, np.int64)])
        self.pool[self.at[self.n]: need] = flat
        self.at[self.n + 1: rows] = ends
        self.n += len(lens)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat values, length of each row's values) for the given rows in order."""
        lens = self.at[rows + 1] - self.at[rows]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        index = np.arange(total) + np.repeat(self.at[rows] - (ends - lens), lens)
        return self.pool[index], lens
