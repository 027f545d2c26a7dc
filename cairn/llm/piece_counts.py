"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie over bytes.  Every node v carries a failure link and the number
of pieces popped on the way: when no edge fits, the pieces that greedy longest-match
would have cut off are already counted, and matching goes on at the failure node.  Each
byte is read once and no piece is ever built.  Counts are computed once per distinct
word of a task; the cache is bounded.

Defined cases: null and empty texts have no words and count 0; a word that the
vocabulary cannot spell counts as one piece and as one unknown word.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb

DEFAULT_FILE = "byte_bpe_50k.json"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


def load_pieces(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file as byte strings."""
    from .vocab import _byte_letters

    byte_of = {c: b for b, c in _byte_letters().items()}
    with open(path, encoding="utf-8") as f:
        book = json.load(f)
    special = {t["content"] for t in book["added_tokens"]}
    return [bytes(byte_of[c] for c in piece) for piece in book["model"]["vocab"]
            if piece not in special and all(c in byte_of for c in piece)]


class PieceCounter:
    """Counts of greedy longest-match pieces of byte strings."""

    def __init__(self, pieces):
        self.edges: list[dict[int, int]] = [{}]
        final, parent, via = [False], [0], [0]
        for piece in pieces:
            at = 0
            for c in piece:
                nxt = self.edges[at].get(c)
                if nxt is None:
                    nxt = self.edges[at][c] = len(self.edges)
                    self.edges.append({})
                    final.append(False)
                    parent.append(at)
                    via.append(c)
                at = nxt
            final[at] = at != 0
        n = len(self.edges)
        # -1: no way on.  Nodes are visited by depth, so a node's links build on shorter ones.
        self.fail, self.pops = [-1] * n, [0] * n
        level = [0]
        while level:
            level = [v for u in level for v in self.edges[u].values()]
            for v in level:
                if final[v]:
                    self.fail[v], self.pops[v] = 0, 1
                    continue
                z, popped, c = self.fail[parent[v]], self.pops[parent[v]], via[v]
                while z >= 0 and c not in self.edges[z]:
                    popped += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.pops[v] = self.edges[z][c], popped

    def count(self, word: bytes) -> int:
        """Pieces of the word, -1 if the vocabulary cannot spell it."""
        edges, fail, pops, at, n = self.edges, self.fail, self.pops, 0, 0
        for c in word:
            nxt = edges[at].get(c)
            while nxt is None:
                if fail[at] < 0:
                    return -1
                n += pops[at]
                at = fail[at]
                nxt = edges[at].get(c)
            at = nxt
        while at:
            if fail[at] < 0:
                return -1
            n += pops[at]
            at = fail[at]
        return n


class _CountedWords:
    def __init__(self, path: str, limit: int = 1_000_000):
        self.counter = PieceCounter(load_pieces(path))
        self.values = tb.Ragged(np.int32)
        self.table = tb.WordTable(self._learn, self.values.clear, limit)

    def _learn(self, words: list[bytes]) -> None:
        got = [self.counter.count(b" " + w) for w in words]
        self.values.extend(np.array(got, np.int32), np.ones(len(got), np.int64))


@lru_cache(maxsize=2)
def _counted(path: str) -> _CountedWords:
    return _CountedWords(path)


def piece_counts(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """doc_id, n_words, n_pieces, n_unknown of every text.  Words are runs of anything but
    ASCII white space; each is matched with a leading space, as the vocabulary marks word
    starts.  No shuffle: one pass over the texts."""
    path = vocab_path or default_path()

    def count(batches):
        book = _counted(path)
        for batch in batches:
            cols = [[], [], []]
            for w in tb.iter_words(batch.column("text"), tb.WHITE_TABLE):
                rows = book.table.lookup(w, w.codes())  # may move the values: read them afterwards
                got = book.values.pool[rows]
                for col, values in zip(cols, (np.ones(len(w), np.int64), np.abs(got), got < 0)):
                    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
                    col.append(np.diff(total[w.first]))
            cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, cols)],
                                             ["doc_id", "n_words", "n_pieces", "n_unknown"])

    keyed = docs.select(F.col("doc_id"), "text")
    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(count, f"doc_id {kind}, n_words long, n_pieces long, n_unknown long")
