"""Token ids of whole texts by a public tokenizer file, with a bounded word cache.

The word-level BPE file drops white space before it splits a text, so no token spans
white space and the ids of a text are those of its words in order.  Ids are therefore
computed once per distinct word of a task and looked up after that.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

from . import textbytes as tb

DEFAULT_FILE = "word_bpe_49k.json"
#: words of ASCII and Latin-1 letters, digits and signs: no character of theirs composes
#: with a neighbour, and folding is one to one
_PLAIN = re.compile("[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_PRE_TOKEN = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: visible Latin-1
    characters stand for themselves, the others for code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


class WordTokenizer:
    def __init__(self, path: str, limit: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.dtype = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {}
        self.ids = tb.Ragged(self.dtype)
        self.table = tb.WordTable(self._learn, self._forget, limit)

    def _forget(self) -> None:
        self.ids.clear()
        self.parts.clear()

    def _learn(self, words: list[bytes]) -> None:
        parts, tokenize, letters = self.parts, self.tok.model.tokenize, self.letters
        flat, ends = array("I"), np.zeros(len(words) + 1, np.int64)
        for n, word in enumerate(words):
            text = word.decode("utf-8", "replace")
            if "'" in text or "<|" in text or not _PLAIN.fullmatch(text):
                flat.extend(self.tok.encode(text, add_special_tokens=False).ids)
            else:
                for part in _PRE_TOKEN.findall(text.lower()):
                    got = parts.get(part)
                    if got is None:
                        spelled = part if part.isascii() else "".join([letters[b] for b in part.encode()])
                        got = array("I", [t.id for t in tokenize(spelled)]).tobytes()
                        if part != text:  # a word that is its own part is kept by the table
                            parts[part] = got
                    flat.frombytes(got)
            ends[n + 1] = len(flat)
        self.ids.extend(np.array(flat, self.dtype), np.diff(ends))

    def encode(self, texts: pa.Array, end_id: int, max_bytes: int = tb.CHUNK_BYTES):
        """Yields (first row, ids of the rows' texts each followed by ``end_id``, ids per
        row) for consecutive groups of rows."""
        for w in tb.iter_words(texts, tb.WHITE_TABLE, max_bytes):
            rows = self.table.lookup(w, w.codes())
            flat, lens = self.ids.gather(rows)
            total = np.concatenate([[0], np.cumsum(lens)])
            per_doc = np.diff(total[w.first]) if len(w.first) else np.zeros(0, np.int64)
            out = np.full(len(flat) + len(per_doc), end_id, np.uint32)
            keep = np.ones(len(out), bool)
            keep[np.cumsum(per_doc + 1) - 1] = False
            out[keep] = flat
            yield w.lo, out, per_doc + 1


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker and file: it stays for the worker's later tasks."""
    return WordTokenizer(path)
