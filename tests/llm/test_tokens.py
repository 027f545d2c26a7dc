"""Token-id files, piece counts and packing against direct computations."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from cairn.llm import vocab
from cairn.llm.common import work_path
from cairn.llm.elias_fano import EliasFano
from cairn.llm.piece_counts import PieceCounter, default_path, load_pieces, piece_counts
from cairn.llm.token_ids import Shard, read_token_files, token_offsets, write_token_files

TEXTS = [None, "", "  \n\t ", "Don't STOP 's it's İstanbul ΣΑΣ <|ENDOFTEXT|> <|endoftext|> a<|endoftext|>b",
         "x́y é É ﬁ\xa0nbsp em … – “quote”! 12a3 a1b'll", "日本語テスト\x1c\x85 a\x00b", "á ́b Á",
         "Schöne Grüße, übermäßig! ÇA ÑANDÚ", "word " * 30_000, "same same", "same same"]


@pytest.fixture(scope="module")
def direct():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocab.default_path())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [3, 3, 9, 1000], list(range(5000)), [1 << 40, (1 << 40) + 7]])
def test_elias_fano_selects_every_value(values):
    code, size = EliasFano.from_bytes(memoryview(EliasFano.build(values).to_bytes()))
    assert code.values().tolist() == values
    if values:
        assert code.select([len(values) - 1]).tolist() == values[-1:]


def test_elias_fano_is_small():
    rng = np.random.default_rng(1)
    values = np.cumsum(rng.integers(1, 2000, 50_000))
    code = EliasFano.build(values)
    assert (code.values() == values).all()
    assert len(code.to_bytes()) * 8 / len(values) < 2.5 + np.log2(values[-1] / len(values))


def test_cached_ids_equal_the_library(direct):
    import pyarrow as pa

    for limit in (3, 10_000):  # a table that is emptied again and again gives the same ids
        tok = vocab.WordTokenizer(vocab.default_path(), limit=limit)
        got = {}
        for lo, flat, lens in tok.encode(pa.array(TEXTS), 2):
            for i, part in enumerate(np.split(flat, np.cumsum(lens)[:-1])):
                got[lo + i] = part.tolist()
        for i, text in enumerate(TEXTS):
            assert got[i] == direct.encode(text or "", add_special_tokens=False).ids + [2]


def test_token_files_round_trip(spark, direct):
    ids = [7, -3, 12, 5, 5, 40, 41, 42, 43, 44, None]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, blob=1, start=9) for i, t in zip(ids, TEXTS)],
                                 "doc_id long, text string, blob int, start int")
    rows = sorted(token_offsets(docs).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, -3, 5, 5, 7, 12, 40, 41, 42, 43, 44]
    assert [r.start for r in rows] == np.concatenate([[0], np.cumsum([r.n_tokens for r in rows])[:-1]]).tolist()
    want = sorted((crc(direct.encode(t or "", add_special_tokens=False).ids + [2]), i) for i, t in zip(ids, TEXTS) if i is not None)
    assert sorted((r.ids_crc32, r.doc_id) for r in rows if r.doc_id is not None) == want


def test_small_shards_hold_the_documents(spark, direct):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    path = work_path(spark, "token_files")
    write_token_files(docs, path, vocab.default_path(), 2, shard_ids=20)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path).collect()
    assert len(files) > 2
    got = {}
    for f in files:
        shard = Shard(bytes(f.content))
        for i, doc in enumerate(shard.doc_ids()):
            got[doc] = shard.document(i).tolist()
    assert got == {i: direct.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(TEXTS)}
    assert read_token_files(spark, path).count() == len(TEXTS)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_offsets(none).count() == 0
    assert piece_counts(none).count() == 0


def greedy(pieces, word):
    n, at = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


def test_automaton_equals_greedy_longest_match():
    rng = random.Random(3)
    for _ in range(200):
        pieces = {bytes(rng.choices(b"abc", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 14))}
        counter = PieceCounter(sorted(pieces))
        for _ in range(40):
            word = bytes(rng.choices(b"abc", k=rng.randint(0, 14)))
            assert counter.count(word) == greedy(pieces, word), (pieces, word)


def test_piece_counts_of_documents(spark):
    pieces = set(load_pieces(default_path()))
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int")
    for r in piece_counts(docs).collect():
        words = (TEXTS[r.doc_id] or "").encode().split()
        want = [greedy(pieces, b" " + w) for w in words]
        assert (r.n_words, r.n_pieces, r.n_unknown) == (len(words), sum(abs(x) for x in want), sum(x < 0 for x in want))
