"""Packing: whole, without overlap, near the lower bound."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from cairn.llm import vocab
from cairn.llm.packing import packed_documents, place_table, plan_patterns


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 64, 4096])
    hist = {}
    for _ in range(rng.randint(0, 400)):
        x = rng.randint(1, cap)
        hist[x] = hist.get(x, 0) + rng.choice([1, 1, 2, 50])
    plan = plan_patterns(hist, cap)
    used = {}
    for pattern, copies in plan:
        assert sum(pattern) <= cap and copies > 0
        for x in pattern:
            used[x] = used.get(x, 0) + copies
    assert used == hist
    key, seq, off = place_table(plan)
    assert (np.diff(key) > 0).all() and len(key) == sum(len(p) for p, _ in plan)


def test_exact_complements_fill_sequences():
    assert plan_patterns({60: 5, 40: 5}, 100) == [([60, 40], 5)]
    assert plan_patterns({50: 4}, 100) == [([50, 50], 2)]
    assert plan_patterns({70: 2, 10: 6}, 100) == [([70, 10, 10, 10], 2)]
    assert plan_patterns({60: 1, 20: 1, 15: 1, 5: 1, 39: 1}, 100) == [([60, 20, 15, 5], 1), ([39], 1)]


def test_near_lower_bound():
    rng = np.random.default_rng(0)
    sizes = np.minimum(4096, rng.lognormal(6, 1.2, 20_000).astype(int) + 1)
    hist = dict(zip(*(x.tolist() for x in np.unique(sizes, return_counts=True))))
    n = sum(c for _, c in plan_patterns(hist))
    assert n <= 1.001 * np.ceil(sizes.sum() / 4096) + 1


def test_packed_documents(spark):
    from tokenizers import Tokenizer

    direct = Tokenizer.from_file(vocab.default_path())
    rng = random.Random(5)
    texts = [None, "", " \n", "same text", "same text"] + [" ".join(rng.choices(["alpha", "be", "gamma42", "Straße", "it's"], k=rng.choice([3, 40, 900, 6000]))) for _ in range(40)]
    rows = [Row(doc_id=i, text=t, length=1, part=2) for i, t in enumerate(texts)] + [Row(doc_id=None, text="x y", length=1, part=1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, part int").repartition(3)
    got = packed_documents(docs).collect()
    per_doc, per_seq, total = {}, {}, 0
    for r in got:
        per_doc.setdefault(r.doc_id, []).append(r)
        per_seq.setdefault(r.sequence_id, []).append(r)
        total += r.length
    assert set(per_doc) == set(range(len(texts))) | {None}
    for i, t in enumerate(texts):
        ids = direct.encode(t or "", add_special_tokens=False).ids + [1]
        pieces = sorted(per_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // 4096)))
        for r in pieces:
            own = ids[r.start: r.start + r.length]
            assert r.start == 4096 * r.piece and len(own) == r.length == min(4096, len(ids) - r.start)
            assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    for rows in per_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert len(per_seq) <= -(-total // 4096) + 1


def test_empty(spark):
    assert packed_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
