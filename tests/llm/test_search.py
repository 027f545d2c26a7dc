"""Ranked search against a direct computation."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm.lexical_search import best_places, part, ranked_search

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top):
    held = [(i, Counter(words(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in wanted.items():
        ranked = []
        for i, c in held:
            n = sum(c.values())
            m = 50 + 50 * n * n_docs // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in terms if c[t])
            if score > 0:
                ranked.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, top=10, kinds=("long", "long"), parts=3, **kw):
    d = spark.createDataFrame(docs, f"doc_id {kinds[0]}, text string").repartition(parts)
    i = spark.createDataFrame(items, f"item_id {kinds[1]}, text string").repartition(2)
    out = ranked_search(d, i, top=top, **kw)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == brute(docs, items, top)
    return got


def corpus(rng, n):
    vocabulary = [f"w{i}" for i in range(150)] + ["Ärger", "ärger", "naïve", "Q1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda k: " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(vocabulary, weights, k=k))
    docs = [(i, text(rng.randint(0, 60))) for i in rng.sample(range(-500, 5 * n), n)]
    return docs, [(i, text(rng.randint(1, 30))) for i in range(13)]


@pytest.mark.parametrize("kw", [{}, {"block_rows": 7}, {"bundle_bits": 1, "shares": ()}, {"filter_limit": 3, "block_rows": 50},
                                {"shares": (0.01, 0.02, 0.05, 0.1, 0.5)}])
def test_random_corpus(spark, kw):
    docs, items = corpus(random.Random(11), 200)
    assert len(check(spark, docs, items, **kw)) > 100


def test_ties_and_copies(spark):
    docs = [(i, "the same words in every copy") for i in range(400, 0, -1)] + [(1000 + i, f"other text number {i}") for i in range(500)]
    got = check(spark, docs, [(1, "copy of the words"), (2, "number"), (3, "absent"), (4, "text 17")], top=20, block_rows=64, parts=9)
    assert [r[2] for r in got if r[0] == 1] and {r[2] for r in got if r[0] == 1} == set(range(1, 21))


def test_odd_input(spark):
    docs = [(1, None), (2, ""), (3, "  \n"), (4, "alpha beta"), (4, "alpha gamma"), (5, "alpha beta"), (5, "alpha beta"),
            (None, "alpha beta"), (None, "gamma"), (6, "ALPHA alphaé é_beta\x7fbeta"), (7, "alpha " * 150_000 + "beta"), (8, "delta")] + [
        (50 + i, f"filler{i} epsilon") for i in range(40)]
    items = [(1, "alpha"), (1, "delta"), (2, "Alpha BETA alpha"), (None, "gamma"), (None, "beta"), (3, None), (4, ""), (5, "é"), (6, "nothing")]
    check(spark, docs, items, top=4)
    check(spark, docs, items, top=50, block_rows=3)


def test_empty_tables(spark):
    docs, items = corpus(random.Random(1), 20)
    none = lambda k: spark.createDataFrame([], f"{k} long, text string")
    d, i = (spark.createDataFrame(x, f"{k} long, text string") for k, x in (("doc_id", docs), ("item_id", items)))
    assert ranked_search(none("doc_id"), i).collect() == []
    assert ranked_search(d, none("item_id")).collect() == []
    assert ranked_search(none("doc_id"), none("item_id")).collect() == []


def test_string_ids_and_further_columns(spark):
    docs, items = corpus(random.Random(2), 60)
    d = spark.createDataFrame([(f"d{i:06}", t) for i, t in docs if i >= 0], "doc_id string, text string")
    i = spark.createDataFrame([(f"i{i}", t) for i, t in items], "item_id string, text string")
    extra = {c: F.lit("x") for c in ("block", "place", "term", "score", "rank", "bundle", "item", "number", "_id")}
    got = sorted((tuple(r) for r in ranked_search(d.withColumns(extra), i.withColumns(extra), top=5).collect()), key=repr)
    plain = ranked_search(spark.createDataFrame([(i, t) for i, t in docs if i >= 0], "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"), top=5)
    want = sorted(((f"i{r.item_id}", r["rank"], f"d{r.doc_id:06}", r.score) for r in plain.collect()), key=repr)
    assert got == want


def test_best_places():
    score = np.array([0, 5, 7, 5, 7, 5, 0, 9])
    assert best_places(score, 4).tolist() == [1, 2, 4, 7]
    assert best_places(score, 99).tolist() == [1, 2, 3, 4, 5, 7]
    assert best_places(np.zeros(3, np.int64), 2).tolist() == []


def test_part_is_in_whole_numbers():
    assert part(np.array([1, 3]), np.array([10, 2000]), 5, 100).tolist() == [10**9 // (1000 + 20 * (50 + 50 * 10 * 5 // 100)),
                                                                            3 * 10**9 // (3000 + 20 * (50 + 50 * 2000 * 5 // 100))]
