"""SimHash fingerprints and components against a direct computation."""

from __future__ import annotations

import random
import re

import pytest
import xxhash

from cairn.llm.components import components
from cairn.llm.simhash_blocks import links, simhash_components


def fp(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    grams = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def pairs(fps):
    return [(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2]


@pytest.mark.parametrize("limit", [2, 64, 10_000])
def test_links_connect_what_brute_force_connects(spark, limit):
    rng = random.Random(limit)
    fps = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    for base in list(fps)[:6]:
        for _ in range(40):
            x = base
            for _ in range(rng.randint(1, 6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = {signed(x) for x in fps}
    got = {(r.a, r.b) for r in links(spark.createDataFrame([(x,) for x in fps], "fp long"), bucket_limit=limit).collect()}
    want = pairs(fps)
    assert got <= set(want)
    assert roots(fps, got) == roots(fps, want)
    if limit > len(fps):
        assert got == set(want)


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 30)] + [(70, 69), (70, 70)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    assert got == roots(nodes, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    texts = [None, "", " \t", "One", "one", "ONE two", "É two", "é two", "a b c", " A\x0bb\x0c c\n", "x" * 50_000, "long " * 5000]
    for _ in range(30):
        copy = list(base)
        copy[rng.randrange(400)] = "changed"
        texts.append(" ".join(copy))
    rows = [(100 - i, t, "x") for i, t in enumerate(texts)] + [(5, "a b c", "y"), (5, "a b c", "y"), (None, "a b c", "z")]
    got = simhash_components(spark.createDataFrame(rows, "doc_id long, text string, fp string"), bucket_limit=4).collect()
    marks = {signed(fp(t)) for _, t, _ in rows}
    root = roots(marks, pairs(marks))
    first = {}
    for d, t, _ in rows:
        if d is not None:
            r = root[signed(fp(t))]
            first[r] = min(d, first.get(r, d))
    want = sorted(((d, f"{fp(t):016x}", first[root[signed(fp(t))]]) for d, t, _ in rows), key=str)
    assert sorted(map(tuple, got), key=str) == want


def test_empty(spark):
    assert simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
