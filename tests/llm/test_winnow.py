"""Winnowing against a search for every window."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from cairn.llm import winnow
from cairn.llm.winnow import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i: i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i: i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i: i + n])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def data(seed):
    rng = random.Random(seed)
    pool = [rng.choice(["alpha", "Beta", "c", "dé", "7", "x9"]) + rng.choice(["", "s", "日", "Z"]) for _ in range(12)]
    say = lambda n: rng.choice([" ", ", ", "\n", "--"]).join(rng.choices(pool, k=n))
    items = [(i, say(rng.choice([1, 2, 3, 5, 8, 9, 10, 11, 14, 30]))) for i in range(12)] + [(50, None), (51, ""), (52, "?!"), (3, say(12)), (None, say(11))]
    docs = [(i, say(rng.choice([0, 1, 4, 9, 10, 30, 200]))) for i in range(25)]
    for i in range(20):
        item = items[rng.randrange(12)][1].split()
        cut = rng.randint(0, len(item))
        docs.append((100 + i, " ".join([say(rng.randint(0, 8)), *item[cut // 2:], say(6), *item[:cut]]).upper()))
    docs += [(200, None), (201, ""), (7, items[4][1]), (7, items[4][1]), (None, items[5][1]), (300, "same " * 30_000)]
    return docs, items


@pytest.mark.parametrize("seed,size,limit", [(1, 10, 500_000), (2, 10, 0), (3, 4, 500_000), (4, 13, 3)])
def test_against_brute_force(spark, seed, size, limit):
    docs, items = data(seed)
    if seed == 1:
        items = [x for x in items if len(words(x[1])) not in (1, 2)]
    d = spark.createDataFrame([(*x, "row", 1) for x in docs], "doc_id long, text string, row string, lo int")
    b = spark.createDataFrame([(*x, 5) for x in items], "item_id long, text string, code int")
    got = decontaminate(d, b, window=size, filter_limit=limit).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, size)


def test_empty_tables(spark):
    docs, items = data(1)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate(d.limit(0), b).count() == 0
    got = decontaminate(d, b.limit(0)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, [], 10)


def test_a_context_of_many_items_is_joined_once(spark, monkeypatch):
    rng = random.Random(3)
    template = " ".join(f"t{i}" for i in range(30))
    items = [(i, f"{template} " + " ".join(rng.choices(["a", "b", "c"], k=12))) for i in range(40)]
    docs = [(i, f"x{i} y{i} {template} z{i}") for i in range(20)]
    seen, extend = [], winnow._extend
    monkeypatch.setattr(winnow, "_extend", lambda hits: seen.append(hits.count()) or extend(hits))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, decontaminate(d, b).collect()), key=str) == brute(docs, items, 10)
    # seven kept grams a document and item (5600) before; now those near the template's end only
    assert seen[0] < len(items) * len(docs) * 6
