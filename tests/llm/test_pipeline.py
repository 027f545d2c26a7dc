"""The pipeline against the brute-force versions of its stages."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as cp
from test_compact import brute as brute_repeats
from test_quality import base
from test_simhash import fp, pairs, roots, signed
from test_winnow import brute as brute_hits


def fixture():
    rng = random.Random(11)
    good = [f"good{i}" for i in range(900)]
    bad = [f"{w}$$$" for w in good[:200]]
    say = lambda pool, n: rng.choices(pool, k=n)
    items = [(i, " ".join(say(good, 14))) for i in range(6)]
    passage = say(good, 70)
    docs, labels = [], []
    for i in range(60):
        docs.append(say(good, rng.randint(60, 200)))
        if i % 2:
            labels.append((i, 1, 0))
    for i in range(60, 90):
        docs.append(say(bad, rng.randint(60, 200)))
        if i % 2:
            labels.append((i, 0, 0))
    docs += [docs[3], docs[3], docs[5] + ["tail"], say(good, 70) + passage + say(good, 70), say(good, 70) + passage,
             say(good, 80) + items[2][1].split() + say(good, 80), say(good, 20), []]
    rows = [(i, " ".join(w), "en", f"s{i % 3}", len(" ".join(w))) for i, w in enumerate(docs)]
    rows += [(200, None, None, None, None), (7, rows[7][1], "en", "s1", rows[7][4])]
    return rows, labels, items


def test_stages_and_run(spark, tmp_path):
    rows, labels, items = fixture()
    sf = str(tmp_path)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    now, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in cp.STAGES:
        before = now
        now = stage(spark, before, sf)
        if name != "best_fit_packing":
            assert now.columns == docs.columns and now.dtypes == docs.dtypes
            now.write.parquet(f"{sf}/{name}")
            now = spark.read.parquet(f"{sf}/{name}")
            kept.append({r.doc_id: r for r in now.collect()})
            assert len(kept[-1]) == now.count() or name == "quality_rules"
    by_id = {r[0]: r for r in rows}
    # quality: the base rules and the bad vocabulary
    want = {i for i, r in by_id.items() if not base(r[1])[-1] and not 60 <= i < 90}
    assert set(kept[0]) == want
    # near-dedup: one of each group of fingerprints
    marks = {signed(fp(by_id[i][1])) for i in want}
    root = roots(marks, pairs(marks))
    first = {}
    for i in sorted(want):
        first.setdefault(root[signed(fp(by_id[i][1]))], i)
    assert set(kept[1]) == set(first.values())
    # substring dedup: the passage stays in the first document that has it
    hits = brute_repeats([(i, by_id[i][1]) for i in kept[1]])
    for i, h in hits.items():
        left = [w for w, gone in zip(by_id[i][1].split(), h) if not gone]
        assert (i in kept[2]) == bool(left)
        if left:
            assert kept[2][i].text.split() == left and kept[2][i].n_chars == len(kept[2][i].text)
    assert any(h.any() for h in hits.values())
    # decontamination
    found = {r[0] for r in brute_hits([(i, r.text) for i, r in kept[2].items()], items, 10) if r[-1]}
    assert found and set(kept[3]) == set(kept[2]) - found
    # packing keeps every document, and run() gives the same pieces
    pieces = now.collect()
    assert {r.doc_id for r in pieces} == set(kept[3])
    again = cp.run(spark, sf).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, again)) == sorted(map(key, pieces))


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_empty_tables(spark, tmp_path, stage):
    sf = str(tmp_path)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert cp.STAGES[stage][1](spark, docs, sf).count() == 0
