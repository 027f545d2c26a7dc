"""Base rules and log-likelihood ratio against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
import xxhash

from cairn.llm.quality_llr import quality_verdicts

WORD = re.compile("[^\x20\x09-\x0d]+")


def h(*words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    n = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            len(words) < 50 or 100 * len(inside) > 50 * len(words))


def grams(text, buckets):
    words = WORD.findall(text or "")
    return [h(w) % buckets for w in words] + [h(a, b) % buckets for a, b in zip(words, words[1:])]


ODD = [None, "", " \t\n", "one", "a b", "a b c", "a b c a b c", "x y z x y z x y z " * 20, "l1 a\nl1 a\n \n\nl1 a\nL1 a\r\n",
       "nbsp\xa0 x é#*$%&|<> \x1c\x85", "long " * 40_000, " ".join(map(str, range(20_000)))]


def corpus():
    rng = random.Random(2)
    good = [f"good{i}" for i in range(300)]
    bad = [f"{w}{s}" for w in good[:100] for s in ("$$$", "###", " |")]
    texts = list(ODD)
    for i in range(120):
        texts.append(" ".join(rng.choices(good if i % 3 else bad, k=rng.randint(40, 200))))
    labels = [(len(ODD) + i, int(bool(i % 3)), int(i % 30 == 1)) for i in range(0, 120, 2)]
    return texts, labels


def test_verdicts(spark):
    texts, labels = corpus()
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, trusted string")
    marks = spark.createDataFrame(labels + [(None, 1, 0), (len(ODD) + 4, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_verdicts(docs, marks, buckets=512).collect()}
    raw, target = Counter(), Counter()
    trusted = {d for d, q, t in labels if q and not t}
    for i, t in enumerate(texts):
        raw.update(grams(t, 512))
        if i in trusted:
            target.update(grams(t, 512))
    w = [math.log((target[b] + 1) / (sum(target.values()) + 512)) - math.log((raw[b] + 1) / (sum(raw.values()) + 512)) for b in range(512)]
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r, want = got[i], base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, repr(t)[:80]
        f = grams(t, 512)
        assert r.llr == pytest.approx(sum(w[b] for b in f) / len(f) if f else 0.0, abs=1e-9)
        if i >= len(ODD) and not want[-1]:
            assert r.kept == bool((i - len(ODD)) % 3)
        assert not (r.base_failed and r.kept)


def test_without_labels_or_documents(spark):
    texts, labels = corpus()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for r in quality_verdicts(docs, none, buckets=64).collect():
        assert r.kept == (not r.base_failed) and r.llr == 0
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert quality_verdicts(docs.limit(0), marks, buckets=64).count() == 0


def test_plan_is_native(spark):
    import contextlib
    import io

    texts, labels = corpus()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:20])], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        quality_verdicts(docs, marks, buckets=64).explain("formatted")
    nodes = re.findall(r"\(\d+\) (.+?)(?: \[|\n)", out.getvalue())
    assert nodes and all(re.match("Project|Scan|Filter", n) for n in nodes), nodes
