"""Line dedup against a direct computation."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from cairn.llm.line_dedup import dedup_lines, line_digest

WHITE = " \t\n\x0b\f\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows, min_chars=10, min_docs=2):
    """rows: (doc_id, text); result in the order of the rows."""
    who = [(i is None, i if i is not None else 0, t or "" if i is None else "") for i, t in rows]
    holders = {}
    for w, (_, text) in zip(who, rows):
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(w)
    out = []
    for w, (i, text) in zip(who, rows):
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or min(holders[key(x)]) == w]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in dedup_lines(df, **kw).collect()), key=repr)
    assert got == sorted(brute(rows, **kw), key=repr)


def test_random_texts(spark):
    rng = random.Random(5)
    pool = [f"  Line number {i} of the POOL \t" for i in range(30)] + ["short", "", " ", "ÄÖÜ äöü Straße", "äöü ÄÖÜ straße", "x" * 10, "y" * 9]
    rows = [(i, "\n".join(rng.choice(pool).swapcase() if rng.random() < 0.3 else rng.choice(pool) for _ in range(rng.randint(0, 12))))
            for i in rng.sample(range(-50, 400), 120)]
    check(spark, rows)
    check(spark, rows, min_chars=3, min_docs=4)


def test_odd_input(spark):
    stock = "this line is found in most of the texts"
    rows = [(1, None), (2, ""), (3, "\n"), (4, "\n\n" + stock + "\n"), (4, stock + "\nbut the row differs"),  # one id, two texts
            (5, stock), (5, stock), (None, stock + "\nrow without an id"), (None, "row without an id"), (None, "row without an id"),
            (6, "\r\n".join(f"\f{stock}\v" for _ in range(3))), (7, "a\x00b" + stock.upper()), (8, " " + stock)]
    rows += [(100 + i, f"{stock}\nown line number {i} stays here") for i in range(300)]
    rows += [(1000, "\n".join([stock, "a long text has many lines", "and some of them repeat"] * 30_000))]
    check(spark, rows)


def test_clashing_columns_and_other_ids(spark):
    rows = [("b", "shared line of text\nown", 1, True, "x", "y", 2.0), ("a", "shared line of text", 2, False, "x", "y", 3.0)]
    df = spark.createDataFrame(rows, "doc_id string, text string, n_lines int, Kept_Text boolean, _id string, dropped string, `a b.c` double")
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "n_lines_in", "Kept_Text_in", "_id", "dropped", "a b.c", "n_lines", "n_dropped", "kept_text"]
    assert {tuple(r) for r in out.collect()} == {
        ("b", rows[0][1], 1, True, "x", "y", 2.0, 2, 1, "own"), ("a", rows[1][1], 2, False, "x", "y", 3.0, 1, 0, "shared line of text")}


def test_empty_table_and_digest(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_digest(empty).collect() == []
    rows = [(1, "one line that repeats"), (2, "one line that repeats\nelse")]
    got = {r.doc_id: r.kept_sha256 for r in line_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: hashlib.sha256(rows[0][1].encode()).hexdigest(), 2: hashlib.sha256(b"else").hexdigest()}


def test_no_python_on_the_path(spark):
    df = spark.range(4).select(F.col("id").alias("doc_id"), F.lit("some line of a text").alias("text"))
    assert "Python" not in dedup_lines(df)._jdf.queryExecution().toString()
