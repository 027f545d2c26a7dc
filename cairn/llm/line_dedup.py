"""Exact line dedup in DataFrame functions only.

Lines are exploded with their position and normalised (white space stripped at both ends,
A-Z lower-cased).  A key of ``min_chars`` code points or more is hashed to 128 bits, the
distinct documents of a hash are counted, and the lines of a hash met in ``min_docs`` or
more are dropped everywhere but in the smallest document that holds it.  A text is put
together again from its runs between dropped positions, in one linear step.

Only hashes and positions are shuffled for the verdict.  Counting is by (hash, document)
first and by hash after that, so a line in a third of the documents is summed in many
tasks.  Its lines do not meet the verdict in one task either: the hashes of more than a
thousandth of all (hash, document) pairs are a thousand at most and are sent to every
task; the others are joined in a shuffle.  Texts move once, to meet their positions.

Defined cases: null and empty texts are one empty line; rows of equal doc_id are one
document, so they keep each other's lines, and each row is put together by itself; rows
without doc_id come after all others, each different text a document of its own; an empty
table gives no rows.  Ids may be of any ordered type.  Other columns come along; one named
like a result is renamed ``<name>_in``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

MIN_CHARS = 10
MIN_DOCS = 2
#: hashes of more than 1 / HOT_SHARE of all pairs are sent to every task: HOT_SHARE rows at most
HOT_SHARE = 1000
WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MADE = ("n_lines", "n_dropped", "kept_text")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def with_free_names(df: DataFrame, made: tuple[str, ...]) -> DataFrame:
    """``df`` with the columns named like one of ``made`` renamed to ``<name>_in``."""
    taken = {c.lower() for c in (*made, *df.columns)}
    names = []
    for c in df.columns:
        if c.lower() in made:
            while c.lower() in taken:
                c += "_in"
            taken.add(c.lower())
        names.append(c)
    return df.toDF(*names)


def _key_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(_no_id, _id, _text_hash, pos, h1, h2) of every line that is long enough."""
    lines = docs.select("_no_id", "_id", "_text_hash",
                        F.posexplode(F.split(F.translate("_text", UPPER, LOWER), "\n", -1)).alias("pos", "_line"))
    key = F.btrim(F.col("_line"), F.lit(WHITE))
    return (lines.select("_no_id", "_id", "_text_hash", "pos", key.alias("_key")).where(F.length("_key") >= min_chars)
            .select("_no_id", "_id", "_text_hash", "pos", F.xxhash64("_key").alias("h1"),
                    F.xxhash64(F.lit(1), F.col("_key")).alias("h2")))


def _document(docs: DataFrame) -> DataFrame:
    """Adds what identifies a document (_no_id, _id) and a row's text (_text, _text_hash)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = F.xxhash64(text)
    # rows without id are told apart by their text; one string column serves both cases
    return (docs.withColumn("_text", text).withColumn("_text_hash", whole)
            .withColumn("_no_id", F.when(F.col("doc_id").isNull(), whole)).withColumn("_id", F.col("doc_id")))


def repeated_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """h1, h2, n_docs and the first document (_first) of the hashes of ``min_docs`` documents or more."""
    who = F.struct(F.col("_no_id").isNotNull().alias("late"), F.col("_id").alias("id"), F.col("_no_id").alias("text"))
    pairs = lines.groupBy("h1", "h2", "_no_id", "_id").agg(F.lit(1).alias("one"))
    return (pairs.groupBy("h1", "h2").agg(F.count("one").alias("n_docs"), F.min(who).alias("_first"))
            .where(F.col("n_docs") >= min_docs))


def dropped_positions(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(_no_id, _id, _text_hash, dropped) of the texts that lose lines; dropped: sorted positions."""
    lines = _key_lines(docs, min_chars)
    repeated = materialize(repeated_keys(lines, min_docs))
    total = repeated.agg(F.sum("n_docs")).first()[0] or 0
    hot = repeated.where(F.col("n_docs") * HOT_SHARE > total).select("h1", "h2", F.col("_first").alias("_hot"))
    rest = repeated.where(F.col("n_docs") * HOT_SHARE <= total).select("h1", "h2", "_first")
    marked = lines.join(F.broadcast(hot), ["h1", "h2"], "left")
    here = ["_no_id", "_id", "_text_hash", "pos"]
    by_hot = marked.where(F.col("_hot").isNotNull()).select(*here, F.col("_hot").alias("_first"))
    by_rest = marked.where(F.col("_hot").isNull()).select("h1", "h2", *here).join(rest, ["h1", "h2"]).select(*here, "_first")
    stays = F.col("_first.id").eqNullSafe(F.col("_id")) & F.col("_first.text").eqNullSafe(F.col("_no_id"))
    return (by_hot.unionByName(by_rest).where(~stays).groupBy("_no_id", "_id", "_text_hash")
            .agg(F.sort_array(F.collect_set("pos")).alias("dropped")))


def without(lines: Column, dropped: Column) -> Column:
    """The lines at other than the (sorted) dropped positions: one slice for each run between two."""
    ends = F.concat(dropped, F.array(F.size(lines)))
    return F.flatten(F.transform(ends, lambda end, i: F.slice(
        lines, F.coalesce(F.get(dropped, i - 1) + 2, F.lit(1)),
        end - F.coalesce(F.get(dropped, i - 1) + 1, F.lit(0)))))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (with doc_id, text) with n_lines (before dropping), n_dropped and kept_text."""
    docs = with_free_names(docs, MADE)
    # all columns travel in one struct, so that no working name can meet one of theirs
    own = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_own")
    keyed = _document(docs.select("doc_id", "text"))
    gone = materialize(dropped_positions(keyed, min_chars, min_docs)).select(
        F.col("_no_id").alias("_n"), F.col("_id").alias("_i"), F.col("_text_hash").alias("_h"), "dropped")
    rows = _document(docs.select(own, "doc_id", "text"))
    same = (F.col("_id").eqNullSafe(F.col("_i")) & F.col("_no_id").eqNullSafe(F.col("_n"))
            & (F.col("_text_hash") == F.col("_h")))
    # a list in an array of one, so that a text is split once for all that is made of it
    held = F.transform(F.array(lines_of(F.col("text"))), lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), F.col("_text")).otherwise(F.array_join(without(x, F.col("dropped")), "\n")).alias("kept")))
    return (rows.join(gone, same, "left").withColumn("_held", held[0])
            .select("_own.*", F.col("_held.n_lines").alias("n_lines"),
                    F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.col("_held.kept").alias("kept_text")))


def line_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept lines of every document."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line, len(parts) AS n_lines
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT d.doc_id, d.pos, d.line, d.n_lines, coalesce(r.first_id <> d.doc_id, false) AS gone
  FROM keyed d LEFT JOIN repeated r ON d.k = r.k
)
SELECT doc_id, max(n_lines)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
