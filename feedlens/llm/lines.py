"""Line dedup: repeated windows of three consecutive lines, all in DataFrames.

Lines are the parts of a text between line feeds. Windows run over
consecutive lines that are not blank, overlap, and are compared by a
96-bit hash over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import fresh, materialize, without

WIDTH = 3
BLANK = r"^[\x20\x09-\x0D]*$"


def windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(no_id, id, text_hash, first, last, h1, h2): a row per window; first and last are line numbers from 0."""
    rows = docs.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
                       F.xxhash64("text").alias("text_hash"),
                       F.filter(F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("at"), line.alias("line"))),
                                lambda x: ~x["line"].rlike(BLANK)).alias("full"))
    at = F.explode(F.when(F.size("full") >= width, F.sequence(F.lit(1), F.size("full") - (width - 1)))).alias("k")
    rows = rows.select("no_id", "id", "text_hash", "full", at).withColumn("win", F.slice("full", F.col("k"), width))
    same = F.transform("win", lambda x: x["line"])
    return rows.select("no_id", "id", "text_hash", F.element_at("win", 1)["at"].alias("first"),
                       F.element_at("win", -1)["at"].alias("last"), F.xxhash64(same).alias("h1"), F.hash(same, F.lit(width)).alias("h2"))


def repeated_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(no_id, id, text_hash, covered): the lines of each document that later occurrences of a window cover.

    The first occurrence is the one with the smallest (doc_id, text hash,
    line), null ids last. Counting is pre-aggregated, and as the repeated
    windows are written before they are joined back, adaptive execution can
    split the rows of a passage that very many documents share."""
    found = windows(docs, width)
    place = F.struct("no_id", "id", "text_hash", "first")
    repeats = materialize(found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("origin"))
                          .where("n > 1").select("h1", "h2", "origin"), "lines-repeats")
    later = found.join(repeats, ["h1", "h2"]).where(place != F.col("origin"))
    return materialize(later.groupBy("no_id", "id", "text_hash")
                       .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("first", "last"))))).alias("covered")),
                       "lines-covered")


def dedup_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with text less the repeated lines, and added n_lines and n_removed (longs).

    A line goes if a later occurrence of some window covers it; blank lines
    between covered lines go with them. Every row stays; a text of which all
    lines go becomes empty. Texts with fewer than ``width`` full lines, empty
    ones and null (0 lines, stays null) are unchanged. Rows equal in doc_id
    and text are one document and share its result. n_chars, if there is
    such a column, follows the new text. Null ids come last; an empty table
    gives an empty result; input columns named like an added one are replaced."""
    docs = without(docs, "n_lines", "n_removed")
    no_id, key, text_hash, covered, lines, kept = fresh(docs, "no_id", "id", "text_hash", "covered", "lines", "kept")
    # The marks grow with the corpus, so they are merged at every size rather than broadcast while they are few.
    marks = repeated_lines(docs, width).select(F.col("no_id").alias(no_id), F.col("id").alias(key),
                                               F.col("text_hash").alias(text_hash), F.col("covered").alias(covered))
    rows = (docs.withColumn(no_id, F.col("doc_id").isNull()).withColumn(key, F.coalesce("doc_id", F.lit(0)).cast("long"))
            .withColumn(text_hash, F.xxhash64("text")).join(marks.hint("merge"), [no_id, key, text_hash], "left")
            .withColumn(lines, F.split("text", "\n", -1))
            .withColumn(kept, F.filter(lines, lambda line, i: ~F.coalesce(F.array_contains(covered, i), F.lit(False)))))
    text = F.when(F.col(covered).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    rows = (rows.withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
            .withColumn("n_removed", F.coalesce(F.size(covered), F.lit(0)).cast("long")).withColumn("text", text))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(covered).isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], "n_lines", "n_removed")


ORACLE = """
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM l WHERE NOT regexp_full_match(line, '[ \\t\\n\\x0B\\f\\r]*')),
w AS (
  SELECT a.doc_id, a.pos AS p0, c.pos AS p1, a.line || chr(10) || b.line || chr(10) || c.line AS win
  FROM f a JOIN f b ON b.doc_id = a.doc_id AND b.k = a.k + 1 JOIN f c ON c.doc_id = a.doc_id AND c.k = a.k + 2),
r AS (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, p0) AS nth FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(p0, p1 + 1)) AS pos FROM r WHERE nth > 1),
k AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
  FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, k.text AS text
FROM documents d LEFT JOIN k USING (doc_id)
"""
