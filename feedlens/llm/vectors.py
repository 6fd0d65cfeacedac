"""Shared by the vector searches: valid vectors, one row per distinct vector, and results per query row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import materialize


def finite(vec: Column) -> Column:
    """Not null, not empty, no null or non-finite component."""
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & (F.size(vec) > 0), F.lit(False))


def distinct_vectors(rows: DataFrame, k: int, is_query: Column, name: str) -> DataFrame:
    """(h1, h2, dim, vec, ids, asked) written to the shared folder: one row per distinct vector of ``rows`` (vec_id, vec),
    and one more for each of its ids that other vectors of that length have too.

    ids are its k + 1 smallest distinct ids, which is all that k results
    beside a query's own row can need, so a vector that a third of the rows
    share is one candidate. An id on several vectors stands alone in its rows, so
    rows with equal first ids are one id's. asked: some row of it is a query (on one row of a vector)."""
    keyed = rows.select("vec_id", "vec", F.xxhash64("vec").alias("h1"), F.hash("vec", F.size("vec")).alias("h2"), is_query.alias("q"))
    nth = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    few = (keyed.select("h1", "h2", "vec_id", F.size("vec").alias("size")).distinct().withColumn("nth", nth)
           .where(F.col("nth") <= k + 1).drop("nth"))
    again = few.groupBy("size", "vec_id").agg(F.count("*").alias("times")).where("times > 1")
    of = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("vec_id"))))
    ids = (few.join(again, ["size", "vec_id"], "left").groupBy("h1", "h2")
           .agg(of(F.col("times").isNull()).alias("own"), of(F.col("times").isNotNull()).alias("shared"))
           .select("h1", "h2", F.posexplode(F.filter(F.concat(F.array("own"), F.transform("shared", lambda x: F.array(x))),
                                                     lambda x: F.size(x) > 0)).alias("part", "ids")))
    asked = keyed.groupBy("h1", "h2").agg(F.max("q").alias("asked"))
    once = keyed.dropDuplicates(["h1", "h2"]).select("h1", "h2", F.size("vec").alias("dim"), "vec")
    whole = once.join(ids, ["h1", "h2"]).join(asked, ["h1", "h2"])
    return materialize(whole.withColumn("asked", F.col("asked") & (F.col("part") == 0)).drop("part"), name)


def results(found: DataFrame, rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score for every query row, from ``found`` (h1, h2 of a query's vector, vec_id, score).

    found holds a vector's k + 1 best rows at least, its own included; a query
    leaves out the rows of its own id. Repeated ids count once, with the best score."""
    best = F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id"))
    top = materialize(found.groupBy("h1", "h2", "vec_id").agg(F.max("score").alias("score"))
                      .withColumn("nth", best).where(F.col("nth") <= k + 1).drop("nth"), "search-top")
    asking = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.xxhash64("vec").alias("h1"),
                                         F.hash("vec", F.size("vec")).alias("h2")).distinct()
    each = (asking.join(top, ["h1", "h2"]).where("query_id <> vec_id").groupBy("query_id", "vec_id")
            .agg(F.max("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def matrix(column: pa.ChunkedArray, dim: int, dtype) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(dtype)


def spread(query: np.ndarray, at: np.ndarray, score: np.ndarray, ids: pa.Array, most: int) -> tuple[np.ndarray, ...]:
    """(query, id, score) for pairs (query, candidate class): the ``most`` best rows per query, ties to smaller ids."""
    of = ids.take(pa.array(at, pa.int64()))
    count = np.diff(of.offsets.to_numpy()) if len(of) else np.zeros(0, np.int64)
    q, s, i = np.repeat(query, count), np.repeat(score, count), of.flatten().to_numpy(zero_copy_only=False)
    order = np.lexsort((i, -s, q))
    q, s, i = q[order], s[order], i[order]
    first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
    place = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    keep = place < most
    return q[keep], i[keep], s[keep]
