"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

Each table turns a unit vector by rounds of random signs and a fast Hadamard
transform and takes the nearest signed axis as its bucket. A query looks
into the buckets of the axes nearest to it; whatever it finds is ranked by
the exact cosine. Queries that find too few rows are compared with all."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import materialize
from feedlens.llm.vectors import distinct_vectors, finite, matrix, results, spread

TABLES, HASHES, PROBES, SEED = 4, 1, 28, 42
#: A bucket's vectors and its queries meet in blocks of at most about so many.
BLOCK, QUERY_BLOCK = 8192, 2048


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision, whatever their magnitude."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def rotate(unit_rows: np.ndarray, table: int, part: int, seed: int) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform, padded to a power of two."""
    n, d = unit_rows.shape
    width = 1 << max(0, (d - 1).bit_length())
    x = np.zeros((n, width))
    x[:, :d] = unit_rows
    rng = np.random.default_rng([seed, table, part, width])
    for _ in range(3):
        x = x * rng.choice([-1.0, 1.0], width)
        h = 1
        while h < width:
            y = x.reshape(n, -1, 2, h)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, width)
            h *= 2
        x /= math.sqrt(width)
    return x


def axes(unit_rows: np.ndarray, table: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """n x probes bucket numbers, nearest first: axis a as a, its opposite as width + a, ``hashes`` of them as digits."""
    total, bucket = np.zeros((len(unit_rows), 1)), np.zeros((len(unit_rows), 1), np.int64)
    for part in range(hashes):
        x = rotate(unit_rows, table, part, seed)
        both = np.concatenate([x, -x], axis=1)
        near = np.argsort(-both, axis=1, kind="stable")[:, :probes]
        gain = np.take_along_axis(both, near, 1)
        total = (total[:, :, None] + gain[:, None, :]).reshape(len(x), -1)
        bucket = (bucket[:, :, None] * both.shape[1] + near[:, None, :]).reshape(len(x), -1)
        best = np.argsort(-total, axis=1, kind="stable")[:, :probes]
        total, bucket = np.take_along_axis(total, best, 1), np.take_along_axis(bucket, best, 1)
    return bucket


def _buckets(batches: Iterator[pa.RecordBatch], tables: int, hashes: int, probes: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Each row with slots: its buckets in every table, table number and bucket in turn."""
    for b in batches:
        dims, vec = b.column("dim").to_numpy(), b.column("vec")
        slots = [None] * b.num_rows
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            u = unit(matrix(vec.take(pa.array(rows)), dim, np.float64))
            got = [axes(u, t, hashes, probes, seed) for t in range(tables)]
            for i, r in enumerate(rows.tolist()):
                slots[r] = [(t, int(x)) for t in range(tables) for x in got[t][i]]
        kind = pa.list_(pa.struct([("table", pa.int32()), ("bucket", pa.int64())]))
        named = [[{"table": t, "bucket": x} for t, x in row] for row in slots]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(named, kind)], [*b.schema.names, "slots"])


def _in_tables(rows: DataFrame, tables: int, hashes: int, probes: int, seed: int) -> DataFrame:
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    wide = rows.mapInArrow(lambda bs: _buckets(bs, tables, hashes, probes, seed),
                           f"{schema}, slots array<struct<table:int,bucket:bigint>>")
    return wide.withColumn("slot", F.explode("slots")).select(*rows.columns, "slot.table", "slot.bucket")


def _rerank(found: pa.Table, asked: pa.Table, most: int) -> pa.Table:
    out = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not found.num_rows or not asked.num_rows:
        return out.empty_table()
    dim = found.column("dim")[0].as_py()
    u, v = unit(matrix(asked.column("vec"), dim, np.float64)), unit(matrix(found.column("vec"), dim, np.float64))
    ids = found.column("ids").combine_chunks()
    smallest = ids.values.to_numpy(zero_copy_only=False)[ids.offsets.to_numpy()[:-1]]
    q, at, score = [], [], []
    repeats = len(np.unique(smallest)) < len(smallest)
    for i in range(len(u)):
        s = v @ u[i]
        near = np.arange(len(s)) if len(s) <= most or repeats else np.flatnonzero(s >= np.partition(s, -most)[-most] - 1e-12)
        exact = (v[near] * u[i]).sum(axis=1)  # summed in one order, wherever the pair meets
        near = near[np.lexsort((smallest[near], -exact))]
        if repeats:  # an id's best vector counts
            near = near[np.sort(np.unique(smallest[near], return_index=True)[1])]
        near = near[:most]
        q.append(np.full(len(near), i)), at.append(near), score.append((v[near] * u[i]).sum(axis=1))
    q, i, s = spread(np.concatenate(q), np.concatenate(at), np.concatenate(score), ids, most)
    h1, h2 = asked.column("h1").to_numpy()[q], asked.column("h2").to_numpy()[q]
    return pa.table([pa.array(h1), pa.array(h2, pa.int32()), pa.array(i), pa.array(s)], schema=out)


def _exhaustive(found: DataFrame, once: DataFrame, k: int) -> DataFrame:
    """Every vector's exact score for the queries of ``once`` that found fewer than k ids beside their own, if there are more.

    Such queries are dealt to blocks, all vectors to others, and each two blocks meet once."""
    have = found.groupBy("h1", "h2").agg(F.countDistinct("vec_id").alias("have"))
    short = once.where("asked").join(have, ["h1", "h2"], "left").where(F.coalesce("have", F.lit(0)) <= k)
    ids = once.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("all"))  # ids: at most k + 1 a vector
    short = short.join(ids, "dim").where(F.coalesce("have", F.lit(0)) < F.col("all")).select("dim", "vec", "h1", "h2")
    short = materialize(short, "ann-short")
    counts = once.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).join(
        short.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks")), "dim")
    counts = materialize(counts, "ann-short-sizes")
    deal = lambda n: F.pmod(F.xxhash64("h1", "h2"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["dim", "block", "query_block"]
    left = (once.join(counts, "dim").withColumn("block", deal("blocks")).withColumn("query_block", each("query_blocks"))
            .select(*keys, "vec", "ids"))
    right = (short.join(counts, "dim").withColumn("query_block", deal("query_blocks")).withColumn("block", each("blocks"))
             .select(*keys, "vec", "h1", "h2"))
    right = right.toDF(*right.columns)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda a, b: _rerank(a, b, k + 1), "h1 long, h2 int, vec_id long, score double")


def nearest(rows: DataFrame, is_query, k: int = 5, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES,
            seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row of ``rows`` (vec_id, vec) the k nearest rows found, by cosine.

    Ties go to the smaller vec_id and the query's own id is left out. Rows with a null
    id, and vectors that are null, empty, zero or hold a null or non-finite
    component take no part; vectors of different length are never compared.
    A query that found fewer than k is compared with all rows, so it gets k or all there are.
    A repeated id counts once, with its best score. An empty table gives an
    empty result. ``is_query`` is a condition on vec_id.

    Every vector is indexed in every table. More ``hashes`` per table make
    buckets smaller (their number is (2 width) ** hashes), more probes
    and tables find more. A large bucket is dealt out in blocks of vectors
    and of queries; no bucket is cut short."""
    valid = rows.where(F.col("vec_id").isNotNull() & finite(F.col("vec")) & F.exists("vec", lambda x: x != 0))
    valid = valid.select("vec_id", "vec")
    once = distinct_vectors(valid, k, is_query, "ann-vectors")
    stored = _in_tables(once.drop("asked"), tables, hashes, 1, seed)
    asked = _in_tables(once.where("asked").drop("asked", "ids"), tables, hashes, probes, seed)
    place = ["table", "dim", "bucket"]
    sizes = (stored.groupBy(*place).agg(F.count("*").alias("n"))
             .join(asked.groupBy(*place).agg(F.count("*").alias("m")), place))
    sizes = materialize(sizes.select(*place, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
                                     F.ceil(F.col("m") / QUERY_BLOCK).cast("int").alias("query_blocks")), "ann-sizes")
    deal = lambda n: F.pmod(F.xxhash64("h1", "h2"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (stored.join(sizes, place).withColumn("block", deal("blocks")).withColumn("query_block", each("query_blocks"))
            .select(*place, "block", "query_block", "vec", "ids"))
    right = (asked.join(sizes, place).withColumn("query_block", deal("query_blocks")).withColumn("block", each("blocks"))
             .select(*place, "block", "query_block", "vec", "h1", "h2"))
    keys = [*place, "block", "query_block"]
    right = right.toDF(*right.columns)  # columns of its own, as both sides come from one table
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda a, b: _rerank(a, b, k + 1), "h1 long, h2 int, vec_id long, score double")
    found = materialize(found, "ann-found")
    return results(found.unionByName(_exhaustive(found, once, k)), valid, is_query, k)
