"""Exact top-k by inner product: a ball tree per shard, branch and bound, and shared kth scores.

A node covers its vectors by a ball; no vector in it scores more than the
query's product with the centre plus the query's length times the radius. Nodes are
visited in order of that bound and a query leaves a node out once the bound is below
its kth score so far.

Shards are cut from cells, the vectors nearest to one of a few seeded pivots, so a
shard's ball is small where the data cluster. Trees are built and written once. A first round in the nearest
cell gives every query a kth score; the second sends it only to the shards
of cells whose bound reaches that score."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import materialize
from feedlens.llm.vectors import distinct_vectors, finite, matrix, results, spread

SHARD, QUERY_BLOCK, LEAF = 8192, 2048, 128
#: Pivots are sent to every task: so many a vector length, of so many components in all, at most.
PIVOTS, PIVOT_VALUES = 1024, 1 << 21
NONE = np.iinfo(np.int64).min


class BallTree:
    """Integer vectors reordered so that every node is a slice; nodes as parallel lists."""

    def __init__(self, integers: np.ndarray, leaf: int = LEAF):
        vectors = integers.astype(np.float64)
        self.order = np.arange(len(vectors))
        self.slices, self.centres, self.radii, self.children = [], [], [], []
        todo = [(0, len(vectors), None)]
        while todo:
            a, b, parent = todo.pop()
            own, me = vectors[self.order[a:b]], len(self.slices)
            centre = own.mean(axis=0)
            far = np.sqrt(((own - centre) ** 2).sum(axis=1))
            self.slices.append((a, b))
            self.centres.append(centre)
            self.radii.append(float(far.max()))
            self.children.append([])
            if parent is not None:
                self.children[parent].append(me)
            if b - a > leaf and far.max() > 0:
                one = own[far.argmax()]
                other = own[((own - one) ** 2).sum(axis=1).argmax()]
                side = np.argsort((own - one) @ (other - one), kind="stable")
                self.order[a:b] = self.order[a:b][side]
                todo += [(a, (a + b) // 2, me), ((a + b) // 2, b, me)]
        self.vectors = integers[self.order]

    def packed(self) -> tuple:
        """The tree as arrays and lists, to be written."""
        return self.vectors, self.order, self.slices, np.array(self.centres), np.array(self.radii), self.children

    @classmethod
    def unpacked(cls, parts: tuple) -> BallTree:
        tree = cls.__new__(cls)
        tree.vectors, tree.order, tree.slices, tree.centres, tree.radii, tree.children = parts
        return tree


def exact_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products as int64; beyond its range they stop at its ends."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if most < 2.0**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    got = queries.astype(object) @ vectors.astype(object).T
    return np.clip(got, np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max).astype(np.int64)


def search(tree: BallTree, queries: np.ndarray, names: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores and positions (n x k, best first, NONE and -1 where there are fewer) of the vectors that can be among
    the k best: none below a query's ``floor`` is wanted. names orders ties; of
    vectors with one name the best counts."""
    n = len(queries)
    score, at = np.full((n, k), NONE), np.full((n, k), -1)
    kth, length = floor.copy(), np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    big = np.iinfo(np.int64).max

    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        top = queries[rows].astype(np.float64) @ tree.centres[node] + length[rows] * tree.radii[node]
        return top + np.abs(top) * 1e-9 + length[rows] * tree.radii[node] * 1e-9 + 1e-6  # rounding never hides a vector

    repeats = len(np.unique(names)) < len(names)
    every = np.arange(n)
    heap = [(0.0, 0, every, bound(0, every))] if len(tree.order) else []
    while heap:
        _, node, rows, top = heapq.heappop(heap)
        open_ = top >= kth[rows]
        rows = rows[open_]
        if not len(rows):
            continue
        if tree.children[node]:
            for child in tree.children[node]:
                tops = bound(child, rows)
                heapq.heappush(heap, (-float(tops.max()), child, rows, tops))
            continue
        a, b = tree.slices[node]
        got = exact_products(queries[rows], tree.vectors[a:b])
        better = (got >= kth[rows][:, None]).any(axis=1)
        rows, got = rows[better], got[better]
        if not len(rows):
            continue
        s = np.concatenate([score[rows], got], axis=1)
        p = np.concatenate([at[rows], np.broadcast_to(tree.order[a:b], got.shape)], axis=1)
        tie = np.where(p >= 0, names[p], big)
        first = np.lexsort((tie, -s.astype(np.float64) if np.abs(got).max(initial=0) < 2**53 else ~s), axis=1)
        if repeats:  # later places of a name go to the end, without a score
            named = np.take_along_axis(tie, first, 1)
            by = np.argsort(named, axis=1, kind="stable")
            same = np.take_along_axis(named, by, 1)
            later = np.zeros(s.shape, bool)
            np.put_along_axis(later, by, np.concatenate([np.zeros((len(s), 1), bool), same[:, 1:] == same[:, :-1]], axis=1), 1)
            place = np.take_along_axis(first, np.argsort(later, axis=1, kind="stable"), 1)
            gone = np.take_along_axis(later, np.argsort(later, axis=1, kind="stable"), 1)
            np.put_along_axis(s, place, np.where(gone, NONE, np.take_along_axis(s, place, 1)), 1)
            np.put_along_axis(p, place, np.where(gone, -1, np.take_along_axis(p, place, 1)), 1)
            first = place
        first = first[:, :k]
        score[rows], at[rows] = np.take_along_axis(s, first, 1), np.take_along_axis(p, first, 1)
        kth[rows] = np.maximum(kth[rows], score[rows, k - 1])
    return score, at


def _build(shard: pa.Table) -> pa.Table:
    """A shard's row: its tree and ids, as bytes."""
    dim = shard.column("dim")[0].as_py()
    ids = shard.column("ids").combine_chunks()
    tree = BallTree(matrix(shard.column("vec"), dim, np.int64)).packed()
    held = pickle.dumps((tree, ids.offsets.to_numpy() - ids.offsets[0].as_py(), ids.flatten().to_numpy(zero_copy_only=False)), protocol=5)
    keys = [shard.column(c).slice(0, 1).combine_chunks() for c in ("dim", "cell", "part")]
    return pa.table([*keys, pa.array([held], pa.binary())], ["dim", "cell", "part", "tree"])


def _search_shard(shard: pa.Table, asked: pa.Table, most: int) -> pa.Table:
    out = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
    if not shard.num_rows or not asked.num_rows:
        return out.empty_table()
    parts, offsets, values = pickle.loads(shard.column("tree")[0].as_py())
    ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
    floor, queries = asked.column("kth").to_numpy(), matrix(asked.column("vec"), asked.column("dim")[0].as_py(), np.int64)
    score, at = search(BallTree.unpacked(parts), queries, values[offsets[:-1]], most, floor)
    q, j = np.nonzero((at >= 0) & (score >= floor[:, None]))
    q, i, s = spread(q, at[q, j], score[q, j], ids, most)
    return pa.table([asked.column("h1").to_numpy()[q], pa.array(asked.column("h2").to_numpy()[q], pa.int32()), i, s], schema=out)


def _pivots(once: DataFrame, shard: int) -> dict[int, np.ndarray]:
    """For each length of more vectors than a shard holds, some of them, chosen by hash."""
    out = {}
    h, parts = F.xxhash64("h2", "h1"), 1 << 30
    for r in once.groupBy("dim").agg(F.count("*").alias("n")).where(F.col("n") > shard).collect():
        most = min(-(-r["n"] // shard), PIVOTS, max(2, PIVOT_VALUES // r["dim"]))
        passing = once.where((F.col("dim") == r["dim"]) & (F.pmod(h, F.lit(parts)) <= min(parts, (4 * most + 50) * parts // r["n"])))
        rows = passing.orderBy(h, "h1", "h2").limit(most).select("vec").collect()
        if rows:
            out[r["dim"]] = np.array([x["vec"] for x in rows], np.float64)
    return out


def _in_cells(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Each vector with the nearest pivot of its length (the origin where there are none) and the distance to it."""
    for b in batches:
        dims = b.column("dim").to_numpy()
        cell, far = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows)
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            v, p = matrix(b.column("vec").take(pa.array(rows)), dim, np.float64), pivots.get(dim, np.zeros((1, dim)))
            cell[rows] = ((p * p).sum(axis=1) - 2 * v @ p.T).argmin(axis=1)
            far[rows] = np.sqrt(((v - p[cell[rows]]) ** 2).sum(axis=1))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(far)], [*b.schema.names, "cell", "far"])


def _route(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray], cells: dict[int, list[tuple[int, float, int, int]]], k: int,
           first: bool) -> Iterator[pa.RecordBatch]:
    """Each query's shards: one of the nearest cell at ``first`` (of those that surely hold k vectors, if any do), then all others
    of cells whose bound reaches its kth score."""
    for b in batches:
        dims, kth, h1 = b.column("dim").to_numpy(), b.column("kth").to_numpy(), b.column("h1").to_numpy()
        shards: list[list[dict]] = [[] for _ in range(b.num_rows)]
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            own = cells[dim]
            centres = pivots.get(dim, np.zeros((1, dim)))[[c for c, *_ in own]]
            q = matrix(b.column("vec").take(pa.array(rows)), dim, np.float64)
            reach = np.sqrt((q * q).sum(axis=1))[:, None] * np.array([r for _, r, *_ in own])[None, :]
            bound = q @ centres.T + reach
            sizes = np.sqrt((q * q).sum(axis=1))[:, None] * np.sqrt((centres * centres).sum(axis=1))[None, :]
            bound += (np.abs(bound) + reach + sizes) * 1e-9 + 1e-6  # rounding never hides a vector
            full = np.array([n // parts > 2 * k for *_, parts, n in own])
            best = np.where(full | ~full.any(), 2 * q @ centres.T - (centres * centres).sum(axis=1), -np.inf).argmax(axis=1)
            for i, r in enumerate(rows.tolist()):
                c, _, parts, _ = own[best[i]]
                home = (c, int(h1[r]) % parts)
                if first:
                    shards[r] = [{"cell": home[0], "part": home[1]}]
                else:
                    shards[r] = [{"cell": own[k][0], "part": part} for k in np.flatnonzero(bound[i] >= kth[r]).tolist()
                                 for part in range(own[k][2]) if (own[k][0], part) != home]
        kind = pa.list_(pa.struct([("cell", pa.int32()), ("part", pa.int32())]))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shards, kind)], [*b.schema.names, "shards"])


def quantize(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double; beyond a long's range it stops at its ends."""
    return F.transform(embedding, lambda x: F.floor(
        F.greatest(F.least(x.cast("double") * scale, F.lit(9.2e18)), F.lit(-9.2e18))))


def top_products(rows: DataFrame, is_query, k: int = 5, shard: int = SHARD, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row of ``rows`` (vec_id, vec of longs) the k largest inner products.

    Exact; ties go to the smaller vec_id and the query's own id is left out. Rows
    with a null id and vectors that are null, empty or hold a null take no
    part; vectors of different length are never compared; repeated
    ids count once, with the best score. An empty table gives an empty result.

    Distinct vectors are dealt to cells and these to shards of about ``shard`` vectors; a shard's
    queries meet it in blocks of about ``query_block``, so a task holds one shard and one block.
    On vectors without clusters every cell's bound reaches every query's score and each query visits all shards."""
    valid = rows.where(F.col("vec_id").isNotNull() & F.coalesce(F.forall("vec", lambda x: x.isNotNull()) & (F.size("vec") > 0), F.lit(False)))
    valid = valid.select("vec_id", "vec")
    once = distinct_vectors(valid, k, is_query, "mips-vectors")
    pivots = _pivots(once, shard)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in once.schema)
    placed = materialize(once.mapInArrow(lambda bs: _in_cells(bs, pivots), f"{schema}, cell int, far double"), "mips-cells")
    sizes = placed.groupBy("dim", "cell").agg(F.max("far").alias("radius"), F.ceil(F.count("*") / shard).cast("int").alias("parts"), F.count("*").alias("n"))
    sizes = materialize(sizes, "mips-sizes")  # a row a cell, and a cell a pivot or length
    cells: dict[int, list[tuple[int, float, int, int]]] = {}
    for r in sizes.orderBy("dim", "cell").collect():
        cells.setdefault(r["dim"], []).append((r["cell"], r["radius"], r["parts"], r["n"]))
    keys = ["dim", "cell", "part"]
    dealt = placed.join(F.broadcast(sizes.select("dim", "cell", "parts")), ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("h1", "h2"), F.col("parts")).cast("int"))
    trees = materialize(dealt.select(*keys, "vec", "ids").groupBy(*keys).applyInArrow(_build, "dim int, cell int, part int, tree binary"), "mips-trees")
    asked = placed.where("asked").select("dim", "vec", "h1", "h2")

    def visit(queries: DataFrame, first: bool) -> DataFrame:
        routed = queries.mapInArrow(lambda bs: _route(bs, pivots, cells, k, first),
                                    "dim int, vec array<bigint>, h1 long, h2 int, kth long, shards array<struct<cell:int,part:int>>")
        pairs = materialize(routed.withColumn("s", F.explode("shards")).select("dim", "s.*", "vec", "h1", "h2", "kth"), "mips-pairs")
        blocks = pairs.groupBy(*keys).agg(F.ceil(F.count("*") / query_block).cast("int").alias("blocks"))
        left = trees.join(blocks, keys).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        right = pairs.join(blocks, keys).withColumn("block", F.pmod(F.xxhash64("h2", "h1"), F.col("blocks")).cast("int")).drop("blocks")
        right = right.toDF(*right.columns)  # columns of its own
        return left.groupBy(*keys, "block").cogroup(right.groupBy(*keys, "block")).applyInArrow(
            lambda a, b: _search_shard(a, b, k + 1), "h1 long, h2 int, vec_id long, score long")

    first = materialize(visit(asked.withColumn("kth", F.lit(int(NONE))), True), "mips-first")
    kth = (first.groupBy("h1", "h2").agg(F.count("*").alias("have"), F.min("score").alias("least"))
           .select("h1", "h2", F.when(F.col("have") > k, F.col("least")).alias("least")))
    rest = asked.join(kth, ["h1", "h2"], "left").select("dim", "vec", "h1", "h2", F.coalesce("least", F.lit(int(NONE))).alias("kth"))
    return results(first.unionByName(visit(rest, False)), valid, is_query, k)
