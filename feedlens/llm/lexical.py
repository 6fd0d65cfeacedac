"""Ranked lexical search of many queries at once, with common subexpressions evaluated once.

A score is a sum over a query's terms, so queries that share a set of terms
share that set's partial sum. Sets are mined among the queries: terms that
occur in the same queries form one set, then the pair of sets that most queries share
becomes a set of its own, again and again. This gives a directed graph from
terms over shared sets to queries. A document's accumulator of a set
is computed once, level by level, and the queries combine the accumulators."""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import materialize

#: Texts are split in pieces of so many bytes.
PIECE = 1 << 20
#: (query, term) pairs whose terms and graph are sent to the tasks at once; more queries go in several blocks.
BLOCK_PAIRS = 1 << 18
#: Cells of a batch's accumulators, and candidates a task holds before it cuts them to the best.
CELLS, HELD = 1 << 21, 1 << 18
#: Parts a query's candidates are ranked in before they meet.
PARTS = 64

#: 0-9, A-Z, a-z and everything beyond ASCII are term characters; A-Z become a-z.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 0x80 else 32 for c in range(256))


def term_counts(text: str | None) -> Counter:
    """Every term (UTF-8) of a whole text with its occurrences."""
    line, at, out = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE), 0, Counter()
    while at < len(line):
        end = line.find(b" ", at + PIECE)
        end = len(line) if end < 0 else end
        out.update(line[at:end].split())
        at = end
    return out


@dataclass
class SharingGraph:
    """Terms 0 .. terms - 1 and sets above them; ``levels`` hold (children, parents) edges from lower to higher levels, the last level the queries'.

    Node numbers of a level follow those of the one below; queries are numbered last."""

    terms: int
    queries: int
    nodes: int  # without the queries
    edges: list[tuple[np.ndarray, np.ndarray]]  # per level: children (any lower node) and parents (nodes of the level)
    starts: list[int]  # the first node of each level, then ``nodes``

    @classmethod
    def mine(cls, queries: list[list[int]], terms: int) -> SharingGraph:
        """The graph of ``queries``, lists of distinct terms."""
        asked: defaultdict[int, list[int]] = defaultdict(list)
        for q, own in enumerate(queries):
            for t in own:
                asked[t].append(q)
        together: defaultdict[tuple[int, ...], list[int]] = defaultdict(list)
        for t in sorted(asked):
            together[tuple(asked[t])].append(t)
        members: list[tuple[int, ...]] = []  # of each set: terms, or sets as terms + number
        has: list[set[int]] = [set() for _ in queries]
        for where, own in together.items():
            node = own[0]
            if len(own) > 1 and len(where) > 1:
                node = terms + len(members)
                members.append(tuple(own))
            for q in where:
                has[q].update([node] if len(where) > 1 else own)
        cls._pair(has, members, terms)
        return cls._layered(has, members, terms, len(queries))

    @staticmethod
    def _pair(has: list[set[int]], members: list[tuple[int, ...]], terms: int) -> None:
        """Makes the pair of nodes that most queries share a set, while three queries at least share one."""
        times = Counter(n for own in has for n in own)
        where: defaultdict[tuple[int, int], set[int]] = defaultdict(set)
        for q, own in enumerate(has):
            shared = sorted(n for n in own if times[n] > 2)
            for i, a in enumerate(shared):
                for b in shared[i + 1:]:
                    where[a, b].add(q)
        heap = [(-len(qs), pair) for pair, qs in where.items() if len(qs) > 2]
        heapq.heapify(heap)
        while heap:
            n, (a, b) = heapq.heappop(heap)
            qs = {q for q in where[a, b] if a in has[q] and b in has[q]}
            if len(qs) < 3:
                continue
            if len(qs) < -n:
                where[a, b] = qs
                heapq.heappush(heap, (-len(qs), (a, b)))
                continue
            node = terms + len(members)
            members.append((a, b))
            mates: defaultdict[int, set[int]] = defaultdict(set)
            for q in qs:
                has[q] -= {a, b}
                for other in has[q]:
                    if times[other] > 2:
                        mates[other].add(q)
                has[q].add(node)
            times[node] = len(qs)
            for other, own in mates.items():
                if len(own) > 2:
                    where[other, node] = own
                    heapq.heappush(heap, (-len(own), (other, node)))

    @classmethod
    def _layered(cls, has: list[set[int]], members: list[tuple[int, ...]], terms: int, queries: int) -> SharingGraph:
        depth = [0] * len(members)
        for k, own in enumerate(members):  # members come before the sets made of them
            depth[k] = 1 + max(depth[m - terms] if m >= terms else 0 for m in own)
        order = sorted(range(len(members)), key=lambda k: depth[k])
        number = {terms + k: terms + i for i, k in enumerate(order)}
        name = lambda m: number.get(m, m)
        edges, starts = [], [0]
        for level in range(1, max(depth, default=0) + 1):
            own = [k for k in order if depth[k] == level]
            starts.append(name(terms + own[0]))
            edges.append((np.array([name(m) for k in own for m in members[k]]), np.array([name(terms + k) for k in own for _ in members[k]])))
        nodes = terms + len(members)
        starts.append(nodes)
        pairs = [(name(m), nodes + q) for q, own in enumerate(has) for m in sorted(own)]
        edges.append((np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)))
        return cls(terms, queries, nodes, edges, starts)

    def cost(self) -> int:
        """Edges: additions a document with all terms takes."""
        return sum(len(e[0]) for e in self.edges)

    def evaluate(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, docs: int) -> np.ndarray:
        """Sums (docs x queries) of the postings (doc, term, value): each level's accumulators from those below."""
        parts = [(doc, term, value)]
        for level, (child, parent) in enumerate(self.edges):
            last = level == len(self.edges) - 1
            first, width = (self.nodes, self.queries) if last else (self.starts[level + 1], self.starts[level + 2] - self.starts[level + 1])
            order = np.argsort(child, kind="stable")
            child, parent = child[order], parent[order]
            sums = np.zeros(docs * width, np.int64)
            for d, n, v in parts:
                a = np.searchsorted(child, n)
                count = np.searchsorted(child, n, side="right") - a
                at = np.arange(count.sum()) + np.repeat(a - np.cumsum(count) + count, count)
                np.add.at(sums, np.repeat(d * width, count) + parent[at] - first, np.repeat(v, count))
            sums = sums.reshape(docs, width)
            if last:
                return sums
            d, n = np.nonzero(sums)
            parts.append((d, n + first, sums[d, n]))
        raise AssertionError("a graph has its queries' level")


def _postings(batches: Iterator[pa.RecordBatch], numbers: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """doc_id, number of terms, and the known terms with their occurrences, of every document with a term."""
    for b in batches:
        ids, sizes, terms, counts = [], [], [], []
        for key, text in zip(b.column(0), b.column(1)):
            found = term_counts(text.as_py())
            if found:
                known = sorted((numbers[t], n) for t, n in found.items() if t in numbers)
                ids.append(key.as_py())
                sizes.append(found.total())
                terms.append([t for t, _ in known])
                counts.append([n for _, n in known])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                          pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "counts"])


def _statistics(batches: Iterator[pa.RecordBatch], terms: int) -> Iterator[pa.RecordBatch]:
    """(term, documents with it) of a task; term -1: documents, -2: their terms."""
    df, docs, words = np.zeros(terms, np.int64), 0, 0
    for b in batches:
        docs, words = docs + b.num_rows, words + sum(b.column(0).to_pylist())
        df += np.bincount(b.column(1).flatten().to_numpy(zero_copy_only=False), minlength=terms)
    seen = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, [-1, -2]), pa.int64()), pa.array(np.append(df[seen], [docs, words]), pa.int64())], ["term", "n"])


class Best:
    """The k best (score, then smaller doc_id, null last) per query of what was added."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor = k, np.ones(queries, np.int64)  # the least score worth keeping
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        d, q = np.nonzero(scores >= self.floor)
        self.parts.append((q, scores[d, q], none[d], ids[d]))
        self.held += len(q)
        if self.held > HELD:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        q, s, none, ids = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((ids, none, -s, q))
        q, s, none, ids = q[order], s[order], none[order], ids[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        full = place == self.k - 1
        self.floor[q[full]] = s[full]
        keep = place < self.k
        self.parts = [(q[keep], s[keep], none[keep], ids[keep])]
        self.held = int(keep.sum())
        return self.parts[0]


def _rank(batches: Iterator[pa.RecordBatch], graph: SharingGraph, weight: np.ndarray, docs: int, words: int, k: int) -> Iterator[pa.RecordBatch]:
    """(query, doc_id, score): the k best of a task for each query."""
    best, step = Best(graph.queries, k), max(1, CELLS // max(graph.queries, graph.nodes - graph.terms, 1))
    for whole in batches:
        for at in range(0, whole.num_rows, step):
            b = whole.slice(at, step)
            size = b.column("n").to_numpy(zero_copy_only=False)
            held = np.diff(b.column("terms").offsets.to_numpy())
            doc = np.repeat(np.arange(b.num_rows), held)
            term = b.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            tf = b.column("counts").flatten().to_numpy(zero_copy_only=False)
            length = 100 - 50 + 50 * size * docs // words
            value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * length[doc]))
            ids = b.column("doc_id")
            best.add(graph.evaluate(doc, term, value, b.num_rows), ids.fill_null(0).to_numpy(zero_copy_only=False),
                     ids.is_null().to_numpy(zero_copy_only=False))
    if best.parts:
        q, s, none, ids = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids, pa.int64(), mask=none), pa.array(s, pa.int64())], ["query", "doc_id", "score"])


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [[t.decode("utf-8", "surrogatepass") for t in term_counts(x.as_py())] for x in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string()))], ["item_id", "terms"])


def term_weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    own = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents with a score above 0 of every item.

    docs: doc_id, text; items: item_id, text. Scores are integer BM25-like sums
    over an item's distinct terms, with statistics over all documents that hold a term;
    equal scores stand by doc_id, null ids last. Null and empty texts
    hold no terms and get and are no results; repeated documents count and rank each on its own; repeated items (one item_id
    and text) are answered once, an item_id with several texts is
    searched by the terms of all; a null item_id is an item. Other columns are ignored;
    empty tables give no rows.

    Documents are read once for their postings of the items' terms, which are
    written; statistics and scores read those. Items go in blocks of
    BLOCK_PAIRS terms, so what is sent to the tasks is bounded by that or one item's text."""
    asked = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(_query_terms, "item_id long, terms array<string>")
    asked = asked.select("item_id", F.explode("terms").alias("term")).distinct()
    pairs = materialize(asked, "lexical-items")
    blocks = max(1, -(-pairs.count() // BLOCK_PAIRS))
    none, out = F.col("item_id").isNull(), None
    for block in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(0)), none), F.lit(blocks)) == block)
        rows = mine.toArrow()
        if rows.num_rows:
            found = _search_block(docs, rows, k)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return pairs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


def _search_block(docs: DataFrame, pairs: pa.Table, k: int) -> DataFrame:
    named = sorted(set(pairs.column("term").to_pylist()))
    number = {t: i for i, t in enumerate(named)}
    own: defaultdict[int | None, list[int]] = defaultdict(list)
    for item, term in zip(pairs.column("item_id").to_pylist(), pairs.column("term").to_pylist()):
        own[item].append(number[term])
    items = sorted(own, key=lambda i: (i is None, i or 0))
    graph = SharingGraph.mine([sorted(own[i]) for i in items], len(named))
    coded = {t.encode("utf-8", "surrogatepass"): i for t, i in number.items()}
    postings = materialize(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lambda bs: _postings(bs, coded), "doc_id long, n long, terms array<int>, counts array<long>"), "lexical-postings")
    total = (postings.select("n", "terms").mapInArrow(lambda bs: _statistics(bs, len(named)), "term long, n long")
             .groupBy("term").agg(F.sum("n").alias("n")).toArrow())  # a row per term of the block
    df = dict(zip(total.column("term").to_pylist(), total.column("n").to_pylist()))
    n_docs, n_words = df.get(-1, 0), max(df.get(-2, 0), 1)
    weight = np.array([term_weight(df.get(i, 0), n_docs) for i in range(len(named))], np.int64)
    found = postings.where(F.size("terms") > 0).mapInArrow(lambda bs: _rank(bs, graph, weight, n_docs, n_words, k), "query int, doc_id long, score long")
    few = _ranked(found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))), ["query", "part"], k).drop("part", "rank")
    ids = F.array(*[F.lit(i).cast("long") for i in items])
    return _ranked(few, ["query"], k).select(F.get(ids, F.col("query")).alias("item_id"), "rank", "doc_id", "score")
