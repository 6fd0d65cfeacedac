"""Toxicity from the nearest labelled examples by exact TF-IDF cosine, found with a block-max inverted index.

Terms are the words that the examples hold, all of them. Examples lie in
blocks of alike ones; a frequent term keeps its largest weight per block, so a
block's score is bounded by that and the rare terms' exact part without reading the rest, and blocks that
cannot reach the kth score are skipped.

A neighbour votes by its distance and by its grounds: the best odds for its label that a
term it shares with the text has among the examples. A text near a toxic example for
its subject or language alone so gets a vote of little weight. Votes are calibrated by leaving each example out in turn."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import materialize, without

#: The classifier is fitted on at most so many labelled documents, half of each label, of at most so many
#: characters each and in all; a label's share of the characters goes by the hash order of its texts.
EXAMPLES, EXAMPLE_CHARS, ALL_CHARS = 4096, 1 << 18, 1 << 26
NEIGHBOURS, BLOCK = 32, 64
#: Texts searched at once, and those of them whose postings are gathered at once.
BATCH, GATHER = 256, 32
#: A term in more than one of so many examples is frequent.
FREQUENT = 16
#: Texts are split in pieces of so many characters.
PIECE = 1 << 20
WORDS, NO_WORD = re.compile(r"[^\W\d_]+"), re.compile(r"[\W\d_]")


@dataclass
class BlockMaxIndex:
    """Unit vectors of the examples: postings of the rare terms, and the frequent ones' weights by block with each block's largest."""

    start: np.ndarray  # terms + 1: where each term's postings begin; a frequent term has none
    example: np.ndarray
    weight: np.ndarray
    place: np.ndarray  # a frequent term's row in ``dense`` and ``most``, -1 for a rare term
    dense: np.ndarray  # blocks x frequent terms x BLOCK
    most: np.ndarray  # frequent terms x blocks
    size: int

    @classmethod
    def build(cls, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int) -> BlockMaxIndex:
        t = np.concatenate([v[0] for v in vectors]) if vectors else np.zeros(0, np.int64)
        w = np.concatenate([v[1] for v in vectors]) if vectors else np.zeros(0)
        e = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])
        frequent = np.flatnonzero(np.bincount(t, minlength=terms) * FREQUENT > len(vectors))
        place = np.full(terms, -1)
        place[frequent] = np.arange(len(frequent))
        blocks, often = max(1, -(-len(vectors) // BLOCK)), place[t] >= 0
        dense = np.zeros((blocks, len(frequent), BLOCK))
        dense[e[often] // BLOCK, place[t[often]], e[often] % BLOCK] = w[often]
        t, w, e = t[~often], w[~often], e[~often]
        order = np.argsort(t, kind="stable")
        start = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=terms))])
        return cls(start, e[order].astype(np.int32), w[order], place, dense, dense.max(axis=2).T.copy(), len(vectors))

    def top(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, skip: list[int] | None = None) -> tuple[list[tuple[np.ndarray, np.ndarray]], float]:
        """For each query (terms, weights) the (examples, cosines) of the k best with a cosine above 0, best first, ties to the smaller number; and
        the share of all blocks that was scored. ``skip``: an example each that is no result.

        The blocks of the largest bounds are scored first, then those whose bound reaches the kth score so far; a
        block is scored for all queries that need it at once."""
        n, blocks = len(queries), len(self.dense)
        sizes = np.fromiter((len(q[0]) for q in queries), np.int64, n)
        ends, cells = np.cumsum(sizes), blocks * BLOCK
        terms = np.concatenate([q[0] for q in queries]) if n else np.zeros(0, np.int64)
        weights = np.concatenate([q[1] for q in queries]) if n else np.zeros(0)
        of = np.repeat(np.arange(n), sizes)
        score = np.zeros((n, cells))
        for a in range(0, n, GATHER):  # the rare terms' postings, of some queries at a time
            b = min(a + GATHER, n)
            own = slice(ends[a] - sizes[a], ends[b - 1])
            count = self.start[terms[own] + 1] - self.start[terms[own]]
            at = np.arange(count.sum()) + np.repeat(self.start[terms[own]] - np.cumsum(count) + count, count)
            place = np.repeat((of[own] - a) * cells, count) + self.example[at]
            score[a:b] = np.bincount(place, np.repeat(weights[own], count) * self.weight[at], (b - a) * cells).reshape(b - a, cells)
        score = score.reshape(n, blocks, BLOCK)
        often = self.place[terms] >= 0
        whole = np.zeros((n, self.most.shape[0]))
        whole[of[often], self.place[terms[often]]] = weights[often]
        if skip is not None:
            gone = np.array(skip)
            score[np.arange(n), gone // BLOCK, gone % BLOCK] = -1e9
        bound = whole @ self.most + score.max(axis=2)
        scored = np.zeros((n, blocks), bool)
        first = min(blocks, -(-2 * k // BLOCK) + 1)
        need = np.zeros((n, blocks), bool)
        np.put_along_axis(need, np.argpartition(-bound, first - 1, axis=1)[:, :first], True, axis=1)
        for _ in range(2):
            for c in np.flatnonzero(need.any(axis=0)).tolist():
                who = np.flatnonzero(need[:, c])
                score[who, c] += whole[who] @ self.dense[c]
            scored |= need
            seen = np.where(scored[:, :, None], score, -1.0).reshape(n, cells)
            kth = np.array([np.partition(row, max(cells - k, 0))[max(cells - k, 0)] for row in seen])
            need = ~scored & (bound * (1 + 1e-12) >= np.maximum(kth, 1e-300)[:, None])
        out = []
        for i in range(n):
            best = np.flatnonzero(seen[i] >= max(kth[i], 1e-300))
            best = best[np.lexsort((best, -seen[i, best]))][:k]
            out.append((best, seen[i, best]))
        return out, float(scored.mean()) if n else 0.0


def alike_order(rows: np.ndarray, size: int) -> np.ndarray:
    """Row numbers in an order whose runs of ``size`` hold alike rows: halved along the main direction, again and again."""
    def halve(own: np.ndarray) -> list[np.ndarray]:
        if len(own) <= size:
            return [own]
        x = rows[own] - rows[own].mean(axis=0)
        v = x[np.abs(x).sum(axis=1).argmax()]
        for _ in range(8):  # the power method
            v = x.T @ (x @ v)
            v /= max(math.sqrt(float(v @ v)), 1e-300)
        own = own[np.argsort(x @ v, kind="stable")]
        cut = -(-len(own) // size) // 2 * size  # whole blocks on either side
        return halve(own[:cut]) + halve(own[cut:])

    return np.concatenate(halve(np.arange(len(rows)))) if len(rows) else np.zeros(0, np.int64)


@dataclass
class Model:
    terms: dict[str, int] = field(default_factory=dict)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    index: BlockMaxIndex | None = None
    own: list = field(default_factory=list)  # the terms of each example
    held: np.ndarray | None = None  # examples of label 0 and 1 with each term, while the model is fitted
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))  # log odds of each term
    spoken: np.ndarray | None = None  # room for a text's log odds, -inf for terms it lacks; made where it is used
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ids: list = field(default_factory=list)
    names: list = field(default_factory=list)
    prior: float = 0.0
    votes: np.ndarray = field(default_factory=lambda: np.zeros(0))  # calibration: vote -> probability, both rising
    chance: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The terms and weights (1 + ln n) * idf of a text, as a unit vector."""
        w = (1 + np.log(counts)) * self.idf[terms]
        size = math.sqrt(float((w * w).sum())) if len(terms) else 0.0
        return terms, w / size if size else w

    def log_odds(self, terms: np.ndarray, without: int = -1) -> np.ndarray:
        """ln of label 1's odds by each term among the examples, over its odds among all; ``without``: an example left out, which has all ``terms``."""
        held, all_of = self.held[:, terms].astype(float), np.array([(self.labels == 0).sum(), (self.labels == 1).sum()], float)
        if without >= 0:
            held[int(self.labels[without])] -= 1
            all_of[int(self.labels[without])] -= 1
        share = (held + 0.5) / (all_of + 1)[:, None]
        return np.log(share[1] / share[0])

    def grounds(self, terms: np.ndarray, odds: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each neighbour of label 1 the shared term that speaks most for it and the log odds it speaks with; -1 and 0 for others."""
        best, most = np.full(len(near), -1), np.zeros(len(near))
        yes = np.flatnonzero(self.labels[near] == 1).tolist()
        if yes:
            if self.spoken is None:
                self.spoken = np.full(len(self.terms), -np.inf)
            self.spoken[terms] = odds
            for k in yes:
                own = self.own[near[k]]
                speaks = self.spoken[own]
                at = int(speaks.argmax())
                best[k], most[k] = own[at], max(float(speaks[at]), 0.0)
            self.spoken[terms] = -np.inf
        return best, most

    def vote(self, near: np.ndarray, cosine: np.ndarray, grounds: np.ndarray) -> float:
        """What speaks for label 1: the logarithm of its neighbours' weights, by inverse distance and the square of their grounds' odds."""
        yes = self.labels[near] == 1
        if not yes.any():
            return 0.0
        return float(np.log1p(np.sum(np.exp(2 * grounds[yes]) / (1.05 - np.minimum(cosine[yes], 1.0)))))

    def look(self, texts: list[tuple[np.ndarray, np.ndarray]], without: list[int] | None = None) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each text's terms and counts: the vote, and of its neighbours the examples, cosines, terms that speak and their log odds."""
        vectors = [self.vector(*c) for c in texts]
        out = []
        for i, (near, cosine) in enumerate(self.index.top(vectors, NEIGHBOURS, without)[0]):
            terms = vectors[i][0]
            term, grounds = self.grounds(terms, self.log_odds(terms, without[i]) if without else self.odds[terms], near)
            out.append((self.vote(near, cosine, grounds), near, cosine, term, grounds))
        return out

    def score(self, vote: float) -> float:
        return float(np.interp(vote, self.votes, self.chance)) if len(self.votes) else self.prior


def rising_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic regression by pooling adjacent violators: (x, fitted y) at the pools' ends."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # mean, weight, first x, last x
    for i in order.tolist():
        pools.append([float(y[i]), float(weight[i]), float(x[i]), float(x[i])])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            m, w, _, last = pools.pop()
            p = pools[-1]
            p[0], p[1], p[3] = (p[0] * p[1] + m * w) / (p[1] + w), p[1] + w, last
    at = np.array([v for p in pools for v in (p[2], p[3])])
    return at, np.clip(np.array([p[0] for p in pools for _ in range(2)]), 0, 1)


def _words(text: str | None) -> Iterator[list[str]]:
    """The words of a whole text, lower-cased, a bounded number at a time."""
    text, at = text or "", 0
    while at < len(text):
        end = NO_WORD.search(text, at + PIECE)
        end = end.start() if end else len(text)
        yield WORDS.findall(text[at:end].lower())
        at = end


def words_of(text: str | None) -> Counter:
    """The words of a whole text with their occurrences."""
    out: Counter = Counter()
    for words in _words(text):
        out.update(words)
    return out


def known_counts(text: str | None, terms: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a text, rising, and their occurrences."""
    found: Counter = Counter()
    for words in _words(text):
        found.update(map(terms.get, words))
    found.pop(None, None)
    t = np.fromiter(found.keys(), np.int64, len(found))
    n = np.fromiter(found.values(), np.int64, len(found))
    order = np.argsort(t)
    return t[order], n[order]


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array({w for text in b.column(0) for w in words_of(text.as_py())}, pa.string())], ["term"])


def _document_frequencies(batches: Iterator[pa.RecordBatch], terms: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """(term, documents with it) of a task's documents; term -1 counts the documents."""
    df, n = np.zeros(len(terms), np.int64), 0
    for b in batches:
        n += b.num_rows
        for text in b.column(0):
            found: set[int | None] = set()
            for words in _words(text.as_py()):
                found.update(map(terms.get, words))
            found.discard(None)
            df[np.fromiter(found, np.int64, len(found))] += 1
    seen = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1), pa.int64()), pa.array(np.append(df[seen], n), pa.int64())], ["term", "n"])


def _example_vectors(batches: Iterator[pa.RecordBatch], terms: dict[str, int]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        own = [known_counts(x.as_py(), terms) for x in b.column("text")]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("toxic"), pa.array([t.astype(np.int32).tobytes() for t, _ in own], pa.binary()),
             pa.array([n.tobytes() for _, n in own], pa.binary())],
            ["doc_id", "toxic", "terms", "counts"])


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, seed: int = 11) -> Model:
    """A model of (doc_id, text) with ``labels`` (doc_id, toxic 0 or 1; the larger if a document has several).

    The examples are chosen by a hash of the text, one per distinct text, so
    that their number is bounded and copies count once; ``EXAMPLE_CHARS`` and ``ALL_CHARS``
    bound their text, and so the model. Null ids and labels teach nothing.
    All terms of the examples are kept; document frequencies are counted over all rows of ``docs`` with a text."""
    marks = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text", F.lit(seed)).alias("h"), F.length("text").alias("chars"))
    once = materialize(known.join(marks, "doc_id").groupBy("h").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"),
                                                                    F.max("chars").alias("chars"), F.count("*").alias("rows")), "toxicity-known")
    total = {r["toxic"]: r["rows"] for r in once.groupBy("toxic").agg(F.sum("rows").alias("rows")).collect()}
    if not total:
        return Model()
    prior = total.get(1, 0) / sum(total.values())
    if len(total) < 2:
        return Model(prior=prior)
    sofar = F.sum("chars").over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, 0))  # over ``examples`` / 2 rows at most
    chosen = [once.where((F.col("toxic") == y) & (F.col("chars") <= EXAMPLE_CHARS)).orderBy("h").limit(examples // 2)
              .withColumn("sofar", sofar).where(F.col("sofar") <= ALL_CHARS // 2) for y in (0, 1)]
    picked = materialize(chosen[0].unionByName(chosen[1]).select("doc_id", "h", "toxic"), "toxicity-examples")  # at most ``examples`` rows, so it can be broadcast
    sample = docs.withColumn("h", F.xxhash64("text", F.lit(seed))).select("doc_id", "text", "h").join(F.broadcast(picked), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
    sample = materialize(sample.select("doc_id", "text", "toxic"), "toxicity-texts")
    words = sample.select("text").mapInArrow(_vocabulary, "term string").distinct().toArrow()
    names = sorted(words.column(0).to_pylist())
    terms = {t: i for i, t in enumerate(names)}
    df = (docs.where("text is not null").select("text").mapInArrow(lambda bs: _document_frequencies(bs, terms), "term long, n long")
          .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
    found = np.zeros(len(names) + 1)  # the last one: all documents
    found[df.column("term").to_numpy()] = df.column("n").to_numpy()
    got = sample.mapInArrow(lambda bs: _example_vectors(bs, terms), "doc_id long, toxic int, terms binary, counts binary").toArrow()
    own = sorted(((r["doc_id"], r["toxic"], np.frombuffer(r["terms"], np.int32).astype(np.int64), np.frombuffer(r["counts"], np.int64))
                  for b in got.to_batches() for r in b.to_pylist()), key=lambda x: x[:2])
    if len({x[1] for x in own}) < 2:
        return Model(prior=prior)
    return _learn(Model(terms, np.log((1 + found[-1]) / (1 + found[:-1])) + 1, names=names, prior=prior), own, total)


def _learn(model: Model, own: list[tuple], total: dict[int, int]) -> Model:
    """Index, odds and calibration from the examples ``own`` (id, label, terms, counts)."""
    vectors = [model.vector(*x[2:]) for x in own]
    dense = BlockMaxIndex.build(vectors, len(model.terms)).dense
    order = alike_order(dense.transpose(0, 2, 1).reshape(-1, dense.shape[1])[:len(own)], BLOCK).tolist()
    del dense
    own, vectors = [own[i] for i in order], [vectors[i] for i in order]
    model.index = BlockMaxIndex.build(vectors, len(model.terms))
    model.labels, model.ids, model.own = np.array([x[1] for x in own], float), [x[0] for x in own], [v[0].astype(np.int32) for v in vectors]
    model.held = np.array([np.bincount(np.concatenate([t for t, y in zip(model.own, model.labels) if y == label]), minlength=len(model.terms)) for label in (0, 1)])
    model.odds = model.log_odds(np.arange(len(model.terms)))
    votes = np.array([x[0] for at in range(0, len(own), BATCH) for x in model.look([x[2:] for x in own[at:at + BATCH]], list(range(at, min(at + BATCH, len(own)))))])
    model.held = model.spoken = None
    weight = np.array([total[int(y)] / (model.labels == y).sum() for y in model.labels])
    model.votes, model.chance = rising_fit(votes, model.labels, weight)
    return model


def _evidence(model: Model, rows: list[int], looks: list[tuple], n: int) -> pa.Array:
    """The neighbours of ``rows`` among ``n`` texts as lists of structs."""
    sizes = np.zeros(n + 1, np.int64)
    sizes[np.array(rows, np.int64) + 1] = [len(x[1]) for x in looks]
    near, cosine, term, odds = (np.concatenate([x[k] for x in looks]) if looks else np.zeros(0, np.int64) for k in (1, 2, 3, 4))
    ids, said = pa.array(model.ids, pa.int64()), pa.array(model.names, pa.string())
    silent = term < 0
    flat = pa.StructArray.from_arrays(
        [ids.take(pa.array(near, pa.int64())), pa.array(model.labels[near].astype(np.int32)), pa.array(cosine, pa.float64()),
         said.take(pa.array(term, pa.int64(), mask=silent)), pa.array(odds, pa.float64(), mask=silent)], ["doc_id", "toxic", "cosine", "term", "log_odds"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), flat)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    empty = model.score(0.0)
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            b = whole.slice(at, BATCH)
            score = np.full(b.num_rows, empty)
            counts = [known_counts(text.as_py(), model.terms) for text in b.column(b.num_columns - 1)] if model.index else []
            rows = [row for row, c in enumerate(counts) if len(c[0])]
            looks = model.look([counts[row] for row in rows]) if rows else []
            score[rows] = [model.score(x[0]) for x in looks]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score), _evidence(model, rows, looks, b.num_rows)],
                                             [*b.schema.names[:-1], "score", "evidence"])


def judge(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The kept columns, score and evidence (the nearest examples: doc_id, toxic, cosine, and of toxic ones the term that speaks for them and its
    log odds) of every row of ``docs``.

    score is the calibrated chance of label 1, from the whole text alone. A
    text without any of the model's terms, as null and empty ones are, has
    no neighbours and the chance of such texts; without labelled examples all
    scores are 0, with those of one label only all are that label's share.
    Repeated rows repeat; an empty table gives an empty result; kept columns named like an added one are
    replaced."""
    kept = without(docs.select(*[F.col(f"`{c}`") for c in keep]), "score", "evidence").columns
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    spec = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "score double",
                      "evidence array<struct<doc_id:bigint,toxic:int,cosine:double,term:string,log_odds:double>>"])
    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias("_judged_text")).mapInArrow(
        lambda bs: _score(bs, model), spec)
