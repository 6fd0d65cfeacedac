"""Language-model scores from a probabilistic suffix tree over words.

States are contexts of zero, one or two preceding words. A longer context is
kept only if it predicts its next words better than the next shorter one does: its
mean log-likelihood gain per training token, each token left out of its own count,
must reach a threshold. A state's distribution is its counts mixed with
its parent's, and a token is scored by its longest kept context.

The tables of such a model have as many rows as the corpus has distinct pairs, so they are neither
collected nor broadcast. Documents are packed into chunks of bounded size; a
chunk sends the keys it holds (hashes of words, pairs, triples and contexts) with its own counts, in sorted
runs, to the shards of the key space, and gets back each key's global sum.
Work and traffic follow the chunks' distinct keys; no key's occurrences meet in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import materialize

CHUNK_BYTES = 10_000_000
END = np.uint64(xxhash.xxh64_intdigest(b"\n"))  # no word has a line feed
WORD_KIND, PAIR_KIND, TRIPLE_KIND, ONE_KIND, TWO_KIND = range(5)
#: Occurrences that a context of one and of two words needs; least mean gain in nats; weights of a state's own counts to choose from.
LEAST_ONE, LEAST_TWO, GAIN = 4, 16, 0.01
SHARES = (0.3, 0.7, 0.95)
MILLI = 1000.0
SENT = "chunk long, kind int, shard int, keys binary, sums binary"
BACK = "chunk long, kind int, shard int, totals binary, distinct long, mass long"


def squeeze(x: np.ndarray) -> bytes:
    """An integer array by byte planes, compressed: high bytes are mostly zero."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T if len(x) else np.zeros((0, 0), np.uint8)
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(planes).tobytes())


def expand(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit key of an ordered pair of keys."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _pack(ids: list, held: list[np.ndarray], sizes: list[np.ndarray], words: list[pa.Array], place: int) -> dict:
    """One chunk: its documents' ids and sizes in tokens, its distinct words' keys and the tokens as numbers of words."""
    size = np.concatenate(sizes).astype(np.int64)
    coded = pc.dictionary_encode(pa.concat_arrays(words))
    code, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.cast(pa.binary()).to_pylist()
    order = np.argsort(-np.bincount(code, minlength=len(names)), kind="stable")  # frequent words get small numbers
    number = np.empty(len(names), np.int64)
    number[order] = np.arange(1, len(names) + 1)
    tokens = np.zeros(int(size.sum() + len(size)), np.uint32)  # 0 is the end
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(size + 1) - 1] = False
    tokens[inside] = number[code]
    keys = np.array([END, *(xxhash.xxh64_intdigest(names[i]) for i in order.tolist())], np.uint64)
    return {"chunk": place, "ids": ids, "held": np.concatenate(held).tolist(), "sizes": (size + 1).tolist(),
            "tokens": squeeze(tokens), "words": keys.tobytes()}


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                        ("sizes", pa.list_(pa.int32())), ("tokens", pa.binary()), ("words", pa.binary())])
    place = TaskContext.get().partitionId() << 32
    ids, held, sizes, words, load = [], [], [], [], 0
    for b in batches:
        at = 0
        while at < b.num_rows:
            texts = b.column(2).slice(at)
            length = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            n = max(1, int(np.searchsorted(length, chunk_bytes - load, side="right")))
            texts = pc.fill_null(texts.slice(0, n), "")
            split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
            flat, owner = pc.list_flatten(split), pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
            full = pc.not_equal(flat, "")
            ids += b.column(0).slice(at, n).to_pylist()
            held.append(b.column(1).slice(at, n).to_numpy(zero_copy_only=False).astype(bool))
            sizes.append(np.bincount(owner[full.to_numpy(zero_copy_only=False)], minlength=len(texts)))
            words.append(flat.filter(full))
            load, at = load + int(length[len(texts) - 1]), at + len(texts)
            if load >= chunk_bytes * 0.9:
                yield pa.RecordBatch.from_pylist([_pack(ids, held, sizes, words, place)], schema)
                ids, held, sizes, words, load, place = [], [], [], [], 0, place + 1
    if ids:
        yield pa.RecordBatch.from_pylist([_pack(ids, held, sizes, words, place)], schema)


class Chunk:
    """A chunk's tokens, its keys of each kind, and what is known of their global sums so far.

    Keys of a kind are in a fixed order, so sums come back in that order."""

    def __init__(self, row: dict, back: dict[int, np.ndarray], n: int = 0, v: int = 0):
        self.place, self.ids, self.held = row["chunk"], row["ids"], np.array(row["held"], bool)
        self.sizes = np.array(row["sizes"], np.int64)
        self.code = expand(row["tokens"], np.uint32).view(np.int32)
        self.word = np.frombuffer(row["words"], np.uint64)
        self.back, self.n, self.v = back, n, v
        ends = np.cumsum(self.sizes)
        self.start = ends - self.sizes
        place = np.arange(len(self.code)) - np.repeat(self.start, self.sizes)
        self.train = np.repeat(~self.held, self.sizes)
        self.second, self.third = (np.flatnonzero(place >= k).astype(np.int32) for k in (1, 2))
        del place
        ids = self.code[self.second - 1].astype(np.int64) * len(self.word) + self.code[self.second]
        pairs, pair = np.unique(ids, return_inverse=True)
        del ids
        self.pair = pair.astype(np.int32)
        self.pair_key = mix(self.word[pairs // len(self.word)], self.word[pairs % len(self.word)])

    def sums_of(self, kind: int, keys: np.ndarray, width: int = 1) -> np.ndarray:
        """The global sums of ``keys`` as they came back, in the order of ``keys``; they are taken once."""
        out = np.empty((len(keys), width), np.int64)
        out[np.argsort(keys)] = self.back.pop(kind).reshape(-1, width)
        return out if width > 1 else out[:, 0]

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.code[self.train], minlength=len(self.word))

    def pair_counts(self) -> np.ndarray:
        return np.bincount(self.pair[self.train[self.second]], minlength=len(self.pair_key))

    def root(self) -> None:
        """Word counts, the words that are frequent enough for a state, and the root's probabilities, per token."""
        self.count = self.sums_of(WORD_KIND, self.word)
        self.contexts1 = np.flatnonzero(self.count >= LEAST_ONE)
        self.p0 = ((self.count + 0.5) / (self.n + 0.5 * (self.v + 1)))[self.code]

    def one(self) -> None:
        """Per token after a first: how often its last word, and the pair with it, occur."""
        self.pair_count = self.sums_of(PAIR_KIND, self.pair_key)
        self.context1, self.joint1 = self.count[self.code[self.second - 1]], self.pair_count[self.pair]

    def two(self) -> None:
        """Triples whose first two words may be a state: they are frequent."""
        before = self.pair[np.searchsorted(self.second, self.third - 1)]
        fits = self.pair_count[before] >= LEAST_TWO
        self.third, self.before = self.third[fits], before[fits]
        ids = self.before.astype(np.int64) * len(self.word) + self.code[self.third]
        triples, triple = np.unique(ids, return_inverse=True)
        del ids
        self.triple = triple.astype(np.int32)
        self.triple_key = mix(self.pair_key[triples // len(self.word)] ^ np.uint64(0x5851F42D4C957F2D),
                              self.word[triples % len(self.word)])
        del triples, triple
        self.contexts2, at = np.unique(self.before, return_inverse=True)
        self.context2_at = at.astype(np.int32)

    def triple_counts(self) -> np.ndarray:
        return np.bincount(self.triple[self.train[self.third]], minlength=len(self.triple_key))

    @staticmethod
    def gains(at: np.ndarray, n: int, joint: np.ndarray, context: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Per context and share: gain over the parent in thousandths of a nat, each token left out of its own counts."""
        out = np.zeros((n, len(SHARES)), np.int64)
        own = np.maximum(joint - 1, 0) / np.maximum(context - 1, 1)
        for k, share in enumerate(SHARES):
            out[:, k] = np.rint(np.bincount(at, np.log(share * own / parent + 1 - share), n) * MILLI).astype(np.int64)
        return out

    @staticmethod
    def kept_share(sums: np.ndarray, count: np.ndarray, least: int) -> np.ndarray:
        """Each context's best share, 0 if its mean gain does not reach the threshold or it is too rare."""
        best = sums.argmax(axis=1)
        gain = np.take_along_axis(sums, best[:, None], 1)[:, 0] / MILLI / np.maximum(count, 1)
        return np.where((gain >= GAIN) & (count >= least), np.array(SHARES)[best], 0.0)

    def votes1(self) -> np.ndarray:
        use = self.train[self.second] & (self.context1 >= LEAST_ONE)
        i = self.second[use]
        return self.gains(self.code[i - 1], len(self.word), self.joint1[use], self.context1[use], self.p0[i])[self.contexts1]

    def apply1(self) -> None:
        """p1: per token, the probability by its last word where that is a state."""
        self.share1 = np.zeros(len(self.word))
        self.share1[self.contexts1] = self.kept_share(self.sums_of(ONE_KIND, self.word[self.contexts1], len(SHARES)),
                                                      self.count[self.contexts1], LEAST_ONE)
        share = self.share1[self.code[self.second - 1]]
        self.p1 = self.p0.copy()
        self.p1[self.second] = share * self.joint1 / np.maximum(self.context1, 1) + (1 - share) * self.p0[self.second]
        del self.context1, self.joint1

    def votes2(self) -> np.ndarray:
        joint = self.sums_of(TRIPLE_KIND, self.triple_key)[self.triple]
        use = self.train[self.third] & (self.share1[self.code[self.third - 1]] > 0)  # a state's parent is a state
        return self.gains(self.context2_at[use], len(self.contexts2), joint[use], self.pair_count[self.before[use]],
                          self.p1[self.third[use]])

    def apply2(self) -> None:
        share = self.kept_share(self.sums_of(TWO_KIND, self.pair_key[self.contexts2], len(SHARES)),
                                self.pair_count[self.contexts2], LEAST_TWO)[self.context2_at]
        joint = self.sums_of(TRIPLE_KIND, self.triple_key)[self.triple]
        self.p2 = self.p1.copy()
        self.p2[self.third] = share * joint / np.maximum(self.pair_count[self.before], 1) + (1 - share) * self.p1[self.third]

    def upto(self, step: int) -> Chunk:
        for f in (self.root, self.one, self.two, self.apply1, self.apply2)[: (0, 3, 4, 5)[step]]:
            f()
        return self

    def send(self, step: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, keys, own sums) of this step: words and pairs; triples and one-word contexts; two-word contexts."""
        self.upto(step)
        if step == 0:
            return [(WORD_KIND, self.word, self.word_counts()), (PAIR_KIND, self.pair_key, self.pair_counts())]
        if step == 1:
            return [(TRIPLE_KIND, self.triple_key, self.triple_counts()), (ONE_KIND, self.word[self.contexts1], self.votes1())]
        return [(TWO_KIND, self.pair_key[self.contexts2], self.votes2())]

    def scores(self) -> dict:
        self.upto(3)
        add = lambda x: np.add.reduceat(x, self.start)  # noqa: E731  every document has its end
        return {"doc_id": pa.array(self.ids, pa.int64()), "held_out": pa.array(self.held), "n_tokens": pa.array(self.sizes),
                "n_known": pa.array(add((self.count > 0)[self.code].astype(np.int64))),
                "base_score": pa.array(add(np.log10(self.p0))), "score": pa.array(add(np.log10(self.p2)))}


def _messages(chunk: Chunk, step: int, bits: int) -> pa.Table:
    """A chunk's sorted keys, cut where the shards of the key space (by their top bits) begin."""
    rows = {n: [] for n in ("chunk", "kind", "shard", "keys", "sums")}
    for kind, keys, sums in chunk.send(step):
        order = np.argsort(keys)
        sums = sums.astype(np.int64)
        keys, sums = keys[order], (sums[:, None] if sums.ndim == 1 else sums)[order]
        cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange(1 << bits, dtype=np.uint64))
        for shard, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(keys)])):
            if b > a:
                part = keys[a:b]
                for n, x in zip(rows, (chunk.place, kind, shard, squeeze(np.diff(part, prepend=np.uint64(0))), squeeze(sums[a:b].T.ravel()))):
                    rows[n].append(x)
    types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(x, t) for (n, x), t in zip(rows.items(), types)})


def _first_messages(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            yield from _messages(Chunk(row, {}), 0, bits).to_batches()


def _later_messages(step: int, bits: int, n: int, v: int):
    return lambda chunk, back: _messages(Chunk(chunk.to_pylist()[0], _known(back), n, v), step, bits)


def _add_up(shard: pa.Table) -> pa.Table:
    """One shard of one kind: each chunk's keys with their sums over all chunks."""
    rows = shard.to_pylist()
    with np.errstate(over="ignore"):
        keys = [np.cumsum(expand(r["keys"], np.uint64), dtype=np.uint64) for r in rows]
    sums = [expand(r["sums"], np.int64).reshape(-1, len(k)).T for r, k in zip(rows, keys)]
    names, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.concatenate(sums)
    total = np.stack([_int_sums(at, sums[:, k], len(names)) for k in range(sums.shape[1])], axis=1)
    parts = np.split(total[at], np.cumsum([len(k) for k in keys])[:-1])
    nothing = [0] * (len(rows) - 1)
    return pa.table({"chunk": pa.array([r["chunk"] for r in rows], pa.int64()), "kind": pa.array([r["kind"] for r in rows], pa.int32()),
                     "shard": pa.array([r["shard"] for r in rows], pa.int32()),
                     "totals": pa.array([squeeze(p.T.ravel()) for p in parts], pa.binary()),
                     "distinct": pa.array([int((total[:, 0] > 0).sum()), *nothing], pa.int64()),
                     "mass": pa.array([int(total[:, 0].sum()), *nothing], pa.int64())})


def _int_sums(at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, at, x)
    return out


def _known(back: pa.Table) -> dict[int, np.ndarray]:
    """Kind -> sums in key order; a kind's shards are ranges of the key space, in order."""
    widths = {WORD_KIND: 1, PAIR_KIND: 1, TRIPLE_KIND: 1, ONE_KIND: len(SHARES), TWO_KIND: len(SHARES)}
    out: dict[int, list[np.ndarray]] = {kind: [np.zeros(0, np.int64)] for kind in widths}
    for r in sorted(back.to_pylist(), key=lambda r: (r["kind"], r["shard"])):
        x = expand(r["totals"], np.int64)
        out[r["kind"]].append(np.ascontiguousarray(x.reshape(widths[r["kind"]], -1).T).ravel())
    return {kind: np.concatenate(x) for kind, x in out.items()}


def score_texts(docs: DataFrame, held_out: Column, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row of ``docs`` (doc_id, text).

    Tokens are words, with A-Z lower-cased, and one end per document; null and empty
    texts are an end. Rows that are not held out (null counts as not) train. base_score is the root's
    log10 probability, score that of the longest kept contexts. With nothing to learn from, every token has the root's
    probability of an unseen one. Repeated rows count and are scored
    each; null ids are kept; an empty table gives an empty result; other
    columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), "text")
    chunks = materialize(rows.mapInArrow(lambda bs: _chunks(bs, chunk_bytes), "chunk long, ids array<long>, held array<boolean>, "
                                         "sizes array<int>, tokens binary, words binary"), "lm-chunks")
    bits = max(7, (2 * chunks.count()).bit_length())  # shards grow with the chunks, so a shard's size does not
    n = v = 0
    back = None
    for step in range(3):
        if step == 0:
            sent = chunks.mapInArrow(lambda bs: _first_messages(bs, bits), SENT)
        else:
            sent = chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(_later_messages(step, bits, n, v), SENT)
        got = materialize(sent.groupBy("kind", "shard").applyInArrow(_add_up, BACK), f"lm-sums{step}")
        if step == 0:
            total = got.where(F.col("kind") == WORD_KIND).agg(F.sum("mass").alias("n"), F.sum("distinct").alias("v")).first()
            n, v = int(total["n"] or 0), int(total["v"] or 0)
        back = got if back is None else back.unionByName(got)

    def score(chunk: pa.Table, known: pa.Table) -> pa.Table:
        return pa.table(Chunk(chunk.to_pylist()[0], _known(known), n, v).scores())

    scored = chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
