"""Best-fit-decreasing packing of token sequences with a segment tree over remaining capacities.

Only the histogram of piece lengths (at most ``capacity`` rows) decides the
packing, so best-fit decreasing runs over all documents at once: bins with
the same content so far are kept as one group, and each step finds the
tightest open capacity in a segment tree. Documents then take the places of
their length by rank, which Spark computes and joins."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import fresh, materialize, salted_rank

CAPACITY = 2048
END_ID = 0
RANK_PARTS_BITS = 8
#: Texts of these characters only, and without special tokens, go to the faster of two encoders of one vocabulary.
PLAIN = regex.compile(r"[^\x00-ɏ]|<\|")
PLACE_SCHEMA = "length int, first long, last long, sequence_id long, per_bin long, offset long"


class CapacityTree:
    """Segment tree over the capacities 0..top; a leaf counts the open groups with that much room."""

    def __init__(self, top: int):
        self.width = 1 << (top + 1).bit_length()
        self.open = [0] * (2 * self.width)

    def add(self, room: int, by: int) -> None:
        at = room + self.width
        while at:
            self.open[at] += by
            at >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest open capacity of at least ``need``."""
        at = need + self.width
        while not self.open[at]:
            while at & 1:  # a right child: everything to its right hangs higher up
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.width:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.width


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Best-fit decreasing over lengths with multiplicities.

    Returns places (length, first, last, sequence_id, per_bin, offset): the
    pieces of that length ranked first..last fill bins from sequence_id on,
    per_bin of them each, from offset on; and the number of bins. Pieces of
    one length go to the tightest bin until it has no room for one more, which
    is what best fit does with them one by one; a group of equal bins takes
    them in one step. A length opens at most two groups and splits at most
    one, so the places depend on the capacity, not on the documents."""
    tree, groups, places, bins = CapacityTree(capacity), {}, [], 0

    def put(size: int, start: int, room: int) -> None:
        if size:
            groups.setdefault(room, []).append((size, start))
            tree.add(room, 1)

    for length in sorted((x for x in counts if counts[x] > 0), reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                size, start = -(-left // (capacity // length)), bins
                bins += size
            else:
                size, start = groups[room].pop()
                tree.add(room, -1)
            fit = room // length
            full = min(size, left // fit)
            part = min(left - full * fit, fit) if full < size else 0
            took = full * fit + part
            places.append((length, rank, rank + took - 1, start, fit, capacity - room))
            put(full, start, room - fit * length)
            put(1 if part else 0, start + full, room - part * length)
            put(size - full - (part > 0), start + full + (part > 0), room)
            left, rank = left - took, rank + took
    return places, bins


class Encoder:
    """Ids by the ``tokenizers`` file; plain texts by tiktoken over the same vocabulary, which is several times faster.

    Both give the same ids (a test compares them); texts with characters
    beyond Latin, whose classes the two libraries may date differently, or
    with a possible special token always take the first."""

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.exact, self.fast = Tokenizer.from_file(tokenizer), None
        if ranks and pattern:
            import base64
            import tiktoken
            with open(ranks, "rb") as f:
                merge = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merge, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not PLAIN.search(text):
            return np.asarray(self.fast.encode_ordinary(text), dtype="<u4")
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


def default_vocabulary() -> dict:
    import public_tokenizers as P
    return {"tokenizer": P.path("byte_bpe_50k.json"), "ranks": P.path("byte_bpe_50k.tiktoken"), "pattern": P.PATTERN}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole capacities, the first piece taking what is over."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _cut_batches(batches: Iterator[pa.RecordBatch], vocabulary: dict, capacity: int, end_id: int,
                 keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(**vocabulary)
    end = np.array([end_id], dtype="<u4")
    for batch in batches:
        row, piece, start, length, crc, ids_out = [], [], [], [], [], []
        for i, text in enumerate(batch.column(batch.num_columns - 1)):
            ids = np.concatenate([encoder.ids(text.as_py() or ""), end])
            for k, (s, n) in enumerate(cut(len(ids), capacity)):
                own = ids[s:s + n]
                row.append(i), piece.append(k), start.append(s), length.append(n), crc.append(zlib.crc32(own.tobytes()))
                if keep_ids:
                    ids_out.append(own.astype(np.int32))
        kept = pa.Table.from_batches([batch]).drop_columns([batch.schema.names[-1]]).take(pa.array(row, pa.int64()))
        cols = [*kept.columns, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                pa.array(crc, pa.int64())]
        names = [*kept.schema.names, "piece", "start", "length", "ids_crc32"]
        if keep_ids:
            cols.append(pa.array(ids_out, pa.list_(pa.int32())))
            names.append("ids")
        yield from pa.table(cols, names).combine_chunks().to_batches()


def pieces(docs: DataFrame, vocabulary: dict | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           keep_ids: bool = False, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per piece: the kept columns, piece, start, length, ids_crc32 and, on request, the ids."""
    vocabulary = vocabulary or default_vocabulary()
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema),
                        "piece int, start long, length int, ids_crc32 long", *(["ids array<int>"] if keep_ids else [])])
    return docs.select(*keep, "text").mapInArrow(
        lambda batches: _cut_batches(batches, vocabulary, capacity, end_id, keep_ids), schema)


def pack(docs: DataFrame, vocabulary: dict | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) for every piece of every row.

    A document is its text's ids and one end id; null and empty texts have
    the end id alone. Only documents above ``capacity`` are cut, the first
    piece being the shorter. Sequences have no gaps and hold ``capacity`` ids at most.
    Null doc_ids and repeated rows are packed like any other; an
    empty table gives an empty result; other columns are ignored."""
    cut_rows = materialize(pieces(docs, vocabulary, capacity, end_id, keep_ids), "pack-pieces")
    part, rank, n = fresh(cut_rows, "part", "rank", "n")
    order = F.xxhash64("doc_id", "piece", "ids_crc32", "start")
    cut_rows = cut_rows.withColumn(part, F.shiftrightunsigned(order, 64 - RANK_PARTS_BITS))
    counts = materialize(cut_rows.groupBy("length", part).agg(F.count("*").alias(n)), "pack-lengths")
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum(n).alias("n")).collect()}
    places, _ = best_fit(by_length, capacity)  # at most ``capacity`` rows reach the driver
    where = docs.sparkSession.createDataFrame(places, PLACE_SCHEMA)
    ranked = salted_rank(cut_rows, ["length"], ["doc_id", "piece", "ids_crc32"], part, rank, counts, n)
    a, b = ranked.alias("a"), F.broadcast(where).alias("b")  # its size depends on the capacity alone
    at = F.col(f"a.{rank}") - F.col("b.first")
    return a.join(b, (F.col("a.length") == F.col("b.length")) & F.col(f"a.{rank}").between(F.col("b.first"), F.col("b.last"))) \
        .select("a.doc_id", "a.piece", "a.start", F.col("a.length").cast("long").alias("length"), "a.ids_crc32",
                (F.col("b.sequence_id") + F.floor(at / F.col("b.per_bin"))).cast("long").alias("sequence_id"),
                (F.col("b.offset") + at % F.col("b.per_bin") * F.col("a.length")).cast("long").alias("offset"),
                *(["a.ids"] if keep_ids else []))
