"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, Hamming checks, components.

A fingerprint is cut into blocks. Two that differ in at most d bits agree on
all but d blocks, so each choice of (blocks - d) blocks, kept as a bit mask,
is one join table and some table brings the pair together. Rows of a bucket
(equal masked fingerprints) meet in one sorted partition and are compared
with numpy; only a spanning set of the links leaves it, never all pairs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import fresh, materialize
from feedlens.llm.components import connected_components

SEED = 42
#: Largest bucket compared at once; larger ones are cut by further blocks until a mask holds MASKED bits.
BUCKET, MASKED = 1 << 17, 48
#: Fingerprints a bucket should hold on average.
FILL = 16


def fingerprint(text: str | None, width: int, seed: int = SEED) -> int:
    """The fingerprint of a text's word shingles as an unsigned integer; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = np.array([digest(line, seed)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist())
        hashes = np.array([digest(line[a:b], seed) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):  # a very long text in bounded memory
        part = hashes[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.array([fingerprint(t.as_py(), width, seed) for t in b.column(b.num_columns - 1)], np.uint64)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))], [*b.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, keep: list[str], width: int, seed: int = SEED) -> DataFrame:
    """The kept columns and fp, the fingerprint's 64 bits as a signed long."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), "fp long"])
    return docs.select(*keep, "text").mapInArrow(lambda bs: _fingerprints(bs, width, seed), schema)


def masks(free: list[int], distance: int, rows: int = 0) -> list[int]:
    """Bit masks over the ``free`` bit positions such that any two words differing in at most ``distance``
    of these bits agree under some mask. More blocks make longer masks; enough are taken for buckets of
    about FILL of ``rows`` random fingerprints (each mask stays exact whatever the number)."""
    blocks = min(distance + 2, len(free))
    while blocks < min(2 * distance + 2, len(free)) and rows > FILL << (len(free) * (blocks - distance) // blocks):
        blocks += 1
    if blocks <= distance:
        return [0]
    parts = [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(free), blocks)]
    return [sum(c) for c in combinations(parts, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def spanning_links(words: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that span the components of ``words`` under Hamming distance, by breadth-first search."""
    left, src, dst = np.arange(len(words)), [], []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(words[left] ^ words[at]) <= distance
            found, left = left[near], left[~near]
            src += [at] * len(found)
            dst += found.tolist()
            queue += found.tolist()
    return np.array(src, np.int64), np.array(dst, np.int64)


def _links_of_sorted(mask: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of every bucket of rows sorted by (mask, masked fingerprint)."""
    key = fp & mask
    first = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]))
    size = np.diff(np.concatenate([first, [len(fp)]]))
    bucket = np.repeat(np.arange(len(first)), size)
    close = np.zeros(len(first), bool)
    src, dst = [], []
    for gap in range(1, min(int(size.max()), 64)):  # buckets are mostly tiny: rows at one distance all at once
        same = np.flatnonzero(bucket[gap:] == bucket[:-gap])
        if not len(same):
            break
        hit = same[np.bitwise_count(fp[same] ^ fp[same + gap]) <= distance]
        pair = hit[size[bucket[hit]] == 2]
        src.append(fp[pair]), dst.append(fp[pair + gap])
        close[bucket[hit]] = True
    for b in np.flatnonzero((close & (size > 2)) | (size > 64)):
        own = fp[first[b]:first[b] + size[b]]
        i, j = spanning_links(own, distance)
        src.append(own[i]), dst.append(own[j])
    return (np.concatenate(src), np.concatenate(dst)) if src else (fp[:0], fp[:0])


def _compare(parts: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    mask, fp = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for part in parts:
        mask = np.concatenate([mask, part["mask"].to_numpy(np.int64).view(np.uint64)])
        fp = np.concatenate([fp, part["fp"].to_numpy(np.int64).view(np.uint64)])
        if not len(fp):
            continue
        tail = (mask == mask[-1]) & ((fp & mask) == (fp[-1] & mask[-1]))  # its bucket may go on in the next part
        src, dst = _links_of_sorted(mask[~tail], fp[~tail], distance) if not tail.all() else (fp[:0], fp[:0])
        yield pd.DataFrame({"src": src.view(np.int64), "dst": dst.view(np.int64)})
        mask, fp = mask[tail], fp[tail]
    if len(fp):
        src, dst = _links_of_sorted(mask, fp, distance)
        yield pd.DataFrame({"src": src.view(np.int64), "dst": dst.view(np.int64)})


def links(prints: DataFrame, distance: int, bucket: int = BUCKET) -> DataFrame:
    """(src, dst) fingerprint pairs within ``distance`` bits that span all such pairs of ``prints`` (distinct fp).

    A bucket above ``bucket`` rows is cut again by masks over the bits its
    mask leaves free, which keeps every close pair together somewhere, until
    all are below; a mask of 48 bits or more cannot hold more than 2**16."""
    spark, rows = prints.sparkSession, prints.count()
    todo, found = prints.select("fp").crossJoin(F.broadcast(_mask_table(spark, {0: masks(list(range(64)), distance, rows)}))), None
    todo = todo.select("fp", F.col("finer").alias("mask"))
    while True:
        todo = todo.withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = materialize(todo.groupBy("mask", "part").agg(F.count("*").alias("n"))
                            .where((F.col("n") > bucket) & (F.bit_count("mask") < MASKED)), "simhash-hot")
        hot = [r["mask"] % (1 << 64) for r in sizes.select("mask").distinct().collect()]  # masks, as many as there are choices of blocks
        cold = todo.join(sizes, ["mask", "part"], "left_anti") if hot else todo
        near = (cold.repartition("mask", "part").sortWithinPartitions("mask", "part").select("mask", "fp")
                .mapInPandas(lambda parts: _compare(parts, distance), "src long, dst long"))
        found = near if found is None else found.union(near)
        if not hot:
            return found
        finer = {m: [m | x for x in masks([b for b in range(64) if not m >> b & 1], distance)] for m in hot}
        todo = materialize(todo.join(sizes.select("mask", "part"), ["mask", "part"], "left_semi").drop("part")
                           .join(F.broadcast(_mask_table(spark, finer)), "mask").select("fp", F.col("finer").alias("mask"))
                           .distinct(), "simhash-finer")


def _mask_table(spark, finer: dict[int, list[int]]) -> DataFrame:
    """(mask, finer): a few thousand rows at most, as masks are choices of blocks."""
    return spark.createDataFrame([(_signed(m), _signed(x)) for m, xs in finer.items() for x in xs], "mask long, finer long")


def classes(prints: DataFrame, distance: int, bucket: int = BUCKET) -> DataFrame:
    """(fp, class): the fingerprints of ``prints`` (fp, repeats allowed) with the smallest one linked to each."""
    distinct = materialize(prints.select("fp").distinct(), "simhash-distinct")
    parts = connected_components(links(distinct, distance, bucket), "src", "dst")
    return (distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("component", "fp").alias("class")))


def near_duplicates(docs: DataFrame, width: int = 5, distance: int = 3, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs``.

    component_id is the smallest doc_id whose fingerprint is reachable over
    links of at most ``distance`` bits. Null, empty and blank texts have
    fingerprint zero and are linked like any other; null doc_ids are never a
    component_id unless a component has no other. Repeated rows
    are rows of one component; an empty table gives an empty result; other
    columns are ignored. A copied text costs one fingerprint row in the joins,
    however often it occurs."""
    prints = materialize(fingerprints(docs, ["doc_id"], width, seed), "simhash-prints")
    ids = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    known = materialize(classes(prints, distance), "simhash-classes")
    lowest = known.join(ids, "fp").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    labels = materialize(known.join(lowest, "class").select("fp", "component_id"), "simhash-labels")
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 5, distance: int = 3, seed: int = SEED) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (a null id last), then the smallest text hash.

    Every column is kept as it is. Of rows that repeat in doc_id and text one stays."""
    (text_hash,) = fresh(docs, "text_hash")
    hashed = docs.withColumn(text_hash, F.xxhash64("text"))
    slim = hashed.select("doc_id", F.col(text_hash).alias("text_hash"), "text")
    prints = materialize(fingerprints(slim, ["doc_id", "text_hash"], width, seed), "simhash-prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    known = materialize(classes(prints, distance), "simhash-classes")
    chosen = known.join(prints.groupBy("fp").agg(first), "fp").groupBy("class").agg(F.min("first").alias("first"))
    chosen = chosen.select("first.no_id", F.coalesce("first.doc_id", F.lit(0)).alias("id"), F.col("first.text_hash").alias("th"))
    no_id, key = fresh(hashed, "no_id", "id")
    rows = hashed.withColumn(no_id, F.col("doc_id").isNull()).withColumn(key, F.coalesce("doc_id", F.lit(0)))
    chosen = chosen.select(F.col("no_id").alias(no_id), F.col("id").alias(key), F.col("th").alias(text_hash))
    return (rows.join(chosen, [no_id, key, text_hash], "left_semi").dropDuplicates([no_id, key, text_hash])
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
