import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.llm import mixing, packing


def test_knapsack_finds_the_nearest_sum():
    rng = np.random.default_rng(3)
    for _ in range(40):
        sizes, counts = np.unique(rng.integers(1, 25, 4)), None
        counts = rng.integers(0, 4, len(sizes))
        budget = int(rng.integers(0, 60))
        take = mixing.knapsack(sizes, counts, budget)
        assert (take <= counts).all()
        sums = [sum(a * b for a, b in zip(c, sizes)) for c in itertools.product(*(range(n + 1) for n in counts))]
        assert abs(int((take * sizes).sum()) - budget) == min(abs(s - budget) for s in sums if s <= 2 * budget)


def test_large_budgets_leave_only_a_knapsack():
    rng = np.random.default_rng(4)
    sizes = np.arange(1, 3000)
    counts = rng.integers(1, 50, len(sizes))
    total = int((sizes * counts).sum())
    for target in (total * 0.37, total * 1.61, total * 2, 0):
        copies, extra = mixing.fit_counts(sizes, counts, target, budget=5000)
        assert (extra <= counts).all() and copies * total + int((extra * sizes).sum()) == round(target)


def test_sources_of_long_documents_only():
    copies, extra = mixing.fit_counts(np.array([400_000]), np.array([3]), 1_900_000)
    assert (copies, extra.tolist()) == (1, [2])
    rng = np.random.default_rng(14)
    for _ in range(30):
        sizes = np.unique(rng.integers(7, 90, 3)) * 10_000
        counts = rng.integers(1, 4, len(sizes))
        total = int((sizes * counts).sum())
        target = int(rng.integers(0, total * 2))
        copies, extra = mixing.fit_counts(sizes, counts, target)
        rest = target - copies * total
        sums = [int((np.array(c) * sizes).sum()) for c in itertools.product(*(range(n + 1) for n in counts))]
        assert (0 <= extra).all() and (extra <= counts).all()
        if rest > 2 * mixing.KNAPSACK_BUDGET:
            assert abs(int((extra * sizes).sum()) - rest) <= min(abs(s - rest) for s in sums) + 10_000


def water(sizes, weights, share, most):
    left, out, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * level > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * level
            return out
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
            open_.discard(i)
    return out


def test_targets_fill_like_water(spark, docs_of):
    rows = [(i, "w " * (1 + (i * 7) % 23), f"s{i % 7}" if i % 7 < 6 else None) for i in range(300)]
    got = mixing.mix(docs_of(rows)).collect()
    by = {}
    for _, t, s in rows:
        by[s] = by.get(s, 0) + len(t.split())
    names = sorted((s for s in by if s), key=str) + [None]
    want = dict(zip(names, water([by[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2)))
    for r in got:
        assert r["source_size"] == by[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in names:
        taken = sum(r["copies"] * r["size"] for r in got if r["source"] == s)
        assert abs(taken - want[s]) <= 1


def test_mix_edge_cases(docs_of):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", "a"), (None, "x y", "a"), (3, "q " * 50_000, None), (4, " \t", "b")]
    docs = docs_of(rows).withColumn("copies", F.lit("clash")).withColumn("_rank", F.lit(9))
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_rank", "size", "source_size", "target", "copies"]
    rows = got.collect()
    assert len(rows) == 6 and all(0 <= r["copies"] <= 2 and (r["size"] or not r["copies"]) for r in rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, rows))
    assert mixing.repeat(got, ["doc_id"]).count() == sum(r["copies"] for r in rows)
    assert mixing.mix(docs.limit(0)).count() == 0


def plain_best_fit(counts, capacity):
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = [r for r in rooms if r >= length]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - length)
            else:
                rooms.append(capacity - length)
    return len(rooms)


def test_grouped_best_fit_is_best_fit():
    rng = np.random.default_rng(5)
    for _ in range(60):
        capacity = int(rng.integers(5, 60))
        counts = {int(x): int(rng.integers(1, 30)) for x in rng.integers(1, capacity + 1, 8)}
        places, bins = packing.best_fit(counts, capacity)
        assert bins == plain_best_fit(counts, capacity)
        load, seen = {}, {}
        for length, first, last, start, per_bin, offset in places:
            seen.setdefault(length, []).extend(range(first, last + 1))
            for k in range(last - first + 1):
                load.setdefault(start + k // per_bin, []).append((offset + k % per_bin * length, length))
        assert {x: sorted(r) for x, r in seen.items()} == {x: list(range(n)) for x, n in counts.items()}
        for parts in load.values():
            parts.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0
            assert sum(n for _, n in parts) <= capacity


def test_tightest_room():
    tree = packing.CapacityTree(9)
    for room in (3, 7, 7, 9):
        tree.add(room, 1)
    assert [tree.tightest(n) for n in range(10)] == [3, 3, 3, 3, 7, 7, 7, 7, 9, 9]
    tree.add(9, -1)
    assert tree.tightest(8) is None


def test_both_encoders_agree(documents):
    e = packing.Encoder(**packing.default_vocabulary())
    texts = [r["text"] for r in documents.limit(60).collect()]
    for t in [*texts, "", " ", "a" * 30_000, "<|endoftext|> x", "naïve  \n\n été\t…", "日本語 text", "can't I'll 12 345"]:
        assert e.ids(t).tolist() == e.exact.encode(t, add_special_tokens=False).ids


def test_packing_round_trip(spark, docs_of):
    rows = [(1, "word " * 3000), (2, None), (3, ""), (None, "hello there"), (None, "hello there"), (5, "x" * 9000), (6, "tail end")]
    docs = docs_of(rows).withColumn("length", F.lit("clash")).withColumn("piece", F.lit(1))
    got = packing.pack(docs, keep_ids=True).collect()
    e = packing.Encoder(**packing.default_vocabulary())
    want = sorted([*e.ids(t or "").tolist(), 0] for _, t in rows)
    by_doc, places = {}, {}
    for r in got:
        assert len(r["ids"]) == r["length"] <= 2048
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        if r["doc_id"] is not None:
            by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["ids"]))
    texts = sorted([x for p in sorted(v) for x in p[2]] for v in by_doc.values())
    assert texts + [w for w in want if w not in texts] and all(t in want for t in texts)
    for parts in by_doc.values():
        parts.sort()
        assert [p[0] for p in parts] == list(range(len(parts)))
        assert all(p[1] == sum(len(q[2]) for q in parts[:i]) for i, p in enumerate(parts))
        assert all(len(p[2]) == 2048 for p in parts[1:])
    for parts in places.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    assert sum(r["doc_id"] is None for r in got) == 2
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_the_table_wastes_little(documents):
    got = packing.pack(documents).agg(F.countDistinct("sequence_id").alias("n"), F.sum("length").alias("t")).first()
    assert got["n"] <= -(-got["t"] // 2048) * 1.02 + 1
    assert re.match(r"\d+", str(got["t"]))
