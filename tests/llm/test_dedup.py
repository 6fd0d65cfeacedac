import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feedlens.llm import lines, simhash
from feedlens.llm.components import connected_components


def plain_fingerprint(text, width, seed=42):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(ids, near):
    label = {i: i for i in range(len(ids))}
    for i in range(len(ids)):
        todo, seen = [i], {i}
        while todo:
            at = todo.pop()
            for j in range(len(ids)):
                if j not in seen and near[at][j]:
                    seen.add(j)
                    todo.append(j)
        label[i] = min(seen, key=lambda j: (ids[j] is None, ids[j]))
    return [ids[label[i]] for i in range(len(ids))]


def test_spark_xxhash64_is_the_plain_one(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("of the änd")).alias("h")).first()["h"]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("of the änd".encode(), 42)


@pytest.mark.parametrize("width", [1, 3, 4])
def test_fingerprint_by_hand(width):
    for text in ("", None, "one", "a b  c\td\x0be", "A b c d e f g", "x " * 70_000):
        assert simhash.fingerprint(text, width) == plain_fingerprint(text, width)


def test_masks_cover_every_close_pair():
    rng = np.random.default_rng(0)
    for rows in (10, 10**9):
        ms = simhash.masks(list(range(64)), 4, rows)
        for _ in range(300):
            flip = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(flip & m == 0 for m in ms)


def test_components_match_brute_force_and_edge_cases(spark, docs_of):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(5, base), (3, base), (9, base.replace("w59", "other")), (None, base), (7, ""), (2, None), (8, " \n"), (11, "lone text here now"), (5, base)]
    got = simhash.near_duplicates(docs_of(rows).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x")), 4, 4)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    fps = [plain_fingerprint(t, 4) for _, t in rows]
    near = [[(a ^ b).bit_count() <= 4 for b in fps] for a in fps]
    want = sorted(zip([r[0] or -1 for r in rows], [f"{f:016x}" for f in fps], reach([r[0] for r in rows], near)))
    assert sorted((r[0] or -1, r[1], r[2]) for r in got.collect()) == want


def test_components_on_the_table(documents):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents, 4, 4).collect()}
    rows = sorted((r["doc_id"], plain_fingerprint(r["text"], 4)) for r in documents.collect())
    fps = np.array([f for _, f in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    want = reach([i for i, _ in rows], near)
    assert got == {i: (f"{f:016x}", c) for (i, f), c in zip(rows, want)}


def test_hot_buckets_are_cut_without_losing_links(spark):
    rng = np.random.default_rng(1)
    core = int(rng.integers(1, 1 << 62))
    words = {core ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(150)}
    words |= {int(x) for x in rng.integers(0, 1 << 62, 50)}
    prints = spark.createDataFrame([(simhash._signed(w),) for w in words], "fp long")
    small, large = ({tuple(r) for r in simhash.classes(prints, 4, bucket=b).collect()} for b in (8, 1 << 17))
    assert small == large
    fps = sorted(simhash._signed(w) for w in words)
    u = np.array(fps, np.int64).view(np.uint64)
    want = reach(fps, np.bitwise_count(u[:, None] ^ u[None, :]) <= 4)
    assert large == set(zip(fps, want))


def test_keep_one_keeps_columns_and_drops_repeats(docs_of):
    base = " ".join(f"w{i}" for i in range(60))
    docs = docs_of([(5, base), (3, base), (3, base), (None, base), (1, "another text of its own"), (None, None), (4, "")])
    got = simhash.keep_one(docs.withColumn("_id", F.lit("extra")).withColumn("class", F.lit(0)), 4, 4)
    assert got.columns == [*docs.columns, "_id", "class"]
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(1, "another text of its own"), (3, base), (4, "")]
    assert simhash.keep_one(docs.limit(0), 4, 4).count() == 0
    assert simhash.near_duplicates(docs.limit(0), 4, 4).count() == 0


def test_connected_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(200 + i, 201 + i) for i in range(40)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"), "a", "b").collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


def plain_dedup(rows, width=3):
    wins, gone = {}, [set() for _ in rows]
    split = [r[1].split("\n") if r[1] is not None else [] for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        full = [k for k, line in enumerate(split[i]) if line.strip(" \t\n\x0b\f\r")]
        for at in zip(*(full[k:] for k in range(width))):
            key = tuple(split[i][k] for k in at)
            if wins.setdefault(key, (i, at[0])) != (i, at[0]):
                gone[i] |= set(range(at[0], at[-1] + 1))
    return [(r[0], None if r[1] is None else "\n".join(line for k, line in enumerate(s) if k not in g), len(s), len(g))
            for r, s, g in zip(rows, split, gone)]


def test_line_windows_by_hand(docs_of):
    p = "alpha one\nbeta two\ngamma three\ndelta four"
    rows = [(4, f"head\n{p}\ntail"), (2, p), (1, "alpha one\nbeta two"), (3, None), (6, ""), (None, f"x\n\n{p}\n\ny"),
            (8, "r\nr\nr\nr\nr"), (9, "alpha one\n\nbeta two\ngamma three"), (10, "long " * 30_000 + "\n" + p)]
    docs = docs_of(rows).withColumn("covered", F.lit(1)).withColumn("N_LINES", F.lit("clash"))
    got = lines.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "covered", "n_lines", "n_removed"]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in got.collect()), key=key) == sorted(plain_dedup(rows), key=key)
    assert all(r["n_chars"] == len(r["text"]) for r in got.where("text is not null").collect())
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_repeated_rows_share_one_result(docs_of):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc")]
    got = sorted((r["doc_id"], r["text"]) for r in lines.dedup_lines(docs_of(rows)).collect())
    assert got == [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "")]


def test_line_oracle(documents):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    got = lines.dedup_lines(documents).select("doc_id", "n_lines", "n_removed", "text").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(lines.ORACLE).fetchall())
