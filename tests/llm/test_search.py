import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.llm import balltree, crosspoly, queries
from feedlens.llm.common import table

SF = "/root/testdata/sf0.001"


def even():
    return F.col("vec_id") % 2 == 0


def plain(rows, k, score):
    out = []
    for q in sorted({i for i, v in rows if i is not None and i % 2 == 0 and v is not None}):
        best = {}
        for qv in [v for i, v in rows if i == q and v is not None]:
            for i, v in rows:
                if i is not None and i != q and v is not None and len(v) == len(qv):
                    best[i] = max(best.get(i, -(10**30)), score(qv, v))
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, r + 1, i, s) for r, (i, s) in enumerate(top)]
    return out


def test_exact_products_match_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [int(x) for x in rng.integers(-9, 9, 4)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # copies and ties
    rows += [(7, rows[7][1]), (8, [1, 2, 3, 4]), (300, [5, 5]), (302, [4, 4]), (304, [0, 0, 0, 0]), (306, None), (None, [1, 1, 1, 1]), (308, [])]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>").withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in balltree.top_products(df, even(), 5, shard=30, query_block=25).orderBy("query_id", "rank").collect()]
    usable = [(i, v or None) for i, v in rows]
    assert got == plain(usable, 5, lambda a, b: sum(x * y for x, y in zip(a, b)))
    assert balltree.top_products(df.limit(0), even(), 5).count() == 0


def test_an_id_with_several_vectors_counts_once(spark):
    rng = np.random.default_rng(15)
    rows = [(i, [int(x) for x in rng.integers(-9, 9, 4)]) for i in range(60)]
    rows += [(1, [30 + j, 30, 30, 30]) for j in range(9)] + [(0, [40, 40 + j, 40, 40]) for j in range(9)] + [(3, rows[5][1]), (4, [30, 30, 30, 30])]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>")
    want = plain(rows, 5, lambda a, b: sum(x * y for x, y in zip(a, b)))
    for shard in (8, 8192):
        got = balltree.top_products(df, even(), 5, shard=shard, query_block=25).orderBy("query_id", "rank").collect()
        assert list(map(tuple, got)) == want
    real = df.select("vec_id", F.col("vec").cast("array<double>").alias("vec")).where(F.exists("vec", lambda x: x != 0))
    got = crosspoly.nearest(real, even(), 5, tables=1, probes=8).orderBy("query_id", "rank").collect()
    want = plain([r for r in rows if any(r[1])], 5, lambda a, b: round(cosine(a, b), 12))
    assert [(r[0], r[1]) for r in got] == [w[:2] for w in want] and np.allclose([r[3] for r in got], [w[3] for w in want], atol=1e-11)


def test_branch_and_bound_equals_a_full_scan():
    rng = np.random.default_rng(7)
    centres = rng.integers(-300, 300, (12, 8))
    vectors = np.concatenate([c + rng.integers(-9, 9, (60, 8)) for c in centres])
    q = centres[:5] + rng.integers(-5, 5, (5, 8))
    tree = balltree.BallTree(vectors, leaf=16)
    score, at = balltree.search(tree, q, np.arange(len(vectors)), 6, np.full(5, balltree.NONE))
    for i in range(5):
        s = vectors @ q[i]
        want = np.lexsort((np.arange(len(s)), -s))[:6]
        assert at[i].tolist() == want.tolist() and score[i].tolist() == s[want].tolist()


def test_queries_visit_few_shards_of_clustered_vectors(spark, monkeypatch):
    rng = np.random.default_rng(21)
    centres = rng.normal(size=(24, 16))
    centres *= 2000 / np.linalg.norm(centres, axis=1, keepdims=True)
    visits = {}
    write = balltree.materialize

    def counted(df, name):
        out = write(df, name)
        if name == "mips-pairs":
            visits[n] = visits.get(n, 0) + out.count()
        return out

    monkeypatch.setattr(balltree, "materialize", counted)
    for n in (600, 2400):
        v = (centres[np.arange(n) % 24] + rng.normal(size=(n, 16)) * 20).astype(int)
        rows = [(i, x.tolist()) for i, x in enumerate(v)]
        df = spark.createDataFrame(rows, "vec_id long, vec array<long>")
        got = balltree.top_products(df, F.col("vec_id") % 20 == 0, 5, shard=25, query_block=10).collect()
        s = (v[::20] @ v.T).astype(float)
        for k, q in enumerate(range(0, n, 20)):
            s[k, q] = -np.inf
            want = np.lexsort((np.arange(n), -s[k]))[:5].tolist()
            assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want
    asked = {n: n // 20 for n in visits}
    share = {n: visits[n] / (asked[n] * (n / 25)) for n in visits}  # of all pairs of a query and a shard
    assert share[2400] < 0.3 and visits[2400] / asked[2400] < 1.2 * visits[600] / asked[600]  # four times the shards, no more visits a query


def test_quantize_and_huge_values(spark):
    df = spark.createDataFrame([(0, [0.5, -0.001, 1e300]), (2, [1.0, 2.0, -1e300])], "vec_id long, x array<double>")
    got = df.select("vec_id", balltree.quantize(F.col("x")).alias("vec"))
    assert got.orderBy("vec_id").first()["vec"][:2] == [128, -1]
    assert balltree.top_products(got, even(), 5).count() == 2


@pytest.mark.skipif(not hasattr(queries, "TOP_K_ORACLE"), reason="no oracle")
def test_top_k_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries.op10_exact_top_k(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(queries.TOP_K_ORACLE).fetchall())


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def test_nearest_with_all_buckets_is_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(60)] + [(100 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(20)]
    bad = [(200, None), (202, [0.0] * 6), (204, [1.0, float("nan")] * 3), (206, [float("inf")] * 6), (None, [1.0] * 6), (208, [1.0, 2.0]),
           (210, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (212, []), (0, rows[0][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, vec array<double>").withColumn("table", F.lit("clash"))
    got = crosspoly.nearest(df, even(), 5, tables=1, probes=16).orderBy("query_id", "rank").collect()
    ok = rows + [(208, [1.0, 2.0])]
    want = plain(ok, 5, lambda a, b: round(cosine(a, b), 12))
    assert [(r[0], r[1], r[2]) for r in got] == [w[:3] for w in want]
    assert np.allclose([r[3] for r in got], [w[3] for w in want], atol=1e-11)
    assert crosspoly.nearest(df.limit(0), even(), 5).count() == 0


def test_blocks_change_nothing(spark, monkeypatch):
    rows = table(spark, SF, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    whole = sorted(map(tuple, crosspoly.nearest(rows, F.col("vec_id") % 20 == 0).collect()))
    monkeypatch.setattr(crosspoly, "BLOCK", 7)
    monkeypatch.setattr(crosspoly, "QUERY_BLOCK", 2)
    assert sorted(map(tuple, crosspoly.nearest(rows, F.col("vec_id") % 20 == 0).collect())) == whole


@pytest.mark.parametrize("n", [3, 10])
def test_small_tables_get_k_or_all(spark, n):
    rng = np.random.default_rng(12)
    rows = [(i, [float(x) for x in rng.normal(size=64)]) for i in range(n)] + [(100, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    got = crosspoly.nearest(df, even(), 5).orderBy("query_id", "rank").collect()
    want = plain(rows, 5, lambda a, b: round(cosine(a, b), 12))
    assert [(r[0], r[1]) for r in got] == [w[:2] for w in want]
    assert n > 6 or [r[2] for r in got] == [w[2] for w in want]


def test_a_query_away_from_the_cluster_gets_k(spark):
    rng = np.random.default_rng(13)
    axis = np.eye(64)[0]
    rows = [(0, (-axis + 0.1 * rng.normal(size=64)).tolist())]
    rows += [(i, (axis + 0.01 * rng.normal(size=64)).tolist()) for i in range(1, 200, 2)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    got = crosspoly.nearest(df, even(), 5, probes=1).orderBy("query_id", "rank").collect()
    assert [(r[0], r[1], r[2]) for r in got] == [w[:3] for w in plain(rows, 5, lambda a, b: round(cosine(a, b), 12))]


def test_recall(spark):
    data = table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding").orderBy("vec_id").collect()
    v = np.array([r["embedding"] for r in data], float)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = queries.op2_cross_polytope_ann(spark, "/root/testdata/sf0.1").collect()
    ids = [r["vec_id"] for r in data]
    hit = 0
    asked = [i for i in ids if i % 50 == 0]
    for q in asked:
        s = u @ u[ids.index(q)]
        s[ids.index(q)] = -2
        best = {ids[i] for i in np.argsort(-s)[:5]}
        hit += len(best & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hit / (5 * len(asked)) >= 0.9
