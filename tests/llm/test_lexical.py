import math
import re
from collections import Counter

import duckdb
import numpy as np

from feedlens.llm import lexical, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, words = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        rows = []
        for doc_id, c, n in held:
            m = 100 - 50 + 50 * n * n_docs // words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if s > 0:
                rows.append((-s, doc_id is None, doc_id or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(rows)[:k])]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def world():
    rng = np.random.default_rng(4)
    vocabulary = [f"t{i}" for i in range(60)] + ["Äpfel", "日本", "x9"]
    skew = 1 / np.arange(1, len(vocabulary) + 1)
    say = lambda n: " ".join(str(w).upper() if rng.random() < 0.2 else str(w) for w in rng.choice(vocabulary, n, p=skew / skew.sum()))
    docs = [(i, say(int(rng.integers(1, 60)))) for i in range(300)] + [(1000 + i, "t3 t4 t5 tail") for i in range(80)]
    docs += [(None, say(20)), (None, "t3 t4 t5 tail"), (5, "t3 t4 t5 tail"), (5, "t3 t4 t5 tail"), (400, None), (401, ""), (402, "!? \x00"), (403, "t1 " * 400_000)]
    items = [(i, say(12) + (" t3_t4.t5" if i % 2 else "")) for i in range(25)] + [(30, None), (31, ""), (32, "unheard of"), (None, "t7 t8"), (3, "t9"), (4, "t0"), (4, "t0")]
    return docs, items


def test_search_matches_brute_force(spark, monkeypatch):
    docs, items = world()
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score long, terms string").repartition(5)
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, term string")
    want = plain(docs, items, 7)
    got = lexical.search(d, i, 7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and in_order(got.collect()) == want
    monkeypatch.setattr(lexical, "BLOCK_PAIRS", 40)
    monkeypatch.setattr(lexical, "HELD", 10)
    monkeypatch.setattr(lexical, "CELLS", 200)
    monkeypatch.setattr(lexical, "PIECE", 7)
    assert in_order(lexical.search(d, i, 7).collect()) == want
    assert lexical.search(d.limit(0), i, 7).count() == 0 and lexical.search(d, i.limit(0), 7).count() == 0


def test_graph_shares_and_adds_up():
    rng = np.random.default_rng(6)
    base = [list(range(0, 6)), list(range(6, 10)), list(range(20, 23))]
    own = [sorted({t for b in base if rng.random() < 0.7 for t in b} | set(rng.choice(60, 5).tolist())) for _ in range(40)] + [[]]
    graph = lexical.SharingGraph.mine(own, 60)
    assert graph.cost() < sum(map(len, own)) and len(graph.edges) > 2
    doc, term = np.nonzero(rng.random((9, 60)) < 0.5)
    value = rng.integers(1, 10**9, len(doc))
    got = graph.evaluate(doc, term, value, 9)
    for q, ts in enumerate(own):
        for d in range(9):
            assert got[d, q] == sum(int(v) for a, t, v in zip(doc, term, value) if a == d and t in ts)
    assert lexical.SharingGraph.mine([[], []], 0).evaluate(*[np.zeros(0, np.int64)] * 3, 2).tolist() == [[0, 0], [0, 0]]


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    got = in_order(queries.op13_lexical_search(spark, SF).collect())
    assert got == in_order(con.execute(queries.LEXICAL_ORACLE).fetchall()) and got
