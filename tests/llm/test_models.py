import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.llm import langid, queries, suffixtree, toxicity

SF = "/root/testdata/sf0.01"


def held(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod


def test_windows_cover_every_byte():
    texts = [b"", b"a", bytes(range(1, 256)) * 3, b"x" * langid.LENGTH]
    windows, owner = langid.cut_windows(texts)
    for i, t in enumerate(texts):
        assert b"".join(w[:langid.LENGTH].tobytes() for w in windows[owner == i]).rstrip(b"\0") == t


def test_table_lookups_equal_the_convolution():
    net = langid.train([(b"the of and to", "en"), (b"der die das und", "de")] * 20, epochs=1)
    w = langid.cut_windows([b"the die and das"])[0]
    e = net.embed[w[0]]
    conv = np.array([sum(e[i + k] @ net.conv[k] for k in range(4)) for i in range(langid.LENGTH)])
    assert np.allclose(net.pooled(w, net.tables())[0], conv.max(axis=0), atol=1e-4)


def test_languages_of_held_out_documents(spark):
    got = queries.op1_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (held(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.97


def test_copies_leave_a_language_its_texts(docs_of, monkeypatch):
    rows = [(0, "immer derselbe Satz")] * 6000 + [(i, f"Satz Nummer {i}") for i in range(30)]
    other = [(i, f"sentence number {i}") for i in range(6000)]
    monkeypatch.setattr(langid, "train", lambda sample: sample)
    sample = langid.fit(docs_of(rows, "de").unionByName(docs_of(other, "en")), windows=20)
    assert Counter(lang for _, lang in sample) == {"de": 10, "en": 10} and len(set(sample)) == 20


def test_language_edge_cases(docs_of):
    train = [(t.encode(), lang) for t, lang in [("the cat and the dog", "en"), ("der Hund und die Katze", "de")] for _ in range(30)]
    net = langid.train(train)
    rows = [(1, None), (2, ""), (3, "12 %%"), (4, "the dog"), (None, "die Katze und der Hund"), (6, "the dog and the cat " * 20_000), (4, "the dog")]
    docs = docs_of(rows).withColumn("score", F.lit("clash"))
    got = langid.identify(docs, net, docs.columns).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 7 and all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3))
    assert by[4]["lang_pred"] == by[6]["lang_pred"] == "en" and by[None]["lang_pred"] == "de"
    assert {r["lang_pred"] for r in langid.identify(docs, langid.fit(docs.limit(0)), ["doc_id"]).collect()} == {"und"}
    assert langid.identify(docs.limit(0), net, ["doc_id"]).count() == 0
    assert langid.keep_known(docs, net).columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in langid.keep_known(docs, net).collect()) == ["4", "4", "6", "None"]


def plain_scores(rows, held_out):
    """The suffix tree with dictionaries, straight from its definition."""
    toks = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    train = [t for t, (i, _) in zip(toks, rows) if not held_out(i)]
    one, two, three = Counter(), Counter(), Counter()
    for t in train:
        one.update(t), two.update(zip(t, t[1:])), three.update(zip(t, t[1:], t[2:]))
    n, v = sum(one.values()), len(one)
    p0 = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))
    gain1, gain2 = {}, {}
    for t in train:
        for a, b in zip(t, t[1:]):
            if one[a] >= suffixtree.LEAST_ONE:
                own = (two[a, b] - 1) / (one[a] - 1)
                gain1.setdefault(a, []).append([math.log(s * own / p0(b) + 1 - s) for s in suffixtree.SHARES])
    best = lambda g, c: (lambda tot: suffixtree.SHARES[tot.argmax()] if tot.max() / c >= suffixtree.GAIN else 0.0)(np.array(g).sum(axis=0))
    share1 = {a: best(g, one[a]) for a, g in gain1.items()}
    p1 = lambda a, b: (lambda s: s * two[a, b] / max(one[a], 1) + (1 - s) * p0(b))(share1.get(a, 0.0))
    fits = lambda a, b: two[a, b] >= suffixtree.LEAST_TWO
    for t in train:
        for a, b, c in zip(t, t[1:], t[2:]):
            if fits(a, b) and share1.get(b, 0) > 0:
                own = (three[a, b, c] - 1) / (two[a, b] - 1)
                gain2.setdefault((a, b), []).append([math.log(s * own / p1(b, c) + 1 - s) for s in suffixtree.SHARES])
    share2 = {k: best(g, two[k]) for k, g in gain2.items()}
    out = []
    for (i, _), t in zip(rows, toks):
        base = score = 0.0
        for k, w in enumerate(t):
            p = p0(w) if k == 0 else p1(t[k - 1], w)
            if k > 1 and (s := share2.get((t[k - 2], t[k - 1]), 0.0)):
                p = s * three[t[k - 2], t[k - 1], w] / two[t[k - 2], t[k - 1]] + (1 - s) * p
            base, score = base + math.log10(p0(w)), score + math.log10(p)
        out.append((i, held_out(i), len(t), sum(one[w] > 0 for w in t), n, base, score))
    return out, sum(x > 0 for x in share1.values()), sum(x > 0 for x in share2.values())


def lm_rows():
    rng = np.random.default_rng(9)
    common, odd = [f"w{i}" for i in range(30)], "the Red fox jumps over of the lazy dog".split()
    rows = []
    for i in range(160):
        words = list(rng.choice(common, rng.integers(1, 60)))
        at = int(rng.integers(0, len(words)))
        rows.append((i, " ".join([*words[:at], *odd, *words[at:], "of", "a", "x" if i % 2 else "the", "y" if i % 2 else "z"])))
    return [*rows, (500, None), (501, ""), (502, " \t\n"), (None, "the Red fox"), (7, rows[7][1]), (503, "w1 " * 9000)]


@pytest.mark.parametrize("chunk_bytes", [20_000_000, 3000])
def test_suffix_tree_by_hand(docs_of, chunk_bytes):
    rows = lm_rows()
    want, states1, states2 = plain_scores(rows, lambda i: i is not None and held(i, 5) == 1)
    assert states1 and states2
    docs = docs_of(rows).withColumn("held", F.lit("clash"))
    got = suffixtree.score_texts(docs, queries.crc_bucket(F.col("doc_id"), 5) == 1, chunk_bytes).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(g[:5]) == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-6), (g, w)


def test_scores_of_nothing(docs_of):
    docs = docs_of([(1, "a b"), (2, None)])
    assert suffixtree.score_texts(docs.limit(0), F.lit(False)).count() == 0
    got = suffixtree.score_texts(docs, F.lit(True)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    assert all(r["score"] == r["base_score"] == 0 for r in got)  # one symbol, the unseen one, has all the mass


def test_contexts_help_on_held_out_documents(spark):
    got = queries.op6_lm_score(spark, SF).where("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s"), F.count("*").alias("n")).first()
    assert got["n"] > 100 and got["b"] < got["s"] < 0


def test_block_max_search_is_exact():
    rng = np.random.default_rng(10)
    vectors = []
    for _ in range(300):
        t = np.sort(rng.choice(80, rng.integers(1, 9), replace=False))
        w = rng.random(len(t))
        vectors.append((t, w / np.sqrt((w * w).sum())))
    index = toxicity.BlockMaxIndex.build(vectors, 80)
    full = np.zeros((300, 80))
    for i, (t, w) in enumerate(vectors):
        full[i, t] = w
    asked = list(range(0, 300, 7))
    got, share = index.top([vectors[i] for i in asked], 6, asked)
    for i, (name, cosine) in zip(asked, got):
        s = full @ full[i]
        s[i] = 0
        want = [j for j in np.lexsort((np.arange(300), -np.round(s, 12)))[:6] if s[j] > 0]
        assert np.allclose(cosine, s[want]) and sorted(np.round(s[name], 12)) == sorted(np.round(s[want], 12))
    assert len(index.top([(np.zeros(0, np.int64), np.zeros(0))], 6)[0][0][0]) == 0 and index.top([], 6) == ([], 0.0) and 0 < share <= 1


def test_blocks_of_alike_examples_are_skipped():
    rng = np.random.default_rng(12)
    rows = [(np.sort(rng.choice(20, 8, replace=False)) + 20 * (i % 8), np.full(8, 8 ** -0.5)) for i in range(1024)]  # eight languages
    dense = np.zeros((1024, 160))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    order = toxicity.alike_order(dense, toxicity.BLOCK)
    assert sorted(order.tolist()) == list(range(1024))
    rows = [rows[i] for i in order.tolist()]
    got, share = toxicity.BlockMaxIndex.build(rows, 160).top(rows[:200], 5)
    assert share < 0.3 and all(len(name) == 5 for name, _ in got)


def test_neighbours_are_the_nearest_by_plain_tf_idf(docs_of, spark):
    rng = np.random.default_rng(13)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(3, 40))))) for i in range(150)]
    labels = spark.createDataFrame([(i, i % 3 % 2) for i in range(100)], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(rows), labels)
    bags = [Counter(t.split()) for _, t in rows]
    df = Counter(w for b in bags for w in b)
    held = {w for b in bags[:100] for w in b}
    weigh = lambda b: {w: (1 + math.log(n)) * (math.log(151 / (1 + df[w])) + 1) for w, n in b.items() if w in held}
    vectors = [weigh(b) for b in bags]
    cosine = lambda a, b: sum(x * b.get(w, 0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    got = {r["doc_id"]: r["evidence"] for r in toxicity.judge(docs_of(rows), model, ["doc_id"]).collect()}
    for i in range(0, 150, 5):
        want = sorted((-round(cosine(vectors[i], vectors[j]), 9) for j in range(100)))[:toxicity.NEIGHBOURS]
        assert [-round(e["cosine"], 9) for e in got[i]] == want
        for e in got[i]:
            assert round(cosine(vectors[i], vectors[e["doc_id"]]), 9) == round(e["cosine"], 9) and e["toxic"] == e["doc_id"] % 3 % 2
            assert (e["term"] in bags[i] and e["term"] in bags[e["doc_id"]]) if e["toxic"] else e["term"] is None


def test_rising_fit():
    x, y = toxicity.rising_fit(np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 0, 1.0]), np.ones(5))
    assert (np.diff(y) >= 0).all() and y[0] == 0 and y[-1] == 1


def test_toxic_documents_are_found(docs_of, spark):
    rng = np.random.default_rng(11)
    words = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(400):
        text = list(rng.choice(words, 40))
        if i % 8 == 0:
            text += ["grumpf", f"vexel{chr(97 + i % 26)}"]
        rows.append((i, " ".join(text)))
    rows += [(900, None), (901, ""), (None, "grumpf"), (902, "grumpf vexelo " * 9000), (903, rows[1][1])]
    docs = docs_of(rows).withColumn("evidence", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(0, 400)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    known = docs.where(F.col("doc_id") % 3 != 0)
    got = toxicity.judge(docs, toxicity.fit(known, labels), ["doc_id"]).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    out = [i for i in range(0, 400, 3)]
    assert all((by[i] >= 0.3) == (i % 8 == 0) for i in out)
    assert by[902] >= 0.3 and by[None] >= 0.3 and max(by[900], by[901], by[903]) < 0.3
    assert {r["score"] for r in toxicity.judge(docs, toxicity.fit(known.limit(0), labels), ["doc_id"]).collect()} == {0.0}
    one = toxicity.fit(known, labels.where("toxic = 0"))
    assert {r["score"] for r in toxicity.judge(docs, one, ["doc_id"]).collect()} == {0.0}
    assert toxicity.judge(docs.limit(0), one, ["doc_id"]).count() == 0


def test_rare_words_are_evidence_and_all_documents_count(docs_of, spark):
    rows = [(i, f"{i} plain words here" + (" zwirbel" if i == 1 else "")) for i in range(20)]
    rows += [(100 + i, "plain words there") for i in range(30)]  # without a label
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(20)], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(rows), labels)
    assert {"zwirbel", "plain", "words", "here"} <= set(model.terms) and "there" not in model.terms
    for word, df in (("zwirbel", 1), ("here", 20), ("plain", 50)):
        assert model.idf[model.terms[word]] == pytest.approx(math.log(51 / (1 + df)) + 1)
    got = toxicity.judge(docs_of([(1, "Zwirbel!"), (2, "nothing")]), model, ["doc_id"]).collect()
    assert {r["doc_id"]: [e["doc_id"] for e in r["evidence"]] for r in got} == {1: [1], 2: []}


def test_more_languages_than_usual_are_all_learned(docs_of, spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k * 3 + i, f"{letters[k % 26]}{letters[k // 26]}" * 40 + f" {i}", "s") for k in range(300) for i in range(3)]
    docs = docs_of(rows).withColumn("lang", F.concat(F.lit("l"), F.floor(F.col("doc_id") / 3).cast("string")))
    net = langid.fit(docs, windows=900)
    assert len(net.langs) == 300 and len(langid.fit(docs, windows=120).langs) == 120
