import re
import zlib
from collections import Counter

import numpy as np
import pytest

from feedlens.llm import queries, spelling
from feedlens.llm.common import table

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def plain_words(docs, least, times, every):
    total = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= times}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def plain_variants(words, ratio=5):
    """By deletion neighbourhoods: words one apart share the word less one letter, or one is the other less one."""
    less = {}
    for w in words:
        for k in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            less.setdefault(k, set()).add(w)
    near = {w: set() for w in words}
    for group in less.values():
        for a in group:
            near[a] |= {b for b in group if one_apart(a, b)}
    form = {}
    for w, ns in near.items():
        best = min(ns, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words[form[w]] if form[w] else None, root))
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_variants_match_brute_force(spark, block):
    rng = np.random.default_rng(3)
    stems = ["".join(rng.choice(list("abcé"), int(rng.integers(4, 10)))) for _ in range(40)]
    texts = [" ".join(str(s).capitalize() for s in rng.choice(stems, 400)) + " ünïcode-Straße ÀÀÀÀÀÀ 漢字漢字漢字 ×÷×÷×÷" for _ in range(30)]
    texts += [" ".join(s[:i] + c + s[i + 1:] for s in stems for i in range(len(s)) for c in "ab"), None, "", "12 %", "aaaaaa " * 70_000, "z" * 30_000]
    docs = list(enumerate(texts)) + [(None, texts[0]), (7, texts[1]), (7, texts[1])] + [(900 + i, "y" * 3000 + "x" * (i % 2)) for i in range(12)]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, word string, n long")
    got = spelling.variants(df, least=4, times=2, ratio=2, every=7, block=block)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    want = plain_variants(plain_words(docs, 4, 2, 7), 2)
    assert sorted(map(tuple, got.collect())) == want and any(r[3] for r in want) and any(r[5] not in (r[0], r[3]) for r in want)
    assert spelling.variants(df.limit(0)).count() == 0


def test_query_matches_brute_force(spark):
    got = queries.op12_spelling_variants(spark, SF)
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect())) == plain_variants(plain_words(docs, 6, 5, 199))


def test_index_tracks_all_one_error_sets():
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("ab"), int(n))) for n in rng.integers(1, 9, 300)})
    index = spelling.PositionIndex(words)
    for m in {len(w) for w in words}:
        own = [w for w in words if len(w) == m]
        q, w = index.near(own, True, True, True)
        got = {(own[a], words[b]) for a, b in zip(q.tolist(), w.tolist())}
        assert got == {(a, b) for a in own for b in words if one_apart(a, b)}


def test_tiles_change_nothing(spark, monkeypatch):
    words = spark.createDataFrame([(f"{a}{b}{c}", i) for i, (a, b, c) in enumerate((a, b, c) for a in "abcd" for b in "efgh" for c in "ijkl")], "word string, n long")
    whole = sorted(map(tuple, spelling.near_words(words).collect()))
    monkeypatch.setattr(spelling, "TOGETHER", 5)
    monkeypatch.setattr(spelling, "LETTERS", 20)
    monkeypatch.setattr(spelling, "PIECE", 3)
    assert sorted(map(tuple, spelling.near_words(words).collect())) == whole and len(whole) == 64


def test_chains_end_and_long_chains_double(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)], "word string, form string")
    assert {r["root"] for r in spelling.roots(forms).collect()} == {"w37"}
    with pytest.raises(ValueError, match="twice"):
        spelling.variants(forms, ratio=1)
