import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedlens.llm import langid, lines, mixing, packing, queries, simhash, urlfilter

SF = "/root/testdata/sf0.001"
PAGES = [
    (1, "http://a.org/x", '<link rel="canonical" href="https://example.com/en/1">'),
    (2, "http://b.org/y#top", '<META HTTP-EQUIV=refresh content="0; URL=/z">'),
    (3, "https://B.org/z", "<link href='//a.org/x' rel='canonical'>"),
    (4, None, None), (5, "no-scheme.com/en/", "x"), (6, "http://q.org", ""), (6, "http://q.org", ""),
    (7, "http://WWW.Example.com/en/a?b=c://d", None), (8, "http://m.example.com/en/", None), (9, "http://example.com", None),
    (10, "http://notexample.com/en/", None), (11, "http://x.net/fr/", '<link rel=canonical href="http://ok.com/">'),
    (12, "http://alias.org/1", '<link rel=canonical href="http://ok.com/">'), (None, "http://x.net/es/q", None),
    (13, "http://c.org/1", '<link rel="canonical" href="relative/page">'), (14, "http://d.org/" + "p" * 50_000, None),
]
WANT = {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "allow", 10: "allow",
        11: "block", 12: "allow", None: "block", 13: "allow", 14: "allow"}


def test_aliases_rules_and_oracle(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("verdict", F.lit("clash"))
    got = urlfilter.judge(pages, queries.URL_RULES).collect()
    assert len(got) == len(PAGES) and {r["page_id"]: r["verdict"] for r in got} == WANT
    assert {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in got}[7] == ("www.example.com", "/en/a", "www.example.com/en/")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(con.execute(urlfilter.oracle(queries.URL_RULES)).fetchall(), key=key)
    assert urlfilter.judge(pages.limit(0), queries.URL_RULES).count() == 0
    assert {r["verdict"] for r in urlfilter.judge(pages, []).collect()} == {"allow"}


RELATIVE = [
    (1, "http://r.org/a/b/page?q=1", '<link rel=canonical href="../c/./d"><LINK REL="canonical" HREF="http://example.com/en/2">'),  # the second link blocks
    (2, "http://r.org/a/c/d", None), (3, "http://r.org/a/b/other", '<link rel="canonical" href="?q=1"><meta http-equiv="refresh" content="5; url=page?q=1">'),
    (4, "http://r.org", '<link rel=canonical href="deep/../../top">'), (5, "http://r.org/top", '<meta http-equiv=refresh content="0;url=/a/./b/page?q=1">'),
    (6, "http://s.org/x/", '<link rel=canonical href="#top"><link rel=canonical href="mailto:a@example.com"><link rel=canonical href="">'),
    (7, "http://s.org/y/z", '<link rel=canonical href="..">'), (8, "http://s.org/", '<link rel=canonical href="//example.com/en/">'),
    (9, "http://u.org/q", '<link rel=canonical href="q/w/.">'), (10, "http://u.org/q/w/", '<link rel=stylesheet href="http://example.com/en/">'),
    (11, "http://v.org/1", '<link rel=canonical href="2"><link rel=canonical href="3">'), (12, "http://v.org/3", '<link rel=canonical href="http://x.net/fr/">'),
    (13, "http://v.org/2", None), (14, "http://r.org/a/b/other?q=1", None), (15, "http://w.org/k", '<link rel=canonical href="' + "../" * 300 + 'k2">'),
    (16, "http://w.org/k2", '<link rel=canonical href="http://x.net/es/">'),
]


def test_relative_links_and_every_tag_carry_blocks(spark):
    pages = spark.createDataFrame(RELATIVE, "page_id long, url string, html string")
    got = urlfilter.judge(pages, queries.URL_RULES).collect()
    allowed = {6, 9, 10}
    assert {r["page_id"]: r["verdict"] for r in got} == {i: "allow" if i in allowed else "block" for i, *_ in RELATIVE}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", RELATIVE)
    assert sorted(map(tuple, got)) == sorted(con.execute(urlfilter.oracle(queries.URL_RULES)).fetchall())


@pytest.mark.parametrize("page, target, want", [
    ("http://a.org/b/c", "d", "http://a.org/b/d"), ("http://a.org/b/c", "./d/", "http://a.org/b/d/"), ("http://a.org/b/c", "../../../d", "http://a.org/d"),
    ("http://a.org/b/c", "..", "http://a.org/"), ("http://a.org/b/c/", "..", "http://a.org/b/"), ("http://a.org/b/c", "?x#y", "http://a.org/b/c?x"),
    ("http://a.org", "d", "http://a.org/d"), ("http://a.org?x", "d?y", "http://a.org/d?y"), ("http://a.org/b", "/c/../d/.", "http://a.org/d/"),
    ("http://a.org/b", "...", "http://a.org/..."), ("http://a.org/b", "c/.d/..e", "http://a.org/c/.d/..e"), ("http://a.org/b", "//C.org/x", "http://C.org/x"),
    ("http://a.org/b", "HTTPS://c.org/./x", "HTTPS://c.org/./x"), ("http://a.org/b", "tel:1", None), ("http://a.org/b", "  ", None), ("http://a.org/b", "#x", None),
])
def test_references_resolve(spark, page, target, want):
    df = spark.range(1).select(F.lit(page).alias("p"), F.lit(target).alias("t"))
    assert df.select(urlfilter._absolute(F.col("t"), F.col("p")).alias("u")).first()["u"] == want


def test_redirect_table_joins_components(spark):
    pages = spark.createDataFrame([(1, "http://far.org/1", None)], "page_id long, url string, html string")
    hops = spark.createDataFrame([("http://far.org/1", "http://mid.org/"), ("http://mid.org/", "http://example.com/en/z"), (None, "http://x.org/")], "src string, dst string")
    assert urlfilter.judge(pages, queries.URL_RULES, hops).first()["verdict"] == "block"
    assert urlfilter.judge(pages, [*queries.URL_RULES, ("allow", "mid.org", "/")], hops).first()["verdict"] == "allow"


def test_no_python_in_the_url_plan(spark, capsys):
    urlfilter.judge(spark.read.parquet(f"{SF}/pages.parquet"), queries.URL_RULES).explain("formatted")
    assert not any(x in capsys.readouterr().out for x in ("Python", "Pandas", "Arrow"))


def test_stages_and_oracles_are_registered():
    import __spark_entry__
    have = __spark_entry__.queries()
    assert [k for k in have if k.startswith("op")] == list(queries.queries()) and len(queries.queries()) == 13
    assert have["pipeline"] is corpus_pipeline.run and set(queries.oracle_sql()) <= set(have)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "source_mix", "packing"]


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    named = corpus_pipeline.language_id(spark, docs, SF)
    assert named.columns == columns and named.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()
    slim = corpus_pipeline.line_dedup(spark, named, SF)
    con = duckdb.connect()
    con.register("documents", named.toPandas())
    assert slim.columns == columns
    assert sorted((r["doc_id"], r["text"]) for r in slim.collect()) == sorted((r[0], r[3]) for r in con.execute(lines.ORACLE).fetchall())
    one = corpus_pipeline.near_dedup(spark, slim, SF)
    groups = simhash.near_duplicates(slim, 4, 4)
    assert one.columns == columns and sorted(r["doc_id"] for r in one.collect()) == sorted(
        r["component_id"] for r in groups.select("component_id").distinct().collect())
    mixed = corpus_pipeline.source_mix(spark, one, SF)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(one).collect() if r["copies"]}
    assert mixed.columns == columns and {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == copies
    packed = corpus_pipeline.pack(spark, mixed, SF)
    e = packing.Encoder(**packing.default_vocabulary())
    assert packed.agg(F.sum("length")).first()[0] == sum(len(e.ids(r["text"])) + 1 for r in mixed.collect())
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == packed.columns and whole.count() == packed.count()


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_empty_and_odd_documents(spark, docs_of, stage):
    name, f = corpus_pipeline.STAGES[stage]
    docs = docs_of([(None, None, None), (1, "", "a"), (2, "one two\nthree", None), (2, "one two\nthree", None), (3, "%%% 12", "b")])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") == 2, "en"))
    assert f(spark, docs.limit(0), SF).count() == 0
    got = f(spark, docs, SF)
    assert got.count() > 0 and (name == "packing" or got.columns == docs.columns)
    assert langid.UNDETERMINED == "und"
