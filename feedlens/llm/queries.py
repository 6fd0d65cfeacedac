"""The registered queries of the training-data operators: opN_<name>(spark, sf_dir) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import (balltree, chatformat, crosspoly, langid, lexical, lines, mixing, packing, simhash, spelling, suffixtree, toxicity,
                          urlfilter)
from feedlens.llm.common import crc_bucket, table
from feedlens.llm.vectors import finite

QueryFn = Callable[[SparkSession, str], DataFrame]

SHINGLE, BITS = 4, 4
#: (verdict, host, path)
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.held_out(F.col("doc_id")))
    return langid.identify(docs, langid.fit(docs.where("not held_out")), ["doc_id", "held_out"])


EVERY, TOP = 50, 5


def op2_cross_polytope_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return crosspoly.nearest(rows, F.col("vec_id") % EVERY == 0, TOP)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE, BITS)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffixtree.score_texts(docs, crc_bucket(F.col("doc_id"), 5) == 1)


#: A text is predicted toxic from this score on.
TOXIC_FROM = 0.3


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", crc_bucket(F.col("doc_id"), 4) == 2)
    model = toxicity.fit(docs.where("not held_out"), table(spark, sf_dir, "labels"))
    rows = toxicity.judge(docs, model, ["doc_id", "held_out"])
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "evidence")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(finite(F.col("embedding")))
    rows = rows.select("vec_id", balltree.quantize(F.col("embedding")).alias("vec"))
    return balltree.top_products(rows, F.col("vec_id") % EVERY == 0, TOP)


#: A conversation whose texts hold the template's own control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    done = chatformat.format_conversations(given.unionByName(added))
    back = done.withColumn("turns", chatformat.read_turns(F.col("formatted"))).withColumn("trained", chatformat.trained_text(F.col("segments")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid", "first_bad", "ended")


def chat_oracle() -> str:
    """The same digests in SQL, from the texts as given; lengths from the template's strings and the escapes' number."""
    t = chatformat.INSTRUCT
    sql = lambda s: "'" + s.replace("'", "''") + "'"
    held = lambda c: " + ".join([f"(length({c}) - length(replace({c}, chr(92), '')))"] + [
        f"(length({c}) - length(replace({c}, {sql(x)}, ''))) // {len(x)}" for x in t.controls])
    around = " ".join(f"WHEN {sql(n)} THEN {len(r.open) + len(r.close)}" for n, r in t.roles.items())
    trained = ", ".join(sql(n) for n, r in t.roles.items() if r.loss)
    arcs = " OR ".join(f"state = {sql(s)} AND nth {'= 0' if s == chatformat.START else '> 0'} AND role IN ({', '.join(map(sql, to))})" for s, to in t.arcs.items())
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS x FROM conversations
  UNION ALL SELECT -7, 0, 'user', {sql(CONTROL_TEXT)}, 'user', {sql(CONTROL_TEXT)}
  UNION ALL SELECT -7, 1, 'assistant', {sql(CONTROL_TEXT)}, 'assistant', {sql(CONTROL_TEXT)}),
n AS (SELECT *, row_number() OVER w - 1 AS nth, coalesce(lag(role) OVER w, '') AS state FROM c
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r NULLS FIRST, x NULLS FIRST)),
o AS (SELECT *, coalesce({arcs}, false) AS ok,
        CASE role {around} ELSE {sum(map(len, t.other))} + length(role) + {held("role")} END + length(text) + {held("text")} AS chars FROM n)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
  CAST(sum(CASE WHEN role IN ({trained}) THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (WHERE role IN ({trained})), '')) AS loss_sha256,
  CAST({len(t.begin)} + sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(ok) AS valid, min(nth) FILTER (WHERE NOT ok) AS first_bad, arg_max(role, nth) AS ended
FROM o GROUP BY conv_id
"""


#: A document's run loses a letter where this divides its crc32.
NOISE_EVERY = 199


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), every=NOISE_EVERY)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
LEXICAL_ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS terms FROM documents),
d AS (SELECT k, doc_id, len(terms) AS n FROM t WHERE len(terms) > 0),
a AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d),
p AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM t) GROUP BY k, term),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, a GROUP BY term),
s AS (
  SELECT item_id, k, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (k), a GROUP BY item_id, k, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""


#: Integer scores, so SQL gives the same rows.
TOP_K_ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (
        op1_language_id, op2_cross_polytope_ann, op3_simhash_dedup, op4_best_fit_packing, op5_line_dedup, op6_lm_score, op7_toxicity, op8_url_filter, op9_source_mix,
        op10_exact_top_k, op11_chat_format, op12_spelling_variants, op13_lexical_search)}


def oracle_sql() -> dict[str, str]:
    return {"op5_line_dedup": lines.ORACLE, "op8_url_filter": urlfilter.oracle(URL_RULES),
            "op10_exact_top_k": TOP_K_ORACLE, "op11_chat_format": chat_oracle(),
            "op13_lexical_search": LEXICAL_ORACLE}
