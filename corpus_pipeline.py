"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Language ID, line dedup, SimHash near-dedup, mixing to target weights, and
best-fit packing. Every stage works on all rows its predecessor kept; all
but the last return the columns they were given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import langid, lines, mixing, packing, simhash
from feedlens.llm.common import materialize, table

SHINGLE, BITS = 4, 4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts and texts without a letter. lang keeps the given label."""
    known = docs.where(F.coalesce(~langid.held_out(F.col("doc_id")), F.lit(True)))
    return langid.keep_known(docs, langid.fit(known))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows leave the texts; every document stays."""
    return lines.dedup_lines(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one of the smallest doc_id (null after all ids), and of rows
    that share it the first by a hash of the text.

    Null and empty texts have fingerprint zero and count as copies of each other; repeated
    rows are copies; an empty table gives an empty one; columns of any name are kept."""
    return simhash.keep_one(docs, SHINGLE, BITS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to 2 times.

    Null and empty texts have no words and are never taken; null sources are one source; which of equal rows is
    taken is all the same, others are chosen by a seeded hash; an empty table gives
    an empty one; columns of any name are kept."""
    return mixing.repeat(mixing.mix(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the packed sequences.

    Null and empty texts are a piece of the end id alone; repeated rows and null doc_ids are packed like any other;
    texts above 2048 tokens are cut; an empty table gives no pieces; other columns are left out."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", pack),
]

#: Language ID, the SimHash fingerprints and the seeded choice of the mix have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
