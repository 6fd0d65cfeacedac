"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.session import shared_scratch

#: A word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder named by ``spark.checkpoint.dir`` and read it back.

    Lineage is cut at a table every executor can read, so a lost executor
    costs at most the tasks it was running. The shuffle files of the write
    are of no more use and go when it ends."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = shared_scratch(spark, f"llm-{name}"), spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names based on ``names`` that no column of ``df`` uses (in any letter case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        new, k = f"_{name}", 0
        while new.lower() in taken:
            k += 1
            new = f"_{name}{k}"
        taken.add(new.lower())
        out.append(new)
    return out


def crc_bucket(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less any column whose name an operator is about to add (in any letter case)."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def null_key(column: Column) -> Column:
    """A non-null text key: equal for equal values, and one of its own for null."""
    return F.when(column.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), column.cast("string")))


def salted_rank(df: DataFrame, group: list[str], order: list[str], bucket: str, rank: str,
                counts: DataFrame, n: str) -> DataFrame:
    """Add ``rank``: the row's number from 0 within ``group``, ordered by (bucket, *order).

    ``group`` and ``bucket`` hold no nulls. ``bucket`` must be a coarse prefix
    of the order (its top bits, say), so a group holding a third of all rows
    is spread over many sorts. ``counts`` is a written table with one row per
    (group, bucket), its row count ``n`` and any further columns, which are
    added too. Rows are shuffled once, on (group, bucket); a bucket starts at
    the running sum of its group's earlier buckets."""
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(n, F.coalesce(F.sum(n).over(before), F.lit(0)))
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group, bucket).orderBy(*order)))
    return (numbered.join(starts, [*group, bucket])
            .withColumn(rank, (F.col(rank) + F.col(n) - 1).cast("long")).drop(n))
