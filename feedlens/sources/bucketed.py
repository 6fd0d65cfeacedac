"""Keyed tables stored in buckets of their key: merges that never shuffle the stored rows.

A table is a Spark catalog table with a folder per bucket, and in it the files
of that bucket. Spark reads them as already partitioned by the key, so a
batch is shuffled to the stored rows' places and joined bucket by bucket.
Only the buckets a batch has keys of are read, joined and rewritten."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators.merge import FIRST_ORD, LAST_ORD, MergeRules, combine, first_wins

BUCKET = "_bucket"


class BucketedTable:
    """A table ``name`` (of the session's catalog) under ``path`` on shared storage, in ``buckets`` buckets of ``key``.

    ``buckets`` should be a multiple of the tasks a merge is to use. A key
    is one column at least; rows with equal keys are in one bucket, so it holds a key's rows and
    no more: keyed tables have one row per key."""

    def __init__(self, spark: SparkSession, name: str, path: str, key: list[str], buckets: int):
        self.spark, self.name, self.path, self.key, self.buckets = spark, name, path.rstrip("/"), list(key), buckets

    def bucket(self) -> Column:
        """The bucket of a row, as Spark numbers it."""
        return F.pmod(F.hash(*self.key), F.lit(self.buckets))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def open(self) -> bool:
        """Names the table in this session if its files are there, and finishes a rewrite that was cut off; whether there is one."""
        if not self.exists():
            try:
                schema = self.spark.read.parquet(self.path).drop(BUCKET).schema
            except AnalysisException as e:
                if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
                return False
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            keys = ", ".join(f"`{k}`" for k in self.key)
            self.spark.sql(f"CREATE TABLE {self.name} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                           f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
            self.spark.catalog.recoverPartitions(self.name)
        pending = self._pending()
        if pending is not None:
            self._replace(pending)
        return True

    def create(self, rows: DataFrame) -> None:
        """The table from ``rows``, one per key."""
        (rows.withColumn(BUCKET, self.bucket()).repartition(self.buckets, *self.key).write.format("parquet").mode("overwrite")
         .partitionBy(BUCKET).bucketBy(self.buckets, *self.key).option("path", self.path).saveAsTable(self.name))

    def read(self, touched: list[int] | None = None) -> DataFrame:
        """The rows, or those of some buckets: others' folders are not listed for reading."""
        rows = self.spark.table(self.name)
        return (rows if touched is None else rows.where(F.col(BUCKET).isin(touched))).drop(BUCKET)

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of a batch's keys: at most as many numbers as the table has buckets."""
        return sorted(r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect())

    # ---- merges ---------------------------------------------------------------------
    def merged(self, batch: DataFrame, rules: MergeRules, touched: list[int]) -> DataFrame:
        """The rows of the touched buckets after ``batch``, by ``rules`` on the rows' ordinals, as ``merge.upsert`` has them."""
        new = combine(batch, rules)
        t, b = self.read(touched).alias("t"), new.select(*[F.col(c).alias(f"b_{c}") for c in new.columns])
        joined = t.join(b, [F.col(f"t.{k}") == F.col(f"b_{k}") for k in self.key], "full_outer")
        none = F.col(f"t.{LAST_ORD}").isNull()
        later = F.coalesce(F.col(f"b_{LAST_ORD}") > F.col(f"t.{LAST_ORD}"), none)
        earlier = F.coalesce(F.col(f"b_{FIRST_ORD}") < F.col(f"t.{FIRST_ORD}"), none)
        last_of = {*rules.latest, rules.last_seen, LAST_ORD}

        def column(c: str) -> Column:
            if c in self.key:
                return F.coalesce(F.col(f"t.{c}"), F.col(f"b_{c}")).alias(c)
            return F.when(later if c in last_of else earlier, F.col(f"b_{c}")).otherwise(F.col(f"t.{c}")).alias(c)

        return joined.select(*[column(c) for c in self.read().columns])

    def upsert(self, batch: DataFrame, rules: MergeRules) -> list[int]:
        """Merges a batch (with ordinals) and rewrites the buckets it touches; which ones.

        The new buckets are first written whole beside the table and then take the old ones'
        places; ``open`` does the second step again if it was cut off."""
        if not self.open():
            self.create(combine(batch, rules))
            return list(range(self.buckets))
        touched = self.touched(batch)
        if touched:
            done = f"{self.path}__pending"
            self.merged(batch, rules, touched).withColumn(BUCKET, self.bucket()).write.mode("overwrite").parquet(done)
            self._replace(self.spark.read.parquet(done))
        return touched

    def absent(self, batch: DataFrame, order: Column | str, touched: list[int]) -> DataFrame:
        """The batch's rows, the first in ``order`` of each key, whose keys the table lacks."""
        return first_wins(batch, self.key, order).join(self.read(touched).select(*self.key), self.key, "left_anti")

    def insert_if_absent(self, batch: DataFrame, order: Column | str) -> list[int]:
        """Adds the batch's new keys as further files of their buckets; nothing stored is rewritten. Which buckets were read."""
        if not self.open():
            self.create(first_wins(batch, self.key, order))
            return list(range(self.buckets))
        touched = self.touched(batch)
        if touched:
            new = self.absent(batch, order, touched).select(*self.read().columns).withColumn(BUCKET, self.bucket())
            new.repartition(self.buckets, *self.key).write.insertInto(self.name)
        return touched

    # ---- replacing buckets ------------------------------------------------------------
    def _pending(self) -> DataFrame | None:
        """The buckets of a rewrite that ended before its mark was removed."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}__pending/_SUCCESS")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.parquet(f"{self.path}__pending")

    def _replace(self, rows: DataFrame) -> None:
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "dynamic")  # only the buckets that rows have are replaced
        try:
            (rows.select(*self.read().columns, F.col(BUCKET).cast("int").alias(BUCKET)).repartition(self.buckets, *self.key)
             .write.insertInto(self.name, overwrite=True))
        finally:
            self.spark.conf.set(key, before)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}__pending/_SUCCESS")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, False)
        self.spark.catalog.refreshTable(self.name)
