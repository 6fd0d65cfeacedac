"""Incremental load of a feed directory with Structured Streaming.

The file source lists new page files, ``maxFilesPerTrigger`` bounds each
micro-batch (10 files, as the reference commits every 10 files), and
``foreachBatch`` writes each batch's rows as deltas: O(batch) work per
micro-batch, nothing stored is rewritten. The streaming checkpoint records
which files were loaded, so a second run over the same directory loads
nothing new. Delta folders are named by the batch id, so a batch replayed
after a failure overwrites its own delta; the merge rules are idempotent.
A load that ends midway is continued by calling it again with the same run
and checkpoint: the batch that failed comes again with the same files, the
finished ones do not.
Deltas are folded into the bases once, when the run ends.

The frames of a batch's tables are built once a load (``pipeline.Delivery``), not
once a batch: each batch is staged at the place that they read, which replaces
what is kept of the batch before.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from feedlens.config import FILES_PER_COMMIT
from feedlens.plans import pipeline
from feedlens.session import shared_scratch
from feedlens.sources.feed import file_name, parse_pages
from feedlens.sources.store import TableStore

PAGES_PER_TASK = 100  # a page holds some 100 events; fewer are not worth a shuffle's start
# A batch's plans make more classes than Spark keeps (spark.sql.codegen.cache.maxEntries, 100), so each batch would compile
# them again, which takes longer than its rows.
SMALL_BATCH = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.adaptive.enabled": "false"}


def page_stream(spark: SparkSession, input_dir: str, max_files: int = FILES_PER_COMMIT,
                glob: str = "*.json") -> DataFrame:
    """Stream of (source_file, value) of a flat folder of page files."""
    r = (spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", max_files))
    return (r.option("pathGlobFilter", glob).load(input_dir)
            .select(file_name().alias("source_file"), "value"))


def incremental_load(spark: SparkSession, input_dir: str, store: TableStore, checkpoint: str, run_id: str,
                     started_at: datetime | None = None, max_files: int = FILES_PER_COMMIT,
                     compact_after: bool = True) -> DataFrame:
    """Load every file not yet seen by ``checkpoint``; returns the ledger row.

    The ledger's numbers come from the batches' own writes (``pipeline.batch_metrics``),
    those of an interrupted load included."""
    started = started_at or pipeline._now()
    pipeline.start_run(spark, store, run_id, started, input_dir)
    pages = parse_pages(page_stream(spark, input_dir, max_files)).drop("value", "errors")
    stage, tasks = shared_scratch(spark, "stream-batch"), -(-max_files // PAGES_PER_TASK)
    deliveries = []

    def load(batch_df: DataFrame, batch_id: int) -> None:
        own = batch_df.sparkSession  # the stream's own copy of the session
        if not deliveries:
            for name, value in SMALL_BATCH.items():
                own.conf.set(name, value)
            spark.createDataFrame([], pages.schema).write.parquet(stage)
            deliveries.append(pipeline.Delivery(own.read.schema(pages.schema).parquet(stage).coalesce(tasks), run_id, started))
        batch_df.coalesce(tasks).write.mode("overwrite").parquet(stage)
        own.catalog.refreshByPath(stage)  # the frames read the new files, and nothing kept of the batch before
        # O(batch): this batch's rows become deltas tagged by the batch id
        deliveries[0].write(own, store, f"{run_id}-b{batch_id}")

    try:
        q = (pages.writeStream
             .foreachBatch(load)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()
    finally:
        for delivery in deliveries:
            delivery.unpersist()
    done = pipeline.finish_run(spark, store, run_id, started, input_dir)
    if compact_after:
        pipeline.compact(store)  # once per run, not per micro-batch
    return done
