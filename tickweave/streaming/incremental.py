"""Incremental load as a Structured Streaming job.

New tick files landing under the raw root are picked up by the tick file
source (sources/tickformat.py; ``maxFilesPerTrigger`` bounds a batch); every
micro-batch decodes and aggregates its files once, merges the bars into the
store (dedup keeps stored bars, so a replayed batch is harmless), then records
the slot outcomes in the catalog. Bars are written before the catalog: a crash
in between only causes a replay, never a slot marked fetched without its bars.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.backfill import ingest_decoded
from ..session import ensure_utc
from ..sources.tickformat import last_mark, tick_stream


def tick_file_stream(spark: SparkSession, raw_root: str, checkpoint_location: str, max_files_per_trigger: int = 1000,
                     pairs: list[str] | None = None, settle_seconds: float = 2) -> DataFrame:
    """Decoded rows of the files that land under ``raw_root``."""
    reader = tick_stream(spark).option("maxFilesPerTrigger", max_files_per_trigger).option("checkpoint", checkpoint_location)
    reader = reader.option("settleSeconds", settle_seconds)
    return (reader.option("pairs", ",".join(pairs)) if pairs else reader).load(raw_root)


def make_batch_handler(spark: SparkSession, store_root: str, catalog_path: str | None,
                       knowledge_time: dt.datetime | None, pairs: list[str] | None = None,
                       landing_log: DataFrame | None = None):
    """foreachBatch body: the batch ingest (decode once, merge, then catalog).
    The batch's content is read by the decode alone; all else reads the decoded
    copy. A file that landed again for a slot with an entry is left to a retry
    by the batch ingest. Of the landing log only attempts without a file count
    here: a file that landed may belong to a later batch."""
    if landing_log is not None:
        empty = F.coalesce(F.col("n_bytes"), F.lit(1)) == 0 if "n_bytes" in landing_log.columns else F.lit(False)
        landing_log = landing_log.where((F.col("http_status") != 200) | empty)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        ingest_decoded(spark, batch, store_root, catalog_path, knowledge_time, pairs, landing_log=landing_log, skip_known=True)

    return handle


def incremental_load(
    spark: SparkSession,
    raw_root: str,
    store_root: str,
    checkpoint_location: str,
    catalog_path: str | None = None,
    knowledge_time: dt.datetime | None = None,
    max_files_per_trigger: int = 1000,
    available_now: bool = True,
    pairs: list[str] | None = None,
    trigger_interval: str = "1 minute",
    landing_log: DataFrame | None = None,
):
    """Start the incremental load; with ``available_now`` it processes every
    file present, ``max_files_per_trigger`` at a time, and stops (use a
    processing-time trigger for a service). ``landing_log`` is read anew by
    each batch."""
    ensure_utc(spark)
    # what is there when the load is asked for counts as landed
    stream = tick_file_stream(spark, raw_root, checkpoint_location, max_files_per_trigger, pairs, 0 if available_now else 2)
    handle = make_batch_handler(spark, store_root, catalog_path, knowledge_time, pairs=pairs, landing_log=landing_log)
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_location)
    if not available_now:
        return writer.trigger(processingTime=trigger_interval).start()
    while True:  # Spark asks a source once for all that is available: each run takes one batch
        before = last_mark(checkpoint_location)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        if last_mark(checkpoint_location) == before:
            return query
