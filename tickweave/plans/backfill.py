"""The reference's entry points as Spark plans.

* ``plan_worklist`` — what a backfill run would fetch next (quota per pair,
  newest pending or error slots, interleaved, with URL and landing path).
* ``ingest_files`` / ``ingest`` — landed files -> bars merged into the store
  -> slot outcomes upserted into the catalog (the batch form of I1).
* ``status_report`` / ``save_qa_report`` — the status and validation outputs.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hourmaps as H
from ..operators import slots as S
from ..operators.daytable import kept_days, refresh_days
from ..operators.quality import pair_summary, qa_report, qa_report_document, report_of
from ..operators.status import pair_status, status_rollup
from ..session import ensure_utc, load_time, path_exists, ts_lit, written
from ..sources.barstore import partition_filter, read_store
from ..sources.catalog import read_catalog, write_catalog
from ..sources.instruments import BASE_URL, DEFAULT_SOURCE, instruments
from ..sources.tickfiles import decode_tick_files, list_tick_files, no_tick_files
from ..sources.tickformat import decode_listed
from .load import aggregated, bars_of, outcomes_of, slot_outcome
from .merge import MergeResult, merge_bars


def plan_worklist(
    spark: SparkSession,
    catalog: DataFrame,
    as_of: dt.datetime,
    pairs: list[str] | None = None,
    max_hours: int | None = None,
    retry_errors: bool = False,
    start: dt.datetime = S.TARGET_START,
    raw_root: str = "raw",
    base_url: str = BASE_URL,
    maps: DataFrame | None = None,
) -> DataFrame:
    """E5 + E4/F3 + E7 + A3: the slots a run would fetch, in fetch order.
    Pending slots come from the catalog's hour maps (``read_hour_maps``, or made
    from ``catalog`` here); the catalog itself is read for errors only."""
    ensure_utc(spark)
    inst = instruments(spark, pairs)
    limit = S.DEFAULT_MAX_HOURS if max_hours is None else max_hours
    quota = S.pair_quota(inst, limit)
    if retry_errors:
        batch = S.error_batch(catalog, quota, limit)
    else:
        batch = H.next_batch(spark, H.slot_maps(catalog) if maps is None else maps, as_of, quota, limit, start, pairs)
    manifest = S.download_manifest(batch, raw_root, base_url)
    return S.worklist(batch).join(manifest, S.SLOT_KEY, "left")


@dataclass
class IngestResult:
    merge: MergeResult
    slots: int                  # slots attempted: by a landed file or the landing log
    errors: int                 # of them
    files: int = 0              # files decoded
    skipped: int = 0            # landed files left alone: their slot is in the catalog, or their path names none
    unplaced: int = 0           # files whose path names no slot (listed in ``outcomes``)
    trailing: int = 0           # files with bytes after their last whole record
    outcomes: DataFrame | None = None  # one row per decoded file


def _catalogued(spark: SparkSession, catalog_path: str, fetched_only: bool = False) -> DataFrame:
    """Slots that the catalog has, whatever came of them; or those fetched."""
    where = F.col("status") == "fetched" if fetched_only else None
    return read_catalog(spark, catalog_path, where).select(*S.SLOT_KEY)


def _without(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """``rows`` (pair, slot, ...) whose slot is not among ``slots`` (SLOT_KEY)."""
    parts = [p for p in S.slot_parts("slot")]
    return rows.select("*", *parts).join(slots, S.SLOT_KEY, "left_anti").drop(*S.SLOT_KEY[1:])


def _record(spark: SparkSession, outcomes: DataFrame, catalog_path: str, stamp: dt.datetime) -> None:
    """Upsert slot outcomes (a written table: pair, slot, status). Only the
    (pair, year) partitions that they touch are read and rewritten."""
    updates = outcomes.select("pair", *S.slot_parts("slot"), "status", ts_lit(stamp).alias("fetched_at"), F.lit(1).alias("update_seq"))
    touched = [(r["pair"], int(r["year"])) for r in updates.select("pair", "year").distinct().collect()]
    if touched:
        current = read_catalog(spark, catalog_path, partition_filter(touched))
        # cut lineage before overwriting the partitions this plan reads
        write_catalog(written(S.catalog_upsert(current, updates), "catalog-upsert"), catalog_path)


def ingest_files(
    spark: SparkSession,
    files: DataFrame,
    store_root: str,
    catalog_path: str | None,
    knowledge_time: dt.datetime | None = None,
    pairs: list[str] | None = None,
    source: str = DEFAULT_SOURCE,
    landing_log: DataFrame | None = None,
) -> IngestResult:
    """``ingest_decoded`` over files at hand (path, length, content, pair, slot)."""
    return ingest_decoded(spark, decode_tick_files(files), store_root, catalog_path, knowledge_time, pairs, source, landing_log)


def ingest_decoded(
    spark: SparkSession,
    decoded: DataFrame,
    store_root: str,
    catalog_path: str | None,
    knowledge_time: dt.datetime | None = None,
    pairs: list[str] | None = None,
    source: str = DEFAULT_SOURCE,
    landing_log: DataFrame | None = None,
    skip_known: bool = False,
) -> IngestResult:
    """Read ``decoded`` files once, merge the bars, then upsert one catalog row
    per attempted slot (A11). ``skip_known`` leaves alone files of slots that
    the catalog has, whatever came of them.

    The landing log (pair, slot, http_status, optional n_bytes) carries the
    attempts that left no file: missing hours and empty bodies become no_data,
    failed downloads error. Slots the catalog has as fetched are not
    downgraded by it. The decoded aggregate is written once to the shared
    folder and everything else reads that copy. Bars are written before the
    catalog; the whole batch has one load time.
    """
    ensure_utc(spark)
    stamp = load_time(knowledge_time)
    inst = instruments(spark, pairs)
    combined = written(aggregated(decoded, inst, source), "decoded")
    if skip_known and catalog_path is not None:
        combined = _without(combined, _catalogued(spark, catalog_path))
    outcomes = outcomes_of(combined)
    res = merge_bars(spark, bars_of(combined).drop("n_ticks"), store_root, stamp)
    placed = outcomes.where(F.col("slot").isNotNull())
    attempted = placed.select("pair", "slot")
    log = landing_log
    if log is not None:
        if pairs:
            log = log.where(F.col("pair").isin(list(pairs)))
        if catalog_path is not None:
            log = _without(log, _catalogued(spark, catalog_path, fetched_only=True))
        attempted = attempted.unionByName(log.select("pair", "slot"))
    bad = placed.where(F.col("error").isNotNull()).select("pair", "slot", "error")
    slots = slot_outcome(attempted.distinct(), placed.select("pair", "slot", "length"), bad, log)
    slots = written(slots.where(F.col("status").isNotNull()).select("pair", "slot", "status"), "slot-outcomes")
    n = slots.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "error").alias("e")).first()
    f = outcomes.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("slot").isNull()).alias("u"), F.count_if(F.col("trailing") > 0).alias("t")).first()
    if catalog_path is not None:
        _record(spark, slots, catalog_path, stamp)
    return IngestResult(res, int(n["n"]), int(n["e"]), int(f["n"]), 0, int(f["u"]), int(f["t"]), outcomes)


def ingest(
    spark: SparkSession,
    raw_root: str,
    store_root: str,
    catalog_path: str | None = None,
    knowledge_time: dt.datetime | None = None,
    pairs: list[str] | None = None,
    landing_log: DataFrame | None = None,
    retry_errors: bool = False,
) -> IngestResult:
    """Batch load of the landed files under ``raw_root`` whose slot the catalog
    does not have yet, whatever came of it; with ``retry_errors`` also of those
    that it does not have as fetched. Files whose path names no slot can never
    be recorded: they are read (to be reported) only by a first ingest, when
    there is no catalog, and on a retry.

    The listing is compared with the catalog before any content is read. What
    is left is one table of paths, dealt to tasks by bytes and decoded there,
    however many files it has, and merged once."""
    ensure_utc(spark)
    stamp = load_time(knowledge_time)
    listing = list_tick_files(spark, raw_root)
    if pairs:
        listing = listing.where(F.col("pair").isin(list(pairs)))
    known = catalog_path is not None and path_exists(spark, catalog_path)
    if known:
        rows = _without(listing, _catalogued(spark, catalog_path, fetched_only=retry_errors))
        todo = written(rows if retry_errors else rows.where(F.col("slot").isNotNull()), "to-ingest")
        n = listing.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("slot").isNull()).alias("unplaced")).first()
    else:
        todo = written(listing, "to-ingest")
    log = landing_log
    if known and log is not None and not retry_errors:
        log = _without(log, _catalogued(spark, catalog_path))
    out = ingest_decoded(spark, decode_listed(todo), store_root, catalog_path, stamp, pairs, landing_log=log)
    if known:
        out.skipped, out.unplaced = n["n"] - out.files, n["unplaced"]
    return out


def ingest_paths(
    spark: SparkSession,
    paths: list[str],
    store_root: str,
    catalog_path: str | None = None,
    knowledge_time: dt.datetime | None = None,
    landing_log: DataFrame | None = None,
) -> IngestResult | None:
    """Ingest exactly these landed files (a run's worklist, a retry batch):
    no listing of the whole raw tree. The list is bounded by the run's quota;
    paths with no file (never landed) are looked up side by side and left to
    the landing log."""
    from concurrent.futures import ThreadPoolExecutor

    ensure_utc(spark)
    paths = list(dict.fromkeys(paths))
    with ThreadPoolExecutor(16) as pool:
        present = [p for p, there in zip(paths, pool.map(lambda p: path_exists(spark, p), paths)) if there]
    if not present and landing_log is None:
        return None
    files = list_tick_files(spark, present, with_content=True) if present else no_tick_files(spark)
    return ingest_files(spark, files, store_root, catalog_path, knowledge_time, landing_log=landing_log)


def status_report(spark: SparkSession, catalog_path: str, pairs: list[str] | None = None) -> DataFrame:
    """--status: per-pair counts and fetched range plus the totals row."""
    return status_rollup(pair_status(read_catalog(spark, catalog_path), instruments(spark, pairs)))


def validate(spark: SparkSession, store_root: str, pairs: list[str] | None = None) -> DataFrame:
    """--validate: the QA report over the stored bars."""
    return qa_report(read_store(spark, store_root, pairs), instruments(spark, pairs))


def validate_kept(spark: SparkSession, store_root: str, pairs: list[str] | None = None) -> DataFrame:
    """The QA report from the pair-days kept beside the store, which this
    brings up to date first: only days that changed since are read."""
    refresh_days(spark, store_root)
    return report_of(pair_summary(kept_days(spark, store_root)), instruments(spark, pairs))


def save_qa_report(report: DataFrame, path: str, generated_at: dt.datetime | None = None) -> None:
    """The QA report saved as one JSON document (a single text row)."""
    stamp = ts_lit(generated_at) if generated_at is not None else F.current_timestamp()
    iso = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    qa_report_document(report, iso).coalesce(1).write.mode("overwrite").text(path)


def storage_usage(spark: SparkSession, store_root: str | None, raw_root: str | None) -> DataFrame:
    """A10 over the two roots: bar Parquet files and raw tick files (listing
    only — the scans select ``length`` so no file content is read)."""
    from ..operators.status import storage_size

    parts = []
    if store_root:
        parts.append(
            spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(store_root)
            .select(F.lit("bars").alias("kind"), "path", F.col("length").alias("size"))
        )
    if raw_root:
        parts.append(
            list_tick_files(spark, raw_root).select(F.lit("raw").alias("kind"), "path", F.col("length").alias("size"))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return storage_size(out)


def progress_totals(spark: SparkSession, catalog_path: str, store_root: str | None = None,
                    raw_root: str | None = None) -> DataFrame:
    """The progress snapshot's totals: slots processed, fetched, no_data,
    errors (D4's total row) and Parquet / raw MiB (A10), as one row."""
    tot = status_report(spark, catalog_path).where(F.col("is_total")).select(
        F.col("total").alias("slots_processed"), "fetched", "no_data", F.col("error").alias("errors"))
    if not store_root and not raw_root:
        return tot.select("*", F.lit(0.0).alias("parquet_mb"), F.lit(0.0).alias("raw_mb"))
    sizes = storage_usage(spark, store_root, raw_root).select(
        F.when(F.col("kind") == "bars", F.col("mib")).alias("parquet_mb"),
        F.when(F.col("kind") == "raw", F.col("mib")).alias("raw_mb"),
    )
    # fold the one-row totals and the per-kind sizes into a single row
    both = tot.unionByName(sizes, allowMissingColumns=True)
    return both.agg(
        *[F.max(c).alias(c) for c in ("slots_processed", "fetched", "no_data", "errors")],
        *[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in ("parquet_mb", "raw_mb")],
    )
