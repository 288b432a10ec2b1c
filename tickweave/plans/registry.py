"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the provided tables (``events``) and derives its input
with the fixture mapping, so its work grows with the tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import market_closed
from ..functions.prices import total_volume
from ..operators import bars as B
from ..session import ensure_utc
from ..sources import fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return fn(spark, sf_dir)

        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        QUERIES[name] = wrapped
        return wrapped

    return deco


# ---------------------------------------------------------------- ticks / bars


def fixture_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.minute_bars(FX.fixture_ordered_ticks(spark, sf_dir))


@register("minute_bars")
def q_minute_bars(spark, sf_dir):
    """D1 (flagship): ticks -> 1-minute OHLCV."""
    return fixture_bars(spark, sf_dir)


@register("tick_prices")
def q_tick_prices(spark, sf_dir):
    """B1 + C3: price scaling with the point-value lookup."""
    return FX.fixture_ticks(spark, sf_dir).select("pair", "slot", F.col("seq").alias("event_id"), "ask", "bid", "mid")


@register("tick_time")
def q_tick_time(spark, sf_dir):
    """B2: hour start + ms."""
    return FX.fixture_ticks(spark, sf_dir).select("pair", "slot", F.col("seq").alias("event_id"), "timestamp")


@register("tick_volume")
def q_tick_volume(spark, sf_dir):
    """Ask + bid volume."""
    return FX.fixture_ticks(spark, sf_dir).select(
        "pair", "slot", F.col("seq").alias("event_id"), total_volume().alias("total_volume")
    )


@register("market_closed")
def q_market_closed(spark, sf_dir):
    """Weekend-closure predicate on every event time."""
    ev = FX.read_table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return ev.select("event_id", ts.alias("ts"), market_closed(ts).alias("closed"))


# ------------------------------------------------- integrity, stamps, hashes


def _batches(spark, sf_dir):
    """(batch 1, batch 2) of the merge fixture: bad bars, then re-deliveries."""
    bars = fixture_bars(spark, sf_dir)
    return FX.bad_bars(bars), FX.duplicate_copies(bars)


@register("bars_valid")
def q_bars_valid(spark, sf_dir):
    """Bars passing the integrity checks."""
    return B.bars_valid(_batches(spark, sf_dir)[0])


@register("bars_rejected")
def q_bars_rejected(spark, sf_dir):
    """Bars failing the integrity checks."""
    return B.bars_rejected(_batches(spark, sf_dir)[0])


@register("stamp_bars")
def q_stamp_bars(spark, sf_dir):
    """Knowledge-time stamp (with the hash it precedes)."""
    return B.stamp_bars(fixture_bars(spark, sf_dir), FX.KNOWLEDGE_TIME_1)


@register("bar_hash")
def q_bar_hash(spark, sf_dir):
    """Content hash per bar."""
    bars = fixture_bars(spark, sf_dir)
    return bars.select("pair", "timestamp", B.bar_hash().alias("bar_hash"))


def _stored_and_new(spark, sf_dir):
    bars = fixture_bars(spark, sf_dir)
    stored = (
        B.stamp_bars(bars, FX.KNOWLEDGE_TIME_1)
        .withColumn("slot", F.lit(None).cast("timestamp"))
        .withColumn("is_new", F.lit(0))
    )
    new = B.stamp_bars(FX.duplicate_copies(bars), FX.KNOWLEDGE_TIME_2).withColumn("is_new", F.lit(1))
    return stored, new


@register("bars_union")
def q_bars_union(spark, sf_dir):
    """G1: stored bars + re-delivered bars, union all by name."""
    stored, new = _stored_and_new(spark, sf_dir)
    return B.union_bars(stored, new)


@register("bars_dedup")
def q_bars_dedup(spark, sf_dir):
    """Keep-first per (pair, timestamp): stored wins over re-delivered."""
    stored, new = _stored_and_new(spark, sf_dir)
    return B.dedup_bars(B.union_bars(stored, new))


# ----------------------------------------------------------------- bar store


def _roundtrip_store(spark, sf_dir) -> str:
    from ..session import scratch_path
    from ..sources.barstore import write_store

    root = scratch_path(spark, "bars")
    write_store(B.stamp_bars(B.bars_valid(fixture_bars(spark, sf_dir)), FX.KNOWLEDGE_TIME_1), root)
    return root


@register("bar_sink_roundtrip")
def q_bar_sink_roundtrip(spark, sf_dir):
    """A5: valid stamped bars written to the partitioned store and read back."""
    from ..sources.barstore import read_store

    return read_store(spark, _roundtrip_store(spark, sf_dir))


@register("pair_filter")
def q_pair_filter(spark, sf_dir):
    """A pair selection pruned to the pair partitions."""
    from ..sources.barstore import read_store

    return read_store(spark, _roundtrip_store(spark, sf_dir), pairs=["EURUSD", "USDJPY"])


@register("bar_scan")
def q_bar_scan(spark, sf_dir):
    """A4: scan of a store built by one merge (batch 1, rejects dropped)."""
    from ..session import scratch_path
    from ..sources.barstore import read_store
    from .merge import merge_bars

    root = scratch_path(spark, "bars")
    merge_bars(spark, _batches(spark, sf_dir)[0], root, FX.KNOWLEDGE_TIME_1)
    return read_store(spark, root)


@register("merge_bars")
def q_merge_bars(spark, sf_dir):
    """Two merges (bad bars, then re-deliveries) and the final store."""
    from ..session import scratch_path
    from ..sources.barstore import read_store
    from .merge import merge_bars

    root = scratch_path(spark, "bars")
    b1, b2 = _batches(spark, sf_dir)
    merge_bars(spark, b1, root, FX.KNOWLEDGE_TIME_1)
    merge_bars(spark, b2, root, FX.KNOWLEDGE_TIME_2)
    return read_store(spark, root)


def _bar_files(spark, sf_dir):
    """The first batch's store as files of one pair and year each."""
    from ..session import scratch_path

    root = scratch_path(spark, "bar-files")
    FX.write_bar_files(QUERIES["bar_scan"](spark, sf_dir), root).write.parquet(f"{root}/_landed")
    return root


@register("bar_files_scan")
def q_bar_files_scan(spark, sf_dir):
    """A4: a store of the other layout (a file per pair and year, nanosecond times)."""
    from ..sources.barfiles import read_bar_files

    return read_bar_files(spark, _bar_files(spark, sf_dir))


@register("bar_files_merge")
def q_bar_files_merge(spark, sf_dir):
    """That store imported, then the re-deliveries merged into it."""
    from ..session import scratch_path
    from ..sources.barfiles import import_bar_files
    from ..sources.barstore import read_store
    from .merge import merge_bars

    root = scratch_path(spark, "bars")
    import_bar_files(spark, _bar_files(spark, sf_dir), root)
    merge_bars(spark, _batches(spark, sf_dir)[1], root, FX.KNOWLEDGE_TIME_2)
    return read_store(spark, root)


# ------------------------------------------------------------- slots/catalog

QUOTA_MAX_HOURS = 100  # parameter of the registered slot queries


def _slot_inputs(spark, sf_dir):
    from ..operators.slots import expected_slots

    start, as_of = FX.fixture_range(spark, sf_dir)
    return expected_slots(spark, as_of, start), FX.fixture_catalog(spark, sf_dir)


def _quota(spark, sf_dir, catalog):
    from ..operators.slots import pair_quota
    from ..sources.instruments import instruments

    pairs = catalog.select("pair").distinct().join(instruments(spark), "pair")
    return pair_quota(pairs, QUOTA_MAX_HOURS)


def _configured_quota(spark):
    from ..operators.slots import pair_quota
    from ..sources.instruments import instruments

    return pair_quota(instruments(spark), QUOTA_MAX_HOURS)


@register("expected_slots")
def q_expected_slots(spark, sf_dir):
    """Open hours of the events' date range, per configured pair."""
    return _slot_inputs(spark, sf_dir)[0]


@register("catalog_scan")
def q_catalog_scan(spark, sf_dir):
    """Catalog written once, scanned with the declared schema."""
    from ..session import scratch_path
    from ..sources.catalog import read_catalog, write_catalog

    path = scratch_path(spark, "catalog")
    write_catalog(FX.fixture_catalog(spark, sf_dir), path)
    return read_catalog(spark, path)


def _hour_maps(spark, sf_dir):
    """Hour maps kept beside the fixture's catalog, and the range to plan."""
    from ..session import scratch_path
    from ..sources.catalog import read_hour_maps, write_catalog

    path = scratch_path(spark, "catalog")
    write_catalog(FX.fixture_catalog(spark, sf_dir), path)
    start, as_of = FX.fixture_range(spark, sf_dir)
    return read_hour_maps(spark, path), start, as_of


@register("pending_slots")
def q_pending_slots(spark, sf_dir):
    """Expected slots without a catalog entry, from the hour maps."""
    from ..operators.hourmaps import pending

    maps, start, as_of = _hour_maps(spark, sf_dir)
    return pending(spark, maps, as_of, start)


@register("slot_status")
def q_slot_status(spark, sf_dir):
    """Status lookup per expected slot (NULL if absent)."""
    from ..operators.slots import slot_status

    exp, cat = _slot_inputs(spark, sf_dir)
    return slot_status(exp, cat)


@register("slot_exists")
def q_slot_exists(spark, sf_dir):
    """Expected slots that are catalogued."""
    from ..operators.slots import slot_exists

    exp, cat = _slot_inputs(spark, sf_dir)
    return slot_exists(exp, cat)


@register("pair_quota")
def q_pair_quota(spark, sf_dir):
    """E5: per-pair quota of 100 hours over the catalogued pairs."""
    return _quota(spark, sf_dir, FX.fixture_catalog(spark, sf_dir))


@register("next_batch")
def q_next_batch(spark, sf_dir):
    """Newest pending slots per pair, up to the quota, from the hour maps."""
    from ..operators.hourmaps import next_batch

    maps, start, as_of = _hour_maps(spark, sf_dir)
    return next_batch(spark, maps, as_of, _configured_quota(spark), QUOTA_MAX_HOURS, start)


@register("error_batch")
def q_error_batch(spark, sf_dir):
    """newest error slots per pair, up to the quota."""
    from ..operators.slots import error_batch

    cat = FX.fixture_catalog(spark, sf_dir)
    return error_batch(cat, _configured_quota(spark), QUOTA_MAX_HOURS)


@register("worklist")
def q_worklist(spark, sf_dir):
    """The next batch interleaved one slot per pair in turn."""
    from ..operators.slots import next_batch, worklist

    exp, cat = _slot_inputs(spark, sf_dir)
    return worklist(next_batch(exp, cat, _configured_quota(spark), QUOTA_MAX_HOURS))


@register("download_manifest")
def q_download_manifest(spark, sf_dir):
    """A3: feed URL and landing path of every pending slot."""
    from ..operators.slots import download_manifest, pending_slots

    exp, cat = _slot_inputs(spark, sf_dir)
    return download_manifest(pending_slots(exp, cat), "raw")


@register("catalog_upsert")
def q_catalog_upsert(spark, sf_dir):
    """Catalog plus two waves of status updates, last one wins."""
    from ..operators.slots import catalog_upsert

    return catalog_upsert(FX.fixture_catalog(spark, sf_dir), FX.fixture_updates(spark, sf_dir))


@register("catalog_sink_roundtrip")
def q_catalog_sink_roundtrip(spark, sf_dir):
    """The upserted catalog written (declared types) and read back."""
    from ..operators.slots import catalog_upsert
    from ..session import scratch_path
    from ..sources.catalog import read_catalog, write_catalog

    path = scratch_path(spark, "catalog")
    write_catalog(catalog_upsert(FX.fixture_catalog(spark, sf_dir), FX.fixture_updates(spark, sf_dir)), path)
    return read_catalog(spark, path)


# -------------------------------------------------------------------- status


@register("pair_status")
def q_pair_status(spark, sf_dir):
    """D2 + D3 + C4: status counts and fetched date range per configured pair."""
    from ..operators.status import pair_status
    from ..sources.instruments import instruments

    return pair_status(FX.fixture_catalog(spark, sf_dir), instruments(spark))


@register("status_rollup")
def q_status_rollup(spark, sf_dir):
    """Per-pair counts plus the grand-total row."""
    from ..operators.status import pair_status, status_rollup
    from ..sources.instruments import instruments

    return status_rollup(pair_status(FX.fixture_catalog(spark, sf_dir), instruments(spark)))


@register("slot_counts")
def q_slot_counts(spark, sf_dir):
    """Ticks and bars per slot file."""
    from ..operators.status import slot_counts

    return slot_counts(B.minute_bars(FX.fixture_ordered_ticks(spark, sf_dir), with_counts=True))


@register("run_counts")
def q_run_counts(spark, sf_dir):
    """Slots attempted and bars produced per pair: the landed files'
    slots and those that the landing log says left none."""
    from ..operators.status import run_counts

    attempted = FX.fixture_records(spark, sf_dir).select("pair", "slot").unionByName(_landing_log(spark, sf_dir)[1].select("pair", "slot"))
    return run_counts(attempted, fixture_bars(spark, sf_dir))


# ------------------------------------------------------------------- quality


def qa_fixture(spark, sf_dir):
    """QA input: bad bars (batch 1) plus re-delivered copies (batch 2), stamped."""
    b1, b2 = _batches(spark, sf_dir)
    return B.union_bars(B.stamp_bars(b1, FX.KNOWLEDGE_TIME_1), B.stamp_bars(b2, FX.KNOWLEDGE_TIME_2))


def qa_store(spark, sf_dir) -> str:
    """The QA fixture written as a bar store (QA reads stored bars)."""
    from ..session import scratch_path
    from ..sources.barstore import write_store

    root = scratch_path(spark, "qa-bars")
    write_store(qa_fixture(spark, sf_dir), root)
    return root


def _pair_checks(spark, sf_dir):
    from ..operators.quality import pair_checks

    return pair_checks(qa_fixture(spark, sf_dir))


@register("qa_date_range")
def q_qa_date_range(spark, sf_dir):
    """Bar count and ISO date range per pair."""
    return _pair_checks(spark, sf_dir).select("pair", "total_bars", "start", "end")


@register("qa_duplicates")
def q_qa_duplicates(spark, sf_dir):
    """Rows beyond the first per timestamp."""
    s = _pair_checks(spark, sf_dir)
    return s.select("pair", F.col("duplicates").alias("count"), (F.col("duplicates") == 0).alias("pass"))


@register("qa_ohlc")
def q_qa_ohlc(spark, sf_dir):
    """OHLC integrity failures (volume not included)."""
    s = _pair_checks(spark, sf_dir)
    return s.select("pair", F.col("ohlc_failures").alias("failures"), (F.col("ohlc_failures") == 0).alias("pass"))


@register("qa_zero_volume")
def q_qa_zero_volume(spark, sf_dir):
    """Bars with volume <= 0."""
    return _pair_checks(spark, sf_dir).select("pair", F.col("zero_volume").alias("count"))


@register("qa_sources")
def q_qa_sources(spark, sf_dir):
    """Sorted distinct sources per pair (comma-joined)."""
    return _pair_checks(spark, sf_dir).select("pair", F.array_join("sources", ",").alias("sources"))


@register("qa_hash_nulls")
def q_qa_hash_nulls(spark, sf_dir):
    """Bars without a hash."""
    s = _pair_checks(spark, sf_dir)
    return s.select("pair", F.col("hash_nulls").alias("count"), (F.col("hash_nulls") == 0).alias("pass"))


@register("qa_yearly")
def q_qa_yearly(spark, sf_dir):
    """Rows per pair and year."""
    from ..operators.quality import yearly_counts

    return yearly_counts(_pair_checks(spark, sf_dir))


@register("qa_completeness")
def q_qa_completeness(spark, sf_dir):
    """Actual rows vs expected open minutes (closed form)."""
    return _pair_checks(spark, sf_dir).select("pair", "percent", F.col("total_bars").alias("actual"), "expected")


@register("qa_gaps")
def q_qa_gaps(spark, sf_dir):
    """Every reported gap."""
    from ..operators.quality import gaps
    from ..functions.text import iso_utc

    g = gaps(qa_fixture(spark, sf_dir))
    return g.select("pair", iso_utc("from_ts").alias("from"), iso_utc("to_ts").alias("to"), "minutes")


@register("qa_spikes")
def q_qa_spikes(spark, sf_dir):
    """Every price spike within a UTC date."""
    from ..operators.quality import spikes

    return spikes(qa_fixture(spark, sf_dir))


@register("qa_gap_examples")
def q_qa_gap_examples(spark, sf_dir):
    """first 10 gaps per pair by time."""
    from ..functions.text import iso_utc
    from ..operators.quality import gap_examples

    g = gap_examples(_pair_checks(spark, sf_dir))
    return g.select("pair", "rank", iso_utc("from_ts").alias("from"), iso_utc("to_ts").alias("to"), "minutes")


@register("qa_spike_examples")
def q_qa_spike_examples(spark, sf_dir):
    """first 10 spikes per pair by time."""
    from ..operators.quality import spike_examples

    return spike_examples(_pair_checks(spark, sf_dir))


@register("qa_report")
def q_qa_report(spark, sf_dir):
    """The QA report over stored bars, one row per configured pair, its
    nested checks flattened to scalar columns."""
    from ..operators.quality import flatten_report, qa_report
    from ..sources.barstore import read_store
    from ..sources.instruments import instruments

    return flatten_report(qa_report(read_store(spark, qa_store(spark, sf_dir)), instruments(spark)))


@register("qa_report_kept")
def q_qa_report_kept(spark, sf_dir):
    """D14 from pair-days kept beside the store: made for most of the bars,
    then brought up to date after the afternoons of every seventh day came."""
    from ..operators.daytable import refresh_days
    from ..operators.quality import flatten_report
    from ..session import scratch_path, written
    from ..sources.barstore import write_store
    from .backfill import validate_kept

    bars = written(qa_fixture(spark, sf_dir), "qa-fixture")
    later = (F.pmod(F.dayofyear("timestamp"), F.lit(7)) == 0) & (F.hour("timestamp") >= 12)
    root = scratch_path(spark, "qa-kept")
    write_store(bars.where(~later), root)
    refresh_days(spark, root)
    write_store(bars.where(later), root, mode="append")
    return flatten_report(validate_kept(spark, root))


@register("qa_report_json")
def q_qa_report_json(spark, sf_dir):
    """The report saved as one JSON document, read back with a schema and
    flattened again."""
    from ..operators.quality import flatten_report, qa_report, read_report_document
    from ..session import scratch_path
    from ..sources.instruments import instruments
    from .backfill import save_qa_report

    report = qa_report(qa_fixture(spark, sf_dir), instruments(spark))
    path = scratch_path(spark, "qa-report")
    save_qa_report(report, path, dt.datetime.fromisoformat(FX.KNOWLEDGE_TIME_2))
    back = read_report_document(spark.read.text(path, wholetext=True), report.schema)
    return flatten_report(back).join(back.select("pair", "generated_at"), "pair")


# ------------------------------------------------------- raw files and loads


def land_fixture_files(spark, sf_dir) -> str:
    """Encode the fixture ticks into one LZMA file per slot under a fresh
    folder of the shared checkpoint root; the landing listing is written as
    a table next to them (``_landed``, hidden from the file scan)."""
    from ..session import scratch_path
    from ..sources.tickfiles import write_tick_files

    root = scratch_path(spark, "raw")
    records = FX.fixture_records(spark, sf_dir)
    write_tick_files(records, root, order=["ts", "event_id"]).write.parquet(f"{root}/_landed")
    return root


@register("load_ticks")
def q_load_ticks(spark, sf_dir):
    """A1: ticks decoded from landed LZMA tick files (events encoded first)."""
    from ..functions.prices import scale_ticks
    from ..sources.instruments import instruments
    from ..sources.tickfiles import read_tick_files

    root = land_fixture_files(spark, sf_dir)
    raw = read_tick_files(spark, root).where(F.col("path").isNull())
    return scale_ticks(raw, instruments(spark))


@register("slot_from_path")
def q_slot_from_path(spark, sf_dir):
    """A2: pair and slot parsed from every landed file path."""
    from ..operators.slots import slot_parts
    from ..sources.tickfiles import list_tick_files

    files = list_tick_files(spark, land_fixture_files(spark, sf_dir))
    return files.select("pair", "slot", *slot_parts("slot"))


def _landing_log(spark, sf_dir):
    """Feed responses of attempted slots without a file (mirrors the catalog
    fixture): hour index % 17 = 0 -> 404, else % 29 = 0 -> 500."""
    from ..functions.calendar import floor_div
    from ..operators.slots import expected_slots
    from ..session import utc_micros

    start, as_of = FX.fixture_range(spark, sf_dir)
    exp = expected_slots(spark, as_of, start)
    idx = floor_div(F.unix_seconds("slot") - F.lit(utc_micros(start) // 1_000_000), 3600)
    code = F.when(idx % 17 == 0, 404).when(idx % 29 == 0, 500)
    return exp, exp.select("pair", "slot", code.alias("http_status")).where(F.col("http_status").isNotNull())


@register("slot_outcome")
def q_slot_outcome(spark, sf_dir):
    """Status of every attempted slot from landed files, decode errors
    and the landing log."""
    from .load import load, slot_outcome

    root = land_fixture_files(spark, sf_dir)
    res = load(spark, root)
    exp, log = _landing_log(spark, sf_dir)
    out = slot_outcome(exp.select("pair", "slot", "year", "month", "day", "hour"), res.outcomes.select("pair", "slot", "length"), res.bad_files, log)
    return out.where(F.col("status").isNotNull()).select("pair", "year", "month", "day", "hour", "status")


def _mixed_file(root, pair, slot, raw):
    """A slot's file by its hour: sound, cut off, with bytes over, under a
    longer folder name, under an impossible date, or of another pair."""
    from ..sources.tickfiles import compress, raw_path, sound_file

    kind = slot.hour % 7
    path, blob = sound_file(root, pair, slot, raw)
    if kind == 1:
        return path, blob[: len(blob) // 2]
    if kind == 2:
        return path, compress(raw + b"1234567")
    if kind == 3:
        return raw_path(root, "X" + pair, slot), blob
    if kind == 4:
        return path.replace(f"/{slot.month:02d}/{slot.day:02d}/{slot.hour:02d}h", f"/13/{slot.day:02d}/{slot.hour:02d}h"), blob
    if kind == 5:
        return raw_path(root, pair.lower(), slot), blob
    return path, blob


def land_mixed_files(spark, sf_dir) -> str:
    from ..session import scratch_path
    from ..sources.tickfiles import write_tick_files

    root = scratch_path(spark, "mixed")
    write_tick_files(FX.fixture_records(spark, sf_dir), root, ["ts", "event_id"], _mixed_file).write.parquet(f"{root}/_landed")
    return root


@register("file_outcomes")
def q_file_outcomes(spark, sf_dir):
    """A1 + A2 + A11: one outcome for every landed file, sound or not."""
    from .load import load

    out = load(spark, land_mixed_files(spark, sf_dir)).outcomes
    name = F.regexp_extract("path", r"([^/]+/\d+/\d+/\d+/[^/]+)$", 1)
    return out.select(name.alias("name"), "pair", "slot", "status", "records", F.col("trailing").cast("int").alias("trailing"),
                      F.split("error", ":")[0].alias("error"))


def _cut_some(root, pair, slot, raw):
    from ..sources.tickfiles import sound_file

    path, blob = sound_file(root, pair, slot, raw)
    return path, blob[: len(blob) // 2] if slot.hour % 7 == 1 else blob


def _misplaced(root, pair, slot, raw):
    from ..sources.tickfiles import sound_file

    path, blob = sound_file(root, pair, slot, raw)
    return path.replace(f"/{slot.month:02d}/{slot.day:02d}/{slot.hour:02d}h", f"/13/{slot.day:02d}/{slot.hour:02d}h"), blob


@register("ingest_loop")
def q_ingest_loop(spark, sf_dir):
    """K: plan, ingest with the landing log, plan again: what stays pending
    after two ingests, the second of which decodes nothing, be a file sound,
    corrupt or under a path that names no slot."""
    from ..operators.hourmaps import pending
    from ..session import scratch_path
    from ..sources.catalog import read_hour_maps
    from ..sources.tickfiles import write_tick_files
    from .backfill import ingest

    _, log = _landing_log(spark, sf_dir)
    start, as_of = FX.fixture_range(spark, sf_dir)
    raw, store, catalog = (scratch_path(spark, name) for name in ("raw", "bars", "catalog"))
    records = FX.fixture_records(spark, sf_dir)
    write_tick_files(records, raw, ["ts", "event_id"], _cut_some).write.parquet(f"{raw}/_landed")
    write_tick_files(records.where(F.hour("slot") % 7 == 4), raw, ["ts", "event_id"], _misplaced).write.parquet(f"{raw}/_misplaced")
    stamp = dt.datetime.fromisoformat(FX.KNOWLEDGE_TIME_1)
    ingest(spark, raw, store, catalog, stamp, landing_log=log)
    again = ingest(spark, raw, store, catalog, stamp, landing_log=log)
    return pending(spark, read_hour_maps(spark, catalog), as_of, start).withColumn("decoded_again", F.lit(again.files).cast("bigint"))


@register("fractional_bars")
def q_fractional_bars(spark, sf_dir):
    """D1 + B8 with fractional volumes, through files: decoded, aggregated, hashed."""
    from ..session import scratch_path
    from ..sources.tickfiles import write_tick_files
    from .load import load

    root = scratch_path(spark, "raw")
    write_tick_files(FX.fractional_records(spark, sf_dir), root, order=["ts", "event_id"]).write.parquet(f"{root}/_landed")
    return load(spark, root).bars.select("pair", "slot", "timestamp", "volume", B.bar_hash().alias("bar_hash"))


@register("fractional_volumes")
def q_fractional_volumes(spark, sf_dir):
    """D1's exact volume on ticks that were never in a file."""
    from ..functions.prices import scale_ticks
    from ..sources.instruments import instruments

    ticks = scale_ticks(FX.fractional_records(spark, sf_dir).withColumn("seq", F.col("event_id")), instruments(spark))
    return B.minute_bars(ticks).select("pair", "slot", "timestamp", "volume")


@register("storage_size")
def q_storage_size(spark, sf_dir):
    """A10: raw files and bytes as scanned, against those recorded as they
    landed; partitions of the bar store."""
    from .backfill import storage_usage

    raw, store = land_fixture_files(spark, sf_dir), _roundtrip_store(spark, sf_dir)
    landed = spark.read.parquet(f"{raw}/_landed").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("recorded"))
    parts = spark.read.parquet(store).select("pair", "year").distinct().agg(F.count(F.lit(1)).alias("n"))
    known = landed.select(F.lit("raw").alias("kind"), "n", "recorded").unionByName(
        parts.select(F.lit("bars").alias("kind"), "n", F.lit(None).cast("bigint").alias("recorded")))
    raw_ok = (F.col("files") == F.col("n")) & (F.col("bytes") == F.col("recorded"))
    bars_ok = (F.col("files") >= F.col("n")) & (F.col("bytes") > 0)  # a partition may hold several files
    mib = F.col("mib") == F.round(F.col("bytes") / 1048576, 1)
    agrees = F.when(F.col("kind") == "raw", raw_ok).otherwise(bars_ok) & mib
    return storage_usage(spark, store, raw).join(known, "kind").select("kind", "n", agrees.cast("string").alias("agrees"))


@register("incremental_load")
def q_incremental_load(spark, sf_dir):
    """I1 + I2: landed files streamed in micro-batches of 1000 files, merged
    into the store; the final store."""
    from ..session import scratch_path
    from ..sources.barstore import read_store
    from ..streaming.incremental import incremental_load
    raw_root = land_fixture_files(spark, sf_dir)
    store_root = scratch_path(spark, "bars")
    kt = dt.datetime.fromisoformat(FX.KNOWLEDGE_TIME_1)
    incremental_load(
        spark, raw_root, store_root, scratch_path(spark, "stream-ckpt"),
        catalog_path=scratch_path(spark, "catalog"), knowledge_time=kt, max_files_per_trigger=1000,
    )
    return read_store(spark, store_root)


@register("instruments")
def q_instruments(spark, sf_dir):
    """The instrument dimension (pair, order, point value) restricted to
    the pairs that occur in the tick feed derived from ``events``."""
    from ..sources.instruments import instruments

    present = FX.fixture_records(spark, sf_dir).select("pair").distinct()
    return instruments(spark).join(present, "pair", "left_semi")
