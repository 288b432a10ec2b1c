"""Load landed tick files: decode (A1) -> bars (D1) plus one outcome per file
and slot (A11), in one decode pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prices import price_columns, tick_time
from ..operators.bars import ohlcv_aggs
from ..session import ensure_utc, written
from ..sources.instruments import DEFAULT_SOURCE, instruments, with_point_value
from ..sources.tickfiles import decode_tick_files
from ..sources.tickformat import tick_format


@dataclass
class LoadResult:
    bars: DataFrame       # BAR_SCHEMA + n_ticks
    outcomes: DataFrame   # one row per landed file: path, pair, slot, length, status, records, trailing, error
    bad_files: DataFrame  # pair, slot, error of the files with an error


def bars_and_outcomes(files: DataFrame, inst: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """``aggregated`` over files at hand (with content)."""
    return aggregated(decode_tick_files(files), inst, source)


def aggregated(decoded: DataFrame, inst: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Decoded rows to bars in one pass.

    The decoder's row about each file is a group of its own (``path`` set), so
    the bars and the outcomes come out of the same aggregation. Ticks of an
    unknown pair (C3) make no bars; the file's row says why.
    """
    decoded = with_point_value(decoded, inst)
    about = F.col("path").isNotNull()
    unknown = F.col("point_value").isNull() & (F.coalesce(F.col("pair"), F.lit("")) != "")
    ticks = decoded.where(about | F.col("point_value").isNotNull()).select(
        "pair", "slot", "seq", "path", "length", "records", "trailing",
        F.coalesce("error", F.when(about & unknown, F.lit("unknown pair"))).alias("error"),
        tick_time("slot", "ms").alias("timestamp"), *price_columns(), "ask_volume", "bid_volume", "minute_volume",
    )
    minute: Column = F.when(F.col("path").isNull(), F.date_trunc("minute", "timestamp"))
    # the file's texts are grouping keys, not max(): string aggregation
    # buffers would push the whole aggregate off HashAggregate (and codegen)
    return (
        ticks.groupBy("pair", "slot", minute.alias("timestamp"), "path", "error")
        .agg(*ohlcv_aggs(with_counts=True, exact_volume_col="minute_volume"), *[F.max(c).alias(c) for c in ("length", "records", "trailing")])
        .withColumn("source", F.lit(source))
    )


_FILE = ["path", "length", "records", "trailing", "error"]


def bars_of(combined: DataFrame) -> DataFrame:
    return combined.where(F.col("path").isNull()).drop(*_FILE)


def outcomes_of(combined: DataFrame) -> DataFrame:
    """One row per landed file; ``trailing`` > 0 warns of a dropped partial record."""
    status = F.when(F.col("error").isNotNull(), "error").when(F.col("length") > 0, "fetched").otherwise("no_data")
    return combined.where(F.col("path").isNotNull()).select(
        "path", "pair", "slot", "length", status.alias("status"), "records", "trailing", "error")


def load(spark: SparkSession, raw_root: str, pairs: list[str] | None = None,
         source: str = DEFAULT_SOURCE, files: DataFrame | None = None) -> LoadResult:
    """Decode every landed file under ``raw_root`` (or the given listing).

    The aggregated result (bars + file rows, ~1/60 of the ticks) is written
    once to the shared folder: every consumer (bar merge, catalog outcomes)
    reads it without decoding again, and an executor lost later does not force
    a re-decode.
    """
    ensure_utc(spark)
    decoded = decode_tick_files(files) if files is not None else tick_format(spark).load(raw_root)
    if pairs:
        decoded = decoded.where(F.col("pair").isin(list(pairs)))
    combined = written(aggregated(decoded, instruments(spark, pairs), source), "decoded")
    outcomes = outcomes_of(combined)
    bad = outcomes.where(F.col("error").isNotNull()).select("pair", "slot", "error")
    return LoadResult(bars_of(combined), outcomes, bad)


def slot_outcome(slots: DataFrame, files: DataFrame, bad_files: DataFrame,
                 landing_log: DataFrame | None = None) -> DataFrame:
    """Status per attempted slot from what landed.

    decode failure -> error; bytes -> fetched; empty body or 404 -> no_data;
    any other logged failure -> error; nothing landed and nothing logged ->
    NULL (not attempted). All inputs are keyed by (pair, slot).

    Spark's file scans skip zero-length files, so an empty body is known from
    the landing log (``http_status``, optional ``n_bytes``), not the listing.
    """
    f = files.groupBy("pair", "slot").agg(F.max("length").alias("length"))
    b = bad_files.groupBy("pair", "slot").agg(F.max("error").alias("error"))
    out = slots.join(f, ["pair", "slot"], "left").join(b, ["pair", "slot"], "left")
    if landing_log is not None:
        has_bytes = "n_bytes" in landing_log.columns
        log = landing_log.groupBy("pair", "slot").agg(
            F.max("http_status").alias("http_status"),
            (F.max("n_bytes") if has_bytes else F.lit(None).cast("bigint")).alias("n_bytes"),
        )
        out = out.join(log, ["pair", "slot"], "left")
        http, n_bytes = F.col("http_status"), F.col("n_bytes")
    else:
        http, n_bytes = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    status = (
        F.when(F.col("error").isNotNull(), "error")
        .when(F.col("length") > 0, "fetched")
        .when((F.col("length") == 0) | (http == 404) | ((http == 200) & (n_bytes == 0)), "no_data")
        .when(http.isNotNull(), "error")
    )
    return out.withColumn("status", status)
