"""Progress reporting over the catalog: per-pair counts, totals, run figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNT_COLS = ["total", "fetched", "no_data", "error"]


def pair_status(catalog: DataFrame, inst: DataFrame) -> DataFrame:
    """D2 + D3 + C4: one row per configured pair.

    total counts every entry (unknown statuses too); oldest/newest are the
    first/last fetched dates as ``YYYY-MM-DD`` (NULL when none). Catalog rows
    of unconfigured pairs drop; configured pairs without rows get zeros.
    The catalog is filtered against the instrument list and aggregated map-side; only one row per pair is joined back.
    """
    d = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    fetched = F.col("status") == "fetched"
    agg = (
        catalog.join(inst.select("pair"), "pair", "left_semi")
        .groupBy("pair")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(fetched).alias("fetched"),
            F.count_if(F.col("status") == "no_data").alias("no_data"),
            F.count_if(F.col("status") == "error").alias("error"),
            F.min(F.when(fetched, d)).alias("_oldest"),
            F.max(F.when(fetched, d)).alias("_newest"),
        )
    )
    return (
        inst.select("pair", "pair_ord")
        .join(agg, "pair", "left")
        .select(
            "pair", "pair_ord",
            *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNT_COLS],
            F.date_format("_oldest", "yyyy-MM-dd").alias("oldest"),
            F.date_format("_newest", "yyyy-MM-dd").alias("newest"),
        )
    )


def status_rollup(per_pair: DataFrame) -> DataFrame:
    """Per-pair rows plus a grand-total row (``is_total``, pair NULL).

    Input is ``pair_status`` (one row per configured pair), so the rollup
    runs over a handful of rows.
    """
    return per_pair.rollup("pair").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in COUNT_COLS],
        (F.grouping_id() == 1).alias("is_total"),
    )


def slot_counts(bars: DataFrame) -> DataFrame:
    """Ticks and bars per slot file (the run log's figures).

    ``bars`` must carry ``n_ticks`` per bar (see ``minute_bars_with_counts``);
    the second aggregation runs over bars, not ticks.
    """
    return bars.groupBy("pair", "slot").agg(
        F.sum("n_ticks").cast("bigint").alias("n_ticks"),
        F.count(F.lit(1)).alias("n_bars"),
    )


def run_counts(outcomes: DataFrame, bars: DataFrame) -> DataFrame:
    """Slots attempted and bars produced per pair in a batch. Every
    attempted slot counts, with or without bars (``outcomes``: pair, slot, a
    row for each)."""
    per_slot = outcomes.select("pair", "slot", F.lit(1).alias("slot_n"), F.lit(0).cast("bigint").alias("bar_n")).distinct()
    made = bars.select("pair", "slot", F.lit(0).alias("slot_n"), F.lit(1).cast("bigint").alias("bar_n"))
    return per_slot.unionByName(made).groupBy("pair").agg(
        F.sum("slot_n").cast("bigint").alias("slots"), F.sum("bar_n").cast("bigint").alias("bars")
    )


def storage_size(file_sizes: DataFrame) -> DataFrame:
    """A10: total bytes and MiB (1 decimal) per kind of file.

    ``file_sizes`` has ``kind, path, size``; rows are deduplicated per path
    (a Parquet file appears once per row group reader otherwise).
    """
    return (
        file_sizes.groupBy("kind", "path").agg(F.max("size").alias("size"))
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size").cast("bigint").alias("bytes"))
        .withColumn("mib", F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 1))
    )
