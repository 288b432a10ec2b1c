"""Merge new bars into the store.

stamp (B7) -> hash (B8) -> year (B9) -> union with the stored rows of the
affected (pair, year) partitions (G1) -> keep-first dedup (E3) -> integrity
filter (B5) -> ordered write replacing exactly those partitions (A5, F1).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import minutemaps as M
from ..operators.bars import bars_valid, dedup_bars, stamp_bars
from ..session import delete_path, ensure_utc, load_time, written
from .. import schemas
from ..sources.barstore import partition_filter, read_store, write_store


@dataclass
class MergeResult:
    partitions: list[tuple[str, int]]
    new_bars: int
    stored_bars: int


def merge_bars(
    spark: SparkSession,
    new_bars: DataFrame,
    root: str,
    knowledge_time: dt.datetime | str | None = None,
    stamped: bool = False,
    materialize: bool = True,
    force_rewrite: bool = False,
) -> MergeResult:
    """Merge ``new_bars`` (BAR_SCHEMA) into the store at ``root``.

    Only the distinct (pair, year) list of the batch reaches the driver; it
    bounds the partitions listed, read and rewritten. Reading and overwriting the same
    partitions is safe in dynamic mode: the old files are replaced only at job
    commit, after every task finished (a retried task re-reads the originals).
    Empty input is a no-op. The batch gets one load time. ``materialize``
    writes the stamped batch once to the shared folder, and the partition
    list, the collision check and both writes read that copy; switch it off
    only for a batch that is a plain scan already.

    Partitions that share no minute with the batch are appended to, by the
    minute maps kept beside the store (operators/minutemaps.py), which this
    call brings up to date; no stored bar is read for them. Stored
    rows were validated when written, so the result equals a full rewrite for
    stores written here. Rewrites run before appends; after a crash between
    the two, a replay collides with its own rows and converges to the same
    store. ``force_rewrite`` rewrites every affected partition
    (re-filtering stored rows too, as the reference does on each write — use
    it for stores imported from elsewhere).
    """
    ensure_utc(spark)
    new = new_bars if stamped else stamp_bars(new_bars, load_time(knowledge_time))
    new = new.withColumn("year", F.year("timestamp").cast("int"))
    if materialize:
        new = written(new, "merge-batch")
    batch_maps = written(M.minute_maps(new), "merge-minutes")
    parts = sorted((r["pair"], int(r["year"])) for r in batch_maps.select("pair", "year").distinct().collect())
    if not parts:
        return MergeResult([], 0, 0)

    incoming = new.select(
        *[F.col(f.name) for f in schemas.STORED_BAR_SCHEMA.fields],
        "pair", "year",
        F.col("slot") if "slot" in new.columns else F.lit(None).cast("timestamp").alias("slot"),
        F.lit(1).alias("is_new"),
    )
    # Which partitions already hold one of the batch's minutes? Only those
    # need the keep-first rewrite; the others just receive the batch's rows.
    # Asked of the minute maps; of the timestamps where no maps stand for the files.
    there = M.file_digests(spark, root, parts)
    stored_maps = M.kept_maps(spark, root, there)
    hits, known = M.compare(batch_maps, stored_maps)
    unknown = sorted(set(there) - known)
    collide = set(parts) if force_rewrite else hits
    if unknown and not force_rewrite:
        keys = ["pair", "year", "timestamp"]
        stored_keys = read_store(spark, root).where(partition_filter(unknown)).select(*keys)
        # the batch is the build side (AQE broadcasts it when it is small, so
        # the stored timestamps are probed where they are read)
        found = stored_keys.join(incoming.select(*keys), keys, "left_semi").select("pair", "year").distinct()
        collide |= {(r["pair"], int(r["year"])) for r in found.collect()}  # subset of ``parts``
    rewrite = [p for p in parts if p in collide]
    append = [p for p in parts if p not in collide]
    new_n = stored_n = 0
    if rewrite:
        a, b = _rewrite(spark, root, incoming.where(partition_filter(rewrite)), rewrite)
        new_n, stored_n = new_n + a, stored_n + b
    if append:
        a = _append(root, incoming.where(partition_filter(append)))
        new_n, stored_n = new_n + a, stored_n + a
    maps = stored_maps.select(*batch_maps.columns).unionByName(batch_maps)
    if unknown:
        maps = maps.where(~partition_filter(unknown)).unionByName(M.minute_maps(read_store(spark, root).where(partition_filter(unknown))))
    M.write_maps(spark, root, maps, M.file_digests(spark, root, parts))
    return MergeResult(parts, new_n, stored_n)


def _observed(df: DataFrame, name: str):
    obs = Observation(name)
    out = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("is_new")).alias("new_bars"),
        F.collect_set(F.concat_ws("\u0001", F.col("pair"), F.col("year").cast("string"))).alias("written"),
    )
    return out, obs


def _metrics(obs, df: DataFrame) -> tuple[int, int, set]:
    """Rows, new bars and partitions written: as observed during the write, or
    counted from the data where no metric came back (no task had rows, or the
    listener lost them). Merging again after the write gives the same rows, so
    the count is that of the write."""
    try:
        m = obs.get
    except Exception:  # noqa: BLE001 - absent when no task produced rows
        m = None
    if m and m.get("written") is not None:
        return int(m["rows"] or 0), int(m["new_bars"] or 0), {tuple(s.split("\u0001")) for s in m["written"]}
    counted = df.groupBy("pair", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("is_new").alias("new")).collect()  # a row per partition
    return (sum(r["n"] for r in counted), sum(r["new"] or 0 for r in counted), {(r["pair"], str(r["year"])) for r in counted})


def _append(root: str, incoming: DataFrame) -> int:
    """Partitions with no stored minute of the batch: stored rows stay as they
    are (they were validated when written); the batch's own keep-first and
    integrity filter decide what is added. A replay of the same batch finds
    its own rows stored and takes the rewrite path, so appends stay
    idempotent."""
    rows = bars_valid(dedup_bars(incoming, keys=["pair", "year", "timestamp"]))
    observed, obs = _observed(rows, "merge-append")
    write_store(observed, root, mode="append")
    return _metrics(obs, rows)[0]


def _rewrite(spark: SparkSession, root: str, incoming: DataFrame, parts: list[tuple[str, int]]) -> tuple[int, int]:
    """Stored and new rows of ``parts``: keep-first dedup, integrity filter,
    and the partitions replaced as a whole (dynamic overwrite)."""
    stored = read_store(spark, root).where(partition_filter(parts)).select(
        *[F.col(f.name) for f in schemas.STORED_BAR_SCHEMA.fields],
        "pair", "year",
        F.lit(None).cast("timestamp").alias("slot"),
        F.lit(0).alias("is_new"),
    )
    # keep-first is an aggregate: copies collapse map-side before the shuffle
    merged = bars_valid(dedup_bars(stored.unionByName(incoming), keys=["pair", "year", "timestamp"]))
    observed, obs = _observed(merged, "merge-rewrite")
    write_store(observed, root)
    rows, new_bars, filled = _metrics(obs, merged)
    # A partition whose rows were all rejected produced no files; dynamic
    # overwrite would leave its old files, the reference leaves it empty.
    for pair, year in parts:
        if (pair, str(year)) not in filled:
            delete_path(spark, f"{root}/pair={pair}/year={year}")
    return new_bars, rows
