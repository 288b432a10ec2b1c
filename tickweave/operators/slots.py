"""Slot planning over the catalog: expected, pending, lookups, quotas, batches,
upserts and the interleaved worklist."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import market_closed
from ..schemas import CATALOG_SCHEMA, SLOT_KEY
from ..session import utc_micros
from ..sources.instruments import BASE_URL, INSTRUMENTS

# Fixed value: the backfill starts at 2021-01-01 00:00 UTC.
TARGET_START = dt.datetime(2021, 1, 1, 0, 0)

DEFAULT_MAX_HOURS = 1500


def slot_parts(slot="slot") -> list[Column]:
    """Catalog key parts of a slot timestamp, typed as the catalog schema."""
    s = F.col(slot) if isinstance(slot, str) else slot
    return [
        F.year(s).cast("smallint").alias("year"),
        F.month(s).cast("tinyint").alias("month"),
        F.dayofmonth(s).cast("tinyint").alias("day"),
        F.hour(s).cast("tinyint").alias("hour"),
    ]


def slot_of_parts() -> Column:
    return F.make_timestamp(
        F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"),
        F.col("hour").cast("int"), F.lit(0), F.lit(0),
    )


def _to_utc_naive(t: dt.datetime) -> dt.datetime:
    if t.tzinfo is not None:
        t = t.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return t


def expected_slots(
    spark: SparkSession,
    as_of: dt.datetime,
    start: dt.datetime = TARGET_START,
    pairs: list[str] | None = None,
) -> DataFrame:
    """Every open-market hour from ``start`` up to the last complete hour
    before ``as_of``, for each pair.

    Hours come from ``spark.range`` (distributed generation, no driver list);
    each hour is fanned out to the configured pairs with an ``explode`` of a
    literal array, so no join is needed.
    """
    as_of, start = _to_utc_naive(as_of), _to_utc_naive(start)
    last = as_of.replace(minute=0, second=0, microsecond=0) - dt.timedelta(hours=1)
    n_hours = int((last - start).total_seconds() // 3600) + 1
    rows = [(p, o) for p, o, _ in INSTRUMENTS if not pairs or p in pairs]
    if pairs:
        rows = sorted(rows, key=lambda r: pairs.index(r[0]))
    start_us = utc_micros(start)
    hours = spark.range(0, max(n_hours, 0)).select(
        F.timestamp_micros(F.lit(start_us) + F.col("id") * F.lit(3_600_000_000)).alias("slot")
    ).where(~market_closed("slot"))
    pair_arr = F.array(*[F.struct(F.lit(p).alias("pair"), F.lit(o).alias("pair_ord")) for p, o in rows])
    return hours.select(F.explode(pair_arr).alias("p"), "slot").select(
        "p.pair", "p.pair_ord", "slot", *slot_parts("slot")
    )


def pending_slots(expected: DataFrame, catalog: DataFrame) -> DataFrame:
    """Expected slots with no catalog entry (any status)."""
    return expected.join(catalog.select(*SLOT_KEY), SLOT_KEY, "left_anti")


def slot_status(slots: DataFrame, catalog: DataFrame) -> DataFrame:
    """Status per slot, NULL when the slot is not catalogued."""
    return slots.join(catalog.select(*SLOT_KEY, "status"), SLOT_KEY, "left")


def slot_exists(slots: DataFrame, catalog: DataFrame) -> DataFrame:
    """Slots that have a catalog entry."""
    return slots.join(catalog.select(*SLOT_KEY), SLOT_KEY, "left_semi")


def pair_quota(pairs: DataFrame, max_hours: int | None = DEFAULT_MAX_HOURS) -> DataFrame:
    """E5: ``max_hours // n`` per pair; the first ``max_hours % n`` pairs (in
    ``pair_ord`` order) get one more. NULL means the default; 0 means none.

    ``pairs`` is a selection of the configured instruments (pair, pair_ord),
    so at most one row per configured pair: like the reference, the quota is
    plain arithmetic over that short list, returned as a VALUES table — no
    window over a single partition.
    """
    if max_hours is None:
        max_hours = DEFAULT_MAX_HOURS
    known = {p for p, _, _ in INSTRUMENTS}
    chosen = sorted(
        {(r["pair"], r["pair_ord"]) for r in pairs.select("pair", "pair_ord").distinct().collect()
         if r["pair"] in known},  # bounded by the configured instruments
        key=lambda t: t[1],
    )
    n = len(chosen)
    rows = [(p, o, max_hours // n + (1 if i < max_hours % n else 0)) for i, (p, o) in enumerate(chosen)]
    spark = pairs.sparkSession
    if not rows:
        return spark.createDataFrame([], "pair string, pair_ord int, quota int")
    vals = ", ".join(f"('{p}', {o}, {q})" for p, o, q in rows)
    return spark.sql(
        "SELECT CAST(pair AS STRING) AS pair, CAST(pair_ord AS INT) AS pair_ord, CAST(quota AS INT) AS quota "
        f"FROM VALUES {vals} AS t(pair, pair_ord, quota)"
    )


def newest_first(slots: DataFrame, quota: DataFrame, max_quota: int) -> DataFrame:
    """E4 / F3 core: the ``quota`` newest slots of each pair, with their rank.

    The literal bound ``rank <= max_quota`` lets Spark plan a WindowGroupLimit,
    so each task keeps at most that many slots per pair before the shuffle;
    the per-pair quota then trims exactly.
    """
    w = Window.partitionBy("pair").orderBy(F.col("slot").desc())
    q = quota.select("pair", "pair_ord", "quota")  # a VALUES relation: Spark knows its size
    ranked = (
        slots.drop("pair_ord")
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= F.lit(int(max_quota)))
        .join(q, "pair")
    )
    return ranked.where(F.col("rank") <= F.col("quota")).drop("quota")


def next_batch(expected: DataFrame, catalog: DataFrame, quota: DataFrame, max_quota: int) -> DataFrame:
    """Up to quota pending slots per pair, newest first."""
    return newest_first(pending_slots(expected, catalog), quota, max_quota)


def error_batch(catalog: DataFrame, quota: DataFrame, max_quota: int) -> DataFrame:
    """up to quota error slots per pair, newest first."""
    errs = catalog.where(F.col("status") == "error").select(*SLOT_KEY).withColumn("slot", slot_of_parts())
    return newest_first(errs, quota, max_quota)


def worklist(batch: DataFrame) -> DataFrame:
    """One slot per pair in turn (rank, then configured pair order).

    The position is computed in closed form from per-pair batch sizes (one
    number per configured pair reaches the driver): rows before (r, o) are
    sum_p min(n_p, r - 1) plus the pairs ordered before o that still have an
    r-th slot. No global window, so nothing funnels through one task.
    """
    counts = {r["pair_ord"]: r["n"] for r in batch.groupBy("pair_ord").agg(F.count(F.lit(1)).alias("n")).collect()}
    r, o = F.col("rank"), F.col("pair_ord")
    pos = F.lit(1)
    for ordv, n in counts.items():
        pos = pos + F.least(F.lit(n), r - 1) + F.when((F.lit(ordv) < o) & (F.lit(n) >= r), 1).otherwise(0)
    return batch.withColumn("position", pos.cast("bigint"))


def catalog_upsert(catalog: DataFrame, updates: DataFrame) -> DataFrame:
    """Last status wins per slot; an update replaces status and fetched_at.

    ``updates`` carries ``update_seq`` (its order within the batch). One union
    and one ``max_by`` aggregate per slot key — many updates of one slot
    collapse map-side instead of meeting in one window partition.
    """
    cols = [f.name for f in CATALOG_SCHEMA.fields]
    rest = [c for c in cols if c not in SLOT_KEY]
    cur = catalog.select(*cols, F.lit(0).alias("_src"), F.lit(0).cast("long").alias("_seq"))
    upd = updates.select(*cols, F.lit(1).alias("_src"), F.col("update_seq").cast("long").alias("_seq"))
    latest = F.max_by(F.struct(*rest), F.struct("_src", "_seq")).alias("_last")
    return (
        cur.unionByName(upd)
        .groupBy(*SLOT_KEY)
        .agg(latest)
        .select(*[(F.col(f.name) if f.name in SLOT_KEY else F.col(f"_last.{f.name}")).cast(f.dataType).alias(f.name)
                  for f in CATALOG_SCHEMA.fields])
    )


def raw_path_expr(root: str) -> Column:
    """Landing path ``root/PAIR/YYYY/MM/DD/HHh_ticks.bi5`` (month 1-based)."""
    return F.format_string(
        "%s/%s/%d/%02d/%02d/%02dh_ticks.bi5", F.lit(root.rstrip("/")), F.col("pair"),
        F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"),
        F.col("hour").cast("int"),
    )


def download_manifest(slots: DataFrame, raw_root: str, base_url: str = BASE_URL) -> DataFrame:
    """A3: URL (0-based month) and landing path (1-based month) per slot."""
    url = F.format_string(
        "%s/%s/%d/%02d/%02d/%02dh_ticks.bi5", F.lit(base_url), F.col("pair"),
        F.col("year").cast("int"), F.col("month").cast("int") - 1, F.col("day").cast("int"),
        F.col("hour").cast("int"),
    )
    return slots.select(*SLOT_KEY, url.alias("url"), raw_path_expr(raw_root).alias("path"))
