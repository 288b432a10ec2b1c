"""The catalog as hour bitmaps: one map of a year's hours per (pair, year, status).

A map holds bit ``(day of year - 1) * 24 + hour`` of every catalogued slot, so
"which slots are pending" is answered by one row per pair and year: the open
hours of the range are generated from the row and those whose bit is set are
left out. No slot of the catalog is joined, or even read, to plan a run; maps
are kept beside the catalog (sources/catalog.py) and replaced for the (pair,
year) partitions that a run touches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import market_closed
from ..session import utc_micros
from ..sources.instruments import INSTRUMENTS
from . import slots as S

MAP_SCHEMA = "pair string, year int, status string, hours binary"
#: A digit's place in this text is its value (0 is not in it).
_DIGITS = "123456789ABCDEF"


def slot_maps(catalog: DataFrame) -> DataFrame:
    """MAP_SCHEMA rows of a catalog."""
    day = F.dayofyear(F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int")))
    at = ((day - 1) * 24 + F.col("hour")).cast("bigint")
    return catalog.select("pair", F.col("year").cast("int").alias("year"), "status", at.alias("at")).groupBy("pair", "year", "status").agg(
        F.bitmap_construct_agg("at").alias("hours"))


def is_set(hours: Column, at: Column) -> Column:
    """Whether bit ``at`` of a map is set; a null map has none."""
    octet = F.hex(F.substring(hours, F.floor(at / 8).cast("int") + 1, F.lit(1)))
    half = F.instr(F.lit(_DIGITS), F.substring(octet, F.lit(2) - F.floor(at % 8 / 4).cast("int"), F.lit(1)))
    return F.coalesce(F.getbit(half, (at % 4).cast("int")) == 1, F.lit(False))


def pending(spark: SparkSession, maps: DataFrame, as_of: dt.datetime, start: dt.datetime = S.TARGET_START, pairs: list[str] | None = None) -> DataFrame:
    """The expected slots (G2) that have no entry of any status; the rows of
    ``slots.pending_slots`` over ``slots.expected_slots``."""
    as_of, start = S._to_utc_naive(as_of), S._to_utc_naive(start)
    last = as_of.replace(minute=0, second=0, microsecond=0) - dt.timedelta(hours=1)
    hour = lambda t: utc_micros(t) // 3_600_000_000
    from_hour, to_hour = -(-utc_micros(start) // 3_600_000_000), hour(last)
    chosen = [(p, o) for p, o, _ in INSTRUMENTS if not pairs or p in pairs]
    if pairs:
        chosen = sorted(chosen, key=lambda r: pairs.index(r[0]))
    pair_array = F.array(*[F.struct(F.lit(p).alias("pair"), F.lit(o).alias("pair_ord")) for p, o in chosen])
    years = spark.range(start.year, max(start.year, last.year) + 1).select(F.col("id").cast("int").alias("year"), F.explode(pair_array).alias("p"))
    present = maps.groupBy("pair", "year").agg(F.bitmap_or_agg("hours").alias("hours"))
    rows = years.select("p.pair", "p.pair_ord", "year").join(present, ["pair", "year"], "left")
    begin = lambda year: (F.unix_seconds(F.make_timestamp(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))) / 3600).cast("bigint")
    rows = rows.withColumns({"first": begin(F.col("year")), "next": begin(F.col("year") + 1)})
    rows = rows.withColumns({"low": F.greatest(F.lit(from_hour), "first") - F.col("first"), "high": F.least(F.lit(to_hour) + 1, "next") - F.col("first") - 1})
    at_hour = lambda at: F.timestamp_seconds((F.col("first") + at) * 3600)
    free = F.filter(F.sequence("low", "high"), lambda at: ~market_closed(at_hour(at)) & ~is_set(F.col("hours"), at))
    out = rows.where(F.col("low") <= F.col("high")).select("pair", "pair_ord", "first", F.explode(free).alias("at"))
    return out.select("pair", "pair_ord", at_hour(F.col("at")).alias("slot")).select("pair", "pair_ord", "slot", *S.slot_parts("slot"))


def next_batch(spark: SparkSession, maps: DataFrame, as_of: dt.datetime, quota: DataFrame, max_quota: int,
               start: dt.datetime = S.TARGET_START, pairs: list[str] | None = None) -> DataFrame:
    """Up to quota pending slots per pair, newest first."""
    return S.newest_first(pending(spark, maps, as_of, start, pairs), quota, max_quota)
