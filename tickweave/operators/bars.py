"""Bar operators: tick -> 1-minute OHLCV, integrity, stamping, hashing, dedup."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prices import total_volume
from ..functions.text import float_reprs, hash_time_text
from ..session import load_time, ts_lit
from ..sources.instruments import DEFAULT_SOURCE

BAR_VALUE_COLUMNS = ["open", "high", "low", "close", "volume"]


# exact_sum's lanes: signed digits to the base 2**32 from 2**-160 up to 2**160. They
# hold every 32-bit float and the sums of two; 32 bits leave a 64-bit counter
# room for 2**31 rows of one group.
_BITS, _LEAST, _LANES = 32, -160, 10
_BEYOND = 2.0 ** (_LEAST + _BITS * _LANES - 1)


def exact_sum(v: Column) -> Column:
    """Sum of 32-bit floats, or of sums of two, that no task order changes.

    A value is cut into whole digits of 32 bits, one lane each; every step of
    the cut is exact. Lanes are sums of integers, so they combine in any order,
    and the total is rounded once: this is the exact sum rounded to the nearest
    double, at any magnitude such volumes have. (Of other doubles, bits below
    2**-160 are rounded off value by value, and a finite value of 2**159 or
    more, which no volume reaches, is an error rather than a rounded sum.)
    Infinities add as usual. NaN is skipped; NULL if nothing is left."""
    v = F.nanvl(v, F.lit(None).cast("double"))
    endless = F.abs(v) == float("inf")
    beyond = F.raise_error(F.concat(F.lit("not a volume of a tick: "), v.cast("string"))).cast("double")
    finite = F.when(F.abs(v) < _BEYOND, v).when(~endless, beyond)
    cut = [F.rint(finite * F.lit(2.0 ** -(_LEAST + _BITS * k))) for k in range(_LANES)]
    digits = [low - high * F.lit(2.0**_BITS) for low, high in zip(cut, cut[1:])] + [cut[-1]]
    lanes = [F.coalesce(F.sum(d.cast("bigint")), F.lit(0).cast("bigint")) for d in digits]
    return F.coalesce(F.sum(F.when(endless, v)), F.when(F.count(finite) > 0, _rounded(lanes)))


def _carried(lanes: Column) -> Column:
    """Lanes as digits from 0 to 2**32 - 1 and what is carried beyond them (negative for a negative total)."""
    start = F.struct(F.array().cast("array<bigint>").alias("digits"), F.lit(0).cast("bigint").alias("carry"))
    return F.aggregate(lanes, start, lambda acc, lane: F.struct(
        F.concat(acc["digits"], F.array((lane + acc["carry"]).bitwiseAND(F.lit(2**_BITS - 1)))).alias("digits"),
        F.shiftright(lane + acc["carry"], _BITS).alias("carry")))


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def _rounded(lanes: list[Column]) -> Column:
    """The double nearest to the total of the lanes. Three digits from the first
    that is not 0 hold 65 bits or more; one more bit says whether any follow."""
    zero = F.lit(0).cast("bigint")

    def magnitude(digits: Column) -> Column:
        top = F.array_max(F.transform(digits, lambda d, i: F.when(d != 0, i).otherwise(-1)))
        return _with(top, lambda k: nearest(digits, k))

    def nearest(digits: Column, top: Column) -> Column:
        digit = lambda k: F.coalesce(F.get(digits, k), zero).cast("decimal(20,0)")
        head = digit(top) * F.lit(Decimal(2 ** (2 * _BITS))) + digit(top - 1) * F.lit(Decimal(2**_BITS)) + digit(top - 2)
        more = F.exists(F.slice(digits, F.lit(1), F.greatest(top - 2, F.lit(0))), lambda d: d != 0)
        return (head.cast("decimal(37,0)") * 2 + more.cast("int")).cast("double") * F.pow(F.lit(2.0), (top - 2) * _BITS + (_LEAST - 1))

    def signed(up: Column) -> Column:
        down = _carried(F.transform(F.array(*lanes, zero, zero), lambda x: -x))
        return F.when(up["carry"] < 0, -_with(down["digits"], magnitude)).otherwise(magnitude(up["digits"]))

    return _with(_carried(F.array(*lanes, zero, zero)), signed)


def ohlcv_aggs(with_counts: bool = False, exact_volume_col: str | None = None) -> list[Column]:
    """D1's aggregate expressions over ticks (pair, slot, seq, mid, volumes).

    ``exact_volume_col`` names a column that already holds the volume of the
    minute (the decoder's compensated sum) on a row of its own, without
    ``seq``; ``max`` picks it and stays a partial, skew-safe aggregate.
    """
    vol = total_volume()
    volume = F.coalesce(F.max(exact_volume_col) if exact_volume_col else exact_sum(vol), F.lit(0.0))
    return [
        *([F.count("seq" if exact_volume_col else F.lit(1)).alias("n_ticks")] if with_counts else []),
        F.min_by("mid", "seq").alias("open"),
        F.max("mid").alias("high"),
        F.min("mid").alias("low"),
        F.max_by("mid", "seq").alias("close"),
        volume.alias("volume"),
    ]


def minute_bars(ticks: DataFrame, source: str = DEFAULT_SOURCE, with_counts: bool = False) -> DataFrame:
    """1-minute OHLCV per (pair, slot file, minute).

    open/close are the first/last mid in file order (``seq``), high/low the
    max/min mid (mid is integer/integer, never NaN), volume the sum of
    ask+bid volume with NaN skipped (f32 volumes can carry NaN). Grouping
    keeps the slot so two files never merge into one bar; the merge's dedup
    settles overlapping minutes. With a numeric ``seq`` all aggregates are
    hash-aggregatable, so Spark combines map-side before the shuffle.

    The volume is ``exact_sum``; ticks decoded from files go through
    ``plans.load.bars_and_outcomes``, which carries the decoder's compensated
    per-minute sum in record order.
    """
    out_cols = ["pair", "slot", "timestamp", "open", "high", "low", "close", "volume", "source"]
    return (
        ticks.groupBy("pair", "slot", F.date_trunc("minute", "timestamp").alias("timestamp"))
        .agg(*ohlcv_aggs(with_counts))
        .withColumn("source", F.lit(source))
        .select(*out_cols, *(["n_ticks"] if with_counts else []))
    )


def _no_nan(c: str) -> Column:
    return F.nanvl(F.col(c), F.lit(None).cast("double"))


def _lt(a: Column, b: Column) -> Column:
    """pandas comparison: anything involving NaN/NULL is False."""
    return F.coalesce(a < b, F.lit(False))


def ohlc_bad(with_volume: bool = True) -> Column:
    """B5/D7 predicate: high < max(open, close), low > min(open, close),
    high < low, and (writer only) volume < 0. Row max/min skip NaN like pandas."""
    o, h, lo, c = _no_nan("open"), _no_nan("high"), _no_nan("low"), _no_nan("close")
    bad = _lt(h, F.greatest(o, c)) | _lt(F.least(o, c), lo) | _lt(h, lo)
    if with_volume:
        bad = bad | _lt(_no_nan("volume"), F.lit(0.0))
    return bad


def bars_valid(bars: DataFrame) -> DataFrame:
    """Keep bars that pass the integrity checks."""
    return bars.where(~ohlc_bad())


def bars_rejected(bars: DataFrame) -> DataFrame:
    """The rejected bars (the reference only logs them)."""
    return bars.where(ohlc_bad())


def bar_hash(ts="timestamp") -> Column:
    """sha256 hex of ``ts|open|high|low|close|volume|source``.

    ``concat`` (not ``concat_ws``) so a NULL input gives a NULL hash.
    """
    values = F.aggregate(
        float_reprs("open", "high", "low", "close", "volume"),
        hash_time_text(ts),
        lambda done, value: F.concat(done, F.lit("|"), value),
    )
    return F.sha2(F.concat(values, F.lit("|"), F.col("source")), 256)


def stamp_bars(bars: DataFrame, knowledge_time: dt.datetime | str | None = None) -> DataFrame:
    """B7 + B8: one load time per batch, then the content hash.

    ``knowledge_time`` defaults to the time of this call; pass it explicitly
    for reproducible runs.
    """
    kt = ts_lit(load_time(knowledge_time))  # a literal: the same in every job that reads the batch
    return bars.withColumn("knowledge_time", kt).withColumn("bar_hash", bar_hash())


def union_bars(*frames: DataFrame) -> DataFrame:
    """G1: union all by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def keep_first_key(bars: DataFrame) -> Column:
    """E3's priority as one ascending struct: stored before new (``is_new``),
    newer slot first, then hash and values (NULLs last) for a total order."""
    parts = []
    if "is_new" in bars.columns:
        parts.append(F.col("is_new"))
    if "slot" in bars.columns:
        parts.append(F.coalesce(-F.unix_micros("slot"), F.lit(2**62)))  # desc, NULLs last
    for c in ["bar_hash", *BAR_VALUE_COLUMNS]:
        if c in bars.columns:
            parts += [F.col(c).isNull(), F.col(c)]
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def dedup_bars(bars: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keep the first bar per (pair, timestamp).

    "First" is stored before new, then newer slot first (the backward
    worklist buffers newest first), then hash for a total order. Written as
    an aggregate — ``min_by(row, priority)`` per key — so copies collapse in
    the map-side partial aggregation: a bar re-delivered many times never
    funnels all its copies into one task.
    """
    keys = keys or ["pair", "timestamp"]
    rest = [c for c in bars.columns if c not in keys]
    return (
        bars.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), keep_first_key(bars)).alias("_first"))
        .select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in bars.columns])
    )


def empty_bars(spark) -> DataFrame:
    """A typed empty bar frame."""
    from ..schemas import BAR_SCHEMA

    return spark.createDataFrame([], BAR_SCHEMA)
