"""Test inputs derived from the provided ``events`` table.

The mapping (documented in FIXTURES.md) turns each event into one tick:
event type -> pair, hour floor of ``ts`` -> slot, whole ms into the hour,
``value`` -> bid, ``props.k`` -> spread and ask volume, ``event_id % 7`` ->
bid volume. Everything here is lazy DataFrame code over ``events``.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import floor_div
from ..functions.prices import scale_ticks
from ..schemas import STORED_BAR_SCHEMA
from ..session import ensure_utc, from_utc_micros, ts_lit, utc_micros
from .instruments import instruments

# Any other event type: a pair that is not configured (C3's unknown pair).
OTHER_PAIR = "OTHERS"

# Fixed values of the fixture mapping: event type -> pair (USDCHF gets none).
EVENT_TYPE_PAIR = [
    ("click", "EURUSD"),
    ("error", "GBPUSD"),
    ("purchase", "USDJPY"),
    ("signup", "USDCAD"),
    ("view", "AUDUSD"),
]

# Fixed fixture stamps.
KNOWLEDGE_TIME_1 = "2024-02-01 00:00:00"
KNOWLEDGE_TIME_2 = "2024-02-02 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_pair(event_type="event_type"):
    expr = F.lit(OTHER_PAIR)
    for et, pair in reversed(EVENT_TYPE_PAIR):
        expr = F.when(F.col(event_type) == et, F.lit(pair)).otherwise(expr)
    return expr


def event_records(events: DataFrame) -> DataFrame:
    """Raw tick records from ``events`` with their file order as (ts, event_id)
    instead of a record index: pair, slot, ts, event_id, ms, ask_int, bid_int,
    ask_volume, bid_volume. No window: the order travels as columns."""
    ts = F.col("ts").cast("timestamp")
    base = (
        events.select(
            "event_id",
            ts.alias("ts"),
            event_pair().alias("pair"),
            F.get_json_object("props", "$.k").cast("long").alias("k"),
            (F.lit(100000) + F.round(F.col("value") * 100).cast("long")).alias("bid_int"),
        )
        .withColumn("slot", F.date_trunc("hour", F.col("ts")))
    )
    return base.select(
        "pair",
        "slot",
        "ts",
        "event_id",
        floor_div(F.unix_micros("ts") - F.unix_micros("slot"), 1000).alias("ms"),
        (F.col("bid_int") + 1 + F.pmod(F.col("k"), F.lit(5))).alias("ask_int"),
        "bid_int",
        F.col("k").cast("double").alias("ask_volume"),
        F.pmod(F.col("event_id"), F.lit(7)).cast("double").alias("bid_volume"),
    )


def fixture_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return event_records(read_table(spark, sf_dir, "events"))


def fixture_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled ticks with their event's id as ``seq``: for what looks at ticks
    one by one, so nothing is shuffled."""
    return scale_ticks(fixture_records(spark, sf_dir).withColumn("seq", F.col("event_id")), instruments(spark))


def fractional_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with fractional 32-bit volumes, as real feeds have: k + tenths
    of the event id, and sevenths of it."""
    f32 = lambda c: c.cast("float").cast("double")
    return fixture_records(spark, sf_dir).withColumns({
        "ask_volume": f32(F.col("ask_volume") + F.pmod(F.col("event_id"), F.lit(10)) / 10),
        "bid_volume": f32(F.col("bid_volume") / 7),
    })


def fixture_ordered_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks derived from ``events`` whose file order (ts, event_id) is
    carried in ``seq`` without a numbering pass; input of the bars.

    Bars compare order only inside one minute: the microsecond offset (26
    bits) before the 64-bit event_id is one exact decimal, a fixed-width
    aggregation buffer, so D1 stays a hash aggregate for any ids.
    """
    recs = fixture_records(spark, sf_dir)
    us_in_minute = F.unix_micros("ts") - F.unix_micros(F.date_trunc("minute", "ts"))
    key = us_in_minute.cast("decimal(8,0)") * F.lit(Decimal(2 ** 64)) + F.col("event_id").cast("decimal(20,0)")
    return scale_ticks(recs.withColumn("seq", key), instruments(spark))


def fixture_range(spark: SparkSession, sf_dir: str) -> tuple[dt.datetime, dt.datetime]:
    """(start, as_of) of the catalog fixture: the whole days spanned by events.

    One aggregate row is collected; Parquet min/max statistics make it cheap.
    """
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    row = ev.select(
        F.unix_micros(F.date_trunc("day", F.min(F.col("ts").cast("timestamp")))).alias("start"),
        F.unix_micros(
            F.date_trunc("day", F.max(F.col("ts").cast("timestamp"))) + F.expr("INTERVAL 1 DAY")
        ).alias("as_of"),
    ).first()
    return from_utc_micros(row["start"]), from_utc_micros(row["as_of"])


def bad_bars(bars: DataFrame) -> DataFrame:
    """Integrity-failure fixture: high/low swapped where minute % 13 = 0,
    volume -1 where minute % 31 = 0."""
    m = F.minute("timestamp")
    swap = m % 13 == 0
    return bars.select(
        *[c for c in bars.columns if c not in ("high", "low", "volume")],
        F.when(swap, F.col("low")).otherwise(F.col("high")).alias("high"),
        F.when(swap, F.col("high")).otherwise(F.col("low")).alias("low"),
        F.when(m % 31 == 0, F.lit(-1.0)).otherwise(F.col("volume")).alias("volume"),
    ).select(*bars.columns)


def duplicate_copies(bars: DataFrame) -> DataFrame:
    """Re-delivered bars: copies where minute % 10 = 0 with close + 0.01."""
    return bars.where(F.minute("timestamp") % 10 == 0).withColumn(
        "close", F.col("close") + F.lit(0.01)
    )


def fixture_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog fixture over the expected slots of the events' date range.

    Slot with ticks -> fetched; else hour index % 17 = 0 -> no_data; else
    % 29 = 0 -> error; else not catalogued (pending). The hour index counts
    whole hours from the range start; fetched_at is the range end (as_of).
    """
    from ..operators.slots import expected_slots, slot_parts

    start, as_of = fixture_range(spark, sf_dir)
    exp = expected_slots(spark, as_of, start)
    tick_slots = fixture_records(spark, sf_dir).select("pair", "slot").distinct().withColumn("has_ticks", F.lit(True))
    start_s = utc_micros(start) // 1_000_000
    idx = floor_div(F.unix_seconds("slot") - F.lit(start_s), 3600)
    status = (
        F.when(F.col("has_ticks"), "fetched")
        .when(idx % 17 == 0, "no_data")
        .when(idx % 29 == 0, "error")
    )
    return (
        exp.join(tick_slots, ["pair", "slot"], "left")
        .select("pair", *slot_parts("slot"), status.alias("status"),
                ts_lit(as_of).alias("fetched_at"))
        .where(F.col("status").isNotNull())
    )


def fixture_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status updates for E6: hour index % 5 = 0 -> error (seq 1, as_of+1h);
    then % 10 = 0 -> fetched (seq 2, as_of+2h). Inserts and overwrites mix."""
    from ..operators.slots import expected_slots, slot_parts

    start, as_of = fixture_range(spark, sf_dir)
    exp = expected_slots(spark, as_of, start)
    start_s = utc_micros(start) // 1_000_000
    idx = floor_div(F.unix_seconds("slot") - F.lit(start_s), 3600)
    u1 = exp.where(idx % 5 == 0).select(
        "pair", *slot_parts("slot"), F.lit("error").alias("status"),
        ts_lit(as_of + dt.timedelta(hours=1)).alias("fetched_at"),
        F.lit(1).alias("update_seq"))
    u2 = exp.where(idx % 10 == 0).select(
        "pair", *slot_parts("slot"), F.lit("fetched").alias("status"),
        ts_lit(as_of + dt.timedelta(hours=2)).alias("fetched_at"),
        F.lit(2).alias("update_seq"))
    return u1.unionByName(u2)


def write_bar_files(bars: DataFrame, root: str) -> DataFrame:
    """Stored bars as one Parquet file per pair and year with nanosecond times
    (the other layout, sources/barfiles.py). A task holds one file's rows, as
    the format fixes. Run an action on the result to write."""
    columns = [f.name for f in STORED_BAR_SCHEMA.fields]

    def write(key, pdf):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        pair, year = key
        fs, base = pafs.FileSystem.from_uri(root)
        fs.create_dir(f"{base}/{pair}", recursive=True)
        kind = {"timestamp": pa.timestamp("ns", tz="UTC"), "knowledge_time": pa.timestamp("ns", tz="UTC"), "source": pa.string(), "bar_hash": pa.string()}
        schema = pa.schema([(c, kind.get(c, pa.float64())) for c in columns])
        rows = pa.Table.from_pandas(pdf.sort_values("timestamp")[columns], schema=schema, preserve_index=False)
        pq.write_table(rows, f"{base}/{pair}/{pair}_{year}.parquet", filesystem=fs, compression="snappy", version="2.6")
        return pd.DataFrame({"pair": [pair], "year": [int(year)], "n": [len(pdf)]})

    return bars.groupBy("pair", "year").applyInPandas(write, "pair string, year int, n bigint")
