"""Fixed schemas of the data model (ticks, bars, stored bars, catalog)."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw records as decoded from a tick file, before price scaling.
RAW_TICK_SCHEMA = T.StructType([
    T.StructField("pair", T.StringType()),
    T.StructField("slot", T.TimestampType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("ms", T.LongType()),
    T.StructField("ask_int", T.LongType()),
    T.StructField("bid_int", T.LongType()),
    T.StructField("ask_volume", T.DoubleType()),
    T.StructField("bid_volume", T.DoubleType()),
])

TICK_SCHEMA = T.StructType([
    T.StructField("pair", T.StringType()),
    T.StructField("slot", T.TimestampType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("ask", T.DoubleType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("mid", T.DoubleType()),
    T.StructField("ask_volume", T.DoubleType()),
    T.StructField("bid_volume", T.DoubleType()),
])

# Bars as produced by aggregation; ``slot`` is lineage used by the merge's
# keep-first rule and is dropped on write.
BAR_SCHEMA = T.StructType([
    T.StructField("pair", T.StringType()),
    T.StructField("slot", T.TimestampType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("source", T.StringType()),
])

# Stored bar columns, in file order; the store adds partition columns pair, year.
STORED_BAR_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("knowledge_time", T.TimestampType()),
    T.StructField("bar_hash", T.StringType()),
])

CATALOG_SCHEMA = T.StructType([
    T.StructField("pair", T.StringType()),
    T.StructField("year", T.ShortType()),
    T.StructField("month", T.ByteType()),
    T.StructField("day", T.ByteType()),
    T.StructField("hour", T.ByteType()),
    T.StructField("status", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
])

SLOT_KEY = ["pair", "year", "month", "day", "hour"]

# Raw file listing as read by the binaryFile source.
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
