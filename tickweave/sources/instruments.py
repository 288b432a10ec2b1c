"""Instrument dimension: the configured pairs and their price scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values (must equal the upstream configuration): pair and point value,
# in configuration order. pair_ord is that order, starting at 1.
INSTRUMENTS = [
    ("EURUSD", 1, 100000),
    ("GBPUSD", 2, 100000),
    ("USDJPY", 3, 1000),
    ("USDCAD", 4, 100000),
    ("AUDUSD", 5, 100000),
    ("USDCHF", 6, 100000),
]

PAIRS = [p for p, _, _ in INSTRUMENTS]

# Fixed value: the source label stamped on every bar.
DEFAULT_SOURCE = "dukascopy"

# Fixed value: the feed's base URL (A3's download manifest).
BASE_URL = "https://datafeed.dukascopy.com/datafeed"


def instruments(spark: SparkSession, pairs: list[str] | None = None) -> DataFrame:
    """``pair string, pair_ord int, point_value int`` — 6 rows, size is fixed.

    ``pairs`` narrows and orders the set like the reference's pair list:
    ``pair_ord`` then follows that list (quota remainders and the worklist
    turn order go by it); unknown names are ignored.
    """
    rows = INSTRUMENTS
    if pairs:
        pv_of = {p: pv for p, _, pv in INSTRUMENTS}
        picked = [p for p in dict.fromkeys(pairs) if p in pv_of]
        rows = [(p, i + 1, pv_of[p]) for i, p in enumerate(picked)]
    # a VALUES relation: planned as a local table scan with a known size,
    # no Python-side RDD behind it
    vals = ", ".join(f"('{p}', {o}, {pv})" for p, o, pv in rows)
    return spark.sql(
        f"SELECT CAST(pair AS STRING) AS pair, CAST(pair_ord AS INT) AS pair_ord, "
        f"CAST(point_value AS INT) AS point_value FROM VALUES {vals} AS t(pair, pair_ord, point_value)"
    )


def instruments_sql_values() -> str:
    """The same table as a VALUES list (for oracle SQL)."""
    vals = ", ".join(f"('{p}', {o}, {pv})" for p, o, pv in INSTRUMENTS)
    return f"(VALUES {vals}) AS instruments(pair, pair_ord, point_value)"


def with_point_value(df: DataFrame, inst: DataFrame) -> DataFrame:
    """Point-value lookup. Unknown pairs keep a NULL point value.

    The instrument table is a VALUES relation: Spark knows its size and
    broadcasts it by itself.
    """
    return df.join(inst.select("pair", "point_value"), "pair", "left")
