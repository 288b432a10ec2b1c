"""Bar store: Parquet partitioned by (pair, year) — scan (A4) and sink (A5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import STORED_BAR_SCHEMA
from ..session import path_exists

STORE_READ_SCHEMA = T.StructType(
    list(STORED_BAR_SCHEMA.fields)
    + [T.StructField("pair", T.StringType()), T.StructField("year", T.IntegerType())]
)


def store_columns(bars: DataFrame) -> DataFrame:
    """B10 + B9: fixed column order and types, plus the partition columns."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED_BAR_SCHEMA.fields]
    return bars.select(*cols, F.col("pair").cast("string").alias("pair"),
                       F.year("timestamp").cast("int").alias("year"))


def read_store(spark: SparkSession, root: str, pairs: list[str] | None = None) -> DataFrame:
    """A4: all bars, with ``pair`` and ``year`` from the partition path.

    A pair filter prunes partitions at planning time (B11).
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], STORE_READ_SCHEMA)
    df = spark.read.schema(STORE_READ_SCHEMA).option("basePath", root).parquet(root)
    if pairs:
        df = df.where(F.col("pair").isin(list(pairs)))
    return df


def partition_filter(parts: list[tuple[str, int]]) -> Column:
    """Rows of exactly these (pair, year) partitions. One flat list, looked up
    by hash, however many there are; on partition columns it prunes."""
    names = [f"{pair}/{int(year)}" for pair, year in parts]
    return F.concat_ws("/", F.col("pair"), F.col("year").cast("string")).isin(names)


def write_store(bars: DataFrame, root: str, mode: str = "overwrite") -> None:
    """A5 + F1: snappy Parquet under ``pair=/year=``; each written partition
    is replaced as a whole (dynamic overwrite), others are untouched.

    ``rebalance(pair, year)`` clusters rows for the partitioned write and lets
    AQE coalesce small partitions and split an oversized (pair, year) into
    several tasks (advisory partition size), so a hot pair never becomes one
    task; each file is time-ordered inside. ``mode="append"`` adds files to
    the partitions instead (used when the batch shares no minute with them).
    """
    out = store_columns(bars).hint("rebalance", "pair", "year")
    (
        out.sortWithinPartitions("pair", "year", "timestamp")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("pair", "year")
        .parquet(root)
    )


def compact_store(spark: SparkSession, root: str, min_files: int = 16, small_bytes: int = 32 << 20) -> list[tuple[str, int]]:
    """Rewrite the (pair, year) partitions of at least ``min_files`` files that
    are smaller than ``small_bytes`` on average (appends accumulate small
    files) as a few time-ordered files.

    The file listing is a Spark scan that reads no content; only the list of
    partitions to compact — at most one entry per (pair, year) — reaches the
    driver. Rows are unchanged: the partitions are read and replaced by the
    same dynamic-overwrite write (old files go at job commit).
    """
    if not path_exists(spark, root):
        return []
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").load(root)
        .select(
            F.regexp_extract("path", r"pair=([^/]+)/", 1).alias("pair"),
            F.regexp_extract("path", r"year=(\d+)/", 1).cast("int").alias("year"),
            "length",
        )
    )
    sizes = files.groupBy("pair", "year").agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
    parts = [(r["pair"], int(r["year"])) for r in sizes.where((F.col("n") >= min_files) & (F.col("mean") < small_bytes)).collect()]
    if parts:
        write_store(read_store(spark, root).where(partition_filter(parts)), root)
    return parts
