"""Stored minutes as bitmaps, to tell which partitions a batch collides with.

A map holds 32,768 minutes of a year; a full year takes 17 of them, 68 KiB.
Maps of the store are kept beside it and replaced by every merge, so the check
of a batch reads bitmaps only, and no stored bar. They hold every stored minute
and may hold more (bars that a check has rejected): a minute that is there for
nothing costs a rewrite, never a bar.

Each map carries a digest of its partition's file names. Where that is not the
digest of the files that are there now (a crash between bars and maps, files
written by other means, a compaction), the maps do not count and the
partition's own timestamps are read.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_fs, path_exists
from ..sources.barstore import partition_filter

MAP_SCHEMA = "bucket int, minutes binary, files string, pair string, year int"
BITS = 32_768

Part = tuple[str, int]


def minute_maps(bars: DataFrame) -> DataFrame:
    """(pair, year, bucket, minutes) of bars (pair, year, timestamp)."""
    first = F.make_timestamp(F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    minute = F.expr("(unix_seconds(timestamp) - unix_seconds(first)) div 60")
    rows = bars.select("pair", "year", "timestamp", first.alias("first")).select("pair", "year", minute.alias("minute"))
    return rows.groupBy("pair", "year", F.floor(F.col("minute") / BITS).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("minute") % BITS).alias("minutes"))


def maps_path(root: str) -> str:
    return root.rstrip("/") + "_minutes"


def file_digests(spark: SparkSession, root: str, parts: list[Part]) -> dict[Part, str]:
    """A digest of the data files' names of each partition; none where it has no file."""
    fs, _ = hadoop_fs(spark, root)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def digest(part: Part) -> str | None:
        folder = path(f"{root}/pair={part[0]}/year={part[1]}")
        if not fs.exists(folder):
            return None
        names = sorted(n for f in fs.listStatus(folder) if not (n := f.getPath().getName()).startswith(("_", ".")))
        return hashlib.sha256("/".join(names).encode()).hexdigest() if names else None

    with ThreadPoolExecutor(16) as pool:
        return {p: d for p, d in zip(parts, pool.map(digest, parts)) if d}


def kept_maps(spark: SparkSession, root: str, digests: dict[Part, str]) -> DataFrame:
    """The maps that stand for the files with these digests."""
    kept = maps_path(root)
    if not digests or not path_exists(spark, kept):
        return spark.createDataFrame([], MAP_SCHEMA)
    maps = spark.read.schema(MAP_SCHEMA).option("basePath", kept).parquet(kept).where(partition_filter(list(digests)))
    return maps.where(F.concat_ws("/", "pair", F.col("year").cast("string"), "files").isin([f"{p}/{y}/{d}" for (p, y), d in digests.items()]))


def compare(batch: DataFrame, stored: DataFrame) -> tuple[set[Part], set[Part]]:
    """The partitions whose maps share a minute with the batch's, and those that have maps."""
    both = batch.select("pair", "year", "bucket", "minutes", F.lit(0).alias("kept")).unionByName(
        stored.select("pair", "year", "bucket", "minutes", F.lit(1).alias("kept")))
    by_bucket = both.groupBy("pair", "year", "bucket").agg(
        F.sum(F.bitmap_count("minutes")).alias("each"), F.bitmap_count(F.bitmap_or_agg("minutes")).alias("together"), F.max("kept").alias("kept"))
    parts = by_bucket.groupBy("pair", "year").agg(F.bool_or(F.col("each") > F.col("together")).alias("hit"), F.max("kept").alias("kept")).collect()
    of = lambda rows: {(r["pair"], int(r["year"])) for r in rows}  # noqa: E731 - a row per partition of the batch
    return of(r for r in parts if r["hit"]), of(r for r in parts if r["kept"])


def write_maps(spark: SparkSession, root: str, maps: DataFrame, digests: dict[Part, str]) -> None:
    """``maps`` (pair, year, bucket, minutes), several to a bucket, as those of the files with ``digests``."""
    names = spark.createDataFrame([(p, y, d) for (p, y), d in digests.items()], "pair string, year int, files string")
    rows = maps.groupBy("pair", "year", "bucket").agg(F.bitmap_or_agg("minutes").alias("minutes")).join(F.broadcast(names), ["pair", "year"])
    (
        rows.select("bucket", "minutes", "files", "pair", "year").repartition("pair", "year")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        .partitionBy("pair", "year").parquet(maps_path(root))
    )
