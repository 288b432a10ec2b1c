"""Bar files of the other layout: one Parquet file per pair and year,
``<root>/<PAIR>/<PAIR>_<YEAR>.parquet``, with nanosecond UTC timestamps.

Stores in that layout are scanned as they are (A4) and merged into a store of
ours (G3): pair and year come from the file name, timestamps become
microseconds, and where both have a minute, the stored row is kept.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists
from .barstore import STORE_READ_SCHEMA

FILE_PATTERN = r"([^/]+)/\1_(\d{4})\.parquet$"
FILE_GLOB = "*_[0-9][0-9][0-9][0-9].parquet"


def _micros(name: str, kind: T.DataType) -> Column:
    """A timestamp column as it was read: nanoseconds as a number, or a timestamp."""
    if isinstance(kind, T.LongType):
        return F.timestamp_micros(F.expr(f"(`{name}` - pmod(`{name}`, 1000)) div 1000"))  # rounded down, also before 1970
    return F.col(name).cast("timestamp")


def read_bar_files(spark: SparkSession, root: str, pairs: list[str] | None = None) -> DataFrame:
    """A4 over bar files: the rows and columns that ``read_store`` gives. With
    ``pairs`` only their folders are listed. A store of another writer may lack
    knowledge_time and bar_hash: they are null then."""
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")  # read by each task: it has to outlive this call
    roots = [f"{root.rstrip('/')}/{p}" for p in pairs] if pairs else [root]
    roots = [r for r in roots if path_exists(spark, r)]
    if not roots:
        return spark.createDataFrame([], STORE_READ_SCHEMA)
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", FILE_GLOB).parquet(*roots)
    kinds = {f.name: f.dataType for f in files.schema.fields}
    path = F.col("_metadata.file_path")
    rows = files.select(
        *[_micros(c, kinds[c]).alias(c) if c in ("timestamp", "knowledge_time") and c in kinds else
          (F.col(c) if c in kinds else F.lit(None)).cast(STORE_READ_SCHEMA[c].dataType).alias(c) for c in STORE_READ_SCHEMA.names if c not in ("pair", "year")],
        F.regexp_extract(path, FILE_PATTERN, 1).alias("pair"), F.regexp_extract(path, FILE_PATTERN, 2).alias("year"))
    return rows.where("pair <> ''").withColumn("year", F.col("year").cast("int"))


def import_bar_files(spark: SparkSession, root: str, store_root: str, pairs: list[str] | None = None, knowledge_time: dt.datetime | str | None = None):
    """Merge bar files into the store. Rows keep their load time and hash; rows
    without are stamped. Of a minute that the store has, the stored row stays;
    rows that fail the integrity check are left out, as in any merge."""
    from ..operators.bars import bar_hash
    from ..plans.merge import merge_bars
    from ..session import load_time, ts_lit

    rows = read_bar_files(spark, root, pairs)
    rows = rows.withColumns({
        "knowledge_time": F.coalesce("knowledge_time", ts_lit(load_time(knowledge_time))),
        "bar_hash": F.coalesce("bar_hash", bar_hash()),
    })
    return merge_bars(spark, rows.drop("year"), store_root, stamped=True)
