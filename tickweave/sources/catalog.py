"""Catalog (slot manifest) source and sink: A6, A7.

Stored as snappy Parquet partitioned by (pair, year), so an ingest rewrites
only the partitions its status updates touch (dynamic overwrite) instead of
the whole manifest. Entries are never deleted, so a partition that is not
rewritten is never stale.

Beside it, under ``<path>_hours``, lie the hour maps of the same partitions
(operators/hourmaps.py), written after them. A crash between the two leaves
maps that lack the newest entries: a run would plan those slots once more, and
the ingest, which asks the catalog itself, leaves them alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hourmaps import MAP_SCHEMA, slot_maps
from ..schemas import CATALOG_SCHEMA
from ..session import path_exists


def enforce_catalog(df: DataFrame) -> DataFrame:
    """The declared catalog schema, applied (column order and types)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CATALOG_SCHEMA.fields])


def read_catalog(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The catalog, or an empty typed catalog when none exists yet.

    ``where`` on ``pair``/``year`` prunes partitions at planning time.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], CATALOG_SCHEMA)
    df = spark.read.schema(CATALOG_SCHEMA).option("basePath", path).parquet(path)
    if where is not None:
        df = df.where(where)
    return enforce_catalog(df)


def write_catalog(catalog: DataFrame, path: str) -> None:
    """Snappy Parquet with the declared types, partitioned by
    (pair, year); the (pair, year) partitions present in ``catalog`` are
    replaced, others are left as they are.

    Written by tasks, never through the driver. Callers that overwrite
    partitions they read from cut lineage first (checkpoint). The partitions'
    hour maps are replaced with them.
    """
    rows = enforce_catalog(catalog)
    _replace(rows, path)
    _replace(slot_maps(rows), maps_path(path))


def _replace(rows: DataFrame, path: str) -> None:
    (
        rows.repartition("pair", "year")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("pair", "year")
        .parquet(path)
    )


def maps_path(path: str) -> str:
    return path.rstrip("/") + "_hours"


def read_hour_maps(spark: SparkSession, path: str) -> DataFrame:
    """The hour maps kept beside the catalog at ``path``; made from the catalog
    where it was written without them."""
    kept = maps_path(path)
    if not path_exists(spark, kept):
        return slot_maps(read_catalog(spark, path))
    return spark.read.schema(MAP_SCHEMA).option("basePath", kept).parquet(kept)
