"""The QA report's pair-days kept beside the store.

``refresh_days`` makes anew only the days that files added since the last
refresh touch, and the partitions whose files were replaced (a rewrite by a
merge, a compaction); the report is then folded from days, without a pass over
the bars. Each (pair, year) of the table carries the names of the bar files it
stands for, written in the same commit as its days, so a crash in between, or
files written by other means, only mean more days to make at the next refresh.

What reaches the driver is the listing of the store and of the table (names of
files; ``compact_store`` keeps them few) and one span of dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, ensure_utc, hadoop_fs, path_exists, written
from ..sources.barstore import STORE_READ_SCHEMA, partition_filter, read_store
from .quality import day_summary, lagged_rows

Part = tuple[str, int]


def days_path(root: str) -> str:
    return root.rstrip("/") + "_days"


def _schema(spark: SparkSession) -> T.StructType:
    """The days' columns, then the bar files of the partition (on one row of
    its own, without a day), then the partition."""
    days = day_summary(lagged_rows(spark.createDataFrame([], STORE_READ_SCHEMA))).schema
    return T.StructType([
        *[T.StructField(f.name, f.dataType) for f in days if f.name != "pair"],
        T.StructField("files", T.ArrayType(T.StringType())),
        T.StructField("pair", T.StringType()), T.StructField("year", T.IntegerType()),
    ])


def _table(spark: SparkSession, root: str) -> DataFrame:
    kept = days_path(root)
    if not path_exists(spark, kept):
        return spark.createDataFrame([], _schema(spark))
    return spark.read.schema(_schema(spark)).option("basePath", kept).parquet(kept)


def _bar_files(spark: SparkSession, root: str) -> dict[Part, list[str]]:
    fs, pattern = hadoop_fs(spark, f"{root.rstrip('/')}/pair=*/year=*/*.parquet")
    out: dict[Part, list[str]] = {}
    for f in fs.globStatus(pattern) or []:
        path = f.getPath()
        year = path.getParent()
        out.setdefault((year.getParent().getName()[5:], int(year.getName()[5:])), []).append(path.getName())
    return {part: sorted(names) for part, names in out.items()}


def kept_days(spark: SparkSession, root: str) -> DataFrame:
    """The pair-days as of the last refresh, as ``day_summary`` gives them."""
    return _table(spark, root).where(F.col("_d").isNotNull()).drop("files", "year")


def refresh_days(spark: SparkSession, root: str) -> dict[str, list[Part]]:
    """Bring the days of the store at ``root`` up to date; returns the
    partitions that were ``extended``, ``remade`` and ``dropped``. A store
    without changes is not read, an empty one gives an empty table."""
    ensure_utc(spark)
    table = _table(spark, root)
    was = {(r["pair"], r["year"]): set(r["files"]) for r in table.where(F.col("_d").isNull()).select("pair", "year", "files").collect()}
    now = _bar_files(spark, root)
    changed = [p for p in sorted(now) if was.get(p) != set(now[p])]
    extended = [p for p in changed if p in was and was[p] < set(now[p])]
    remade = [p for p in changed if p not in extended]
    dropped = sorted(set(was) - set(now))
    for pair, year in dropped:
        delete_path(spark, f"{days_path(root)}/pair={pair}/year={year}")
    if not changed:
        return {"extended": [], "remade": [], "dropped": dropped}

    bars = read_store(spark, root)
    rows, kept = bars.where(partition_filter(remade)), None
    if extended:
        added = [f"{root.rstrip('/')}/pair={p}/year={y}/{n}" for p, y in extended for n in now[p, y] if n not in was[p, y]]
        new_bars = spark.read.schema(STORE_READ_SCHEMA).option("basePath", root).parquet(*added)
        touched = written(new_bars.select("pair", "year", F.to_date("timestamp").alias("_d")).distinct(), "touched-days")
        span = touched.agg(F.min("_d").alias("first"), F.date_add(F.max("_d"), 1).alias("end")).first()
        if span["first"] is not None:  # the span is pushed to the scan, files being sorted by time
            at = F.col("timestamp")
            again = bars.where(partition_filter(extended) & (at >= F.lit(span["first"]).cast("timestamp")) & (at < F.lit(span["end"]).cast("timestamp")))
            again = again.withColumn("_d", F.to_date("timestamp")).join(touched, ["pair", "year", "_d"], "left_semi")
            rows = rows.unionByName(again.select(*bars.columns))
        kept = table.where(partition_filter(extended) & F.col("_d").isNotNull()).join(touched, ["pair", "year", "_d"], "left_anti")

    fresh = day_summary(lagged_rows(rows)).withColumn("year", F.year("_d").cast("int"))
    names = spark.createDataFrame([(p, y, now[p, y]) for p, y in changed], "pair string, year int, files array<string>")
    out = fresh.unionByName(names, allowMissingColumns=True)
    if kept is not None:
        out = out.unionByName(kept, allowMissingColumns=True)
    (
        out.repartition("pair", "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy("pair", "year").parquet(days_path(root))
    )
    return {"extended": extended, "remade": remade, "dropped": dropped}
