"""Running sums in a given order, over all rows or within groups, that no group makes uneven.

``sum(..) over (partition by g order by o)`` sorts each group in one task. Here
rows are range-partitioned by group, order and a salt, so a hot group, and even
many rows that tie, spread over tasks. The dealt rows are written with their
task's number; sums within (task, group) come from a window over that pair,
which never holds more than a task's rows, and sums of the tasks before from a
table with at most one row per task and group on top of one per group.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.common import written


def running(rows: DataFrame, group: dict[str, Column], order: list[Column], value: Column, name: str) -> DataFrame:
    """``rows`` with the columns ``group`` and ``upto`` (the sum of the whole
    numbers ``value`` over the rows of its group up to and including this one)
    and ``whole`` (its group's sum). Rows that tie in ``order`` follow each
    other in any order. ``rows`` is read twice (ranges are sampled first), so it
    should be a written table; columns that are added here must not be in it."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumns({**group, "value": value.cast("long"), "salt": F.xxhash64(F.monotonically_increasing_id())})
    keyed = keyed.withColumns({f"by{i}": c for i, c in enumerate(order)})
    by = [*group, *[f"by{i}" for i in range(len(order))], "salt"]
    nulls_first = lambda c: F.col(c).asc_nulls_first()
    dealt = keyed.repartitionByRange(parts, *map(nulls_first, by)).withColumn("task", F.spark_partition_id())
    dealt, _ = written(dealt, f"{name}-dealt")
    sums = dealt.groupBy("task", *group).agg(F.sum("value").alias("here"))
    of_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    sums = sums.withColumn("before", F.coalesce(F.sum("here").over(of_group.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sums = sums.withColumn("whole", F.sum("here").over(of_group)).select("task", *[F.col(c).alias(f"of_{c}") for c in group], "before", "whole")
    sums, _ = written(sums, f"{name}-sums")
    within = Window.partitionBy("task", *group).orderBy(*map(nulls_first, by[len(group):])).rowsBetween(Window.unboundedPreceding, 0)
    here = dealt.withColumn("here", F.sum("value").over(within)).withColumnRenamed("task", "in_task")
    same = F.col("in_task") == F.col("task")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    out = here.join(sums, same).withColumn("upto", F.col("before") + F.col("here"))
    return out.select(*rows.columns, *[c for c in group if c not in rows.columns], "upto", "whole")
