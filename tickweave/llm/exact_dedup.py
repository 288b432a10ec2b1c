"""Exact dedup by distributed MSD radix partitioning.

A document is its whitespace-normalised bytes behind its length. Groups are
split by the length first, then by successive runs of bytes (64, then 16 times
wider each time); a group leaves as soon as it has one member or its bytes have
ended, so equality is decided by the bytes alone and no digest is taken.

Each level is one counting aggregate (combined before its shuffle, so a group
of copies sends one row per task) and one join that hands every row its new
group. The counts are written first, which leaves a plain two-sided join that
adaptive execution can split where one group holds much of the rows. Only rows
still in a group of two or more carry bytes on to the next level.

Defined results: null text equals the empty text. Of equal texts the smallest
non-null id stays (``keep_id`` is null only if no row of the group has an id);
of several rows with that id exactly one is kept. All other columns pass
through unread; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import SPACE, forget, written

FIRST_BYTES = 64
WIDER = 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: the columns ``carry`` (all by default) and
    keep_id, group_size, kept."""
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    # rows carry their text once: among the carried columns, or until they leave their group
    own = text in carry
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(doc_id).alias("id"),
        (F.lit(None).cast("string") if own else F.col(text)).alias("body"))
    body = F.col("row").getField(text) if own else F.col("body")
    octets = normalised(F.coalesce(body.cast("string"), F.lit(""))).cast("binary")
    rows = rows.withColumn("size", F.octet_length(octets).cast("long")).withColumn("grp", F.col("size"))
    ended, out, seen, width, level = [], [], 0, FIRST_BYTES, 0
    while True:
        rows = rows.withColumn("run", F.substring(octets, seen + 1, width))
        counts, counts_path = written(
            rows.groupBy("grp", "run").agg(F.count(F.lit(1)).alias("group_size"), F.min("id").alias("keep_id"))
            .filter("group_size > 1").withColumn("next", F.monotonically_increasing_id()),
            "radix-counts",
        )
        seen += width
        live = F.col("next").isNotNull() & (F.col("size") > seen)
        step, _ = written(
            rows.join(counts.hint("merge"), ["grp", "run"], "left").select(
                "row", "id", "size", F.col("next").alias("grp"), "group_size", "keep_id",
                F.when(live, F.col("body")).alias("body"), F.monotonically_increasing_id().alias("place"),
            ),
            "radix-level",
        )
        forget(spark, counts_path)
        out.append(step.filter("grp IS NULL").select("row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")))
        ended.append(step.filter(F.col("grp").isNotNull() & (F.col("size") <= seen)).select(
            "row", "id", "group_size", "keep_id", "grp", "place", F.lit(level).alias("level")))
        rows = step.filter(F.col("grp").isNotNull() & (F.col("size") > seen)).select("row", "id", "body", "size", "grp")
        if rows.isEmpty():
            break
        width, level = width * WIDER, level + 1
    copies = reduce(DataFrame.unionByName, ended)
    # several rows may share the smallest id; the first written one of them is kept
    first, _ = written(
        copies.filter(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("level", "grp").agg(F.min("place").alias("place")).drop("grp"),
        "radix-first",
    )
    marked = copies.join(first.withColumn("kept", F.lit(True)).hint("merge"), ["level", "place"], "left").select(
        "row", "keep_id", "group_size", F.coalesce("kept", F.lit(False)).alias("kept"))
    whole = reduce(DataFrame.unionByName, [*out, marked])
    fields = [F.col("row").getField(c).alias(c) for c in carry]
    return whole.select(*fields, *[F.col(c) for c in ("keep_id", "group_size", "kept")])


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that equal a kept one; same columns."""
    whole = exact_groups(docs, text, doc_id)
    names = docs.columns
    inner = whole.toDF(*[f"c{i}" for i in range(len(whole.columns))])
    return inner.filter(F.col(f"c{len(names) + 2}")).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
