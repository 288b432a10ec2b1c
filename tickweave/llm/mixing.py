"""Mixing sources to target weights by weighted fair queueing, in built-in functions only.

Every source is a queue: its documents in shuffled order, up to ``EPOCHS``
times over. A copy's virtual finish time is the words its source has sent by
its end divided by the source's target. All copies are sorted by that time over
the whole corpus (by ranges, see ``running``) and the mixture is cut where the
total budget, the words of all documents, is reached; the copy at the cut is
taken in part.

Targets share the budget by weight; a source stops at ``EPOCHS`` times its own
words and what it cannot use is shared again among the others, until none is
above. Each round is one aggregate over the sources that gives two numbers.

Defined results: null text has no words; documents without words are never
taken. Null sources are one source, the last. The shuffle is a digest of the
id, so reruns agree; rows of equal id go by size, and rows equal in both are
interchangeable. A null id hashes as the empty text. An empty table gives an
empty result; where no document has words all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import text_of, written
from tickweave.llm.running import running

WEIGHTS = (1, 2, 3)
#: No source and no document is taken more often than this.
EPOCHS = 3
SEED = "mix"


def n_words(text: str) -> Column:
    return F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) of every source of ``sizes`` (source, size). Written."""
    sources, _ = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    ranked = running(sources, {}, [F.col("source").isNull(), F.col("source")], F.lit(1), "mix-source-rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("upto") - 1) % len(weights) + 1).cast("int"))
    ranked, _ = written(ranked.select("source", "source_size", weight.alias("weight"), (epochs * F.col("source_size")).alias("most")), "mix-weights")
    budget = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        stops = F.lit(level) * F.col("weight") > F.col("most") if full >= 0 else F.lit(False)
        x = ranked.agg(F.count_if(stops).alias("full"), F.sum(F.when(stops, F.col("most"))).alias("most"), F.sum(F.when(~stops, F.col("weight"))).alias("weight")).first()
        if x["full"] == full or not x["weight"]:
            break
        full, level = x["full"], (budget - (x["most"] or 0)) / x["weight"]
    share = F.least(F.lit(level) * F.col("weight"), F.col("most").cast("double"))
    return written(ranked.select("source", "source_size", share.alias("target")), "mix-targets")[0]


def mix(docs: DataFrame, carry: list[str], source: str = "source", text: str = "text", doc_id: str = "doc_id",
        weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per row of ``docs``: the columns ``carry``, size, source_size,
    target (its source's) and ``copies``, an array of (at, words) for every time
    the row is taken: the words of the mixture before it, and how many of the
    row's words follow there."""
    rows, _ = written(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(source).cast("string").alias("source"), n_words(text).alias("size"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.monotonically_increasing_id().alias("place")), "mix-sizes")
    aims = targets(rows, weights, epochs)
    budget = aims.agg(F.sum("source_size")).first()[0] or 0
    queued = rows.filter("size > 0").select("source", "size", "id", "place", F.md5(F.concat(F.lit(f"{SEED}:"), "id")).alias("shuffled"))
    queued = running(queued, {"source": F.col("source")}, [F.col("shuffled"), F.col("id"), F.col("size")], F.col("size"), "mix-queues")
    queued = queued.withColumnsRenamed({"upto": "sent", "whole": "once"})
    # the table of sources is joined by its size: broadcast while small, else a join that skew may split
    sent = queued.join(aims.select(F.col("source").alias("name"), F.col("target").alias("aim")), F.col("source").eqNullSafe(F.col("name")))
    sent = sent.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    finish = ((F.col("epoch") - 1) * F.col("once") + F.col("sent")) / F.col("aim")
    sent = sent.select("source", "size", "id", "place", "shuffled", "epoch", finish.alias("finish"))
    sent, _ = written(sent, "mix-copies")
    order = [F.col("finish"), F.col("source").isNull(), F.col("source"), F.col("epoch"), F.col("shuffled"), F.col("id"), F.col("size")]
    whole = running(sent, {}, order, F.col("size"), "mix-order")
    at = F.col("upto") - F.col("size")
    taken = whole.select("place", F.struct(at.alias("at"), F.least(F.col("size"), budget - at).alias("words")).alias("copy")).filter(F.col("copy.words") > 0)
    taken = taken.groupBy("place").agg(F.array_sort(F.collect_list("copy")).alias("copies"))
    rows = rows.join(taken, "place", "left").join(aims.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    empty = F.array().cast("array<struct<at:bigint,words:bigint>>")
    return rows.select(*[F.col("row").getField(c).alias(c) for c in carry], "size", "source_size", "target", F.coalesce("copies", empty).alias("copies"))
