"""Host-level quality rules, in built-in functions only.

Every document gets rule counts from its whole text; failures are aggregated by
host; each host's failure rate is shrunk towards a beta prior whose two
parameters are estimated from all hosts (method of moments, weighted by
documents); a host whose shrunk rate reaches ``MAX_HOST_RATE`` fails, and with
it all its documents.

The counts are made within the row (no shuffle of text): word windows are
hashed to 64 bits and sorted with their positions, so a window that occurs
again lies beside its like. Host totals combine before their shuffle; the
prior is one row.

Defined results: null text has no words and fails. Documents of a null host
have no host verdict; only their own rules count. An empty table gives an empty
result. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import SPACE, text_of, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.8
#: Bounds of the prior's weight in documents.
PRIOR_WEIGHT = (1.0, 1e6)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _count(c: Column) -> Column:
    return F.size(c).cast("long")


def rule_counts(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` without ``text`` and with the five counts. Each step is a column
    of its own that the next uses several times, so it is computed once a row."""
    body = text_of(text)
    lines = F.filter(F.split(body, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("parts", F.split(body, SPACE)).withColumn("lines", lines)
    # white space at either end leaves an empty part there
    first = (F.get("parts", F.lit(0)) == "").cast("int")
    last = ((F.size("parts") > 1) & (F.get("parts", F.size("parts") - 1) == "")).cast("int")
    rows = rows.withColumn("words", F.slice("parts", first + 1, F.size("parts") - first - last))
    w = F.col("words")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    rows = rows.withColumns({
        "n_words": _count(w),
        "word_chars": F.char_length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "sorted": F.when(F.size(w) >= 3, F.sort_array(windows)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    })
    s = F.col("sorted")
    again = F.sort_array(F.transform(
        F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
        lambda x: x["i"]))
    # words covered by repeated windows: each window adds those beyond the one before
    covered = F.aggregate(
        again, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")), lambda acc: acc["n"])
    return rows.withColumn("n_repeat_words", covered).drop(text, "parts", "lines", "words", "sorted")


def _base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def host_verdicts(judged: DataFrame, host: str, failed: str) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, host_failed) of every non-null host."""
    hosts = judged.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed"))
    hosts, _ = written(hosts, "host-rates")
    total = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("k")).first()
    n, k = total["n"] or 0, total["k"] or 0
    mean = k / n if n else 0.0
    off = hosts.agg(F.sum(F.col("n_docs") * F.pow(F.col("n_failed") / F.col("n_docs") - mean, 2)).alias("v")).first()["v"] or 0.0
    spread = off / n if n else 0.0
    weight = mean * (1 - mean) / spread - 1 if spread > 0 else PRIOR_WEIGHT[1]
    weight = min(max(weight, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])
    rate = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.withColumn("shrunk_rate", rate).withColumn("host_failed", F.col("shrunk_rate") >= MAX_HOST_RATE)


def judge(docs: DataFrame, host: str = "source", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` (all by default), the counts, base_failed, host_rate, kept."""
    carry = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(host).cast("string").alias("host"), F.col(text).alias("body"))
    rows = rule_counts(rows, "body").withColumn("base_failed", _base_failed())
    rows, _ = written(rows, "rule-counts")
    verdicts, _ = written(host_verdicts(rows, "host", "base_failed").select("host", "shrunk_rate", "host_failed"), "host-verdicts")
    kept = ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))
    out = rows.join(verdicts, "host", "left")
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in carry], *COUNTS,
        "base_failed", F.round("shrunk_rate", 9).alias("host_rate"), kept.alias("kept"))


def keep_good(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` without the rows that their rules or their host reject. Rules
    are counted once: rows that pass their own are written whole, the others
    as their host only, and the host verdicts are joined to what was written."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(host).cast("string").alias("host"), F.col(text).alias("body"))
    rows = rule_counts(rows, "body").withColumn("base_failed", _base_failed())
    rows, _ = written(rows.select(F.when(~F.col("base_failed"), F.col("row")).alias("row"), "host", "base_failed"), "rule-verdicts")
    verdicts, _ = written(host_verdicts(rows, "host", "base_failed").select("host", "host_failed"), "host-verdicts")
    good = rows.filter(~F.col("base_failed")).join(verdicts, "host", "left")
    return good.filter(~F.coalesce("host_failed", F.lit(False))).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
