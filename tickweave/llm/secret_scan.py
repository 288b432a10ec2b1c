"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text). The
ledger is a Parquet table partitioned by rule version with one row per scanned
blob, found secrets or not. A scan takes one path for each distinct blob, drops
those the ledger already has for these rules, scans the rest, appends them, and
joins the ledger's findings back to every path that ever held the blob. New
rules get a new version and so scan everything again; a rerun after a crash
scans only what no finished run has appended.

Where many blobs are new, texts move once, by (blob, path), which no group of
copies makes uneven; where few or none are, no text moves. Paths
join findings by blob as two written tables, so adaptive execution can split a
blob that many paths hold.

Defined results: null text is the empty text; null paths are kept and joined
like others; repeated rows each get the findings. An empty table appends
nothing and gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import text_of, written
from tickweave.session import path_exists, scratch_path

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")
#: Rules beyond the base ones. Each pattern starts at a fixed mark, so a scan is linear.
#: A private key runs to its END line over any text without five dashes (headers, escaped
#: line ends); where none follows, over the long lines of base64 right behind its BEGIN line.
MORE = {
    "private_key": re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"
                              r"(?:[^-]*+(?:-{1,4}+(?!-)[^-]*+)*+-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/=]{32,}+)*+)"),
    "jwt": re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    "github": re.compile(r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}"),
    "slack": re.compile(r"(?<![A-Za-z0-9-])xox[abprs]-[A-Za-z0-9-]{10,}"),
    "url_password": re.compile(r"://[^\s/:@]++:[^\s/:@]++@"),
}
KINDS = (*BASE_KINDS, *MORE)
#: Keywords of ASSIGN, looked for first: most texts hold none.
HINTS = ("passw", "secret", "token", "api")
RULES = hashlib.sha256(repr([ASSIGN.pattern, ACCESS.pattern, HEX.pattern, *((k, p.pattern) for k, p in MORE.items())]).encode()).hexdigest()[:16]
FOUND = "array<struct<start:long,kind:int,end:long>>"


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, sorted."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for kind, pattern in enumerate(MORE.values(), len(BASE_KINDS)):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return sorted(out)


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        spans = [[{"start": s, "kind": k, "end": e} for s, k, e in find(t)] for t in frame["body"]]
        yield pd.DataFrame({"blob": frame["blob"], "spans": spans})


def blob_of(text: str) -> Column:
    return F.sha2(text_of(text), 256)


def _ledger(spark, ledger: str) -> DataFrame:
    schema = f"blob string, spans {FOUND}, rules string"
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(ledger).filter(F.col("rules") == RULES)


def scan_unseen(versions: DataFrame, ledger: str, key: str = "doc_id", text: str = "text") -> None:
    """Scan the blobs of ``versions`` that ``ledger`` doesn't have under these rules."""
    spark = versions.sparkSession
    rows = versions.select(F.col(key).alias("path"), text_of(text).alias("body")).withColumn("blob", F.sha2("body", 256))
    one = rows.groupBy("blob").agg(F.min("path").alias("path"))
    unseen, _ = written(one.join(_ledger(spark, ledger).select("blob"), "blob", "left_anti"), "unseen-blobs")
    if unseen.isEmpty():
        return
    # while few blobs are new, their table is broadcast (Spark knows its size) and no text moves
    todo = rows.join(unseen, (rows["blob"] == unseen["blob"]) & rows["path"].eqNullSafe(unseen["path"]), "left_semi")
    found = todo.select("blob", "body").mapInPandas(_scan, f"blob string, spans {FOUND}")
    # a path listed twice with the same text is scanned twice but entered once
    found = found.groupBy("blob").agg(F.first("spans").alias("spans")).withColumn("rules", F.lit(RULES))
    found.write.mode("append").partitionBy("rules").parquet(ledger)


def hits(spark, ledger: str) -> DataFrame:
    """(blob, spans) of the blobs with findings. Scans side by side, or one that
    is run again, may have entered a blob twice; its spans are the same. Written,
    so that a join with it stays one of two plain sides that skew may split."""
    return written(_ledger(spark, ledger).filter(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"]), "secret-hits")[0]


def new_ledger(spark) -> str:
    return scratch_path(spark, "llm-secret-ledger")


def findings(versions: DataFrame, ledger: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, blob, spans) of every row of ``versions``, after scanning what is new."""
    spark = versions.sparkSession
    scan_unseen(versions, ledger, key, text)
    paths = versions.select(F.col(key), blob_of(text).alias("blob"))
    return paths.join(hits(spark, ledger).hint("merge"), "blob", "left").select(key, "blob", F.coalesce("spans", F.array().cast(FOUND)).alias("spans"))


def kind_name(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), kind + 1)


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, ledger: str, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with each found span replaced by its kind in brackets; the
    length column, where there is one, follows the new text."""
    spark = docs.sparkSession
    scan_unseen(docs, ledger, key, text)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), blob_of(text).alias("blob"))
    rows = rows.join(hits(spark, ledger).hint("merge"), "blob", "left")
    old = F.col("row").getField(text)
    cut = F.aggregate(
        "spans", F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            F.concat(acc["done"], F.substring(old, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), kind_name(s["kind"]), F.lit("]")).alias("done"),
            s["end"].alias("at"))).otherwise(F.struct(acc["done"].alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["done"], F.substring(old, (acc["at"] + 1).cast("int"), F.char_length(old))))
    rows = rows.withColumn("new", F.when(F.col("spans").isNull(), old).otherwise(cut))

    def field(c: str) -> Column:
        if c == text:
            return F.col("new").alias(c)
        was = F.col("row").getField(c)
        if n_chars and c == n_chars:
            return F.when(F.col("spans").isNull() | was.isNull(), was).otherwise(F.char_length("new").cast(docs.schema[c].dataType)).alias(c)
        return was.alias(c)

    return rows.select(*[field(c) for c in names])
