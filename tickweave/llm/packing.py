"""Best-fit packing of token pieces by large-item matching.

Documents become ids (each distinct word of a task is encoded once) and pieces
of at most ``CAPACITY`` ids. Packing needs only how many pieces have each
length, at most CAPACITY numbers: from them the driver lays out all sequences
as ranges of alike ones. Pieces longer than a third of the capacity fit at most
twice into a sequence and are matched greedily, the longest with the longest
that still fits beside it; shorter ones go, longest first, into the smallest
gap that takes them. A piece finds its place by its rank among the pieces of
its length. Ranks come from counts per task and length, so no task sees more
than its own pieces or one row per task, however common a length is.

Defined results: null text is the empty text, one piece with only the end id.
Null and repeated ids are rows like others. An empty table gives no sequence.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.common import text_of, written
from tickweave.llm.wordtable import Ids, WordTable, from_lists

CAPACITY = 2048
END_ID = 0
RANK_BITS = 40


# The tokenizer lower-cases and then encodes each match of its pattern apart
# (fixed values: the contractions). For words of these characters, ASCII and
# Latin-1 letters, normalisation does no more and the matches are PIECE's.
PLAIN = "^[!-~ªµºÀ-ÖØ-öø-ÿ]+$"
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9]|[^a-zªµºß-öø-ÿ0-9]+")
#: Most words: letters, then marks; apostrophes and digits are left to PIECE.
SIMPLE = "^(?P<letters>[a-zªµºß-öø-ÿ]*)(?P<marks>[^a-zªµºß-öø-ÿ0-9']*)$"
#: Pieces that are encoded in one text.
TOGETHER = 1000


def encoder(path: str | None = None):
    """The function that encodes words with the tokenizer at ``path``.

    Plain words fall into pieces, which many words share; distinct pieces are
    encoded once, many to a text, and told apart by the mark that ends each
    piece's last token. All other words (and those that may hold a special
    token) are encoded one by one."""
    import os

    import public_tokenizers
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
    vocabulary = t.get_vocab()
    last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def by_piece(pieces: pa.Array) -> Ids:
        at = [*range(0, len(pieces), TOGETHER), len(pieces)]
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pieces), " ").to_pylist()
        ids = np.concatenate([np.array(e.ids, dtype=np.int32) for e in t.encode_batch_fast(joined, add_special_tokens=False)])
        return ids, np.diff(np.flatnonzero(last[ids]), prepend=-1)

    table = WordTable(by_piece)

    def one_by_one(words: pa.Array) -> Ids:
        return from_lists([e.ids for e in t.encode_batch_fast(words.to_pylist(), add_special_tokens=False)])

    def by_pieces(words: pa.Array) -> Ids:
        """Lower-cased plain words."""
        found = pc.extract_regex(words, SIMPLE)
        simple = found.is_valid()
        letters, marks = (pc.struct_field(found, k).filter(simple) for k in ("letters", "marks"))
        n = len(letters)
        both = pa.concat_arrays([letters, marks]).take(pa.array(np.arange(2 * n).reshape(2, n).T.ravel()))
        there = pc.not_equal(both, "")
        rest = [PIECE.findall(w) for w in words.filter(pc.invert(simple)).to_pylist()]
        ids, sizes = table.ids(pa.concat_arrays([both.filter(there), pa.array([x for r in rest for x in r], pa.string())]))
        simple = simple.to_numpy(zero_copy_only=False)
        counts = np.concatenate([there.to_numpy(zero_copy_only=False).reshape(n, 2).sum(axis=1), [len(r) for r in rest]]).astype(np.int64)
        by_word = np.add.reduceat(sizes, np.cumsum(counts) - counts) if len(counts) else counts
        return in_order(simple, (ids[: by_word[:n].sum()], by_word[:n]), (ids[by_word[:n].sum() :], by_word[n:]))

    def encode(words: pa.Array) -> Ids:
        plain = pc.and_not(pc.match_substring_regex(words, PLAIN), pc.match_substring(words, "<|"))
        return in_order(plain.to_numpy(zero_copy_only=False), by_pieces(pc.utf8_lower(words.filter(plain))), one_by_one(words.filter(pc.invert(plain))))

    return encode


def in_order(first: np.ndarray, a: Ids, b: Ids) -> Ids:
    """Ids of words encoded apart (``a`` where ``first``, else ``b``) in the words' order."""
    sizes = np.empty(len(first), dtype=np.int64)
    sizes[first], sizes[~first] = a[1], b[1]
    of_first = np.repeat(first, sizes)
    ids = np.empty(len(of_first), dtype=np.int32)
    ids[of_first], ids[~of_first] = a[0], b[0]
    return ids, sizes


def split_words(texts: pa.Array) -> pa.ListArray:
    """Parts that are encoded apart: the tokenizer drops white space and lets no token cross it."""
    return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth) of every document;
    nth counts the pieces of that length in the task."""
    kind = docs.schema[doc_id].dataType.simpleString()
    columns = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())]

    def run(batches):
        words, task = WordTable(encoder(path)), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for b in batches:
            at, rows = [], []
            for row, ids in enumerate(words.texts(b.column("body"), split_words)):
                ids = np.append(ids, END_ID).astype("<u4")
                for k, a in enumerate(range(0, len(ids), capacity)):
                    part = ids[a : a + capacity]
                    at.append(row)
                    rows.append((k, a, len(part), zlib.crc32(part.tobytes()), task, int(seen[len(part)])))
                    seen[len(part)] += 1
            values = list(zip(*rows)) or [()] * len(columns)
            arrays = [b.column("doc_id").take(pa.array(at, pa.int64())), *[pa.array(v, t) for v, (_, t) in zip(values, columns)]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *[c for c, _ in columns]])

    return docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("body")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long")


def layout(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Where the pieces go: those of a length from rank ``first`` on lie
    ``each`` to a sequence, in sequences from ``sequence`` on, from ``offset`` on."""
    left, rows = dict(counts), []
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: (first sequence, how many)
    placed: dict[int, int] = dict.fromkeys(counts, 0)
    sequences = 0

    def put(length: int, n: int, sequence: int, gap: int, each: int = 1) -> None:
        rows.append((length, placed[length], sequence, each, capacity - gap))
        placed[length] += n
        left[length] -= n

    for a in range(capacity, capacity // 3, -1):
        while left.get(a, 0):
            b = next((x for x in range(min(a, capacity - a), capacity // 3, -1) if left.get(x, 0) > (x == a)), 0)
            n = left[a] if not b else left[a] // 2 if b == a else min(left[a], left[b])
            put(a, n, sequences, capacity)
            if b:
                put(b, n, sequences, capacity - a)
            gaps[capacity - a - b].append((sequences, n))
            sequences += n
    for a in range(capacity // 3, 0, -1):
        for gap in range(a, capacity + 1):
            if not left.get(a, 0):
                break
            each = gap // a
            ranges, gaps[gap] = gaps[gap], []
            for k, (first, n) in enumerate(ranges):
                if not left[a]:
                    gaps[gap] += ranges[k:]
                    break
                full = min(n, left[a] // each)
                if full:
                    put(a, full * each, first, gap, each)
                    gaps[gap - each * a].append((first, full))
                rest = left[a] if full < n else 0
                if rest:
                    put(a, rest, first + full, gap, each)
                    gaps[gap - rest * a].append((first + full, 1))
                if n > full + bool(rest):
                    gaps[gap].append((first + full + bool(rest), n - full - bool(rest)))
        if n := left.get(a, 0):
            each = capacity // a
            full, rest = divmod(n, each)
            put(a, n, sequences, capacity, each)
            if full:
                gaps[capacity - each * a].append((sequences, full))
            if rest:
                gaps[capacity - rest * a].append((sequences + full, 1))
            sequences += full + bool(rest)
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "each", "offset"]).sort_values(["length", "first"], ignore_index=True)


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` with sequence_id and offset; needs length, task and nth, and
    must give the same rows each time it is read (a written table)."""
    spark = parts.sparkSession
    counts, _ = written(parts.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases, _ = written(counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "piece-bases")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    plan = spark.sparkContext.broadcast(layout({r["length"]: r["n"] for r in totals}, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rows = plan.value
        keys = (rows["length"].to_numpy(np.int64) << RANK_BITS) + rows["first"].to_numpy(np.int64)
        size, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(keys, (size << RANK_BITS) + rank, side="right") - 1
        nth, each = rank - rows["first"].to_numpy()[at], rows["each"].to_numpy()[at]
        return pd.DataFrame({"sequence_id": rows["sequence"].to_numpy()[at] + nth // each, "offset": rows["offset"].to_numpy()[at] + nth % each * size})

    ranked = parts.join(bases.hint("merge"), ["task", "length"]).withColumn("place", place("length", F.col("base") + F.col("nth")))
    return ranked.select("*", "place.sequence_id", "place.offset").drop("place", "base")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    parts, _ = written(pieces(docs, doc_id, text, capacity), "pieces")
    return pack(parts, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
