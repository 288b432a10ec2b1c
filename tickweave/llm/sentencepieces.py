"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece of the model has a character before a whitespace marker, merges
never cross from a character to a marker. A text, with the marker that the
library puts in front, then falls apart into chunks (markers, then characters)
that are segmented alone. Each task segments a distinct chunk once while its
table holds it (the table starts anew beyond ``wordtable.WORDS`` chunks) and joins
the ids back by position. The table stays within the task: chunks that occur in
many tasks are cheap to segment again, and sending every task's own chunks to
one place and back would move more bytes than the texts hold (see README).

The vocabulary is looked through before the first use; a model whose pieces do
cross markers, or that drops or rewrites white space, is refused.

Defined results: null text is the empty text, which has the end id only. Null
and repeated ids are rows like others. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import text_of
from tickweave.llm.wordtable import Ids, WordTable, from_lists

MARK = "▁"
CHUNK = re.compile(" *[^ ]+| +")
CROSSING = re.compile(f"[^{MARK}]{MARK}")


def model_path(path: str | None = None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path("piece_bpe_32k.model")


def check_model(path: str) -> None:
    """Refuse a model whose chunks cannot be segmented alone."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    crossing = [x for x in map(p.id_to_piece, range(p.get_piece_size())) if CROSSING.search(x)]
    probe = " a  b\nÅﬁ "  # kept as it is: no normalisation, no dropped white space, a marker in front
    if crossing or p.normalize(probe) != MARK + probe.replace(" ", MARK):
        raise ValueError(f"chunks of this model cannot be segmented apart: {crossing[:5]}")


def split_chunks(texts: pa.Array) -> pa.ListArray:
    """Chunks with a space for each marker; the first has the one put in front."""
    texts = pc.replace_substring(texts, MARK, " ")
    if pc.any(pc.or_(pc.starts_with(texts, " "), pc.match_substring(texts, "  "))).as_py():
        return pa.array([CHUNK.findall(" " + t) if t else [] for t in texts.to_pylist()], pa.list_(pa.string()))
    texts = pc.if_else(pc.equal(texts, ""), pa.scalar(None, pa.string()), texts)
    return _marked(pc.split_pattern(texts, " "))  # one marker each


def _marked(lists: pa.ListArray) -> pa.ListArray:
    """The words with a space in front; nulls become empty lists."""
    words = pc.binary_join_element_wise(pa.scalar(""), lists.flatten(), " ")
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), words)


def chunk_encoder(processor):
    """Ids of chunks; the library puts one marker in front itself."""
    lone = [processor.piece_to_id(MARK)]

    def encode(chunks: pa.Array) -> Ids:
        chunks = chunks.to_pylist()
        ids = processor.encode([c[1:] for c in chunks], num_threads=1)
        return from_lists([lone if c == " " else x for c, x in zip(chunks, ids)])

    return encode


def _id_type(docs: DataFrame, doc_id: str) -> str:
    return docs.schema[doc_id].dataType.simpleString()


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("body"))


def _encoded(bodies: pa.Array, table: WordTable, end: int) -> Iterator[list[int]]:
    for ids in table.texts(bodies, split_chunks):
        out = ids.tolist()
        out.append(end)
        yield out


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids): every text's ids and the end id."""
    path = model_path(path)
    check_model(path)

    def run(batches):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        table = WordTable(chunk_encoder(p))
        for b in batches:
            ids = pa.array(list(_encoded(b.column("body"), table, p.eos_id())), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids], ["doc_id", "ids"])

    return _rows(docs, doc_id, text).mapInArrow(run, f"doc_id {_id_type(docs, doc_id)}, ids array<int>")


def decode(rows: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``rows`` with the column ``decoded``: the text of each row's ids."""
    path = model_path(path)

    @F.pandas_udf("string")
    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        for x in frames:
            yield pd.Series([None if y is None else p.decode([int(z) for z in y]) for y in x], dtype=object)

    return rows.withColumn("decoded", run(ids))


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode and decode in one pass."""
    path = model_path(path)
    check_model(path)

    def run(batches):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        table, end, digits = WordTable(chunk_encoder(p)), p.eos_id(), [str(i) for i in range(p.get_piece_size())]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            n, own, back = [], [], []
            for ids in _encoded(b.column("body"), table, end):
                n.append(len(ids))
                own.append(sha(" ".join([digits[i] for i in ids])))
                back.append(sha(p.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs, doc_id, text).mapInArrow(run, f"doc_id {_id_type(docs, doc_id)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
