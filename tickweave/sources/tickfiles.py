"""Raw tick files: one LZMA blob per (pair, hour) at
``<root>/<PAIR>/<YYYY>/<MM>/<DD>/<HH>h_ticks.bi5`` holding 20-byte big-endian
records (ms in hour u32, ask u32, bid u32, ask volume f32, bid volume f32).

Decoding (A1) reads, decompresses and views a file chunk by chunk as a numpy
structured array; the slot comes from the path (A2). Bad files do not fail the
job: every file also gives one row about itself, with ``error`` set for
those. (Spark's file scans skip zero-length files, and so does the data source:
an empty body is known from the landing log only.)
"""

from __future__ import annotations

import lzma
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the file format: record layout and size, path pattern.
TICK_DTYPE = np.dtype([("ms", ">u4"), ("ask", ">u4"), ("bid", ">u4"), ("ask_vol", ">f4"), ("bid_vol", ">f4")])
RECORD_SIZE = 20
PATH_PATTERN = r"(?:^|/)([^/]+)/(\d{4})/(\d{2})/(\d{2})/(\d{2})h_ticks\.bi5$"
FILE_GLOB = "*h_ticks.bi5"

DECODED_SCHEMA = T.StructType([
    T.StructField("pair", T.StringType()),
    T.StructField("slot", T.TimestampType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("ms", T.LongType()),
    T.StructField("ask_int", T.LongType()),
    T.StructField("bid_int", T.LongType()),
    T.StructField("ask_volume", T.DoubleType()),
    T.StructField("bid_volume", T.DoubleType()),
    T.StructField("minute_volume", T.DoubleType()),
    T.StructField("error", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("records", T.LongType()),
    T.StructField("trailing", T.IntegerType()),
])


def slot_from_path(path="path") -> list[Column]:
    """A2: pair and slot parsed from a landing path (inverse of the path
    builder). The pair is the whole folder name; a path of another form gives
    an empty pair and NULL slot, an impossible date or hour a NULL slot."""
    p = F.col(path) if isinstance(path, str) else path

    def part(i: int) -> Column:
        return F.regexp_extract(p, PATH_PATTERN, i)

    ok = part(1) != ""
    slot = F.when(ok, F.try_make_timestamp(
        part(2).cast("int"), part(3).cast("int"), part(4).cast("int"), part(5).cast("int"),
        F.lit(0), F.lit(0),
    ))
    return [part(1).alias("pair"), slot.alias("slot")]


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """While open, files named one by one are listed by as many tasks as there
    are cores, not by one task per file."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    was = spark.conf.get(key, None)
    spark.conf.set(key, str(max(2, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def list_tick_files(spark: SparkSession, root: str | list[str], with_content: bool = False) -> DataFrame:
    """The landed files under ``root`` (or exactly the listed file paths):
    path, length (and content if asked), plus the pair and slot from the
    path. Without ``content`` the scan only lists files (ReadSchema prunes
    the bytes)."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", FILE_GLOB)
    if isinstance(root, str):
        df = reader.option("recursiveFileLookup", "true").load(root)
    else:
        with few_listing_tasks(spark):  # the paths are listed by load()
            df = reader.load(list(root))
    cols = ["path", "length"] + (["content"] if with_content else [])
    return df.select(*cols, *slot_from_path("path"))


def no_tick_files(spark: SparkSession) -> DataFrame:
    """An empty listing with content."""
    return spark.createDataFrame([], "path string, length long, content binary, pair string, slot timestamp")


_ARROW = pa.schema([
    ("pair", pa.string()), ("slot", pa.timestamp("us", tz="UTC")), ("seq", pa.int32()), ("ms", pa.int64()), ("ask_int", pa.int64()), ("bid_int", pa.int64()),
    ("ask_volume", pa.float64()), ("bid_volume", pa.float64()), ("minute_volume", pa.float64()),
    ("error", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("records", pa.int64()), ("trailing", pa.int32()),
])
#: Bytes read and decompressed at a time; a file of any size is decoded within a few times that.
CHUNK = 1 << 20


class _MinuteVolumes:
    """Volume of each minute of a file: a compensated (Kahan) sum in record
    order with NaN skipped, which goes on from one chunk to the next. It is how
    the reference's pandas grouped sum adds fractional volumes, so bar hashes
    reproduce bit for bit."""

    def __init__(self) -> None:
        self.sums: dict[int, tuple[float, float]] = {}

    def add(self, minute: np.ndarray, total: np.ndarray) -> None:
        starts = np.flatnonzero(np.diff(minute, prepend=-1)).tolist()
        values = total.tolist()
        for a, b in zip(starts, [*starts[1:], len(values)]):
            s, c = self.sums.get(m := int(minute[a]), (0.0, 0.0))
            for v in values[a:b]:
                if v == v:
                    y = v - c
                    t = s + y
                    c = t - s - y
                    if c != c:
                        c = 0.0
                    s = t
            self.sums[m] = s, c


def _batch(n: int, pair: str | None, slot, **columns) -> pa.RecordBatch:
    known = {"pair": pa.repeat(pa.scalar(pair, pa.string()), n), "slot": pa.repeat(pa.scalar(slot, _ARROW.field("slot").type), n)}
    known |= {k: pa.array(v, _ARROW.field(k).type) for k, v in columns.items()}
    return pa.RecordBatch.from_arrays([known[f.name] if f.name in known else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def _inflated(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The decompressed bytes of LZMA streams set end to end, ``CHUNK`` at a time."""
    d = lzma.LZMADecompressor()
    some = False
    for chunk in chunks:
        some = True
        while True:
            if d.eof:  # bytes behind a stream begin another one, or are padding
                chunk = (d.unused_data + chunk).lstrip(b"\0")
                if not chunk:
                    break
                d = lzma.LZMADecompressor()
            out = d.decompress(chunk, CHUNK)
            chunk = b""
            if out:
                yield out
            if d.eof:
                if not d.unused_data:
                    break
            elif d.needs_input:
                break
    if some and not d.eof:
        raise EOFError("Compressed data ended before the end-of-stream marker was reached")


class _Records:
    """One pass over a file's records."""

    def __init__(self, pair: str, slot) -> None:
        self.pair, self.slot, self.n, self.rest, self.volumes = pair, slot, 0, b"", _MinuteVolumes()

    def batches(self, chunks: Iterable[bytes]) -> Iterator[pa.RecordBatch]:
        for raw in _inflated(chunks):
            raw = self.rest + raw
            count = len(raw) // RECORD_SIZE
            self.rest = raw[count * RECORD_SIZE :]  # a record cut by the chunk's end; at last a trailing one, which is dropped
            rec = np.frombuffer(raw, dtype=TICK_DTYPE, count=count)
            ms = rec["ms"].astype(np.int64)
            ask_v, bid_v = rec["ask_vol"].astype(np.float64), rec["bid_vol"].astype(np.float64)
            self.volumes.add(ms // 60000, ask_v + bid_v)
            yield _batch(
                count, self.pair, self.slot, seq=np.arange(self.n, self.n + count, dtype=np.int32), ms=ms, ask_int=rec["ask"].astype(np.int64),
                bid_int=rec["bid"].astype(np.int64), ask_volume=ask_v, bid_volume=bid_v)
            self.n += count


#: Decoded bytes of a file that are held until it is known to end well.
HELD = 32 << 20


def decode_file(path: str, length: int, pair: str, slot, chunks: Callable[[], Iterable[bytes]]) -> Iterator[pa.RecordBatch]:
    """A file's records in order, then one row a minute with its volume
    (``seq`` null), and last one row about the file (``path`` set). A file that
    does not end well has that last row alone; as this is known at its end
    only, a file of more than ``HELD`` decoded bytes is read a second time."""
    about = {"path": [path], "length": [length]}
    if not pair or slot is None or pd.isna(slot):
        yield _batch(1, pair, None, **about, records=[0], trailing=[0], error=["unrecognised path"])
        return
    held, size, records = [], 0, _Records(pair, slot)
    try:
        for batch in records.batches(chunks()):
            size += batch.nbytes
            held = [*held, batch] if size <= HELD else []
    except (lzma.LZMAError, EOFError, ValueError) as exc:
        yield _batch(1, pair, slot, **about, records=[0], trailing=[0], error=[f"lzma: {exc}"])
        return
    yield from held if size <= HELD else _Records(pair, slot).batches(chunks())
    sums = records.volumes.sums
    if sums:
        yield _batch(len(sums), pair, slot, ms=[60000 * m for m in sums], minute_volume=[s for s, _ in sums.values()])
    yield _batch(1, pair, slot, **about, records=[records.n], trailing=[len(records.rest)])


_FLUSH_ROWS = 100_000


def together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= _FLUSH_ROWS:
            yield from pa.Table.from_batches(held, _ARROW).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held, _ARROW).combine_chunks().to_batches()


_OUT_DTYPES = {"seq": "Int32", "ms": "Int64", "ask_int": "Int64", "bid_int": "Int64",
               "ask_volume": "float64", "bid_volume": "float64", "minute_volume": "float64", "error": object,
               "path": object, "length": "Int64", "records": "Int64", "trailing": "Int32"}


def _decode_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        files = zip(pdf["path"], pdf["length"], pdf["pair"], pdf["slot"], pdf["content"])
        parts = (part for path, length, pair, slot, content in files for part in decode_file(path, length, pair, slot, lambda content=content: [content] if content else []))
        for batch in together(parts):
            yield batch.to_pandas().astype(_OUT_DTYPES)


def decode_tick_files(files: DataFrame) -> DataFrame:
    """A1: raw records (DECODED_SCHEMA) from a listing with ``content``, as
    ``decode_file`` gives them. For frames of files at hand; whole folders are
    read by the data source (sources/tickformat.py)."""
    return files.select("path", "length", "pair", "slot", "content").mapInPandas(_decode_batches, DECODED_SCHEMA)


def read_tick_files(spark: SparkSession, root: str, pairs: list[str] | None = None) -> DataFrame:
    """Records of all files under ``root``, and one row about each file."""
    from .tickformat import tick_format

    rows = tick_format(spark).load(root)
    if pairs:
        rows = rows.where(F.col("pair").isin(list(pairs)))
    return rows.where(F.col("seq").isNotNull() | F.col("path").isNotNull())


# ------------------------------------------------------------------ encoder


def _fs_for(path: str):
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path)


def record_bytes(pdf: pd.DataFrame, order: list[str] | None = None) -> bytes:
    """Records of one slot, in ``order`` (default ``seq``)."""
    pdf = pdf.sort_values(order or ["seq"])
    rec = np.empty(len(pdf), dtype=TICK_DTYPE)
    rec["ms"] = pdf["ms"].to_numpy()
    rec["ask"] = pdf["ask_int"].to_numpy()
    rec["bid"] = pdf["bid_int"].to_numpy()
    rec["ask_vol"] = pdf["ask_volume"].to_numpy()
    rec["bid_vol"] = pdf["bid_volume"].to_numpy()
    return rec.tobytes()


def compress(raw: bytes) -> bytes:
    return lzma.compress(raw, format=lzma.FORMAT_ALONE)


def encode_ticks(pdf: pd.DataFrame, order: list[str] | None = None) -> bytes:
    """Records of one slot as an LZMA blob."""
    return compress(record_bytes(pdf, order))


def raw_path(root: str, pair: str, ts: pd.Timestamp) -> str:
    return f"{root.rstrip('/')}/{pair}/{ts.year:04d}/{ts.month:02d}/{ts.day:02d}/{ts.hour:02d}h_ticks.bi5"


LANDED_SCHEMA = "pair string, slot timestamp, path string, n_bytes bigint"


def sound_file(root: str, pair: str, slot: pd.Timestamp, raw: bytes) -> tuple[str, bytes]:
    """Path and content of a slot's file."""
    return raw_path(root, pair, slot), compress(raw)


def _write_file(root: str, pair: str, slot, pdf: pd.DataFrame, order: list[str], finish) -> tuple:
    slot = pd.Timestamp(slot)
    path, blob = finish(root, pair, slot, record_bytes(pdf, order))
    fs, p = _fs_for(path)
    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(p) as out:
        out.write(blob)
    return pair, slot, path, len(blob)


def write_tick_files(raw_ticks: DataFrame, root: str, order: list[str] | None = None, finish=sound_file) -> DataFrame:
    """Encode raw records (RAW_TICK_SCHEMA, or any columns ``order`` names
    for the record order) into one file per (pair, slot).

    Rows are hash-partitioned by (pair, slot) and sorted, then a
    ``mapInPandas`` writes each contiguous slot group as one file (a slot is
    the unit the file format fixes); a group cut by an Arrow batch boundary is
    carried into the next batch. Files are written by the executors through
    pyarrow's filesystem layer, so ``root`` can be any shared filesystem URI;
    a retried task rewrites identical bytes. Returns the lazy landing
    listing; run an action on it to write. ``finish`` may give another path
    or content (damaged files, in tests).
    """
    order = order or ["seq"]
    cols = ["pair", "slot", *order, "ms", "ask_int", "bid_int", "ask_volume", "bid_volume"]

    out_cols = ["pair", "slot", "path", "n_bytes"]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key, open_parts = None, []  # the slot group still running at a batch end
        for pdf in batches:
            if pdf.empty:
                continue
            groups = [(k, g) for k, g in pdf.groupby(["pair", "slot"], sort=False)]
            written = []
            if open_parts and groups[0][0] == open_key:
                open_parts.append(groups[0][1])
                groups = groups[1:]
            if open_parts and groups:  # the open group ended inside this batch
                written.append(_write_file(root, *open_key, pd.concat(open_parts), order, finish))
                open_key, open_parts = None, []
            if groups:
                for k, g in groups[:-1]:
                    written.append(_write_file(root, *k, g, order, finish))
                open_key, open_parts = groups[-1][0], [groups[-1][1]]
            if written:
                yield pd.DataFrame(written, columns=out_cols)
        if open_parts:
            yield pd.DataFrame([_write_file(root, *open_key, pd.concat(open_parts), order, finish)], columns=out_cols)

    return (
        raw_ticks.select(*cols)
        .repartition("pair", "slot")
        .sortWithinPartitions("pair", "slot", *order)
        .mapInPandas(encode, LANDED_SCHEMA)
    )
