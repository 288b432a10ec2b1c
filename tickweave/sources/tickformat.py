"""Tick files as a Spark data source, for batches and streams.

``spark.read.format("tickfiles").load(root)`` gives DECODED_SCHEMA rows. The
files are listed folder by folder (pair, year, month, day); filters on ``pair``
and ``slot`` are taken over by the source, so folders that they rule out are
not even listed. Files are dealt into partitions by their bytes, and tasks read
and decode them chunk by chunk straight into Arrow batches: content never
passes through the JVM, and one large file needs no more memory than a small
one's batches.

As a stream, offsets are a high-water mark of the listing, (modification time,
path) of the last file read; a batch is the files after one mark up to another.
The start is looked up in the query's own offset log, so no state is kept
beside it. Files land whole and with growing times; ``settleSeconds`` leaves
the newest ones to the next batch where clocks may differ.

Options: ``pairs`` (comma-separated; what a filter does for batches),
``partitionBytes``, ``openCost``; streams: ``maxFilesPerTrigger``,
``checkpoint`` (the query's checkpoint folder), ``settleSeconds``.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from .tickfiles import CHUNK, DECODED_SCHEMA, PATH_PATTERN, decode_file, together

FORMAT = "tickfiles"
SUFFIX = "h_ticks.bi5"
UTC = dt.timezone.utc


def _aware(t: dt.datetime) -> dt.datetime:
    """A filter's value as UTC; timestamps reach Python as local or aware times."""
    return t.astimezone(UTC)


class Wanted:
    """Which pairs and slots a scan wants; ``slots`` has (test, value) pairs."""

    def __init__(self, pairs: set[str] | None = None) -> None:
        self.pairs, self.slots = pairs, []

    def take(self, f: Filter) -> bool:
        """Whether ``f`` is taken over, whole."""
        name = f.attribute if isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) else ()
        if name == ("pair",) and isinstance(f, (EqualTo, In)):
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            if not all(isinstance(v, str) for v in values):
                return False
            self.pairs = values if self.pairs is None else self.pairs & values
            return True
        if name == ("slot",) and not isinstance(f, In) and isinstance(f.value, dt.datetime):
            self.slots.append((type(f).__name__, _aware(f.value)))
            return True
        return False

    def _slots_between(self, first: dt.datetime, last: dt.datetime) -> bool:
        """Whether any time from ``first`` to ``last`` passes all tests."""
        for test, t in self.slots:
            ok = {"EqualTo": first <= t <= last, "GreaterThan": last > t, "GreaterThanOrEqual": last >= t, "LessThan": first < t, "LessThanOrEqual": first <= t}
            if not ok[test]:
                return False
        return True

    def folder(self, parts: list[str]) -> bool:
        """Whether the folder at pair[/year[/month[/day]]] may hold wanted files."""
        if self.pairs is not None and parts[0] not in self.pairs:
            return False
        if not self.slots or len(parts) == 1:
            return True
        if len(parts) > 4 or not all(re.fullmatch(r"\d+", p) for p in parts[1:]):
            return False
        y, m, d = (*map(int, parts[1:]), None, None)[:3]
        try:
            first = dt.datetime(y, m or 1, d or 1, tzinfo=UTC)
            last = dt.datetime(y, m or 12, d or 1, 23, 59, 59, tzinfo=UTC) + (dt.timedelta(0) if d else dt.timedelta(days=30))
        except ValueError:
            return False
        return self._slots_between(first, last)

    def file(self, pair: str, slot: dt.datetime | None) -> bool:
        if self.pairs is not None and pair not in self.pairs:
            return False
        return not self.slots or slot is not None and self._slots_between(slot, slot)


def slot_of(path: str) -> tuple[str, dt.datetime | None]:
    """A2 for one path: an unknown form gives an empty pair, an impossible time no slot."""
    m = re.search(PATH_PATTERN, path)
    if not m:
        return "", None
    try:
        return m[1], dt.datetime(*map(int, m.groups()[1:]), tzinfo=UTC)
    except ValueError:
        return m[1], None


def _open(root: str):
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(root if "://" in root or not root.startswith("file:") else "file://" + root[5:])


def listing(root: str, wanted: Wanted) -> Iterator[tuple[str, int, int]]:
    """(path below root, bytes, modification time in ns) of the wanted files."""
    import pyarrow.fs as pafs

    fs, base = _open(root)
    base = base.rstrip("/")
    todo = [[p] for p in sorted(wanted.pairs)] if wanted.pairs is not None else [[]]
    while todo:
        parts = todo.pop()
        for f in fs.get_file_info(pafs.FileSelector("/".join([base, *parts]), allow_not_found=True)):
            path = [*parts, f.base_name]
            if f.type == pafs.FileType.Directory:
                if not f.base_name.startswith(("_", ".")) and wanted.folder(path):
                    todo.append(path)
            elif f.size and f.base_name.endswith(SUFFIX) and wanted.file(*slot_of("/".join([base, *path]))):
                yield "/".join(path), f.size, f.mtime_ns


class Files(InputPartition):
    def __init__(self, root: str, files: list[tuple[str, int]]) -> None:
        self.root, self.files = root, files


def partitions(root: str, files: Iterable[tuple[str, int]], size: int, open_cost: int) -> list[Files]:
    """Files in path order, cut where a partition would exceed ``size`` bytes; opening one counts as ``open_cost``."""
    out, here, total = [], [], 0
    for path, n in sorted(files):
        if here and total + n + open_cost > size:
            out.append(Files(root, here))
            here, total = [], 0
        here.append((path, n))
        total += n + open_cost
    return [*out, Files(root, here)] if here else out


def chunks_of(fs, path: str) -> Iterator[bytes]:
    with fs.open_input_stream(path) as f:
        while chunk := f.read(CHUNK):
            yield chunk


def read_files(part: Files) -> Iterator[pa.RecordBatch]:
    fs, base = _open(part.root)
    full = lambda path: f"{part.root.rstrip('/')}/{path}"
    each = (decode_file(full(path), n, *slot_of(full(path)), lambda path=path: chunks_of(fs, f"{base.rstrip('/')}/{path}")) for path, n in part.files)
    return together(batch for file in each for batch in file)


def _decode_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files = []
        for path, n, pair, slot in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "pair", "slot"))):
            fs, name = _open(path)
            files.append(decode_file(path, n, pair, slot, lambda fs=fs, name=name: chunks_of(fs, name)))
        yield from together(part for file in files for part in file)


def decode_listed(files: DataFrame, size: int = 8 << 20, open_cost: int = 16 << 10) -> DataFrame:
    """A1 over a written table of files (path, length, pair, slot): tasks get
    about ``size`` bytes of paths each, then read and decode them themselves."""
    total = files.agg(F.sum(F.col("length") + open_cost)).first()[0] or 0
    dealt = files.select("path", "length", "pair", "slot").repartition(max(1, -(-total // size)))
    return dealt.mapInArrow(_decode_paths, DECODED_SCHEMA)


class TickFileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return DECODED_SCHEMA

    def wanted(self) -> Wanted:
        pairs = self.options.get("pairs")
        return Wanted(set(pairs.split(",")) if pairs else None)

    def deal(self, files: Iterable[tuple[str, int]]) -> list[Files]:
        return partitions(self.options["path"], files, int(self.options.get("partitionBytes", 8 << 20)), int(self.options.get("openCost", 16 << 10)))

    def reader(self, schema: StructType) -> DataSourceReader:
        return TickFileReader(self)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return TickFileStreamReader(self)


class TickFileReader(DataSourceReader):
    def __init__(self, source: TickFileSource) -> None:
        self.source, self.wanted = source, source.wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        return [f for f in filters if not self.wanted.take(f)]

    def partitions(self) -> list[Files]:
        return self.source.deal((path, n) for path, n, _ in listing(self.source.options["path"], self.wanted)) or [Files(self.source.options["path"], [])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return read_files(partition)


NO_MARK = {"time": -1, "path": ""}


def last_mark(checkpoint: str) -> dict:
    """The newest offset in a query's log; each entry ends with the source's line."""
    import pyarrow.fs as pafs

    fs, base = _open(checkpoint)
    infos = fs.get_file_info(pafs.FileSelector(f"{base.rstrip('/')}/offsets", allow_not_found=True))
    entries = sorted((int(f.base_name), f.path) for f in infos if f.base_name.isdigit())
    if not entries:
        return NO_MARK
    with fs.open_input_stream(entries[-1][1]) as f:
        return json.loads(f.read().decode().strip().split("\n")[-1])


class TickFileStreamReader(DataSourceStreamReader):
    def __init__(self, source: TickFileSource) -> None:
        self.source, self.options = source, source.options

    def _after(self, start: dict) -> list[tuple[int, str, int]]:
        mark = (start["time"], start["path"])
        return sorted((t, path, n) for path, n, t in listing(self.options["path"], self.source.wanted()) if (t, path) > mark)

    def initialOffset(self) -> dict:
        return NO_MARK

    def latestOffset(self) -> dict:
        start = last_mark(self.options["checkpoint"])
        settled = time.time_ns() - int(float(self.options.get("settleSeconds", 2)) * 1e9)
        files = [f for f in self._after(start) if f[0] <= settled][: int(self.options.get("maxFilesPerTrigger", 1000))]
        return {"time": files[-1][0], "path": files[-1][1]} if files else start

    def partitions(self, start: dict, end: dict) -> list[Files]:
        upto = (end["time"], end["path"])
        return self.source.deal((path, n) for t, path, n in self._after(start) if (t, path) <= upto)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return read_files(partition)


def _registered(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TickFileSource)


def tick_format(spark: SparkSession) -> DataFrameReader:
    """A batch reader of tick files."""
    _registered(spark)
    return spark.read.format(FORMAT)


def tick_stream(spark: SparkSession) -> DataStreamReader:
    """A stream reader of tick files."""
    _registered(spark)
    return spark.readStream.format(FORMAT)
