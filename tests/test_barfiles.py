"""Stores of the other layout: a Parquet file per pair and year, nanosecond times."""

import datetime as dt

import pandas as pd

from conftest import rows
from tickweave import api
from tickweave.session import scratch_path
from tickweave.sources.barfiles import import_bar_files, read_bar_files

T = pd.Timestamp("2023-12-31 23:58", tz="UTC")


def _local(spark, name):
    return scratch_path(spark, name).removeprefix("file:")


def _file(root, pair, year, bars, unit="ns", drop=()):
    import os

    os.makedirs(f"{root}/{pair}", exist_ok=True)
    pdf = pd.DataFrame(bars, columns=["timestamp", "open", "high", "low", "close", "volume"])
    pdf["source"], pdf["knowledge_time"], pdf["bar_hash"] = "feed", pd.Timestamp("2024-05-01 01:02:03.123456789", tz="UTC"), "h"
    for c in ("timestamp", "knowledge_time"):
        pdf[c] = pdf[c].astype(f"datetime64[{unit}, UTC]")
    pdf.drop(columns=list(drop)).to_parquet(f"{root}/{pair}/{pair}_{year}.parquet", index=False)


def test_files_written_by_pandas_are_scanned_and_merged(spark):
    root, store = _local(spark, "t-files"), scratch_path(spark, "t-store")
    minute = lambda k: T + pd.Timedelta(minutes=k)
    _file(root, "EURUSD", 2023, [(minute(0), 1.0, 1.2, 0.9, 1.1, 5.0), (minute(1), 1.1, 1.0, 1.2, 1.1, 5.0)])  # the second one fails the check
    _file(root, "EURUSD", 2024, [(minute(2), 1.0, 1.2, 0.9, 1.1, 5.0), (minute(3), 2.0, 2.2, 1.9, 2.1, 1.0)])
    _file(root, "USDJPY", 1969, [(pd.Timestamp("1969-12-31 23:59:59.000000001", tz="UTC"), 1.0, 1.2, 0.9, 1.1, 5.0)])
    _file(root, "notes", 20, [(minute(0), 1.0, 1.2, 0.9, 1.1, 5.0)])  # not a file of the layout
    got = rows(read_bar_files(spark, root), "pair", "year", "timestamp", "open", "knowledge_time")
    load = dt.datetime(2024, 5, 1, 1, 2, 3, 123456)
    naive = lambda k: minute(k).tz_localize(None).to_pydatetime()
    assert got == [("EURUSD", 2023, naive(0), 1.0, load), ("EURUSD", 2023, naive(1), 1.1, load), ("EURUSD", 2024, naive(2), 1.0, load),
                   ("EURUSD", 2024, naive(3), 2.0, load), ("USDJPY", 1969, dt.datetime(1969, 12, 31, 23, 59, 59), 1.0, load)]
    assert read_bar_files(spark, root, ["USDJPY", "AUDUSD"]).count() == 1
    # a stored minute stays
    bars = spark.createDataFrame([("EURUSD", naive(2), naive(2), 9.0, 9.2, 8.9, 9.1, 1.0, "own")],
                                 "pair string, slot timestamp, timestamp timestamp, open double, high double, low double, close double, volume double, source string")
    api.merge_bars(spark, bars, store, load)
    import_bar_files(spark, root, store)
    kept = rows(api.read_store(spark, store), "pair", "timestamp", "open")
    assert kept == [("EURUSD", naive(0), 1.0), ("EURUSD", naive(2), 9.0), ("EURUSD", naive(3), 2.0), ("USDJPY", dt.datetime(1969, 12, 31, 23, 59, 59), 1.0)]
    assert import_bar_files(spark, root, store) and rows(api.read_store(spark, store), "pair", "timestamp", "open") == kept


def test_microseconds_and_missing_stamps(spark):
    root = _local(spark, "t-files")
    _file(root, "EURUSD", 2023, [(T, 1.0, 1.2, 0.9, 1.1, 5.0)], unit="us", drop=["knowledge_time", "bar_hash"])
    (r,) = read_bar_files(spark, root).collect()
    assert r["timestamp"] == T.tz_localize(None) and r["knowledge_time"] is None
    store, stamp = scratch_path(spark, "t-store"), dt.datetime(2024, 6, 1)
    import_bar_files(spark, root, store, knowledge_time=stamp)
    (r,) = api.read_store(spark, store).collect()
    assert r["knowledge_time"] == stamp and len(r["bar_hash"]) == 64
    assert read_bar_files(spark, f"{root}-none").count() == 0
