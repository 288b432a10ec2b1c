"""Collisions from minute maps: which partitions a merge reads, and what it leaves."""

import datetime as dt
import random

import pytest

import tickweave.plans.merge as merge
from conftest import rows
from tickweave.operators import minutemaps as M
from tickweave.schemas import BAR_SCHEMA
from tickweave.session import scratch_path
from tickweave.sources.barstore import compact_store, read_store, write_store

T = dt.datetime(2023, 12, 31, 23, 30)
KT = dt.datetime(2024, 6, 1)


def bars(spark, minutes, pair="EURUSD", price=1.0, high=None):
    at = [T + dt.timedelta(minutes=m) for m in minutes]
    return spark.createDataFrame([(pair, t, t, price, high or price + 0.1, price - 0.1, price, 1.0, "s") for t in at], BAR_SCHEMA)


def stored(spark, root):
    return rows(read_store(spark, root), "pair", "timestamp", "open")


def reads(monkeypatch):
    """The partitions whose bars a merge reads."""
    seen = []
    original = merge.partition_filter
    monkeypatch.setattr(merge, "partition_filter", lambda parts: seen.extend(parts) or original(parts))
    scans = []
    read = merge.read_store
    monkeypatch.setattr(merge, "read_store", lambda *a, **k: scans.append(a) or read(*a, **k))
    return scans


def test_a_batch_without_collisions_reads_no_stored_bar(spark, monkeypatch):
    root = scratch_path(spark, "t-store")
    merge.merge_bars(spark, bars(spark, range(0, 60)), root, KT)
    scans = reads(monkeypatch)
    merge.merge_bars(spark, bars(spark, range(60, 90)).unionByName(bars(spark, range(0, 5), "USDJPY")), root, KT)
    assert scans == []
    res = merge.merge_bars(spark, bars(spark, [10], price=5.0).unionByName(bars(spark, [100])), root, KT)
    assert len(scans) == 1 and (res.new_bars, len(res.partitions)) == (1, 2)  # the old year alone is rewritten
    want = [("EURUSD", T + dt.timedelta(minutes=m), 1.0) for m in [*range(90), 100]] + [("USDJPY", T + dt.timedelta(minutes=m), 1.0) for m in range(5)]
    assert stored(spark, root) == want


def test_maps_equal_those_of_the_stored_bars(spark):
    rng, root = random.Random(4), scratch_path(spark, "t-store")
    for k in range(4):
        minutes = sorted(rng.sample(range(0, 500_000, 37), 50))
        merge.merge_bars(spark, bars(spark, minutes, price=1.0 + k), root, KT)
    parts = [("EURUSD", 2023), ("EURUSD", 2024)]
    kept = M.kept_maps(spark, root, M.file_digests(spark, root, parts))
    made = M.minute_maps(read_store(spark, root))
    cols = ["pair", "year", "bucket", "minutes"]
    assert rows(kept, *cols) == rows(made, *cols) and kept.count() > 10


@pytest.mark.parametrize("how", ["append", "overwrite", "compact", "no maps"])
def test_files_written_by_other_means_are_read(spark, monkeypatch, how):
    root = scratch_path(spark, "t-store")
    if how != "no maps":
        merge.merge_bars(spark, bars(spark, [0, 1]), root, KT)
    stamped = merge.stamp_bars(bars(spark, [2, 3]), KT)
    if how == "compact":
        compact_store(spark, root, min_files=1)
    else:
        write_store(stamped, root, mode="overwrite" if how == "overwrite" else "append")
    before = stored(spark, root)
    merge.merge_bars(spark, bars(spark, [0, 1, 2, 3, 4], price=7.0), root, KT)
    after = stored(spark, root)
    assert [r for r in after if r[2] == 1.0] == before and len(after) == 5
    scans = reads(monkeypatch)
    merge.merge_bars(spark, bars(spark, [5]), root, KT)
    assert scans == [] and len(stored(spark, root)) == 6


def test_rejected_minutes_cost_a_rewrite_only(spark):
    root = scratch_path(spark, "t-store")
    merge.merge_bars(spark, bars(spark, [0], high=0.5), root, KT)  # rejected: high below open
    assert stored(spark, root) == []
    merge.merge_bars(spark, bars(spark, [0, 1], price=2.0), root, KT)
    assert [r[2] for r in stored(spark, root)] == [2.0, 2.0]
