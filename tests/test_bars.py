"""Bars: aggregation, integrity (NaN rules), hash, dedup, merge properties."""

import datetime as dt
import os
import hashlib
import math
import random
import struct

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tickweave.operators import bars as B
from tickweave.plans.merge import merge_bars
from tickweave.schemas import BAR_SCHEMA
from tickweave.session import scratch_path
from tickweave.sources.barstore import read_store

NAN = float("nan")
T0 = dt.datetime(2024, 1, 3, 10, 0)


def bar(minute, o, h, lo, c, v, pair="EURUSD", slot=None):
    ts = T0 + dt.timedelta(minutes=minute)
    return (pair, slot or T0, ts, o, h, lo, c, v, "dukascopy")


def test_minute_bars_first_last_in_file_order(spark):
    ticks = spark.createDataFrame(
        [
            ("EURUSD", T0, 2, T0 + dt.timedelta(seconds=5), 1.0, 1.0, 1.3, 1.0, 1.0),
            ("EURUSD", T0, 0, T0 + dt.timedelta(seconds=5), 1.0, 1.0, 1.1, 1.0, NAN),
            ("EURUSD", T0, 1, T0 + dt.timedelta(seconds=7), 1.0, 1.0, 1.5, 2.0, 2.0),
        ],
        "pair string, slot timestamp, seq int, timestamp timestamp, ask double, bid double, mid double, "
        "ask_volume double, bid_volume double",
    )
    (r,) = B.minute_bars(ticks).collect()
    assert (r["open"], r["high"], r["low"], r["close"], r["volume"]) == (1.1, 1.5, 1.1, 1.3, 6.0)


def test_integrity_nan_rules(spark):
    df = spark.createDataFrame(
        [
            bar(0, NAN, 1.0, 1.0, 1.0, 1.0),      # NaN open, others 1: kept
            bar(1, 1.0, 0.9, 0.8, 1.0, 1.0),      # high < close: rejected
            bar(2, 1.0, 1.2, 1.1, 1.0, 1.0),      # low > open: rejected
            bar(3, 1.0, 1.0, 1.0, 1.0, -1.0),     # negative volume: rejected
            bar(4, 1.0, 1.1, 0.9, 1.0, 0.0),      # zero volume: kept by writer
            bar(5, 1.0, NAN, 0.9, 1.0, 1.0),      # NaN high compares False: kept
            bar(6, 1.0, 1.1, NAN, 1.0, 1.0),      # NaN low compares False: kept
        ],
        BAR_SCHEMA,
    )
    kept = sorted(r["timestamp"].minute for r in B.bars_valid(df).collect())
    assert kept == [0, 4, 5, 6]
    assert sorted(r["timestamp"].minute for r in B.bars_rejected(df).collect()) == [1, 2, 3]


def py_hash(ts, o, h, lo, c, v, src):
    payload = "|".join([ts.strftime("%Y-%m-%dT%H:%M:%S+00:00"), repr(o), repr(h), repr(lo), repr(c), repr(v), src])
    return hashlib.sha256(payload.encode()).hexdigest()


def test_bar_hash_matches_python_repr(spark):
    data = [
        bar(0, 1.1, 1.2, 1.0, 1.15, 10.0),
        bar(1, 1e-05, 123456789.123, 3266962400.608337, 0.00034857899289185494, 1e16),
    ]
    df = spark.createDataFrame(data, BAR_SCHEMA)
    got = {r["timestamp"]: r["h"] for r in df.select("timestamp", B.bar_hash().alias("h")).collect()}
    for p, s, ts, o, h, lo, c, v, src in data:
        assert got[ts] == py_hash(ts, o, h, lo, c, v, src)


def _store_rows(spark, root):
    return rows(read_store(spark, root), "pair", "timestamp", "open", "high", "low", "close", "volume", "knowledge_time")


def test_dedup_bad_stored_then_good_neither_survives(spark):
    root = scratch_path(spark, "t-store")
    # a bad bar already stored (e.g. imported), then a good re-delivery
    bad = spark.createDataFrame([bar(0, 1.0, 0.5, 0.9, 1.0, 1.0)], BAR_SCHEMA)
    from tickweave.sources.barstore import write_store

    write_store(B.stamp_bars(bad, T0), root)
    good = spark.createDataFrame([bar(0, 1.0, 1.1, 0.9, 1.0, 1.0)], BAR_SCHEMA)
    merge_bars(spark, good, root, T0 + dt.timedelta(days=1))
    assert read_store(spark, root).count() == 0


def test_redelivered_bar_keeps_stored(spark):
    root = scratch_path(spark, "t-store")
    first = spark.createDataFrame([bar(0, 1.0, 1.1, 0.9, 1.0, 1.0), bar(1, 1.0, 1.1, 0.9, 1.0, 1.0)], BAR_SCHEMA)
    merge_bars(spark, first, root, T0)
    again = spark.createDataFrame([bar(0, 1.0, 1.1, 0.9, 1.05, 2.0)], BAR_SCHEMA)
    merge_bars(spark, again, root, T0 + dt.timedelta(days=1))
    got = _store_rows(spark, root)
    assert len(got) == 2 and all(r[6] == 1.0 and r[7] == T0 for r in got)


def test_new_rows_newest_slot_first(spark):
    root = scratch_path(spark, "t-store")
    older = bar(0, 1.0, 1.1, 0.9, 1.0, 1.0, slot=T0 - dt.timedelta(hours=1))
    newer = bar(0, 1.0, 1.1, 0.9, 1.05, 3.0, slot=T0)
    merge_bars(spark, spark.createDataFrame([older, newer], BAR_SCHEMA), root, T0)
    (r,) = read_store(spark, root).collect()
    assert r["volume"] == 3.0


def test_merge_idempotent_and_batches_equal_one(spark):
    from tickweave.plans.registry import fixture_bars

    bars = fixture_bars(spark, SF_SMALL)
    kt = dt.datetime(2024, 2, 1)
    one = scratch_path(spark, "t-one")
    merge_bars(spark, bars, one, kt)
    snapshot = _store_rows(spark, one)
    merge_bars(spark, bars, one, kt)  # replay
    assert _store_rows(spark, one) == snapshot
    two = scratch_path(spark, "t-two")
    merge_bars(spark, bars.where(F.col("pair") < "M"), two, kt)
    merge_bars(spark, bars.where(F.col("pair") >= "M"), two, kt)
    assert _store_rows(spark, two) == snapshot


def test_merge_empty_is_noop(spark):
    root = scratch_path(spark, "t-store")
    res = merge_bars(spark, spark.createDataFrame([], BAR_SCHEMA), root, T0)
    assert res.partitions == [] and read_store(spark, root).count() == 0


def test_fixture_order_is_time_then_id(spark):
    """For any event ids: the bars open and close by (ts, event_id)."""
    from tickweave.sources import fixtures as FX

    recs = FX.fixture_records(spark, SF_SMALL)
    moved = {"event_id": F.when(F.col("event_id") % 2 == 0, F.col("event_id") + 2**62).otherwise(-F.col("event_id") - 2**61)}
    original, FX.fixture_records = FX.fixture_records, lambda *_: recs.withColumns(moved)
    try:
        got = rows(B.minute_bars(FX.fixture_ordered_ticks(spark, SF_SMALL)), "pair", "timestamp", "open", "close")
        ticks = FX.fixture_ticks(spark, SF_SMALL).collect()
        ts = {r["event_id"]: r["ts"] for r in FX.fixture_records().collect()}
    finally:
        FX.fixture_records = original
    want = {}
    for r in sorted(ticks, key=lambda r: (ts[r["seq"]], r["seq"])):
        key = (r["pair"], r["timestamp"].replace(second=0, microsecond=0))
        want[key] = (want.get(key, (r["mid"],))[0], r["mid"])
    assert got == sorted((*k, *v) for k, v in want.items())


def test_volume_does_not_depend_on_task_order(spark):
    """Fractional 32-bit volumes: the exact sum, rounded once."""
    import math
    import random

    import numpy as np

    rng = random.Random(8)
    values = [float(np.float32(rng.choice([0.1, 1.7, 985017.7, 0.0036, 33.3]) * rng.random())) for _ in range(3000)]
    want = math.fsum(values)
    for seed in (1, 2):
        shuffled = values[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame([(v,) for v in shuffled], "v double").repartition(3 + seed)
        assert df.agg(B.exact_sum(F.col("v")).alias("s")).first()["s"] == want
    odd = spark.createDataFrame([(NAN,), (None,), (-1.25,), (2.0**50,), (0.25,)], "v double")
    assert odd.agg(B.exact_sum(F.col("v")).alias("s")).first()["s"] == 2.0**50 - 1.0
    assert odd.where("v IS NULL").agg(B.exact_sum(F.col("v")).alias("s")).first()["s"] is None
    assert spark.createDataFrame([(float("inf"),), (1.0,)], "v double").agg(B.exact_sum(F.col("v"))).first()[0] == float("inf")


def test_exact_sum_at_any_magnitude(spark):
    """Against a correctly rounded sum: large volumes, digits far apart, both signs, infinities and NaN."""
    f32 = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    r, inf = random.Random(11), float("inf")
    groups = [[1.09e12] * 20, [1e9] * 9000, [1e18, 1e-18, -1e18, 0.1], [3.4e38] * 3 + [-3.4e38] * 2 + [1e-40], [2.0**53, 1.0], [2.0**53, 1.0, 2.0**-100],
              [-(2.0**53), -1.0, -(2.0**-100)], [0.0, -0.0], [NAN, 1.5, inf], [-inf, 2.0], [inf, -inf], [NAN], [1e9, 1e12, 1e18, NAN, 0.5, 3e-45]]
    groups += [[f32(r.choice([-1, 1]) * r.random() * 10 ** r.randint(-44, 38)) + f32(r.random()) for _ in range(40)] for _ in range(60)]
    rows = [(g, v) for g, vs in enumerate(groups) for v in vs]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    got = {x["g"]: x["s"] for x in df.groupBy("g").agg(B.exact_sum(F.col("v")).alias("s")).collect()}
    for g, vs in enumerate(groups):
        some = [v for v in vs if v == v]
        both = {inf, -inf} <= set(some)
        want = None if not some else NAN if both else math.fsum(some)
        assert got[g] == want or (both and math.isnan(got[g])), (g, got[g], want)
    with pytest.raises(Exception, match="not a volume"):
        spark.createDataFrame([(1e300,)], "v double").agg(B.exact_sum(F.col("v"))).collect()


def test_one_load_time_for_a_mixed_merge(spark):
    """No time given; one partition is rewritten, another appended to."""
    root = scratch_path(spark, "t-store")
    t23 = dt.datetime(2023, 12, 31, 23, 0)
    merge_bars(spark, spark.createDataFrame([("EURUSD", t23, t23, 1.0, 1.1, 0.9, 1.0, 1.0, "dukascopy")], BAR_SCHEMA), root, T0)
    batch = [("EURUSD", t23, t23 + dt.timedelta(minutes=m), 1.0, 1.1, 0.9, 1.0, 1.0, "dukascopy") for m in range(2)]
    batch += [bar(0, 1.0, 1.1, 0.9, 1.0, 1.0), bar(0, 1.0, 1.1, 0.9, 1.0, 1.0, pair="USDJPY")]
    merge_bars(spark, spark.createDataFrame(batch, BAR_SCHEMA), root)
    times = {r["knowledge_time"] for r in read_store(spark, root).where(F.col("knowledge_time") != F.lit(T0)).collect()}
    assert len(times) == 1


def test_partitions_are_emptied_without_write_metrics(spark, monkeypatch):
    """A lost metric must not leave rejected rows stored."""
    import tickweave.plans.merge as M
    from tickweave.sources.barstore import write_store

    class Lost:
        get = None

    monkeypatch.setattr(M, "_observed", lambda df, name: (df, Lost()))
    root = scratch_path(spark, "t-store")
    write_store(B.stamp_bars(spark.createDataFrame([bar(0, 1.0, 0.5, 0.9, 1.0, 1.0)], BAR_SCHEMA), T0), root)
    res = merge_bars(spark, spark.createDataFrame([bar(0, 1.0, 1.1, 0.9, 1.0, 1.0)], BAR_SCHEMA), root, T0)
    assert read_store(spark, root).count() == 0 and res.stored_bars == 0


def test_non_colliding_batch_appends_and_replay_is_idempotent(spark):
    import glob

    root = scratch_path(spark, "t-store")
    local = root[len("file:"):] if root.startswith("file:") else root
    a = spark.createDataFrame([bar(m, 1.0, 1.1, 0.9, 1.0, 1.0) for m in range(3)], BAR_SCHEMA)
    merge_bars(spark, a, root, T0)
    first_files = {f: os.path.getmtime(f) for f in glob.glob(f"{local}/pair=EURUSD/year=2024/*.parquet")}
    later = T0 + dt.timedelta(hours=1)
    b = spark.createDataFrame([bar(m, 1.0, 1.1, 0.9, 1.0, 2.0, slot=later) for m in range(60, 63)], BAR_SCHEMA)
    merge_bars(spark, b, root, T0 + dt.timedelta(days=1))
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{local}/pair=EURUSD/year=2024/*.parquet")}
    assert all(files.get(f) == t for f, t in first_files.items())  # appended, nothing rewritten
    assert len(files) > len(first_files)
    snapshot = _store_rows(spark, root)
    assert len(snapshot) == 6
    merge_bars(spark, b, root, T0 + dt.timedelta(days=2))  # replay: collides, keep-first rewrite
    assert _store_rows(spark, root) == snapshot


def test_compact_store_keeps_rows_and_cuts_files(spark):
    import glob

    from tickweave.sources.barstore import compact_store

    root = scratch_path(spark, "t-store")
    local = root[len("file:"):] if root.startswith("file:") else root
    for h in range(4):  # four non-colliding batches: four appends
        slot = T0 + dt.timedelta(hours=h)
        rows4 = [bar(60 * h + m, 1.0, 1.1, 0.9, 1.0, 1.0, slot=slot) for m in range(3)]
        merge_bars(spark, spark.createDataFrame(rows4, BAR_SCHEMA).repartition(2), root, T0)
    before = _store_rows(spark, root)
    n_before = len(glob.glob(f"{local}/pair=EURUSD/year=2024/*.parquet"))
    assert compact_store(spark, root, min_files=2) == [("EURUSD", 2024)]
    n_after = len(glob.glob(f"{local}/pair=EURUSD/year=2024/*.parquet"))
    assert _store_rows(spark, root) == before and n_after < n_before
    assert compact_store(spark, root, min_files=n_after + 1) == []


def test_force_rewrite_refilters_imported_rows(spark):
    from tickweave.sources.barstore import write_store

    root = scratch_path(spark, "t-store")
    bad_imported = spark.createDataFrame([bar(0, 1.0, 0.5, 0.9, 1.0, 1.0)], BAR_SCHEMA)
    write_store(B.stamp_bars(bad_imported, T0), root)  # an imported bad row
    new = spark.createDataFrame([bar(5, 1.0, 1.1, 0.9, 1.0, 1.0)], BAR_SCHEMA)
    merge_bars(spark, new, root, T0, force_rewrite=True)
    assert [r["timestamp"].minute for r in read_store(spark, root).collect()] == [5]


def test_crash_between_rewrite_and_append_then_replay(spark, monkeypatch):
    import tickweave.plans.merge as M

    t1 = dt.datetime(2023, 12, 31, 23, 0)  # year 2023: will collide (rewrite)
    t2 = dt.datetime(2024, 1, 2, 10, 0)    # year 2024: new partition (append)
    first = spark.createDataFrame([("EURUSD", t1, t1, 1.0, 1.1, 0.9, 1.0, 1.0, "dukascopy")], BAR_SCHEMA)
    batch = spark.createDataFrame(
        [("EURUSD", t1, t1, 1.0, 1.2, 0.9, 1.1, 2.0, "dukascopy"),
         ("EURUSD", t2, t2, 1.0, 1.1, 0.9, 1.0, 3.0, "dukascopy")], BAR_SCHEMA)
    clean = scratch_path(spark, "t-clean")
    merge_bars(spark, first, clean, T0)
    merge_bars(spark, batch, clean, T0)
    crashed = scratch_path(spark, "t-crash")
    merge_bars(spark, first, crashed, T0)

    def boom(*a, **k):
        raise RuntimeError("driver lost after the rewrite")

    monkeypatch.setattr(M, "_append", boom)
    with pytest.raises(RuntimeError):
        merge_bars(spark, batch, crashed, T0)
    monkeypatch.undo()
    merge_bars(spark, batch, crashed, T0)  # replay
    assert _store_rows(spark, crashed) == _store_rows(spark, clean)


def test_empty_bars_are_typed(spark):
    """No rows, the bars' columns and types, and a frame the operators take."""
    empty = B.empty_bars(spark)
    assert empty.schema == BAR_SCHEMA and empty.count() == 0
    assert B.dedup_bars(B.stamp_bars(empty, T0)).count() == 0 and B.bars_valid(empty).schema == BAR_SCHEMA
    assert merge_bars(spark, empty, scratch_path(spark, "t-store"), T0).partitions == []
