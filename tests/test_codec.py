"""Tick-file codec: round trip and bad files."""

import datetime as dt
import lzma
import os

import numpy as np

from tickweave.plans.load import load, slot_outcome
from tickweave.session import scratch_path
from tickweave.sources.tickfiles import TICK_DTYPE, read_tick_files


def _write(root, pair, ts, payload: bytes):
    d = os.path.join(root, pair, f"{ts.year:04d}", f"{ts.month:02d}", f"{ts.day:02d}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{ts.hour:02d}h_ticks.bi5"), "wb") as f:
        f.write(payload)


def _records(n):
    rec = np.zeros(n, dtype=TICK_DTYPE)
    rec["ms"] = np.arange(n) * 1000
    rec["ask"] = 110000 + np.arange(n)
    rec["bid"] = 109990 + np.arange(n)
    rec["ask_vol"] = 1.5
    rec["bid_vol"] = 2.25
    return rec.tobytes()


def _local(spark, name):
    root = scratch_path(spark, name)
    return root[len("file:"):] if root.startswith("file:") else root


def test_every_landed_file_has_one_outcome(spark):
    root = _local(spark, "t-raw")
    t = dt.datetime(2024, 1, 3, 10)
    _write(root, "EURUSD", t, lzma.compress(_records(2) + b"\x00" * 5, format=lzma.FORMAT_ALONE))  # 45 bytes
    _write(root, "GBPUSD", t, b"\x11" * 64)                                                       # corrupt
    _write(root, "USDJPY", t, lzma.compress(b"\x01" * 5))                                          # < 20 bytes
    _write(root, "USDCAD", t, b"")                                                                 # empty
    _write(root, "XXXYYY", t, lzma.compress(_records(3)))                                          # unknown pair
    _write(root, "XEURUSD", t, lzma.compress(_records(1)))                                         # a longer folder name
    _write(root, "eurusd", t, lzma.compress(_records(1)))                                          # another spelling
    for odd in ("AUDUSD/2024/02/30/10h_ticks.bi5", "AUDUSD/2024/01/03/29h_ticks.bi5", "AUDUSD/latest/10h_ticks.bi5"):
        os.makedirs(os.path.dirname(os.path.join(root, odd)), exist_ok=True)
        with open(os.path.join(root, odd), "wb") as f:
            f.write(lzma.compress(_records(1)))

    dec = read_tick_files(spark, root)
    ticks = dec.where("path IS NULL").collect()
    eur = sorted((r for r in ticks if r["pair"] == "EURUSD"), key=lambda r: r["seq"])
    assert len(eur) == 2 and eur[1]["ms"] == 1000 and eur[1]["ask_int"] == 110001 and eur[0]["bid_volume"] == 2.25

    res = load(spark, root)
    assert {r["pair"] for r in res.bars.collect()} == {"EURUSD"}
    got = {r["path"].split(root.rstrip("/"))[-1].lstrip("/"): (r["status"], r["records"], r["trailing"], (r["error"] or "").split(":")[0])
           for r in res.outcomes.collect()}
    at = "2024/01/03/10h_ticks.bi5"
    assert got == {  # the empty file is invisible to Spark's file scans
        f"EURUSD/{at}": ("fetched", 2, 5, ""),
        f"GBPUSD/{at}": ("error", 0, 0, "lzma"),
        f"USDJPY/{at}": ("fetched", 0, 5, ""),
        f"XXXYYY/{at}": ("error", 3, 0, "unknown pair"),
        f"XEURUSD/{at}": ("error", 1, 0, "unknown pair"),
        f"eurusd/{at}": ("error", 1, 0, "unknown pair"),
        "AUDUSD/2024/02/30/10h_ticks.bi5": ("error", 0, 0, "unrecognised path"),
        "AUDUSD/2024/01/03/29h_ticks.bi5": ("error", 0, 0, "unrecognised path"),
        "AUDUSD/latest/10h_ticks.bi5": ("error", 0, 0, "unrecognised path"),
    }

    slots = spark.createDataFrame([(p, t) for p in ["EURUSD", "GBPUSD", "USDJPY", "USDCAD", "XXXYYY", "AUDUSD"]],
                                  "pair string, slot timestamp")
    # the landing log knows of the empty body
    log = spark.createDataFrame([("USDCAD", t, 200, 0)], "pair string, slot timestamp, http_status int, n_bytes bigint")
    out = {r["pair"]: r["status"] for r in slot_outcome(slots, res.outcomes, res.bad_files, log).collect()}
    assert out == {"EURUSD": "fetched", "GBPUSD": "error", "USDJPY": "fetched",
                   "USDCAD": "no_data", "XXXYYY": "error", "AUDUSD": None}


def test_ingest_counts_every_file_and_attempt(spark):
    from tickweave import api

    root = _local(spark, "t-raw")
    t = dt.datetime(2024, 1, 3, 10)
    _write(root, "EURUSD", t, lzma.compress(_records(2) + b"\x00" * 5, format=lzma.FORMAT_ALONE))
    _write(root, "GBPUSD", t, b"\x11" * 64)
    _write(root, "XEURUSD", t, lzma.compress(_records(1)))
    os.makedirs(os.path.join(root, "EURUSD/odd"))
    with open(os.path.join(root, "EURUSD/odd/10h_ticks.bi5"), "wb") as f:
        f.write(b"x")
    log = spark.createDataFrame(
        [("USDCAD", t, 200, 0), ("USDJPY", t, 404, 0), ("AUDUSD", t, 503, None), ("EURUSD", t, 200, 99)],
        "pair string, slot timestamp, http_status int, n_bytes bigint")
    store, cat = scratch_path(spark, "t-s"), scratch_path(spark, "t-c")
    statuses = lambda: {r["pair"]: r["status"] for r in api.read_catalog(spark, cat).collect()}
    want = {"EURUSD": "fetched", "GBPUSD": "error", "XEURUSD": "error", "USDCAD": "no_data", "USDJPY": "no_data", "AUDUSD": "error"}
    res = api.ingest(spark, root, store, cat, landing_log=log)
    assert (res.files, res.slots, res.errors, res.skipped, res.unplaced, res.trailing) == (4, 6, 3, 0, 1, 1)
    assert statuses() == want
    # what has an entry is left alone, and a path without a slot is not read again
    res = api.ingest(spark, root, store, cat, landing_log=log)
    assert (res.files, res.skipped, res.slots, res.unplaced) == (0, 4, 0, 1) and statuses() == want
    # on a retry fetched files are left alone, the failed ones tried again, nothing is downgraded
    res = api.ingest(spark, root, store, cat, landing_log=log, retry_errors=True)
    assert (res.files, res.skipped, res.merge.new_bars) == (3, 1, 0) and statuses() == want
    assert api.read_store(spark, store).select("knowledge_time").distinct().count() == 1


def test_second_ingest_decodes_no_file(spark):
    from tickweave import api

    root = _local(spark, "t-raw")
    for h in range(3):
        _write(root, "EURUSD", dt.datetime(2024, 1, 3, 10 + h), lzma.compress(_records(2), format=lzma.FORMAT_ALONE))
    store, cat = scratch_path(spark, "t-s"), scratch_path(spark, "t-c")
    assert api.ingest(spark, root, store, cat).files == 3
    again = api.ingest(spark, root, store, cat)
    assert (again.files, again.skipped, again.merge.partitions) == (0, 3, [])


def test_tick_prices_and_time(spark):
    root = _local(spark, "t-raw")
    t = dt.datetime(2024, 1, 3, 10)
    _write(root, "USDJPY", t, lzma.compress(_records(2), format=lzma.FORMAT_ALONE))
    (b,) = load(spark, root).bars.collect()
    ask0, bid0 = 110000 / 1000, 109990 / 1000
    ask1, bid1 = 110001 / 1000, 109991 / 1000
    assert b["open"] == (ask0 + bid0) / 2.0 and b["close"] == (ask1 + bid1) / 2.0
    assert b["timestamp"] == t and b["volume"] == 2 * (1.5 + 2.25) and b["n_ticks"] == 2


def test_fractional_volume_is_compensated_sum_in_file_order(spark):
    """pandas adds a minute's volumes with a compensated sum in row order;
    the decoded bars must carry exactly that value (bar hashes depend on it)."""
    import pandas as pd

    root = _local(spark, "t-raw")
    t = dt.datetime(2024, 1, 3, 10)
    # chosen so that the compensated and the naive sums differ in the last bit
    vols = np.array([0.0014053148915991187, 0.0654960572719574, 0.048505816608667374, 985017.6875,
                     0.6143503785133362, 372132.46875, 82775.4140625, 0.0036385448183864355], dtype=np.float32)
    rec = np.zeros(len(vols), dtype=TICK_DTYPE)
    rec["ms"] = np.arange(len(vols)) * 100
    rec["ask"], rec["bid"] = 110000, 109990
    rec["ask_vol"], rec["bid_vol"] = vols, np.float32(0.3)
    _write(root, "EURUSD", t, lzma.compress(rec.tobytes(), format=lzma.FORMAT_ALONE))
    total = vols.astype(np.float64) + np.float64(np.float32(0.3))
    expected = pd.DataFrame({"g": 0, "v": total}).groupby("g")["v"].sum().iloc[0]
    naive = 0.0
    for x in total:
        naive += x
    assert expected != naive
    (b,) = load(spark, root).bars.collect()
    assert b["volume"] == expected


def test_encoder_groups_across_arrow_batches(spark):
    """Slots cut by Arrow batch boundaries still become one complete file."""
    from pyspark.sql import functions as F

    from tickweave.sources.tickfiles import write_tick_files

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        t = dt.datetime(2024, 1, 3, 10)
        rows = [(p, t + dt.timedelta(hours=h), i, i * 10, 110000 + i, 109990, 1.0, 2.0)
                for p in ("EURUSD", "GBPUSD") for h in range(3) for i in range(5 + 6 * h)]
        raw = spark.createDataFrame(rows, "pair string, slot timestamp, seq int, ms long, ask_int long, "
                                          "bid_int long, ask_volume double, bid_volume double")
        root = _local(spark, "t-raw")
        landed = write_tick_files(raw.repartition(1), root).collect()
        assert len(landed) == 6
        dec = read_tick_files(spark, root).where("path IS NULL").groupBy("pair", "slot").agg(F.count("*").alias("n"), F.max("seq").alias("m"))
        got = sorted((r["pair"], r["slot"].hour, r["n"], r["m"]) for r in dec.collect())
        assert got == sorted((p, 10 + h, 5 + 6 * h, 4 + 6 * h) for p in ("EURUSD", "GBPUSD") for h in range(3))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_source_prunes_folders_and_deals_by_bytes(spark):
    """Filters on pair and slot are taken over whole; a large file is decoded in pieces that add up."""
    from tickweave.sources import tickfiles, tickformat

    root = _local(spark, "t-raw")
    times = [dt.datetime(2023, 12, 31, 23), dt.datetime(2024, 1, 3, 10), dt.datetime(2024, 1, 3, 11), dt.datetime(2024, 2, 1, 0)]
    for pair in ("EURUSD", "USDJPY", "GBPUSD"):
        for t in times:
            _write(root, pair, t, lzma.compress(_records(3), format=lzma.FORMAT_ALONE))
    os.makedirs(os.path.join(root, "EURUSD/latest"))
    with open(os.path.join(root, "EURUSD/latest/10h_ticks.bi5"), "wb") as f:
        f.write(b"x")
    rows = tickformat.tick_format(spark).load(root).where("path IS NOT NULL")
    assert rows.count() == 13
    slots = lambda df: sorted((r["pair"], r["slot"]) for r in df.collect())
    got = rows.where("pair IN ('EURUSD', 'USDJPY') AND slot >= timestamp'2024-01-03 11:00:00' AND slot < timestamp'2024-02-01 00:00:00'")
    assert slots(got) == [("EURUSD", times[2]), ("USDJPY", times[2])]
    scan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "EURUSD" not in scan and "2024-01-03" not in scan  # no filter is left for Spark but those on nulls
    assert slots(rows.where("slot = timestamp'2024-02-01 00:00:00'")) == [(p, times[3]) for p in ("EURUSD", "GBPUSD", "USDJPY")]
    wanted = tickformat.Wanted({"EURUSD"})
    wanted.slots.append(("LessThan", times[1].replace(tzinfo=dt.timezone.utc)))
    assert [w.folder(p) for w in (wanted,) for p in (["EURUSD"], ["EURUSD", "2023"], ["EURUSD", "2024", "01"], ["EURUSD", "2024", "02"], ["EURUSD", "latest"], ["USDJPY"])] == [
        True, True, True, False, False, False]
    parts = tickformat.partitions(root, [(f"f{i}", 100) for i in range(10)], 350, 10)
    assert [len(p.files) for p in parts] == [3, 3, 3, 1]
    assert tickfiles.read_tick_files(spark, root, ["USDJPY"]).where("path IS NULL").count() == 12


def test_a_large_file_is_decoded_in_bounded_memory(monkeypatch):
    """Chunks cut records anywhere; what is yielded equals one decode of the whole, and little is held."""
    import tracemalloc

    from tickweave.sources import tickfiles as F

    rng = np.random.default_rng(5)
    rec = np.zeros(400_000, dtype=TICK_DTYPE)
    rec["ms"] = np.sort(rng.integers(0, 3_600_000, len(rec)))
    rec["ask"], rec["bid"] = 110000, 109990
    rec["ask_vol"], rec["bid_vol"] = rng.random(len(rec), dtype=np.float32) * 1e3, np.nan
    rec["bid_vol"][::2] = 0.3
    blob = lzma.compress(rec.tobytes() + b"1234567", format=lzma.FORMAT_ALONE)

    def decoded(size, held, blob=blob):
        monkeypatch.setattr(F, "CHUNK", size)
        monkeypatch.setattr(F, "HELD", held)
        chunks = lambda: (blob[i : i + size] for i in range(0, len(blob), size))
        return F.decode_file("p", len(blob), "EURUSD", dt.datetime(2024, 1, 3, 10), chunks)

    whole = list(decoded(1 << 30, 1 << 30))
    total = lambda name: np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in whole])
    want = {c: total(c) for c in ("seq", "ms", "minute_volume", "records", "trailing")}
    import pandas as pd

    volume = rec["ask_vol"].astype(float) + rec["bid_vol"].astype(float)
    assert [x for x in want["minute_volume"] if x == x] == pd.Series(volume).groupby(rec["ms"] // 60000).sum().tolist()
    tracemalloc.start()
    got = {c: [] for c in want}
    for b in decoded(7001, 50_000):
        for c in got:
            got[c].append(b.column(c).to_numpy(zero_copy_only=False))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(np.array_equal(np.concatenate(got[c]), want[c], equal_nan=True) for c in ("ms", "minute_volume", "records", "trailing"))
    assert peak < 30_000_000 and want["records"][-1] == len(rec) and want["trailing"][-1] == 7
    bad = list(decoded(7001, 50_000, blob[: len(blob) // 2]))
    assert [b.num_rows for b in bad] == [1] and bad[0].column("error")[0].as_py().startswith("lzma")
