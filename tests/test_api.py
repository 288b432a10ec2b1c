"""End-to-end entry points: plan, ingest (batch and streaming), status, validate."""

import datetime as dt
import json
import os

from conftest import SF_SMALL, rows
from tickweave import api
from tickweave.plans.registry import land_fixture_files
from tickweave.session import scratch_path
from tickweave.sources.fixtures import fixture_catalog, fixture_range

KT = dt.datetime(2024, 2, 1)


def _store_rows(spark, root):
    return rows(api.read_store(spark, root), "pair", "timestamp", "open", "high", "low", "close", "volume", "bar_hash")


def test_ingest_batch_equals_streaming(spark):
    raw = land_fixture_files(spark, SF_SMALL)
    store_a, cat_a = scratch_path(spark, "t-a"), scratch_path(spark, "t-cat-a")
    res = api.ingest(spark, raw, store_a, cat_a, KT)
    assert res.errors == 0 and res.slots > 0
    store_b, cat_b = scratch_path(spark, "t-b"), scratch_path(spark, "t-cat-b")
    api.incremental_load(spark, raw, store_b, scratch_path(spark, "t-ck"), cat_b, KT, max_files_per_trigger=200)
    assert _store_rows(spark, store_a) == _store_rows(spark, store_b)
    cat_cols = ("pair", "year", "month", "day", "hour", "status")
    assert rows(api.read_catalog(spark, cat_a), *cat_cols) == rows(api.read_catalog(spark, cat_b), *cat_cols)
    # replaying the same files changes nothing
    api.ingest(spark, raw, store_a, cat_a, KT + dt.timedelta(days=1))
    assert _store_rows(spark, store_a) == _store_rows(spark, store_b)


def test_plan_worklist(spark):
    start, as_of = fixture_range(spark, SF_SMALL)
    cat = fixture_catalog(spark, SF_SMALL)
    wl = api.plan_worklist(spark, cat, as_of, max_hours=10, start=start).orderBy("position").collect()
    assert [r["position"] for r in wl] == list(range(1, 11))
    assert [r["pair"] for r in wl[:6]] == ["EURUSD", "GBPUSD", "USDJPY", "USDCAD", "AUDUSD", "USDCHF"]
    assert all(r["url"].startswith("https://") and r["path"].startswith("raw/") for r in wl)
    retry = api.plan_worklist(spark, cat, as_of, max_hours=12, retry_errors=True, start=start).collect()
    assert retry and {r["pair"] for r in retry} <= {"EURUSD", "GBPUSD", "USDJPY", "USDCAD", "AUDUSD", "USDCHF"}


def test_status_and_validate_outputs(spark):
    cat_path = scratch_path(spark, "t-cat")
    api.write_catalog(fixture_catalog(spark, SF_SMALL), cat_path)
    st = {r["pair"]: r for r in api.status_report(spark, cat_path).collect()}
    assert st[None]["total"] == sum(st[p]["total"] for p in st if p is not None)
    raw = land_fixture_files(spark, SF_SMALL)
    store = scratch_path(spark, "t-store")
    api.ingest(spark, raw, store, None, KT)
    rep = api.validate(spark, store)
    out = scratch_path(spark, "t-report")
    api.save_qa_report(rep, out, KT)
    local = out[len("file:"):] if out.startswith("file:") else out
    docs = []
    for name in os.listdir(local):
        if name.startswith("part-"):
            with open(os.path.join(local, name)) as f:
                docs += [json.loads(line) for line in f if line.strip()]
    assert len(docs) == 1
    doc = docs[0]
    assert doc["generated_at"].startswith("2024-02-01T00:00:00")
    assert list(doc["pairs"]) == ["EURUSD", "GBPUSD", "USDJPY", "USDCAD", "AUDUSD", "USDCHF"]
    assert doc["pairs"]["USDCHF"] == {"status": "no_data"}
    eur = doc["pairs"]["EURUSD"]
    assert set(eur) == {"total_bars", "date_range", "checks"}
    assert eur["checks"]["duplicates"]["pass"] is True
    assert set(eur["checks"]) == {"duplicates", "ohlc_integrity", "zero_volume", "gaps_over_5min", "completeness",
                                  "sources", "bar_hash_nulls", "price_spikes_5pct", "yearly_row_counts"}


def test_stream_does_not_reread_a_replaced_file_batch_ingest_does(spark):
    """A corrupt file fixed under the same name is not re-read by the file
    stream (it remembers paths); the retry goes through the batch ingest."""
    import lzma

    import numpy as np

    from tickweave.sources.tickfiles import TICK_DTYPE

    raw = scratch_path(spark, "t-raw")
    local = raw[len("file:"):] if raw.startswith("file:") else raw
    d = os.path.join(local, "EURUSD", "2024", "01", "03")
    os.makedirs(d)
    path = os.path.join(d, "10h_ticks.bi5")
    with open(path, "wb") as f:
        f.write(b"not lzma at all")
    store, cat, ck = scratch_path(spark, "t-s"), scratch_path(spark, "t-c"), scratch_path(spark, "t-k")
    api.incremental_load(spark, raw, store, ck, cat, KT)
    status = lambda: [r["status"] for r in api.read_catalog(spark, cat).collect()]
    assert status() == ["error"]

    rec = np.zeros(3, dtype=TICK_DTYPE)
    rec["ask"], rec["bid"], rec["ms"] = 110000, 109990, [0, 1000, 2000]
    with open(path, "wb") as f:
        f.write(lzma.compress(rec.tobytes(), format=lzma.FORMAT_ALONE))
    api.incremental_load(spark, raw, store, ck, cat, KT)
    assert status() == ["error"]  # same path: the stream skips it

    # the retry names the slot's landing path (as a retry worklist would)
    res = api.ingest_paths(spark, [raw + "/EURUSD/2024/01/03/10h_ticks.bi5", raw + "/EURUSD/2024/01/03/11h_ticks.bi5"],
                           store, cat, KT + dt.timedelta(hours=1))
    assert res.slots == 1 and res.errors == 0
    assert status() == ["fetched"]
    assert api.read_store(spark, store).count() == 1


def test_ingest_rewrites_only_touched_catalog_partitions(spark):
    import lzma

    import numpy as np

    from tickweave.sources.tickfiles import TICK_DTYPE

    cat = scratch_path(spark, "t-cat")
    api.write_catalog(fixture_catalog(spark, SF_SMALL), cat)
    cols = ("pair", "year", "month", "day", "hour", "status", "fetched_at")
    before = rows(api.read_catalog(spark, cat), *cols)
    raw = scratch_path(spark, "t-raw")
    local = raw[len("file:"):] if raw.startswith("file:") else raw
    d = os.path.join(local, "EURUSD", "2024", "01", "31")
    os.makedirs(d)
    rec = np.zeros(2, dtype=TICK_DTYPE)
    rec["ask"], rec["bid"] = 110000, 109990
    with open(os.path.join(d, "05h_ticks.bi5"), "wb") as f:
        f.write(lzma.compress(rec.tobytes(), format=lzma.FORMAT_ALONE))
    api.ingest(spark, raw, scratch_path(spark, "t-store"), cat, KT)
    after = rows(api.read_catalog(spark, cat), *cols)
    assert [r for r in after if r[0] != "EURUSD"] == [r for r in before if r[0] != "EURUSD"]
    new = [r for r in after if r[0] == "EURUSD" and (r[2], r[3], r[4]) == (1, 31, 5)]
    assert [r[5] for r in new] == ["fetched"]
    assert len(after) == len(before) + 1


def test_stream_as_a_service(spark):
    """Processing-time trigger: the query keeps running; new files are picked
    up by later triggers."""
    raw = land_fixture_files(spark, SF_SMALL)
    store, cat, ck = scratch_path(spark, "t-s"), scratch_path(spark, "t-c"), scratch_path(spark, "t-k")
    q = api.incremental_load(spark, raw, store, ck, cat, KT, available_now=False, max_files_per_trigger=500,
                               trigger_interval="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    batch_store = scratch_path(spark, "t-b")
    api.ingest(spark, raw, batch_store, None, KT)
    assert _store_rows(spark, store) == _store_rows(spark, batch_store)
