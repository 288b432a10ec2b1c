"""merge_bars vs a plain-Python model of the write semantics, on random
batches: year boundaries, duplicates within and across batches, bad bars,
and partitions whose rows are all rejected."""

import datetime as dt
import random

import pytest

from tickweave.plans.merge import merge_bars
from tickweave.schemas import BAR_SCHEMA
from tickweave.session import scratch_path
from tickweave.sources.barstore import read_store


def bad(o, h, lo, c, v):
    return h < max(o, c) or lo > min(o, c) or h < lo or v < 0


def model_merge(store, batch, kt):
    """store: {(pair, ts): row}; batch: list of bar tuples (BAR_SCHEMA)."""
    years = {(p, ts.year) for p, _, ts, *_ in batch}
    for pair, year in years:
        stored = [(0, None, r) for (p, ts), r in store.items() if p == pair and ts.year == year]
        new = [(1, b[1], b) for b in batch if b[0] == pair and b[2].year == year]
        best = {}
        for is_new, slot, r in stored + new:
            ts = r[2]
            vals = tuple(r[3:8])
            key = (is_new, -(slot.timestamp()) if slot else 0, vals)
            if ts not in best or key < best[ts][0]:
                best[ts] = (key, r)
        for ts in [t for (p, t) in list(store) if p == pair and t.year == year]:
            del store[(pair, ts)]
        for ts, (_, r) in best.items():
            if not bad(*r[3:8]):
                store[(pair, ts)] = r
    return store


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_matches_model(spark, seed):
    rnd = random.Random(seed)
    base = dt.datetime(2023, 12, 31, 22, 0)
    minutes = [base + dt.timedelta(minutes=rnd.randrange(0, 240)) for _ in range(30)]
    root = scratch_path(spark, "t-model")
    store = {}
    for b in range(3):
        batch = []
        for ts in rnd.sample(minutes, 12):
            pair = rnd.choice(["EURUSD", "USDJPY"])
            slot = ts.replace(minute=0) - dt.timedelta(hours=rnd.choice([0, 0, 1]))
            o = rnd.choice([1.0, 1.1])
            c = rnd.choice([1.0, 1.2])
            h = max(o, c) + rnd.choice([0.0, 0.1, -0.5])  # -0.5 makes a bad bar
            lo = min(o, c) - 0.05
            v = rnd.choice([1.0, 2.0, -1.0])
            batch.append((pair, slot, ts, o, h, lo, c, v, "dukascopy"))
        # no two rows of one batch share (pair, slot, ts): one file gives one bar per minute
        seen, uniq = set(), []
        for r in batch:
            if (r[0], r[1], r[2]) not in seen:
                seen.add((r[0], r[1], r[2]))
                uniq.append(r)
        kt = dt.datetime(2024, 2, 1) + dt.timedelta(days=b)
        merge_bars(spark, spark.createDataFrame(uniq, BAR_SCHEMA), root, kt)
        store = model_merge(store, uniq, kt)
        got = sorted(
            (r["pair"], r["timestamp"], r["open"], r["high"], r["low"], r["close"], r["volume"], r["year"])
            for r in read_store(spark, root).collect()
        )
        want = sorted((p, ts, *r[3:8], ts.year) for (p, ts), r in store.items())
        assert got == want, f"batch {b}"
