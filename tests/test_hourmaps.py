"""Pending slots from hour bitmaps against the slot rows they stand for."""

import datetime as dt
import random

import pytest

from conftest import rows
from tickweave.operators import hourmaps as H
from tickweave.operators import slots as S
from tickweave.schemas import CATALOG_SCHEMA
from tickweave.session import scratch_path
from tickweave.sources.catalog import read_catalog, read_hour_maps, write_catalog
from tickweave.sources.instruments import instruments

COLUMNS = ["pair", "pair_ord", "slot", "year", "month", "day", "hour"]
T = dt.datetime(2025, 1, 1)


def catalog(spark, seed, first, hours):
    rng = random.Random(seed)
    slots = [first + dt.timedelta(hours=rng.randrange(hours)) for _ in range(300)] + [first + dt.timedelta(hours=k) for k in (0, hours - 1)]
    entries = {(p, t): rng.choice(["fetched", "no_data", "error", "odd"]) for p in ("EURUSD", "USDJPY", "NOPAIR") for t in slots}
    return spark.createDataFrame([(p, t.year, t.month, t.day, t.hour, s, T) for (p, t), s in entries.items()], CATALOG_SCHEMA)


@pytest.mark.parametrize("start, as_of, pairs", [
    (dt.datetime(2024, 12, 29), dt.datetime(2025, 1, 4, 5, 30), None),  # over the end of a leap year
    (dt.datetime(2024, 2, 27, 13), dt.datetime(2024, 3, 5), ["USDJPY", "EURUSD"]),
    (dt.datetime(2024, 5, 6, 10, 20), dt.datetime(2024, 5, 6, 12), ["EURUSD"]),
    (dt.datetime(2024, 5, 6), dt.datetime(2024, 5, 6), None),  # nothing is complete yet
])
def test_pending_equals_the_join_of_slot_rows(spark, start, as_of, pairs):
    cat = catalog(spark, 5, start.replace(minute=0), 24 * 8)
    expected = S.expected_slots(spark, as_of, start, pairs)
    if start.minute:
        expected = expected.where(expected.slot >= start + dt.timedelta(minutes=60 - start.minute))
        start = start + dt.timedelta(minutes=60 - start.minute)
    want = rows(S.pending_slots(expected, cat), *COLUMNS)
    assert rows(H.pending(spark, H.slot_maps(cat), as_of, start, pairs), *COLUMNS) == want
    quota = S.pair_quota(instruments(spark, pairs), 7)
    batch = ["pair", "pair_ord", "slot", "rank"]
    assert rows(H.next_batch(spark, H.slot_maps(cat), as_of, quota, 7, start, pairs), *batch) == rows(S.next_batch(expected, cat, quota, 7), *batch)


def test_maps_beside_the_catalog_follow_its_partitions(spark):
    path = scratch_path(spark, "t-catalog")
    assert H.pending(spark, read_hour_maps(spark, path), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 2), ["EURUSD"]).count() == 24
    write_catalog(catalog(spark, 1, dt.datetime(2023, 12, 30), 24 * 5), path)
    write_catalog(catalog(spark, 2, dt.datetime(2024, 1, 1), 24 * 5).where("pair = 'EURUSD'"), path)
    kept, made = read_hour_maps(spark, path), H.slot_maps(read_catalog(spark, path))
    cols = ["pair", "year", "status", "hours"]
    assert rows(kept, *cols) == rows(made, *cols)
    assert kept.select("pair", "year").distinct().count() == 6


def test_planning_joins_no_slot_rows(spark):
    path = scratch_path(spark, "t-catalog")
    write_catalog(catalog(spark, 1, dt.datetime(2024, 1, 1), 24 * 5), path)
    plan = H.pending(spark, read_hour_maps(spark, path), dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 1))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert len(scans) == 1 and "_hours" in scans[0] and "hour#" not in scans[0] and plan.count("Join") == 1
