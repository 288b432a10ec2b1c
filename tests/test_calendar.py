"""Trading calendar: hand cases, golden open-hour count, closed forms vs sets of minutes."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tickweave.functions.calendar import gap_has_open_probe, market_closed, open_minutes_between
from tickweave.operators.slots import expected_slots


# The closure by definition: 48 hours from each Friday 22:00, as minutes counted from one of them.
FRIDAY = dt.datetime(2020, 1, 3, 22, 0)
WEEK, CLOSURE = 7 * 24 * 60, 48 * 60


def minute_no(t: dt.datetime) -> int:
    return (t - FRIDAY) // dt.timedelta(minutes=1)


def closed_among(first: int, last: int) -> set[int]:
    """The closed minutes from ``first`` to ``last``: the closures cut to that range."""
    weeks = range(first // WEEK - 1, last // WEEK + 2)
    return {m for w in weeks for m in range(max(w * WEEK, first), min(w * WEEK + CLOSURE, last + 1))}


def open_count(a: dt.datetime, b: dt.datetime) -> int:
    first, last = minute_no(a), minute_no(b)
    return max(0, last - first + 1) - len(closed_among(first, last))


def has_open_probe(a: dt.datetime, b: dt.datetime) -> bool:
    probes = set(range(minute_no(a) + 60, minute_no(b), 60))
    return bool(probes - closed_among(minute_no(a), minute_no(b)))


def test_market_hours_hand_cases(spark):
    cases = [
        (dt.datetime(2024, 1, 5, 21, 59), False),  # Fri 21:59 open
        (dt.datetime(2024, 1, 5, 22, 0), True),    # Fri 22:00 closed
        (dt.datetime(2024, 1, 6, 12, 0), True),    # Sat closed
        (dt.datetime(2024, 1, 7, 21, 59), True),   # Sun 21:59 closed
        (dt.datetime(2024, 1, 7, 22, 0), False),   # Sun 22:00 open
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t timestamp")
    got = {r["i"]: r["c"] for r in df.select("i", market_closed("t").alias("c")).collect()}
    assert [got[i] for i in range(len(cases))] == [c for _, c in cases]


def test_golden_open_hours_per_pair(spark):
    # 2021-01-01 00:00 .. the snapshot at 2026-03-01 12:00 (last slot 11:00)
    exp = expected_slots(spark, dt.datetime(2026, 3, 1, 12, 0))
    counts = {r["pair"]: r["count"] for r in exp.groupBy("pair").count().collect()}
    assert counts == {p: 32302 for p in ["EURUSD", "GBPUSD", "USDJPY", "USDCAD", "AUDUSD", "USDCHF"]}


def test_completeness_closed_form_matches_sets(spark):
    rnd = random.Random(7)
    cases = []
    for i in range(200):
        a = dt.datetime(2023, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 400))
        b = a + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 20))
        cases.append((i, a, b))
    df = spark.createDataFrame(cases, "i int, a timestamp, b timestamp")
    got = {r["i"]: r["n"] for r in df.select("i", open_minutes_between("a", "b").alias("n")).collect()}
    for i, a, b in cases:
        assert got[i] == open_count(a, b), (a, b)


def test_gap_probe_closed_form_matches_sets(spark):
    rnd = random.Random(11)
    cases = []
    for i in range(1500):
        a = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 60))
        b = a + dt.timedelta(minutes=rnd.choice([rnd.randrange(1, 180), rnd.randrange(1, 60 * 24 * 9)]))
        cases.append((i, a, b))
    df = spark.createDataFrame(cases, "i int, a timestamp, b timestamp")
    got = {r["i"]: r["g"] for r in df.select("i", gap_has_open_probe("a", "b").alias("g")).collect()}
    for i, a, b in cases:
        assert got[i] == has_open_probe(a, b), (a, b)


def test_weekday_is_monday_zero(spark):
    r = spark.range(1).select(F.weekday(F.lit("2024-01-01").cast("date")).alias("w")).first()
    assert r["w"] == 0


def test_closed_forms_before_the_week_origin(spark):
    """Ranges before 2020-12-27 (negative offsets from the origin)."""
    rnd = random.Random(5)
    cases = []
    for i in range(120):
        a = dt.datetime(2010, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 365 * 11))
        b = a + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 9))
        cases.append((i, a, b))
    df = spark.createDataFrame(cases, "i int, a timestamp, b timestamp")
    got = {r["i"]: (r["n"], r["g"]) for r in df.select(
        "i", open_minutes_between("a", "b").alias("n"), gap_has_open_probe("a", "b").alias("g")).collect()}
    for i, a, b in cases:
        assert got[i] == (open_count(a, b), has_open_probe(a, b)), (a, b)
