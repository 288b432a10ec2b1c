"""Slot planning: quotas, upsert, worklist order, batches."""

import datetime as dt

from conftest import rows
from tickweave.operators import slots as S
from tickweave.schemas import CATALOG_SCHEMA
from tickweave.sources.instruments import instruments


def test_quota_10_over_6(spark):
    q = S.pair_quota(instruments(spark), 10)
    assert [r["quota"] for r in q.orderBy("pair_ord").collect()] == [2, 2, 2, 2, 1, 1]


def test_quota_default_and_zero(spark):
    assert {r["quota"] for r in S.pair_quota(instruments(spark), None).collect()} == {250}
    assert {r["quota"] for r in S.pair_quota(instruments(spark), 0).collect()} == {0}


def test_upsert_last_status_wins(spark):
    t = dt.datetime(2024, 1, 1)
    cat = spark.createDataFrame([], CATALOG_SCHEMA)
    upd = spark.createDataFrame(
        [("EURUSD", 2024, 1, 2, 3, "fetched", t, 1), ("EURUSD", 2024, 1, 2, 3, "error", t, 2)],
        "pair string, year smallint, month tinyint, day tinyint, hour tinyint, status string, "
        "fetched_at timestamp, update_seq int",
    )
    (r,) = S.catalog_upsert(cat, upd).collect()
    assert r["status"] == "error"


def test_worklist_interleaves_and_positions_are_dense(spark):
    batch = spark.createDataFrame(
        [("A", 1, 1), ("A", 1, 2), ("A", 1, 3), ("B", 2, 1), ("C", 3, 1), ("C", 3, 2)],
        "pair string, pair_ord int, rank int",
    )
    got = [(r["pair"], r["rank"]) for r in S.worklist(batch).orderBy("position").collect()]
    assert got == [("A", 1), ("B", 1), ("C", 1), ("A", 2), ("C", 2), ("A", 3)]
    assert rows(S.worklist(batch), "position") == [(i,) for i in range(1, 7)]


def test_next_batch_newest_first_and_skips_catalogued(spark):
    as_of = dt.datetime(2024, 1, 3, 0, 0)
    exp = S.expected_slots(spark, as_of, dt.datetime(2024, 1, 2), pairs=["EURUSD"])
    cat = spark.createDataFrame(
        [("EURUSD", 2024, 1, 2, 23, "no_data", as_of)], CATALOG_SCHEMA
    )
    q = S.pair_quota(instruments(spark, ["EURUSD"]), 3)
    got = [r["hour"] for r in S.next_batch(exp, cat, q, 3).orderBy("rank").collect()]
    assert got == [22, 21, 20]


def test_download_manifest_month_is_zero_based_in_url(spark):
    df = spark.createDataFrame([("EURUSD", 2024, 1, 5, 7)], "pair string, year smallint, month tinyint, day tinyint, hour tinyint")
    (r,) = S.download_manifest(df, "/data/raw").collect()
    assert r["url"].endswith("/EURUSD/2024/00/05/07h_ticks.bi5")
    assert r["path"] == "/data/raw/EURUSD/2024/01/05/07h_ticks.bi5"


def test_quota_follows_given_pair_order(spark):
    q = S.pair_quota(instruments(spark, ["USDJPY", "EURUSD", "GBPUSD"]), 5)
    assert {r["pair"]: r["quota"] for r in q.collect()} == {"USDJPY": 2, "EURUSD": 2, "GBPUSD": 1}
