"""Status rollup against the published snapshot (golden)."""

from tickweave.operators.status import status_rollup

# Golden per-pair rows of the published status snapshot: fetched, no_data, error.
GOLDEN = [
    ("EURUSD", 31978, 321, 3),
    ("GBPUSD", 31978, 323, 1),
    ("USDJPY", 31979, 321, 2),
    ("USDCAD", 31979, 323, 0),
    ("AUDUSD", 31975, 323, 4),
    ("USDCHF", 31972, 330, 0),
]


def test_golden_totals(spark):
    per_pair = spark.createDataFrame(
        [(p, f + n + e, f, n, e) for p, f, n, e in GOLDEN],
        "pair string, total bigint, fetched bigint, no_data bigint, error bigint",
    )
    rows = {r["pair"]: r for r in status_rollup(per_pair).collect()}
    tot = rows[None]
    assert tot["is_total"] is True
    assert (tot["total"], tot["fetched"], tot["no_data"], tot["error"]) == (193812, 191861, 1941, 10)
    assert all(rows[p]["total"] == 32302 for p, *_ in GOLDEN)


def test_progress_totals(spark):
    from tickweave import api
    from tickweave.plans.registry import _roundtrip_store, land_fixture_files
    from tickweave.session import scratch_path
    from tickweave.sources.fixtures import fixture_catalog

    cat = scratch_path(spark, "t-cat")
    api.write_catalog(fixture_catalog(spark, "/root/testdata/sf0.001"), cat)
    raw = land_fixture_files(spark, "/root/testdata/sf0.001")
    (r,) = api.progress_totals(spark, cat, _roundtrip_store(spark, "/root/testdata/sf0.001"), raw).collect()
    assert r["slots_processed"] == r["fetched"] + r["no_data"] + r["errors"]
    assert r["parquet_mb"] >= 0.0 and r["raw_mb"] >= 0.0


def test_pair_status_nulls_and_zero_rows(spark):
    import datetime as dt

    from tickweave.operators.status import pair_status
    from tickweave.schemas import CATALOG_SCHEMA
    from tickweave.sources.instruments import instruments

    t = dt.datetime(2024, 1, 31)
    cat = spark.createDataFrame(
        [("EURUSD", 2024, 1, 2, 3, "no_data", t), ("EURUSD", 2024, 1, 2, 4, "weird", t),
         ("GBPUSD", 2024, 1, 5, 1, "fetched", t), ("GBPUSD", 2023, 12, 29, 1, "fetched", t),
         ("XXXYYY", 2024, 1, 2, 3, "fetched", t)],
        CATALOG_SCHEMA,
    )
    rows = {r["pair"]: r for r in pair_status(cat, instruments(spark)).collect()}
    assert set(rows) == {"EURUSD", "GBPUSD", "USDJPY", "USDCAD", "AUDUSD", "USDCHF"}
    e = rows["EURUSD"]
    assert (e["total"], e["fetched"], e["no_data"], e["error"], e["oldest"], e["newest"]) == (2, 0, 1, 0, None, None)
    g = rows["GBPUSD"]
    assert (g["oldest"], g["newest"]) == ("2023-12-29", "2024-01-05")
    assert rows["USDCHF"]["total"] == 0
