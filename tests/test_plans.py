"""Plan-shape guards for the scale design (checked on the physical plans)."""

import pytest

from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as E
from conftest import SF_SMALL

from tickweave.plans.registry import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return sum(1 for line in text.splitlines()
               if "Exchange" in line and "BroadcastExchange" not in line and "ReusedExchange" not in line)


def test_flagship_is_one_shuffle_hash_aggregate(spark):
    p = plan(E.queries()["minute_bars"](spark, SF_SMALL))
    assert shuffles(p) == 1 and "HashAggregate" in p and "SortAggregate" not in p


def test_decode_path_is_one_shuffle_hash_aggregate(spark):
    from tickweave.plans.load import bars_and_outcomes
    from tickweave.plans.registry import land_fixture_files
    from tickweave.sources.instruments import instruments
    from tickweave.sources.tickfiles import list_tick_files

    files = list_tick_files(spark, land_fixture_files(spark, SF_SMALL), with_content=True)
    p = plan(bars_and_outcomes(files, instruments(spark)))
    assert shuffles(p) == 1 and "HashAggregate" in p and "SortAggregate" not in p and "MapInPandas" in p


def test_store_scan_prunes_partitions_and_columns(spark):
    from tickweave.plans.registry import _roundtrip_store
    from tickweave.sources.barstore import read_store

    df = read_store(spark, _roundtrip_store(spark, SF_SMALL), ["EURUSD"]).select("timestamp", "close")
    p = plan(df)
    import re

    scan = p[p.index("FileScan parquet"):]
    assert re.search(r"PartitionFilters: \[[^\]]*\(pair#\d+ = EURUSD\)", scan)
    assert "ReadSchema: struct<timestamp:timestamp,close:double>" in scan


#: Queries that fold their whole result into one row on purpose (counts, one document).
ONE_ROW = {"storage_size", "qa_report_json"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_quadratic_or_single_task_operators(spark, monkeypatch, name):
    """On the result's plan and on the plan of everything written on the way."""
    plans = []
    original = DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        plans.append(plan(self._df))
        return original(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    plans.append(plan(QUERIES[name](spark, SF_SMALL)))
    for p in plans:
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", *([] if name in ONE_ROW else ["SinglePartition"])):
            assert bad not in p, f"{name}: {bad}"


def test_report_is_one_pass(spark):
    from tickweave.operators.quality import qa_report
    from tickweave.plans.registry import qa_store
    from tickweave.sources.barstore import read_store
    from tickweave.sources.instruments import instruments

    p = plan(qa_report(read_store(spark, qa_store(spark, SF_SMALL)), instruments(spark)))
    assert p.count("FileScan parquet") == 1
    assert shuffles(p) <= 4 and p.count("Window ") <= 2


def test_tick_queries_do_not_shuffle(spark):
    for name in ("tick_prices", "tick_time", "tick_volume"):
        assert shuffles(plan(QUERIES[name](spark, SF_SMALL))) == 0


def test_store_filter_is_flat_and_prunes(spark):
    from tickweave.plans.registry import _roundtrip_store
    from tickweave.sources.barstore import partition_filter, read_store

    many = [("EURUSD", y) for y in range(1000, 3024)] + [("NOPAIR", y) for y in range(1000, 3000)]
    df = read_store(spark, _roundtrip_store(spark, SF_SMALL)).where(partition_filter(many)).select("pair", "timestamp")
    assert "PartitionFilters: [" in plan(df) and "INSET" in plan(df).upper().replace(" ", "")
    assert {r["pair"] for r in df.select("pair").distinct().collect()} <= {"EURUSD"}
