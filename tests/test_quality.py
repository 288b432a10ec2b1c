"""QA hand cases (gaps, spikes) and the report shape."""

import datetime as dt

from tickweave.operators import quality as Q
from tickweave.schemas import BAR_SCHEMA
from tickweave.sources.instruments import instruments


def _bars(spark, stamps, opens=None, closes=None, pair="EURUSD"):
    data = []
    for i, ts in enumerate(stamps):
        o = opens[i] if opens else 1.0
        c = closes[i] if closes else 1.0
        data.append((pair, None, ts, o, max(o, c), min(o, c), c, 1.0, "dukascopy"))
    return spark.createDataFrame(data, BAR_SCHEMA)


def _gaps(spark, a, b):
    return [r["minutes"] for r in Q.gaps(_bars(spark, [a, b])).collect()]


def test_gap_lengths_midweek(spark):
    a = dt.datetime(2024, 1, 3, 10, 0)  # Wednesday
    assert [m for d in (5, 6, 60, 61) for m in _gaps(spark, a, a + dt.timedelta(minutes=d))] == [61]


def test_weekend_gaps(spark):
    assert _gaps(spark, dt.datetime(2024, 1, 5, 21, 59), dt.datetime(2024, 1, 7, 22, 0)) == []
    assert len(_gaps(spark, dt.datetime(2024, 1, 5, 20, 30), dt.datetime(2024, 1, 7, 22, 1))) == 1


def test_gap_across_midnight_found(spark):
    assert _gaps(spark, dt.datetime(2024, 1, 3, 22, 0), dt.datetime(2024, 1, 4, 1, 0)) == [180]


def test_spikes(spark):
    t = dt.datetime(2024, 1, 3, 23, 59)
    # across midnight: not reported
    across = _bars(spark, [t, t + dt.timedelta(minutes=1)], opens=[1.0, 2.0], closes=[1.0, 2.0])
    assert Q.spikes(across).count() == 0
    a = dt.datetime(2024, 1, 3, 10, 0)
    zero_then_one = _bars(spark, [a, a + dt.timedelta(minutes=1)], opens=[0.0, 1.0], closes=[0.0, 1.0])
    (r,) = Q.spikes(zero_then_one).collect()
    assert r["pct_change"] == float("inf")
    zero_zero = _bars(spark, [a, a + dt.timedelta(minutes=1)], opens=[0.0, 0.0], closes=[0.0, 0.0])
    assert Q.spikes(zero_zero).count() == 0
    jump = _bars(spark, [a, a + dt.timedelta(minutes=1)], opens=[1.0, 1.06], closes=[1.0, 1.06])
    (r,) = Q.spikes(jump).collect()
    assert r["pct_change"] == 6.0


def test_report_shape_and_no_data_pair(spark):
    a = dt.datetime(2024, 1, 3, 10, 0)
    bars = _bars(spark, [a, a, a + dt.timedelta(minutes=2)])
    rep = {r["pair"]: r for r in Q.qa_report(bars, instruments(spark)).collect()}
    assert rep["USDCHF"]["status"] == "no_data" and rep["USDCHF"]["checks"] is None
    c = rep["EURUSD"]["checks"]
    assert rep["EURUSD"]["total_bars"] == 3
    assert c["duplicates"]["count"] == 1 and c["duplicates"]["pass"] is False
    assert c["completeness"]["expected"] == 3 and c["completeness"]["percent"] == 100.0
    assert c["yearly_row_counts"] == {"2024": 3}
    assert rep["EURUSD"]["date_range"]["start"] == "2024-01-03T10:00:00+00:00"


def test_hot_group_of_identical_copies(spark):
    """One bar copied many times: repeated copies follow an identical copy,
    so each is a spike when open vs its own close is; counted without
    funnelling the copies through one window partition."""
    a = dt.datetime(2024, 1, 3, 10, 0)
    base = [("EURUSD", None, a, 1.0, 1.0, 1.0, 1.0, 1.0, "dukascopy")]
    copy = ("EURUSD", None, a + dt.timedelta(minutes=1), 1.0, 1.1, 1.0, 1.1, 1.0, "dukascopy")
    from pyspark.sql import functions as F

    copies = spark.createDataFrame([copy], BAR_SCHEMA).withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(5000))))
    bars = spark.createDataFrame(base, BAR_SCHEMA).unionByName(copies.drop("_i"))
    pairs = Q.pair_checks(bars)
    (cnt,) = pairs.collect()
    assert cnt["spike_count"] == 4999  # open 1.0 vs own close 1.1 (10 %) for copies 2..5000
    assert Q.spikes(bars).count() == 4999
    ex = Q.spike_examples(pairs).collect()
    assert len(ex) == 10 and {r["pct_change"] for r in ex} == {round(0.1 / 1.1 * 100, 3)}
    rep = {r["pair"]: r for r in Q.qa_report(bars, instruments(spark)).collect()}
    c = rep["EURUSD"]["checks"]
    assert c["duplicates"]["count"] == 4999 and c["price_spikes_5pct"]["count"] == 4999
    assert c["gaps_over_5min"]["count"] == 0


def test_iso_text_matches_python_isoformat(spark):
    from tickweave.functions.text import iso_utc

    stamps = [dt.datetime(2024, 1, 3, 10, 0), dt.datetime(2024, 1, 3, 10, 0, 5, 120000),
              dt.datetime(2024, 12, 31, 23, 59, 59, 1)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "i int, t timestamp")
    got = {r["i"]: r["s"] for r in df.select("i", iso_utc("t").alias("s")).collect()}
    assert [got[i] for i in range(3)] == [t.replace(tzinfo=dt.timezone.utc).isoformat() for t in stamps]


def test_spikes_nan_compares_false(spark):
    a = dt.datetime(2024, 1, 3, 10, 0)
    nan = float("nan")
    data = [("EURUSD", None, a, 1.0, 1.0, 1.0, nan, 1.0, "dukascopy"),                          # NaN close
            ("EURUSD", None, a + dt.timedelta(minutes=1), 2.0, 2.0, 2.0, 2.0, 1.0, "dukascopy"),  # vs NaN prev
            ("EURUSD", None, a + dt.timedelta(minutes=2), nan, 2.0, 2.0, 2.0, 1.0, "dukascopy")]  # NaN open
    assert Q.spikes(spark.createDataFrame(data, BAR_SCHEMA)).count() == 0


def test_hash_nulls_counted(spark):
    from pyspark.sql import functions as F

    a = dt.datetime(2024, 1, 3, 10, 0)
    bars = _bars(spark, [a, a + dt.timedelta(minutes=1)]).withColumn(
        "bar_hash", F.when(F.minute("timestamp") == 1, F.lit(None).cast("string")).otherwise(F.lit("x")))
    rep = {r["pair"]: r for r in Q.qa_report(bars, instruments(spark)).collect()}
    c = rep["EURUSD"]["checks"]["bar_hash_nulls"]
    assert c["count"] == 1 and c["pass"] is False


def test_strict_gaps_report_short_gaps(spark):
    a = dt.datetime(2024, 1, 3, 10, 0)  # Wednesday
    bars = _bars(spark, [a, a + dt.timedelta(minutes=6)])
    assert Q.gaps(bars).count() == 0                      # parity: no hourly probe
    assert [r["minutes"] for r in Q.gaps(bars, strict=True).collect()] == [6]
    weekend = _bars(spark, [dt.datetime(2024, 1, 5, 21, 59), dt.datetime(2024, 1, 7, 22, 0)])
    assert Q.gaps(weekend, strict=True).count() == 0     # closed minutes only


def test_flattened_report_no_data_row(spark):
    a = dt.datetime(2024, 1, 3, 10, 0)
    flat = {r["pair"]: r for r in Q.flatten_report(Q.qa_report(_bars(spark, [a]), instruments(spark))).collect()}
    chf = flat["USDCHF"]
    assert chf["status"] == "no_data" and chf["total_bars"] == 0 and chf["completeness_percent"] == 0.0
    assert chf["gap_examples"] is None and chf["duplicates_pass"] is None and chf["start"] is None
    eur = flat["EURUSD"]
    assert eur["status"] == "ok" and eur["total_bars"] == 1 and eur["duplicates_pass"] == "true"
    assert eur["yearly_row_counts"] == "2024:1" and eur["sources"] == "dukascopy"
