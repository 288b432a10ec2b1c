"""H7: the text of doubles against Python's repr, by column expressions only."""

import numpy as np
import pandas as pd

from tickweave.functions.text import float_repr
from tickweave.operators.bars import bar_hash

EDGES = [0.0, -0.0, 1.0, -1.1, 0.1 + 0.2, 100.0, 1e7, 1e15, 1e16, 9999999999999998.0, 1e22, 1e23, 2e23, 8.41e21,
         1e-3, 1e-4, 1e-5, 0.00012345678901234567, 12345678.0, 123456.78901234567, 2.0**53, 2.0**100, 1e300,
         1.7976931348623157e308, 2.2250738585072014e-308, 2.966009638672033e25, 1.1017092948466476e18,
         float("nan"), float("inf"), -float("inf"), None]


def check(spark, values):
    df = spark.createDataFrame(pd.DataFrame({"x": pd.Series(values, dtype=float)})) if None not in values else \
        spark.createDataFrame([(v,) for v in values], "x double")
    for x, text in df.select("x", float_repr("x")).collect():
        assert text == (None if x is None else repr(x)), (x, text)


def test_edges_and_the_least_doubles(spark):
    check(spark, EDGES + [i * 5e-324 for i in range(1, 2000)])


def test_random_bits_integers_and_prices(spark):
    rng = np.random.default_rng(5)
    bits = rng.integers(0, 2**64, 60_000, dtype=np.uint64).view(np.float64)
    whole = rng.integers(2**53, 2**63, 10_000).astype(float)
    wide = rng.random(20_000) * 10.0 ** rng.integers(-7, 30, 20_000)
    mids = (rng.integers(50_000, 200_000, 20_000) / 1e5 + rng.integers(50_000, 200_000, 20_000) / 1e5) / 2
    check(spark, np.concatenate([bits[np.isfinite(bits)], whole, wide, mids]).tolist())


def test_hash_needs_no_python_worker(spark):
    bars = spark.range(1).selectExpr("timestamp_seconds(60) timestamp", "1.5d open", "2d high", "1d low", "1.25d close", "3d volume", "'s' source")
    plan = bars.select(bar_hash())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
