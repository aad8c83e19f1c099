"""Distributed exact quartiles / describe against numpy brute force."""

import numpy as np
import pytest

from riskmart.operators.profile import describe


@pytest.mark.parametrize("few,cuts", [(2000, 64), (1, 2), (5, 3), (1, 64)])
@pytest.mark.parametrize("reuse", ["true", "false"])
def test_describe_matches_numpy(spark, few, cuts, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        _check_describe(spark, few, cuts)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def _check_describe(spark, few, cuts):
    rng = np.random.default_rng(few + cuts)
    n = 3000
    x = np.round(rng.normal(0, 5, n), 2)
    x[: n // 3] = 1.25                      # one value holds a third of the rows
    x[5:40] = np.nan                        # nulls are skipped
    labels = rng.choice(["a", "b", "c", None], n, p=[0.5, 0.3, 0.15, 0.05])
    rows = [(None if np.isnan(v) else float(v), lab) for v, lab in zip(x, labels)]
    df = spark.createDataFrame(rows, "x double, lab string").repartition(7)
    out = {r.column_name: r for r in describe(df, ["x"], ["lab"], cuts=cuts, few=few).collect()}
    v = x[~np.isnan(x)]
    rx = out["x"]
    assert rx["count"] == len(v) and rx["unique"] == len(np.unique(v))
    assert rx["min"] == v.min() and rx["max"] == v.max()
    for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert rx[name] == pytest.approx(np.percentile(v, q * 100), abs=1e-6)
    assert rx["mean"] == pytest.approx(v.mean(), abs=1e-6)
    assert rx["std"] == pytest.approx(v.std(ddof=1), abs=1e-6)
    rl = out["lab"]
    present = [lab for lab in labels if lab is not None]
    values, counts = np.unique(present, return_counts=True)
    assert rl["count"] == len(present) and rl["unique"] == len(values)
    assert rl["top"] == values[np.argmax(counts)] and rl["freq"] == counts.max()
    assert rl["mean"] is None and rl["p50"] is None


def test_describe_approximate_quartiles_within_rank_error(spark):
    rng = np.random.default_rng(7)
    n = 20000
    x = np.round(rng.normal(0, 5, n), 2)
    x[: n // 3] = 1.25                      # one value holds a third of the rows
    df = spark.createDataFrame([(float(v), "a") for v in x], "x double, lab string").repartition(5)
    exact = describe(df, ["x"], ["lab"]).collect()[0]
    accuracy = 200
    approx = describe(df, ["x"], ["lab"], approximate=True, accuracy=accuracy).collect()[0]
    for c in ("count", "unique", "mean", "min", "max"):
        assert approx[c] == exact[c]
    assert approx["std"] == pytest.approx(exact["std"])
    s = np.sort(x)
    for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        v = approx[name]
        lo, hi = np.searchsorted(s, v, "left"), np.searchsorted(s, v, "right")   # ranks holding v
        target = q * (n - 1)
        slack = n / accuracy + 1
        assert lo - slack <= target <= hi + slack


@pytest.mark.parametrize("scale", [1e-9, 1e-6, 1.0, 1.2e9, 1e14])
def test_describe_keeps_small_and_large_values(spark, scale):
    v = [scale * (1 + i / 1000) for i in range(1000)]
    df = spark.createDataFrame([(x, None) for x in v] * 20, "x double, empty string").repartition(4)
    out = {r.column_name: r for r in describe(df, ["x"], ["empty"]).collect()}
    x = out["x"]
    assert x["count"] == 20_000 and x["mean"] == pytest.approx(np.mean(v)) and x["p50"] == pytest.approx(np.median(v))
    assert x["std"] == pytest.approx(np.std(v * 20, ddof=1)) and x["min"] == v[0] and x["max"] == v[-1]
    assert out["empty"]["count"] == out["empty"]["unique"] == 0 and out["empty"]["top"] is None


def test_large_ids_stay_apart_and_the_written_counts_are_small(spark):
    from riskmart.operators.profile import value_counts
    ids = [2 ** 53 + i for i in range(50)] * 3
    df = spark.createDataFrame([(i, None, "x") for i in ids], "id long, none double, lab string").repartition(5)
    out = {r.column_name: r for r in describe(df, ["id", "none"], ["lab"]).collect()}
    assert out["id"]["unique"] == 50 and out["id"]["count"] == 150
    assert out["none"]["count"] == 0 and out["none"].p50 is None
    assert value_counts(df, ["id", "none"], ["lab"]).count() == 51          # null cells and repeats are no rows


def test_describe_odd_values(spark):
    df = spark.createDataFrame([(float("inf"), 1), (1.0, None), (1.0, 3)], "x double, y int")
    out = {r.column_name: r for r in describe(df, ["x", "y"], []).collect()}
    assert out["x"].p50 == 1.0 and out["x"]["max"] == float("inf") and out["x"]["unique"] == 2
    assert (out["y"].p25, out["y"].p50, out["y"].p75, out["y"].std) == (1.5, 2.0, 2.5, pytest.approx(2 ** 0.5))
    assert describe(df.where("false"), ["x"], []).collect()[0]["count"] == 0
