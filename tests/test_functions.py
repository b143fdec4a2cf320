"""Hand-built fixtures for the semantics contract (nulls, windows, EWM, clip)."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.functions import Rolled, clip_keep_null, ewm_mean, finite_or_null, rolling_columns, rolling_mean, rolling_std, rolling_sum


def _series(spark, values, key="A"):
    d0 = dt.date(2000, 1, 1)
    rows = [(key, d0 + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "barrid string, date date, x double")


def _ewm_brute(values, span, min_samples):
    q = 1 - 2 / (span + 1)
    out = []
    cnt = 0
    for t, v in enumerate(values):
        if v is not None:
            cnt += 1
        if v is None or cnt < min_samples:
            out.append(None)
            continue
        num = sum(values[i] * q ** (t - i) for i in range(t + 1) if values[i] is not None)
        den = sum(q ** (t - i) for i in range(t + 1) if values[i] is not None)
        out.append(num / den)
    return out


@pytest.mark.parametrize("span,min_samples,n", [(5, 5, 40), (5, 1, 700), (252, 1, 1200), (1.5, 1, 300)])
def test_ewm_matches_brute_force(spark, span, min_samples, n):
    rng = np.random.default_rng(7)
    vals = [None if rng.random() < 0.1 else float(rng.normal()) for _ in range(n)]
    vals[0] = None  # leading null
    df = ewm_mean(_series(spark, vals), "x", span, min_samples=min_samples, out="y")
    got = [r["y"] for r in df.orderBy("date").collect()]
    exp = _ewm_brute(vals, span, min_samples)
    for g, e in zip(got, exp):
        if e is None:
            assert g is None
        else:
            assert g == pytest.approx(e, rel=1e-9, abs=1e-12)


def test_ewm_per_series_independent(spark):
    a = _series(spark, [1, 2, 3, 4], "A")
    b = _series(spark, [10, None, 30], "B")
    out = {(r.barrid, r.date): r.y for r in ewm_mean(a.unionByName(b), "x", 3, out="y").collect()}
    assert out[("B", dt.date(2000, 1, 2))] is None
    q = 0.5
    assert out[("B", dt.date(2000, 1, 3))] == pytest.approx((30 + 10 * q * q) / (1 + q * q))


def test_rolling_full_window_rule(spark):
    vals = [1, 2, None, 4, 5, 6, 7]
    df = _series(spark, vals).select("date", rolling_sum("x", 3).alias("s"), rolling_sum("x", 3, min_samples=2).alias("s2"))
    got = [(r.s, r.s2) for r in df.orderBy("date").collect()]
    assert got[0] == (None, None)
    assert got[1] == (None, 3.0)
    assert got[2] == (None, 3.0)   # 1, 2, null -> only 2 values
    assert got[4] == (None, 9.0)   # null, 4, 5
    assert got[5] == (15.0, 15.0)


def test_windows_keep_no_trace(spark):
    rng = np.random.default_rng(1)
    vals = [None if rng.random() < 0.05 else float(rng.normal(100, 3)) for _ in range(500)]
    vals[50], vals[120] = 1e15, float("nan")
    df = _series(spark, vals).withColumn("x", finite_or_null("x"))
    got = df.select("date", rolling_sum("x", 40, min_samples=1).alias("s"), rolling_std("x", 60, min_samples=2).alias("d")).orderBy("date").collect()
    clean = [None if v is None or v != v else v for v in vals]
    for i, r in enumerate(got):
        w = [v for v in clean[max(0, i - 39): i + 1] if v is not None]
        assert r.s == pytest.approx(sum(w), rel=1e-12)
        w = [v for v in clean[max(0, i - 59): i + 1] if v is not None]
        if len(w) > 1 and max(w) < 1e9:
            assert r.d == pytest.approx(float(np.std(w, ddof=1)), rel=1e-6)


@pytest.mark.parametrize("n", [5, 33, 64, 230])
def test_long_windows(spark, n):
    rng = np.random.default_rng(n)
    rows = []
    for key, size in (("a", 400), ("b", n), ("c", n - 1), ("d", 1), ("e", 3 * n)):
        vals = [None if rng.random() < 0.1 else float(rng.normal(50, 2)) for _ in range(size)]
        if size > 300:
            vals[37], vals[90], vals[180:230] = 1e15, float("nan"), [0.1] * 50
        rows += [(key, i, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k string, t int, x double").repartition(4)
    aggs = {"c": "count", "s": "sum", "m": "mean", "lo": "min", "hi": "max", "v": "var", "d": "std"}
    out = rolling_columns(df, n, {o: Rolled(a, "x", 3) for o, a in aggs.items()} | {"full": Rolled("sum", F.col("x") * 2)}, by="k", order="t")
    assert out.columns == ["k", "t", "x", *aggs, "full"]
    got, series = {(r.k, r.t): r for r in out.collect()}, {}
    for k, _, v in rows:
        series.setdefault(k, []).append(v)
    assert len(got) == len(rows)
    for (k, t), r in got.items():
        every = series[k][max(0, t - n + 1): t + 1]
        w = [v for v in every if v is not None]
        if len(w) < 3:
            assert r.c is None and r.s is None and r.d is None and r.lo is None
            continue
        assert r.c == len(w) and (r.full is None) == (len(w) < n)
        if any(v != v for v in w):
            assert r.s != r.s and r.d != r.d
            continue
        assert (r.lo, r.hi) == (min(w), max(w))
        assert (r.s, r.m) == pytest.approx((sum(w), sum(w) / len(w)), rel=1e-12)
        if max(w) == min(w):
            assert r.d == 0.0 == r.v
        else:
            assert (r.v, r.d) == pytest.approx((np.var(w, ddof=1), np.std(w, ddof=1)), rel=1e-9)


def test_flat_windows_after_an_outlier(spark):
    out = _series(spark, [1e9, 0.1, 0.1, 0.1, 0.1, 3.0, 3.0, 3.0]).select("date", rolling_std("x", 3).alias("s")).orderBy("date").collect()
    assert [r.s == 0 for r in out] == [False, False, False, True, True, False, False, True]
    one = _series(spark, [3.0, 3.0]).select("date", rolling_std("x", 2, min_samples=1).alias("s")).orderBy("date").collect()
    assert one[0].s is None and one[1].s == 0.0


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (5.0,), (-3.0,), (1.0,)], "x double")
    got = [r.c for r in df.select(clip_keep_null("x", -2, 2).alias("c")).collect()]
    assert got == [None, 2.0, -2.0, 1.0]
