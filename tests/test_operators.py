"""Operator fixtures: as-of joins, store merge semantics, scorers, weights."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import joins as J
from panelforge.operators import portfolio as P
from panelforge.operators import signals as S
from panelforge.operators.weights import rolling_moments, row_numbers
from panelforge.session import shared_dir
from panelforge.sources import tables as TB

D = dt.date


def test_asof_backward_ties_and_missing_keys(spark):
    left = spark.createDataFrame(
        [("A", D(2020, 1, 5)), ("A", D(2020, 1, 1)), ("B", D(2020, 1, 9)), ("C", D(2020, 1, 9)), ("A", None)],
        "k string, date date")
    right = spark.createDataFrame(
        [("A", D(2020, 1, 3), D(2020, 1, 4), "a1"), ("A", D(2020, 1, 3), D(2020, 2, 1), "a2"),
         ("B", D(2020, 1, 10), D(2020, 2, 1), "b1"), ("D", D(2019, 1, 1), D(2030, 1, 1), "d1")],
        "k string, start date, stop date, v string")
    out = {(r.k, r.date): r.v for r in
           J.asof_join(left, right, "date", "start", "k", tie_break=("stop",)).collect()}
    assert out[("A", D(2020, 1, 5))] == "a2"   # equal times: last by tie-break wins
    assert out[("A", D(2020, 1, 1))] is None   # nothing before
    assert out[("B", D(2020, 1, 9))] is None   # only a later row
    assert out[("C", D(2020, 1, 9))] is None   # key absent on the right
    assert out[("A", None)] is None            # null time never matches
    fwd = {(r.k, r.date): r.v for r in
           J.asof_join(left, right, "date", "start", "k", strategy="forward", tie_break=("stop",)).collect()}
    assert fwd[("A", D(2020, 1, 1))] == "a1"   # forward: first by tie-break wins
    assert fwd[("B", D(2020, 1, 9))] == "b1"
    bounded = {(r.k, r.date): r.v for r in J.asof_join(
        left, right, "date", "start", "k", tie_break=("stop",), valid_until="stop").collect()}
    assert bounded[("A", D(2020, 1, 5))] == "a2"


def test_asof_keeps_nulls_inside_matched_row(spark):
    left = spark.createDataFrame([("A", D(2020, 1, 5))], "k string, date date")
    right = spark.createDataFrame([("A", D(2020, 1, 1), "x", 1.0), ("A", D(2020, 1, 2), None, 2.0)],
                                  "k string, start date, s string, n double")
    r = J.asof_join(left, right, "date", "start", "k").collect()[0]
    assert r.s is None and r.n == 2.0          # the whole latest row, not a per-column fill


def test_asof_nearest_tie_goes_backward(spark):
    left = spark.createDataFrame([("A", D(2020, 1, 5))], "k string, date date")
    right = spark.createDataFrame([("A", D(2020, 1, 3), "b"), ("A", D(2020, 1, 7), "f")], "k string, start date, v string")
    assert J.asof_join(left, right, "date", "start", "k", strategy="nearest").collect()[0].v == "b"


def _spec():
    from pyspark.sql import types as T
    return TB.TableSpec("t", T.StructType([T.StructField("date", T.DateType()), T.StructField("id", T.StringType()),
                                           T.StructField("v", T.DoubleType()), T.StructField("w", T.DoubleType())]),
                        ("date", "id"))


def test_upsert_semantics_and_idempotence(spark):
    t = TB.Table(spark, shared_dir(spark, "t"), _spec())
    assert t.read().count() == 0                 # missing table reads as empty
    old = spark.createDataFrame([(D(2019, 5, 1), "a", 1.0, 10.0), (D(2020, 5, 1), "a", 2.0, 20.0)],
                                "date date, id string, v double, w double")
    t.overwrite(old)
    new = spark.createDataFrame([(D(2020, 5, 1), "a", None, 99.0, "x"), (D(2020, 6, 1), "b", 3.0, None, "y")],
                                "date date, id string, v double, w double, extra string")
    t.upsert(new)
    first = sorted(map(tuple, t.read().collect()))
    t.upsert(new)
    assert sorted(map(tuple, t.read().collect())) == first
    assert first == [(D(2019, 5, 1), "a", 1.0, 10.0), (D(2020, 5, 1), "a", 2.0, 99.0), (D(2020, 6, 1), "b", 3.0, None)]
    assert "extra" not in t.read().columns
    t.update(spark.createDataFrame([(D(2021, 1, 1), "z", 1.0, 1.0)], "date date, id string, v double, w double"))
    assert t.read().count() == 3                  # update never inserts
    t.delete(2019)
    assert t.read().count() == 2


def test_zscore_invariants_and_edges(spark):
    rows = [("s", D(2020, 1, 1), f"a{i}", float(v)) for i, v in enumerate([1, 2, 3, 10])]
    rows += [("s", D(2020, 1, 2), "a0", 5.0)]                                        # single asset
    rows += [("s", D(2020, 1, 3), f"a{i}", 7.0) for i in range(3)]                   # identical values
    df = spark.createDataFrame(rows, "signal_name string, date date, barrid string, signal_value double")
    z = S.zscore(df)
    d1 = [r.score for r in z.filter(F.col("date") == D(2020, 1, 1)).collect()]
    assert sum(d1) == pytest.approx(0.0, abs=1e-12)
    import statistics
    assert statistics.stdev(d1) == pytest.approx(1.0)
    assert [r.score for r in z.filter(F.col("date") != D(2020, 1, 1)).collect()] == [None] * 4


def test_active_weights_constraints(spark):
    import random
    random.seed(3)
    rows = [(D(2020, 1, 1), f"a{i}", random.uniform(-0.01, 0.01), random.uniform(0.5, 1.5), random.uniform(0.1, 0.5))
            for i in range(40)]
    df = spark.createDataFrame(rows, "date date, barrid string, alpha double, predicted_beta double, specific_risk double")
    w = P.active_weights(df, target_risk=0.05).collect()
    assert sum(r.weight for r in w) == pytest.approx(0.0, abs=1e-12)
    assert sum(r.weight * r.predicted_beta for r in w) == pytest.approx(0.0, abs=1e-12)
    assert sum((r.weight * r.specific_risk) ** 2 for r in w) ** 0.5 == pytest.approx(0.05)
    tiny = df.limit(2)
    assert [r.weight for r in P.active_weights(tiny).collect()] == [0.0, 0.0]


def test_row_numbers(spark):
    rows = [(D(2000, 1, 1) + dt.timedelta(days=3 * i), float(i)) for i in range(800)]
    df = spark.createDataFrame(rows, "date date, x double").repartition(5)
    assert all(int(r.x) == r._grn for r in row_numbers(df).collect())


def test_moments_keep_no_trace(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(100.0, 1e-3, (330, 2))
    x[31, 0], x[90, 1], x[150, 0], x[230, 1] = 1e9, np.nan, np.inf, np.nan
    rows = [(D(1999, 6, 1) + dt.timedelta(days=2 * i), *map(float, r)) for i, r in enumerate(x)]
    rows[230] = (rows[230][0], rows[230][1], None)
    got = {r.date: r for r in rolling_moments(spark.createDataFrame(rows, "date date, a double, b double").repartition(3), ["a", "b"], 20).collect()}
    assert len(got) == 310
    for i in range(20, 330):
        r, w = got[rows[i][0]], x[i - 20: i]
        if not np.isfinite(w).all():
            assert np.isnan(w).any() == (r.m_a is None) or np.isinf(w).any()
            continue
        c = np.cov(w.T)
        spiked = 1e9 in w
        assert (r.m_a, r.m_b) == pytest.approx(tuple(w.mean(axis=0)), rel=1e-12)
        assert (r.c_a__a, r.c_b__b) == pytest.approx((c[0, 0], c[1, 1]), rel=1e-6)
        if not spiked:
            assert r.c_a__b == pytest.approx(c[0, 1], rel=1e-5, abs=1e-12)


@pytest.mark.parametrize("strategy", ["backward", "forward"])
def test_bucketed_asof_equals_plain(spark, strategy):
    import random
    random.seed(11)
    lrows = [("K" if i % 3 else f"k{i % 7}", D(2000, 1, 1) + dt.timedelta(days=random.randint(0, 2000)))
             for i in range(600)]
    rrows = [("K" if i % 3 else f"k{i % 5}", D(2000, 1, 1) + dt.timedelta(days=random.randint(0, 2000)), i,
              None if i % 11 == 0 else float(i)) for i in range(150)]
    left = spark.createDataFrame(lrows, "k string, date date").dropDuplicates()
    right = spark.createDataFrame(rrows, "k string, start date, seq int, v double")
    plain = J.asof_join(left, right, "date", "start", "k", strategy=strategy, tie_break=("seq",))
    buck = J.asof_join_bucketed(left, right, "date", "start", "k", F.year, strategy=strategy, tie_break=("seq",))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, buck.collect()))


def _universe(spark, rows):
    return spark.createDataFrame(
        [(d, b, 10.0, r, sr, 30.0, 1.0, 100.0, True) for d, b, r, sr in rows],
        "date date, barrid string, price double, return double, specific_return double, specific_risk double, "
        "predicted_beta double, daily_volume double, in_universe boolean")


def test_reversal_edge_rows(spark):
    d0 = D(2020, 1, 1)
    rows = [(d0 + dt.timedelta(days=i), "A", 1.0, 0.5) for i in range(30)]
    rows[25] = (rows[25][0], "A", -100.0, 0.5)                     # -100 %: log1p(-1) -> NULL
    rows += [(d0 + dt.timedelta(days=i), "B", 1.0, 0.5) for i in range(10)]   # shorter than the window
    assets = _universe(spark, rows)
    inp = S.signal_input(assets)
    out = {(r.barrid, r.date): r.reversal for r in S.signal_columns(inp, ["reversal"]).collect()}
    assert out[("A", d0 + dt.timedelta(days=21))] == pytest.approx(-22 * __import__("math").log1p(0.01))
    for i in range(25, 30):                                          # windows holding the -100 % row
        assert out[("A", d0 + dt.timedelta(days=i))] is None
    assert all(out[("B", d0 + dt.timedelta(days=i))] is None for i in range(10))


def test_compute_signals_single_asset_date_and_gate(spark):
    d0 = D(2020, 1, 1)
    rows = [(d0 + dt.timedelta(days=i), b, 0.1 * (k + 1), 0.2 * (k + 1) * (-1) ** i)
            for i in range(40) for k, b in enumerate(["A", "B", "C"])]
    rows += [(d0 + dt.timedelta(days=40), "A", 0.3, 0.1)]              # a date with one asset
    sig, sc, al = S.compute_signals(_universe(spark, rows))
    scores = {(r.signal_name, r.barrid, r.date): r.score for r in sc.collect()}
    assert scores[("beta", "A", d0 + dt.timedelta(days=40))] is None  # one asset: std undefined
    assert scores[("beta", "A", d0)] is None                          # identical betas: std 0 -> NULL
    alphas = {(r.signal_name, r.barrid, r.date): r.alpha for r in al.collect()}
    assert set(alphas) == set(scores)
    wz = [r for r in sc.filter("signal_name = 'barra_reversal'").collect() if r.score is not None]
    assert all(-2.0 <= r.score <= 2.0 for r in wz)


def test_blocked_cumulative_equals_running_sum(spark):
    import math
    import random
    random.seed(5)
    rows = [(p, D(1999, 6, 1) + dt.timedelta(days=i), None if random.random() < 0.05 else random.uniform(-0.05, 0.05))
            for p in ("P", "B") for i in range(900)]
    rows[0] = ("P", rows[0][1], None)
    df = spark.createDataFrame(rows, "portfolio string, date date, return double")
    got = {(r.portfolio, r.date): r.cumulative_return for r in P.cumulative_log_return(df).collect()}
    for p in ("P", "B"):
        acc = None
        for pp, d, r in sorted((x for x in rows if x[0] == p), key=lambda x: x[1]):
            if r is not None:
                acc = (acc or 0.0) + math.log1p(r)
            exp = None if acc is None else 100 * acc
            g = got[(p, d)]
            assert (g is None) == (exp is None)
            if exp is not None:
                assert g == pytest.approx(exp, abs=1e-9)


def test_blocked_signal_windows_equal_plain(spark):
    import random
    random.seed(9)
    d0 = D(2000, 1, 3)
    rows = []
    for b, n in (("HOT", 1500), ("X", 120)):
        for i in range(n):
            sr = None if random.random() < 0.2 else random.uniform(-3, 3)
            if b == "HOT" and 600 <= i < 640:
                sr = None                                   # a long gap: the EWM count guard must carry over
            rows.append((d0 + dt.timedelta(days=i), b, random.uniform(-3, 3), sr))
    inp = S.signal_input(_universe(spark, rows))
    names = list(S.SIGNALS)
    plain = {(r.barrid, r.date): r for r in S.signal_columns(inp, names).collect()}
    blocked = S.signal_columns(inp, names, block_rows=300, halo=256).collect()
    assert len(blocked) == len(plain)
    for r in blocked:
        p = plain[(r.barrid, r.date)]
        for n in names:
            a, b = getattr(r, n), getattr(p, n)
            assert (a is None) == (b is None), (n, r.barrid, r.date)
            if a is not None:
                assert a == pytest.approx(b, rel=1e-9, abs=1e-12), n


def test_blocks_refuse_a_longer_look_back(spark):
    d0 = D(2000, 1, 3)
    rows = [(d0 + dt.timedelta(days=i), "HOT", 0.1 * ((i % 7) - 3), 0.2 * ((i % 5) - 2)) for i in range(1400)]
    inp = S.signal_input(_universe(spark, rows))
    compute = S._col_signal("slow", lambda by=None: S.reversal_expr(600, by))
    reg = {"slow": S.SignalSpec("slow", compute, S.zscore, S.alpha_ic, (), 599)}
    with pytest.raises(ValueError):
        S.signal_columns(inp, ["slow"], reg, block_rows=700, halo=512)
    plain = {r.date: r.slow for r in S.signal_columns(inp, ["slow"], reg).collect()}
    blocked = {r.date: r.slow for r in S.signal_columns(inp, ["slow"], reg, block_rows=700, halo=600).collect()}
    assert plain.keys() == blocked.keys() and sum(v is not None for v in plain.values()) == 801
    for k, v in plain.items():
        assert (v is None) == (blocked[k] is None)
        assert v is None or blocked[k] == pytest.approx(v, rel=1e-9, abs=1e-12)


def test_pivot_strict_rejects_duplicate_cells(spark):
    from panelforge.operators.reshape import pivot_wide, unpivot_long
    df = spark.createDataFrame([(D(2020, 1, 1), "A", "f1", 1.0), (D(2020, 1, 1), "A", "f2", 2.0),
                                (D(2020, 1, 2), "A", "f1", 3.0)], "date date, barrid string, factor string, v double")
    wide = pivot_wide(df, ["date", "barrid"], "factor", "v", ["f1", "f2", "f3"])
    assert wide.columns == ["date", "barrid", "f1", "f2", "f3"]
    back = unpivot_long(wide, ["date", "barrid"], ["f1", "f2", "f3"], "factor", "v").filter("v IS NOT NULL")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))   # pivot then unpivot
    twice = df.unionByName(df.limit(1).withColumn("v", F.lit(9.0)))
    with pytest.raises(Exception, match="several rows"):
        pivot_wide(twice, ["date", "barrid"], "factor", "v", ["f1", "f2"]).collect()
    least = pivot_wide(twice, ["date", "barrid"], "factor", "v", ["f1"], strict=False).orderBy("date").collect()
    assert [r.f1 for r in least] == [1.0, 3.0]


def test_store_refuses_duplicates_and_writes_few_files(spark):
    import glob
    from panelforge.session import shared_dir
    from panelforge.sources.tables import Table, TableSpec
    rows = [(D(2000 + y, 1, 1) + dt.timedelta(days=k), f"A{k}", float(k)) for y in range(4) for k in range(50)]
    df = spark.createDataFrame(rows, "date date, id string, v double")
    t = Table(spark, shared_dir(spark, "t_store"), TableSpec("t", df.schema, ("date", "id")))
    t.upsert(df.repartition(8))
    assert len(glob.glob(t.path.removeprefix("file:") + "/year=*/part-*")) <= 8
    for again in (df.unionByName(df.limit(1)), df.limit(1).unionByName(df.limit(1))):
        with pytest.raises(ValueError):
            t.upsert(again)
    with pytest.raises(ValueError):
        Table(spark, shared_dir(spark, "t_store"), t.spec).upsert(df.unionByName(df.limit(1)))
    assert t.read().count() == 200


@pytest.mark.parametrize("yearly", [True, False])
def test_first_rows_of_a_table_are_written_once(spark, yearly):
    import glob
    import os
    from panelforge.session import checkpoint_root, shared_dir
    from panelforge.sources.tables import Table, TableSpec
    df = spark.createDataFrame([(D(2000 + k % 2, 1, 1 + k), f"A{k}", float(k)) for k in range(9)], "date date, id string, v double")
    t = Table(spark, shared_dir(spark, "t_once"), TableSpec("t", df.schema, ("date", "id"), yearly=yearly))
    staged = lambda: set(glob.glob(checkpoint_root(spark).removeprefix("file:") + "/panelforge/stage-*"))
    before = staged()
    with pytest.raises(ValueError, match="not unique"):
        t.upsert(df.unionByName(df.limit(1)))
    assert not t.exists() and not os.path.exists(t.path.removeprefix("file:"))
    t.upsert(df)
    assert staged() == before
    t.upsert(df.withColumn("v", F.col("v") + 1))
    assert sorted(map(tuple, t.read().collect())) == sorted(map(tuple, df.withColumn("v", F.col("v") + 1).collect()))


def test_weights_of_many_quiet_signals():
    import numpy as np
    import pandas as pd
    from panelforge.operators.weights import _solve_batches
    names = [f"s{i:02d}" for i in range(60)]
    row = {"date": [D(2000, 1, 1)], **{f"m_{a}": [1e-4] for a in names}}
    row |= {f"c_{a}__{b}": [1e-6 if a == b else 0.0] for i, a in enumerate(names) for b in names[i:]}
    (out,) = _solve_batches(names, 10, 20, 1e-6, np.zeros(60))([pd.DataFrame(row)])
    assert np.allclose(out[[f"w_raw_{a}" for a in names]].to_numpy(), 20 * 100.0)


def test_forward_fill_blocked_equals_plain(spark):
    import random
    from panelforge.functions import forward_fill
    from panelforge.functions.blocks import forward_fill_blocked
    random.seed(2)
    rows = [(k, D(1998, 1, 1) + dt.timedelta(days=i), None if random.random() < 0.9 else random.random() < 0.5)
            for k in ("A", "B") for i in range(1500)]
    rows += [("C", D(1998, 1, 1), None)]
    df = spark.createDataFrame(rows, "barrid string, date date, f boolean")
    plain = {(r.barrid, r.date): r.g for r in df.select("barrid", "date", forward_fill("f").alias("g")).collect()}
    blk = {(r.barrid, r.date): r.f for r in forward_fill_blocked(df, ["f"], ["barrid"], "date").collect()}
    assert blk == plain
