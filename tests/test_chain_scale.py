"""The combination chain moves its panels as seldom as it can, with the same rows."""

import datetime as dt

from pyspark.sql import functions as F

from panelforge.operators import portfolio as P
from panelforge.operators.crosssection import attach_stats
from panelforge.plans.combination import Chain, signal_active_weights

D = [dt.date(2020, 1, k) for k in range(1, 5)]


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def _stored(spark, tmp_path, rows, schema, name):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def test_cross_section_statistics_are_broadcast(spark, tmp_path):
    df = _stored(spark, tmp_path, [(D[0], 1.0), (D[0], 3.0), (None, 5.0)], "date date, x double", "x")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as when sizes are unknown
    try:
        out = attach_stats(df, ["date"], {"m": F.avg("x")})
        assert "BroadcastHashJoin" in _plan(out) and "SortMergeJoin" not in _plan(out)
        got = {(r["x"], r["m"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {(1.0, 2.0), (3.0, 2.0), (5.0, None)}


def test_signal_returns_deal_rows_out_by_asset_once(spark, tmp_path):
    w = _stored(spark, tmp_path, [(D[0], "a", "s", 1.0), (D[1], "a", "s", 2.0), (D[2], "a", "s", 4.0), (D[0], "b", "s", 8.0), (D[1], "b", "s", 16.0),
                                  (D[1], None, "s", 32.0), (D[2], None, "s", 64.0), (D[0], "a", None, 1.0), (D[1], "a", None, 1.0)],
                "date date, barrid string, signal_name string, weight double", "w")
    a = _stored(spark, tmp_path, [(D[1], "a", 10.0), (D[1], "a", 20.0), (D[2], "a", None), (D[1], "b", 100.0), (D[2], None, 50.0)],
                "date date, barrid string, return double", "a")
    out = P.signal_returns(w, a)
    assert "SortMergeJoin" not in _plan(out) and "Join" not in _plan(out)
    got = {(r["signal_name"], r["date"]): r["forward_return"] for r in out.collect()}
    # a's two returns of the day both earn; a row without asset matches nothing
    assert {k: round(v, 12) for k, v in got.items()} == {
        ("s", D[0]): 0.0, ("s", D[1]): round(1.0 * 0.3 + 8.0, 12), ("s", D[2]): 0.0, (None, D[0]): 0.0, (None, D[1]): 0.3}


def test_signal_returns_of_a_held_panel_move_no_rows_by_asset(spark, tmp_path):
    rows = [(D[0], "a", 0.8, 3.0, 1.0, 200.0, True), (D[1], "a", 0.9, 2.0, 10.0, 250.0, True), (D[1], "a", 0.9, 2.0, 20.0, 250.0, False),
            (D[2], "a", 1.1, 2.0, 40.0, 250.0, False), (D[3], "a", 1.2, 3.0, None, 200.0, True), (D[0], "b", 0.5, 1.0, 3.0, 100.0, True),
            (D[1], "b", 0.4, 1.0, 5.0, 100.0, True), (D[3], "b", 0.7, 1.0, -7.0, 150.0, True), (D[0], "c", 1.5, 2.0, 1.0, 300.0, True),
            (D[1], "c", 1.6, 2.0, 4.0, 100.0, True), (D[2], "c", 1.4, 2.0, 4.0, 100.0, True), (D[3], "c", 1.3, 5.0, 6.0, 100.0, True),
            (D[0], None, 1.0, 1.0, 9.0, 100.0, True), (D[1], None, 1.0, 2.0, 9.0, 120.0, True), (D[1], "d", 1.0, 2.0, 9.0, 100.0, None),
            (None, "c", 1.1, 2.0, 9.0, 100.0, True)]
    assets = _stored(spark, tmp_path, rows, "date date, barrid string, predicted_beta double, market_cap double, return double, specific_risk double, in_universe boolean", "assets")
    alphas = _stored(spark, tmp_path, [(d, b, s, x) for k, s in enumerate(("beta", "ivol")) for i, (d, b, x) in enumerate([
        (D[0], "a", 1.0), (D[0], "b", -2.0), (D[0], "c", 0.5), (D[1], "a", 3.0 + k), (D[1], "b", 4.0), (D[2], "c", 2.0), (D[3], "b", 1.0)]) if i != k],
        "date date, barrid string, signal_name string, alpha double", "alphas")
    weights = signal_active_weights(assets, alphas, ["beta", "ivol"], held=True)
    out = P.signal_returns(weights, assets)
    assert "Window" not in _plan(out) and "REPARTITION" not in _plan(out)
    got = {(r["signal_name"], r["date"]): r["forward_return"] for r in out.collect()}
    plain = P.signal_returns(weights.drop("held_until", "held_return"), assets)
    want = {(r["signal_name"], r["date"]): r["forward_return"] for r in plain.collect()}
    assert set(got) == set(want) and any(want.values())
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_held_rows_of_one_asset_and_day_follow_each_other(spark, tmp_path):
    assets = _stored(spark, tmp_path, [(D[0], "a", 1.0, 3.0, 10.0, 200.0, True), (D[2], "a", 1.0, 3.0, 30.0, 200.0, True)],
                     "date date, barrid string, predicted_beta double, market_cap double, return double, specific_risk double, in_universe boolean", "assets")
    alphas = _stored(spark, tmp_path, [(D[0], "a", "s", 5.0), (D[0], "a", "s", 6.0)], "date date, barrid string, signal_name string, alpha double", "alphas")
    out = P.optimizer_panel(assets, alphas, signals=["s"], held=True)
    assert sorted((r["date"], str(r["held_until"]), r["held_return"]) for r in out.collect()) == [
        (D[0], str(D[0]), 0.1), (D[0], str(D[2]), 0.3), (D[2], "None", None)]


def test_optimizer_panel_moves_universe_rows_once(spark, tmp_path):
    assets = _stored(spark, tmp_path, [(D[0], "a", 1.0, 3.0, 200.0, True), (D[0], "b", 2.0, 1.0, 100.0, True), (D[0], None, 1.0, 4.0, 100.0, True),
                                       (D[1], "a", 1.0, 3.0, 200.0, False)],
                     "date date, barrid string, predicted_beta double, market_cap double, specific_risk double, in_universe boolean", "assets")
    alphas = _stored(spark, tmp_path, [(D[0], "a", "s", 5.0), (D[0], "a", "s", 6.0), (D[0], "b", "s", None), (D[0], "b", "t", 7.0), (D[0], None, "s", 9.0),
                                       (D[0], "b", "other", 1.0)], "date date, barrid string, signal_name string, alpha double", "alphas")
    out = P.optimizer_panel(assets, alphas, signals=["s", "t"])
    assert "SortMergeJoin" not in _plan(out)
    assert out.columns == ["date", "barrid", "signal_name", "predicted_beta", "specific_risk", "benchmark_weight", "alpha"]
    got = sorted((str(r["barrid"]), r["signal_name"], r["benchmark_weight"], r["alpha"]) for r in out.collect())
    assert got == [("None", "s", 0.5, 0.0), ("None", "t", 0.5, 0.0), ("a", "s", 0.375, 5.0), ("a", "s", 0.375, 6.0), ("a", "t", 0.375, 0.0),
                   ("b", "s", 0.125, 0.0), ("b", "t", 0.125, 7.0)]
    one = P.optimizer_panel(assets, alphas.filter("signal_name = 't'").drop("signal_name"))
    assert one.columns == ["date", "barrid", "predicted_beta", "specific_risk", "benchmark_weight", "alpha"]
    assert sorted((str(r["barrid"]), r["alpha"]) for r in one.collect()) == [("None", 0.0), ("a", 0.0), ("b", 7.0)]


def test_chain_writes_only_what_is_read_again(spark):
    assets = spark.createDataFrame([(D[0], "a", 1.0, 3.0, 2.0, 200.0, True)],
                                   "date date, barrid string, predicted_beta double, market_cap double, return double, specific_risk double, in_universe boolean")
    chain = Chain(assets, spark.createDataFrame([(D[0], "a", "beta", 5.0)], "date date, barrid string, signal_name string, alpha double"))
    chain.signal_returns()
    assert set(chain._memo) == {"signal_returns"}


def test_late_split_files_are_written_from_their_year(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    import __spark_entry__ as E

    seen, plain = [], DataFrame.coalesce

    def noted(df, n):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, n)

    monkeypatch.setattr(DataFrame, "coalesce", noted)
    E.queries()["stream_late_splits"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 4
    for plan in seen:  # the one task that writes a file
        assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]


ASSETS = "date date, barrid string, price double, return double, specific_return double, specific_risk double, predicted_beta double, daily_volume double, in_universe boolean"


def _days(asset, n=8):
    return [(dt.date(2020 + k // 6, 1, 1 + k), asset, 10.0 + k, 1.0 + k, 0.5 * k, 20.0 + k, 0.5 + ord(asset) / 100, 100.0 + k, True) for k in range(n)]


def test_signal_tables_are_written_where_their_rows_lie(spark, tmp_path, monkeypatch):
    from panelforge.plans.flows import signals_flow
    from panelforge.sources.tables import Table

    plans, first = {}, Table._first

    def noted(table, rows, on):
        plans[table.spec.name] = _plan(rows)
        return first(table, rows, on)

    monkeypatch.setattr(Table, "_first", noted)
    assets = spark.createDataFrame(_days("a") + _days("b") + _days("c", 3), ASSETS)
    tables = signals_flow(spark, assets, str(tmp_path / "store"))
    assert set(plans) == {"signals", "scores", "alphas"}
    assert "Exchange" not in plans["signals"] and not any("Window" in p for p in plans.values())  # else the keys' count moves the rows
    rows = {name: t.read().collect() for name, t in tables.items()}
    assert {len(r) for r in rows.values()} == {len({(r["date"], r["barrid"], r["signal_name"]) for r in rows["signals"]})} and len(rows["signals"]) > 30
    assert all(len(r) == 4 for some in rows.values() for r in some)  # the count is not stored


def test_signal_rows_that_share_a_key_are_refused(spark, tmp_path):
    import pytest

    from panelforge.plans.flows import signals_flow

    rows = _days("a") + _days("b")
    none = (*rows[3][:5], None, *rows[3][6:])  # without a specific risk it gives no signal row, so it shares no key
    fine = signals_flow(spark, spark.createDataFrame([*rows, none], ASSETS), str(tmp_path / "fine"), ["beta", "ivol"])
    assert fine["signals"].read().count() == 2 * (8 + 7) - 1  # the row before it is its next one's
    with pytest.raises(ValueError, match="not unique"):
        signals_flow(spark, spark.createDataFrame([*rows, rows[3]], ASSETS), str(tmp_path / "twice"), ["beta"])
    assert not (tmp_path / "twice" / "signals").exists()


def test_first_rows_overwrite_without_moving(spark, tmp_path):
    from panelforge.sources.tables import Table, TableSpec

    rows = [(dt.date(2020 + k % 3, 1, 1), f"a{k}", float(k)) for k in range(30)]
    df = spark.createDataFrame(rows, "date date, barrid string, v double").repartition(2, "barrid")
    t = Table(spark, str(tmp_path), TableSpec("t", df.schema, ("date", "barrid")))
    for _ in range(2):  # the second time from rows written aside
        t.overwrite(df)
        files = list((tmp_path / "t").glob("year=*/part-*"))
        assert len({f.parent for f in files}) == 3 and sorted(map(tuple, t.read().collect())) == sorted(rows)
        if _ == 0:
            assert len(files) == 6  # of both partitions, each year: dealt out by asset still


def test_upsert_reads_and_moves_only_the_years_it_touches(spark, tmp_path, monkeypatch):
    from panelforge.sources.tables import Table, TableSpec

    plans, staged = [], Table._staged

    def noted(table, rows, on):
        plans.append(_plan(rows))
        return staged(table, rows, on)

    monkeypatch.setattr(Table, "_staged", noted)
    rows = [(dt.date(2018 + k % 4, 1, 1 + k), f"a{k}", float(k)) for k in range(20)]
    df = spark.createDataFrame(rows, "date date, barrid string, v double")
    t = Table(spark, str(tmp_path), TableSpec("t", df.schema, ("date", "barrid")))
    t.upsert(df)
    t.upsert(spark.createDataFrame([(rows[3][0], "a3", 9.0), (rows[3][0], "new", None)], df.schema))
    (plan,) = plans
    assert "LeftSemi" not in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(map(tuple, t.read().collect())) == sorted([*rows[:3], (rows[3][0], "a3", 9.0), (rows[3][0], "new", None), *rows[4:]], key=lambda r: (r[0], r[1]))


def test_rows_of_other_tables_are_not_staged(spark, tmp_path):
    import glob

    from panelforge.session import checkpoint_root
    from panelforge.sources.tables import Table, TableSpec

    df = spark.createDataFrame([(D[0], "a", 1.0), (D[1], "b", 2.0)], "date date, barrid string, v double")
    t = Table(spark, str(tmp_path), TableSpec("t", df.schema, ("date", "barrid")))
    before = set(glob.glob(checkpoint_root(spark).removeprefix("file:") + "/panelforge/stage-*"))
    for k in (1, 2):
        t.overwrite(df.withColumn("v", F.col("v") * k), apart=True)
    assert set(glob.glob(checkpoint_root(spark).removeprefix("file:") + "/panelforge/stage-*")) == before
    assert sorted(map(tuple, t.read().collect())) == [(D[0], "a", 2.0), (D[1], "b", 4.0)]
