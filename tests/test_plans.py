"""Physical-plan checks: no nested-loop or cartesian joins, no row-at-a-time
Python, Python workers only where the design puts them, filters and column
pruning reach the parquet scan."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
# queries whose design runs Python in tasks: archive unzip (A1-A4), K x K solve
PYTHON_OK = {"src_archive_history", "src_daily_lookback", "src_latest_snapshot", "signal_weights_raw",
             "signal_weights", "rolling_covariance", "composite_alpha", "composite_weights", "alpha_fill_panel",
             "portfolio_returns", "benchmark_returns", "cumulative_log_return", "active_returns",
             "performance_summary"}
STAGED = {"alphas_long", "active_weights", "signal_returns", "signal_weights_raw", "performance_summary", "signals_pipeline"}
LAZY = ["assets_panel", "alphas_long", "signals_long", "win_zscore", "rolling_sum", "ewm_mean_long", "asof_nearest",
        "pivot_exposures", "extract_events", "optimizer_panel", "active_weights", "signal_returns",
        "benchmark_weights", "universe_forward_fill", "lag_lead"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stage_plans(spark, name, monkeypatch) -> list[str]:
    """Plans of every stage boundary that the query writes, and its last."""
    from panelforge import session
    from panelforge.plans import combination
    from panelforge.sources import tables

    seen, write = [], session.reliable_checkpoint

    def noted(df):
        seen.append(_plan(df))
        return write(df)

    monkeypatch.setattr(session, "reliable_checkpoint", noted)
    monkeypatch.setattr(tables, "reliable_checkpoint", noted)
    assert combination.checkpoint  # looks the function up in its module at each call
    last = E.queries()[name](spark, SF)
    return [*seen, _plan(last)]


@pytest.mark.parametrize("name", [*LAZY, "signal_weights_raw", "performance_summary", "signals_pipeline"])
def test_no_nested_loop_or_python(spark, name, monkeypatch):
    plans = _stage_plans(spark, name, monkeypatch)
    for plan in plans:
        assert "BroadcastNestedLoopJoin" not in plan
        assert "CartesianProduct" not in plan
        assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDF
    python = ("MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroups", "ArrowEvalPython")
    in_python = [p for p in plans if any(k in p for k in python)]
    assert len(in_python) <= (1 if name in PYTHON_OK else 0)
    if name in STAGED:
        assert len(plans) > 2


def test_pushdown_and_pruning(spark):
    df = E.queries()["extract_events"](spark, SF)
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "EqualTo(l_returnflag,R)" in plan
    read_schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "l_discount" not in read_schema and "l_tax" not in read_schema
