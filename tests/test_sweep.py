"""The one-exchange sweep against the step-by-step joins."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from panelforge.operators.joins import AsofSide, asof_join_many, left_chain, universe_fill
from panelforge.operators.sweep import panel_sweep

D0 = dt.date(2020, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def fixture(spark, seed):
    r = random.Random(seed)
    assets = [f"a{i}" for i in range(6)]
    keys = [(day(t), a) for t in range(60) for a in assets if r.random() < 0.7]
    base = [(d, a, r.random(), r.choice(["x", None])) for d, a in keys]
    risk = [(d, a, r.random()) for d, a in keys if r.random() < 0.6] + [(day(500), "zz", 1.0)]
    vol = [(d, a, r.randrange(99)) for d, a in keys if r.random() < 0.5]
    ids = [(a, day(r.randrange(-5, 60)), r.randrange(3), r.choice([None, "n1", "n2", "n3"])) for a in assets for _ in range(5)]
    ids = [*{(a, s, e): (a, s, e, n) for a, s, e, n in ids}.values(), ("a0", None, 1, "never"), (None, day(1), 1, "never")]
    cusips = [(a, day(s), f"C{a[1]}{'' if k == 0 else 'n'}") for a in assets for k, s in enumerate((-3, 30))]
    member = [(day(t), f"C{i}{s}", r.random() < 0.5, r.random() < 0.5) for t in (5, 17, 29, 33, 50) for i in range(6) for s in ("", "n") if r.random() < 0.7]
    make = spark.createDataFrame
    return (make(base, "date date, barrid string, price double, source string").repartition(3),
            [make(risk, "date date, barrid string, beta double"), make(vol, "date date, barrid string, volume int")],
            [AsofSide(make(ids, "barrid string, start date, rank int, name string"), "start", ("rank",), columns=["name", "rank"]),
             AsofSide(make(cusips, "barrid string, start date, cusip string"), "start", columns=["cusip"])],
            make(member, "date date, cusip string, russell_1000 boolean, russell_2000 boolean"))


@pytest.mark.parametrize("seed", [1, 2])
def test_sweep_equals_steps(spark, seed):
    base, daily, histories, member = fixture(spark, seed)
    steps = universe_fill(asof_join_many(left_chain(base, daily), histories, "date", "barrid"), member)
    got = panel_sweep(base, daily, histories, member)
    assert sorted(got.columns) == sorted(steps.columns)
    rows = lambda df: sorted(map(tuple, df.select(*sorted(steps.columns)).collect()), key=str)
    assert rows(got) == rows(steps)


def test_sweep_continues_an_earlier_panel(spark):
    base, daily, histories, member = fixture(spark, 3)
    whole = panel_sweep(base, daily, histories, member)
    cut = F.col("date") >= F.lit(day(31))
    carry = whole.filter(~cut).groupBy("barrid").agg(*[F.max_by(f, "date").alias(f) for f in ("russell_1000", "russell_2000")])
    later = panel_sweep(base.filter(cut), daily, histories, member, carry=carry)
    rows = lambda df: sorted(map(tuple, df.select(*sorted(whole.columns)).collect()), key=str)
    assert rows(later) == rows(whole.filter(cut))


def test_rows_without_a_key_match_nothing(spark):
    base, daily, histories, member = fixture(spark, 4)
    loose = spark.createDataFrame([(None, "a1", 1.0, "x"), (day(40), None, 2.0, "y"), (None, None, 3.0, None)], base.schema)
    out = panel_sweep(base.unionByName(loose), daily, histories, member).filter("date is null or barrid is null").collect()
    assert sorted(r["price"] for r in out) == [1.0, 2.0, 3.0] and all(r["name"] is None and r["in_universe"] is None for r in out)
    with pytest.raises(ValueError):
        panel_sweep(base, [base], histories, member)


def test_the_panel_is_exchanged_once(spark):
    base, daily, histories, member = fixture(spark, 5)
    plan = panel_sweep(base, daily, histories, member)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "SortMergeJoin [date" not in plan
    above = plan[: plan.index("REPARTITION_BY_COL")]  # from the result down to the one exchange
    assert not re.search(r"Exchange hashpartitioning", above[: above.rindex("Exchange")])
