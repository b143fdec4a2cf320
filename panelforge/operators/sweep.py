"""One sweep along each asset's time axis (D1, D2, D4, D9 together).

Daily tables, interval histories and constituency of an asset are all facts with a time.
They are stacked, dealt out by asset once, and merged by (asset, time) in one sorted
pass: daily facts of one day meet, histories hold from their start until the next
start, the constituency of a rebalance day holds until the next.  The panel crosses the
network once, whatever is joined to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.joins import AsofSide

TIME = "_t"


def held_intervals(side: AsofSide, by: str) -> DataFrame:
    """(by, columns, _from, _until): the stretches in which each row of a history is the
    latest of its key; equal starts are settled by the tie break, the last one wins."""
    cols = list(side.columns)
    rows = side.right.filter(F.col(side.right_on).isNotNull() & F.col(by).isNotNull())
    best = rows.groupBy(by, F.col(side.right_on).alias("_from")).agg(F.max_by(F.struct(*cols), F.struct(F.lit(0), *side.tie_break)).alias("_row"))
    nxt = F.lead("_from").over(Window.partitionBy(by).orderBy("_from"))
    return best.select(by, "_row.*", "_from", nxt.alias("_until"))


def membership_by_asset(membership: DataFrame, history: AsofSide, key: str, flags: Sequence[str], by: str) -> DataFrame:
    """(by, date, flags) of membership rows (date, key, flags): the assets that hold the
    key on the day, by interval.  Of the size of the membership file, not of the panel."""
    held = held_intervals(history, by).select(F.col(key).alias("_key"), by, "_from", "_until")
    m = membership.select("date", F.col(key).alias("_key"), *flags).join(held, "_key")
    inside = (F.col("date") >= F.col("_from")) & (F.col("_until").isNull() | (F.col("date") < F.col("_until")))
    return m.filter(inside).select(by, "date", *flags)


def panel_sweep(base: DataFrame, daily: Sequence[DataFrame], histories: Sequence[AsofSide], membership: DataFrame,
                flags: Sequence[str] = ("russell_1000", "russell_2000"), key: str = "cusip", by: str = "barrid",
                out: str = "in_universe", carry: DataFrame | None = None) -> DataFrame:
    """``base`` (by, date, ...) with the columns of the ``daily`` tables of its day, of
    each history's latest row (backward as-of) and the constituency ``flags``.

    Daily tables are unique on (by, date).  On a rebalance day (any day in
    ``membership``) a missing flag means False; flags hold until the next rebalance
    day on which the asset is in ``base``; ``out`` is flag1 OR flag2, three-valued.
    ``carry``: (by, flags) that hold before the base's first rows.  Rows of ``base``
    without asset or day match nothing."""
    flags, daily = list(flags), list(daily)
    values = [c for d in (base, *daily) for c in d.columns if c not in (by, "date")]
    if len(set(values)) < len(values):
        raise ValueError("daily tables share columns")
    keyed = lambda d: d.filter(F.col(by).isNotNull() & F.col("date").isNotNull())
    # a table's values travel as one column, absent in the rows of the others
    own = [d.drop(by, "date").columns for d in (base, *daily)]
    stacked = None
    for i, d in enumerate((base, *daily)):
        rows = keyed(d).select(by, F.col("date").alias(TIME), *([F.struct(*own[i]).alias(f"_d{i}")] if own[i] else []), *([F.lit(True).alias("_base")] if i == 0 else []))
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    holder = next(h for h in histories if key in h.columns)
    member = membership_by_asset(membership, holder, key, flags, by).withColumnRenamed("date", TIME)
    stacked = stacked.unionByName(member.select(by, TIME, *[F.col(f).alias(f"_f_{f}") for f in flags]), allowMissingColumns=True)
    for i, h in enumerate(histories):
        rows = h.right.filter(F.col(h.right_on).isNotNull() & F.col(by).isNotNull())
        row = F.struct(F.struct(F.lit(0), *h.tie_break).alias("o"), F.struct(*h.columns).alias("v"))
        stacked = stacked.unionByName(rows.select(by, F.col(h.right_on).cast(stacked.schema[TIME].dataType).alias(TIME), row.alias(f"_h{i}")), allowMissingColumns=True)

    # the one exchange; the merge by (asset, time) and the pass along time keep its order
    met = stacked.repartition(by).groupBy(by, TIME).agg(
        *[F.max(F.col(f"_d{i}")[c]).alias(c) for i, cols in enumerate(own) for c in cols], F.max("_base").alias("_base"), *[F.max(f"_f_{f}").alias(f"_f_{f}") for f in flags],
        *[F.max_by(f"_h{i}.v", f"_h{i}.o").alias(f"_h{i}") for i in range(len(histories))])
    # at most a row for each day of the calendar, so it can always be broadcast
    rebalance = membership.select(F.col("date").alias(TIME)).distinct().withColumn("_rebalance", F.lit(True))
    met = met.join(F.broadcast(rebalance), TIME, "left")
    along = Window.partitionBy(by).orderBy(TIME).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    decided = {f: F.when(F.col("_base") & F.col("_rebalance"), F.coalesce(f"_f_{f}", F.lit(False))) for f in flags}
    met = met.withColumns({f"_s_{f}": e for f, e in decided.items()})
    met = met.select(by, TIME, *values, "_base", *[F.last(f"_h{i}", ignorenulls=True).over(along).alias(f"_h{i}") for i in range(len(histories))],
                     *[F.last(f"_s_{f}", ignorenulls=True).over(along).alias(f) for f in flags]).filter("_base")
    if carry is not None:
        held = carry.select(by, *[F.col(f).alias(f"_held_{f}") for f in flags])
        met = met.join(held, by, "left").withColumns({f: F.coalesce(f, f"_held_{f}") for f in flags})
    cols = [F.col(TIME).alias("date"), by, *values]
    cols += [F.col(f"_h{i}")[c].alias(c) for i, h in enumerate(histories) for c in h.columns]
    panel = met.select(*cols, *flags)
    loose = base.filter(F.col(by).isNull() | F.col("date").isNull())
    panel = panel.unionByName(loose, allowMissingColumns=True)
    u = F.col(flags[0])
    for f in flags[1:]:
        u = u | F.col(f)
    return panel.withColumn(out, u)
