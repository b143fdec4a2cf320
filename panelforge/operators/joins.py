"""Joins: left equi-join chains, as-of joins (backward / forward / nearest),
interval-bounded as-of, rebalance-aware constituency fill, left join + default.

As-of join without a range join
-------------------------------
Both sides are stacked (``unionByName``) with a side tag and sorted once inside
each ``by`` partition by (time, side, tie-breaks); every left row then takes the
last right row seen so far: ``last(struct(right cols), ignorenulls)`` over a
running frame.  The right row travels as one struct, so NULLs inside a matched
right row are kept.  That is one shuffle on ``by`` and one sort, linear in the
input, and several right tables can ride the same pass (``asof_join_many``).

Forward joins run the same pass in descending time (a running frame, never an
unbounded-following one, which Spark evaluates quadratically).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# --------------------------------------------------------------------------- D1
def left_chain(base: DataFrame, others: Sequence[DataFrame], on=("date", "barrid")) -> DataFrame:
    """base LEFT JOIN o1 LEFT JOIN o2 ... on the same keys (one exchange per
    input; the joined result keeps the key partitioning for the next join)."""
    out = base
    for o in others:
        out = out.join(o, list(on), "left")
    return out


# --------------------------------------------------------------------------- D2/D3
@dataclass
class AsofSide:
    right: DataFrame
    right_on: str
    tie_break: Sequence[str] = field(default_factory=tuple)
    strategy: str = "backward"  # backward | forward | nearest
    columns: Sequence[str] | None = None  # right columns to bring (default: all but by)
    alias: str | None = None  # prefix for colliding names (default "_right" suffix)


def _side_struct(df: DataFrame, cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def asof_join_many(
    left: DataFrame,
    sides: Sequence[AsofSide],
    left_on: str,
    by: str | Sequence[str],
    suffix: str = "_right",
) -> DataFrame:
    """As-of join of ``left`` with several right tables in one partitioned pass.

    For each side the output gains its columns (minus ``by``); a name already
    present gets ``suffix`` (then ``suffix2`` ...).  Unmatched rows get NULLs.
    """
    by = _list(by)
    lcols = left.columns
    lrest = [c for c in lcols if c not in by]  # key columns travel as top-level columns
    lstruct_t = left.select(_side_struct(left, lrest).alias("s")).schema["s"].dataType

    plans = []
    taken = set(lcols)
    for i, s in enumerate(sides):
        out_cols = list(s.columns) if s.columns is not None else [c for c in s.right.columns if c not in by]
        cols = out_cols if s.right_on in out_cols else out_cols + [s.right_on]
        r = s.right.select(*by, *cols, *[t for t in s.tie_break if t not in cols and t not in by])
        rstruct_t = r.select(_side_struct(r, cols).alias("s")).schema["s"].dataType
        outnames = []
        for c in out_cols:
            name = c
            k = 1
            while name in taken:
                name = f"{c}{suffix}" if k == 1 else f"{c}{suffix}{k}"
                k += 1
            taken.add(name)
            outnames.append(name)
        plans.append((s, r, cols, rstruct_t, (out_cols, outnames)))

    n = len(plans)
    tb_cols = [f"_tb{i}_{j}" for i, (s, *_rest) in enumerate(plans) for j in range(len(s.tie_break))]

    def null_of(t):
        return F.lit(None).cast(t)

    left_u = left.select(
        *[F.col(b) for b in by],
        F.col(left_on).alias("_t"),
        F.lit(1).alias("_side"),
        _side_struct(left, lrest).alias("_l"),
        *[null_of(p[3]).alias(f"_r{i}") for i, p in enumerate(plans)],
    )
    # tie-break columns: typed from their right tables
    tb_types = {}
    for i, (s, r, cols, rt, on) in enumerate(plans):
        for j, c in enumerate(s.tie_break):
            tb_types[f"_tb{i}_{j}"] = s.right.schema[c].dataType
    left_u = left_u.select("*", *[null_of(tb_types[c]).alias(c) for c in tb_cols])

    unions = [left_u]
    for i, (s, r, cols, rt, on) in enumerate(plans):
        usable = F.col(s.right_on).isNotNull()
        for b in by:
            usable = usable & F.col(b).isNotNull()
        ri = r.filter(usable).select(
            *[F.col(b) for b in by],
            F.col(s.right_on).alias("_t"),
            F.lit(0).alias("_side"),
            null_of(lstruct_t).alias("_l"),
            *[(_side_struct(r, cols) if k == i else null_of(plans[k][3])).alias(f"_r{k}") for k in range(n)],
            *[
                (F.col(s.tie_break[int(c.split("_")[2])]) if c.startswith(f"_tb{i}_") else null_of(tb_types[c])).alias(c)
                for c in tb_cols
            ],
        )
        unions.append(ri)
    u = unions[0]
    for x in unions[1:]:
        u = u.unionByName(x)

    part = list(by)
    # One ordering per direction for all sides: a side's right rows carry NULL
    # in the other sides' tie-break columns, so each side keeps its own order.
    back_w = (
        Window.partitionBy(*part)
        .orderBy(F.col("_t").asc(), F.col("_side").asc(), *[F.col(c).asc_nulls_first() for c in tb_cols])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    fwd_w = (
        Window.partitionBy(*part)
        .orderBy(F.col("_t").desc(), F.col("_side").asc(), *[F.col(c).desc_nulls_last() for c in tb_cols])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    back = {f"_b{i}": F.last(f"_r{i}", ignorenulls=True).over(back_w)
            for i, p in enumerate(plans) if p[0].strategy in ("backward", "nearest")}
    fwd = {f"_f{i}": F.last(f"_r{i}", ignorenulls=True).over(fwd_w)
           for i, p in enumerate(plans) if p[0].strategy in ("forward", "nearest")}
    if back:
        u = u.withColumns(back)
    if fwd:
        u = u.withColumns(fwd)
    picked = []
    for i, (s, r, cols, rt, on) in enumerate(plans):
        if s.strategy == "backward":
            picked.append(F.col(f"_b{i}"))
        elif s.strategy == "forward":
            picked.append(F.col(f"_f{i}"))
        elif s.strategy == "nearest":
            gb = F.datediff(F.col("_t"), F.col(f"_b{i}")[s.right_on]) if _is_date(rt, s.right_on) else (
                F.col("_t") - F.col(f"_b{i}")[s.right_on])
            gf = F.datediff(F.col(f"_f{i}")[s.right_on], F.col("_t")) if _is_date(rt, s.right_on) else (
                F.col(f"_f{i}")[s.right_on] - F.col("_t"))
            # equal distance: the backward candidate wins
            picked.append(
                F.when(F.col(f"_f{i}").isNull(), F.col(f"_b{i}"))
                .when(F.col(f"_b{i}").isNull(), F.col(f"_f{i}"))
                .when(gf < gb, F.col(f"_f{i}"))
                .otherwise(F.col(f"_b{i}"))
            )
        else:
            raise ValueError(f"unknown strategy {s.strategy!r}")
    u = u.filter(F.col("_side") == 1)
    out = [F.col(c) if c in by else F.col("_l")[c].alias(c) for c in lcols]
    keyed = F.col("_t").isNotNull()  # a NULL time or key matches nothing
    for b in by:
        keyed = keyed & F.col(b).isNotNull()
    for i, (s, r, cols, rt, (oc, on)) in enumerate(plans):
        m = F.when(keyed, picked[i])
        out += [m[c].alias(o) for c, o in zip(oc, on)]
    return u.select(*out)


def _is_date(struct_t: T.StructType, name: str) -> bool:
    return isinstance(struct_t[name].dataType, (T.DateType,))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    by: str | Sequence[str],
    strategy: str = "backward",
    tie_break: Sequence[str] = (),
    valid_until: str | None = None,
    suffix: str = "_right",
) -> DataFrame:
    """As-of join: each left row gets the right row of the same ``by`` whose
    ``right_on`` is the latest <= ``left_on`` (backward), the earliest >=
    (forward) or the closer of the two (nearest; a tie goes backward).

    Right rows with equal time are ordered by ``tie_break``; the last one wins
    backward, the first one forward.  With ``valid_until`` (a right column), a
    match whose interval ended before ``left_on`` is dropped (interval-bounded
    as-of)."""
    side = AsofSide(right, right_on, tuple(tie_break), strategy)
    out = asof_join_many(left, [side], left_on, by, suffix)
    return out if valid_until is None else _bounded(out, left, right, left_on, _list(by), valid_until)


# --------------------------------------------------------------------------- D4
def universe_fill(
    panel: DataFrame,
    membership: DataFrame,
    flags: Sequence[str] = ("russell_1000", "russell_2000"),
    key: str = "cusip",
    asset: str = "barrid",
    out: str = "in_universe",
    bucket=None,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Rebalance-aware constituency.

    Left-join the membership flags on (date, key); on a rebalance date (any date
    present in ``membership``) a missing flag means False, on other dates NULL;
    then forward-fill per asset; ``out`` = flag1 OR flag2 (three-valued).
    The rebalance calendar has one row per rebalance day.  ``bucket`` (e.g. ``F.year``) runs the fill per (asset, time
    bucket) for assets too long for one task.  ``carry``: (asset, flags) that hold
    before the panel's first row of an asset, where its series began earlier."""
    flags = list(flags)
    rebal = membership.select("date").distinct().withColumn("_rebalance", F.lit(True))
    j = panel.join(membership.select("date", key, *flags), ["date", key], "left").join(rebal, "date", "left")
    j = j.select(
        *[c for c in j.columns if c not in flags and c != "_rebalance"],
        *[F.when(F.col("_rebalance"), F.coalesce(F.col(f), F.lit(False))).alias(f) for f in flags],
    )
    if bucket is not None:  # hot assets: fill per (asset, time bucket) with a carried value
        from panelforge.functions.blocks import forward_fill_blocked

        j = forward_fill_blocked(j, flags, [asset], "date", bucket)
        j = j.select(*[c for c in j.columns if c not in flags], *flags)
    else:
        w = Window.partitionBy(asset).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        j = j.select(
            *[c for c in j.columns if c not in flags],
            *[F.last(f, ignorenulls=True).over(w).alias(f) for f in flags],
        )
    if carry is not None:
        held = carry.select(asset, *[F.col(f).alias(f"_held_{f}") for f in flags])
        j = j.join(held, asset, "left").select(*[c for c in j.columns if c not in flags], *[F.coalesce(f, f"_held_{f}").alias(f) for f in flags])
    u = F.col(flags[0])
    for f in flags[1:]:
        u = u | F.col(f)
    return j.withColumn(out, u)


# --------------------------------------------------------------------------- D6
def left_join_default(left: DataFrame, right: DataFrame, on, fill: dict) -> DataFrame:
    """LEFT JOIN then fill missing values (e.g. alpha -> 0)."""
    j = left.join(right, list(_list(on)), "left")
    return j.fillna(fill) if fill else j


# --------------------------------------------------------------------------- D2/D3 for hot keys
def asof_join_bucketed(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    by: str | Sequence[str],
    bucket,
    strategy: str = "backward",
    tie_break: Sequence[str] = (),
    suffix: str = "_right",
    valid_until: str | None = None,
) -> DataFrame:
    """As-of join for keys too large for one task: the stacked pass runs per
    (key, time bucket) - ``bucket`` maps a time Column to an integral bucket
    number, e.g. ``F.year`` - and a row without a match inside its bucket
    takes the latest (backward) or earliest (forward) right row of the
    neighbouring buckets.  That carry comes from one row per (key, bucket):
    the bucket's last/first right row (a partial aggregation) and a range
    frame over bucket numbers, so no task ever holds a whole key.  ``nearest``
    takes both and keeps the closer; ``valid_until`` as in ``asof_join``."""
    if strategy == "nearest":
        out = _bucketed_nearest(left, right, left_on, right_on, _list(by), bucket, tuple(tie_break), suffix)
    elif strategy in ("backward", "forward"):
        out = _bucketed(left, right, left_on, right_on, _list(by), bucket, strategy, tuple(tie_break), suffix)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return out if valid_until is None else _bounded(out, left, right, left_on, _list(by), valid_until)


def _bounded(out: DataFrame, left: DataFrame, right: DataFrame, left_on: str, by: list, valid_until: str) -> DataFrame:
    """Matches whose interval ended before ``left_on`` become NULL."""
    rcols = [c for c in right.columns if c not in by]
    names = out.columns[len(left.columns):]
    end = F.col(names[rcols.index(valid_until)])
    return out.select(*left.columns, *[F.when(end.isNull() | (end >= F.col(left_on)), F.col(n)).alias(n) for n in names])


def _bucketed_nearest(left, right, left_on, right_on, by, bucket, tie_break, suffix) -> DataFrame:
    """The closer of the backward and the forward match; equal distance goes backward."""
    rcols = [c for c in right.columns if c not in by]
    packed = right.select(*by, F.col(right_on).alias("_at"), F.struct(*rcols).alias("_hit"),
                          *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie_break)])
    ties = tuple(f"_tie{i}" for i in range(len(tie_break)))
    names, taken = [], set(left.columns)
    for c in rcols:
        k, name = 1, c
        while name in taken:
            name, k = f"{c}{suffix}" if k == 1 else f"{c}{suffix}{k}", k + 1
        taken.add(name)
        names.append(name)
    d = _bucketed(left, packed, left_on, "_at", by, bucket, "backward", ties, "_x")
    d = d.select(*left.columns, F.col("_at").alias("_bt"), F.col("_hit").alias("_b"))
    d = _bucketed(d, packed, left_on, "_at", by, bucket, "forward", ties, "_x")
    if isinstance(right.schema[right_on].dataType, T.DateType):
        back, ahead = F.datediff(left_on, "_bt"), F.datediff("_at", left_on)
    else:
        back, ahead = F.col(left_on) - F.col("_bt"), F.col("_at") - F.col(left_on)
    hit = F.when(F.col("_b").isNull() | (ahead < back), F.coalesce("_hit", "_b")).otherwise(F.col("_b"))
    return d.withColumn("_b", hit).select(*left.columns, *[F.col("_b")[c].alias(n) for c, n in zip(rcols, names)])


def _bucketed(left, right, left_on, right_on, by, bucket, strategy, tie_break, suffix) -> DataFrame:
    lb = left.withColumn("_bk", bucket(F.col(left_on)).cast("long"))
    rb = right.filter(F.col(right_on).isNotNull()).withColumn("_bk", bucket(F.col(right_on)).cast("long"))
    rcols = [c for c in right.columns if c not in by]
    inner = asof_join_many(lb, [AsofSide(rb, right_on, tuple(tie_break), strategy, columns=rcols)],
                           left_on, [*by, "_bk"], suffix)
    out_names = inner.columns[len(lb.columns):]
    t_out = out_names[rcols.index(right_on)]

    order = F.struct(*[F.col(c) for c in (right_on, *tie_break)])
    pick = F.max_by if strategy == "backward" else F.min_by
    per_bucket = rb.groupBy(*by, "_bk").agg(pick(F.struct(*[F.col(c) for c in rcols]), order).alias("_row"))
    keys = lb.select(*by, "_bk").distinct().withColumn("_row", F.lit(None).cast(per_bucket.schema["_row"].dataType))
    table = per_bucket.unionByName(keys).groupBy(*by, "_bk").agg(F.max("_row").alias("_row"))
    if strategy == "backward":
        w = Window.partitionBy(*by).orderBy("_bk").rangeBetween(Window.unboundedPreceding, -1)
        carry = F.last("_row", ignorenulls=True).over(w)
    else:
        w = Window.partitionBy(*by).orderBy("_bk").rangeBetween(1, Window.unboundedFollowing)
        carry = F.first("_row", ignorenulls=True).over(w)
    table = table.select(*by, "_bk", carry.alias("_carry"))
    j = inner.join(table, [*by, "_bk"], "left")
    hit = F.col(t_out).isNotNull()
    sel = [F.col(c) for c in left.columns]
    sel += [F.when(hit, F.col(o)).when(F.col(left_on).isNotNull(), F.col("_carry")[c]).alias(o)
            for c, o in zip(rcols, out_names)]
    return j.select(*sel)
