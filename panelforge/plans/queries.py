"""Registered queries over the driver's tables, each with its DuckDB oracle.

Naming follows the operator inventory (README, "Operators").  Every query
reads the given parquet tables through the fixture views of
``panelforge.plans.fixtures`` and runs over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import signals as S
from panelforge.plans import fixtures as fx
from panelforge.plans.assets import build_assets_from_fixtures
from panelforge.plans.fixture_sql import with_ctes
from panelforge.plans.registry import R, RR, query, rnd, rnd_rel, round_all

# ---------------------------------------------------------------- shared SQL
UNI = """SELECT date, barrid, price, "return" / 100 AS ret, specific_return / 100 AS sret,
       specific_risk / 100 AS specific_risk, predicted_beta, daily_volume
FROM assets WHERE in_universe"""

EWM_IN = """SELECT barrid, date, sret,
       row_number() OVER (PARTITION BY barrid ORDER BY date) AS rn,
       count(sret) OVER (PARTITION BY barrid ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM uni"""

# q = 1 - 2 / (5 + 1)
EWM5 = """SELECT a.barrid, a.date,
       CASE WHEN a.sret IS NOT NULL AND a.cnt >= 5 THEN
         sum(b.sret * power(CAST(0.6666666666666667 AS DOUBLE), a.rn - b.rn))
         / sum(CASE WHEN b.sret IS NOT NULL THEN power(CAST(0.6666666666666667 AS DOUBLE), a.rn - b.rn) END)
       END AS ewm5
FROM ewm_in a JOIN ewm_in b ON a.barrid = b.barrid AND b.rn <= a.rn
GROUP BY a.barrid, a.date, a.sret, a.cnt"""

STAGE1 = """SELECT u.*,
       CASE WHEN count(lr) OVER w230 = 230 THEN sum(lr) OVER w230 END AS rs230,
       CASE WHEN count(lr) OVER w22 = 22 THEN sum(lr) OVER w22 END AS rs22,
       CASE WHEN count(lsr) OVER w230 = 230 THEN sum(lsr) OVER w230 END AS rss230,
       CASE WHEN count(sret) OVER w230 = 230 THEN stddev_samp(sret) OVER w230 END AS sd230
FROM (SELECT *, CASE WHEN ret > -1 THEN ln(1 + ret) END AS lr,
             CASE WHEN sret > -1 THEN ln(1 + sret) END AS lsr FROM uni) u
WINDOW w230 AS (PARTITION BY barrid ORDER BY date ROWS BETWEEN 229 PRECEDING AND CURRENT ROW),
       w22 AS (PARTITION BY barrid ORDER BY date ROWS BETWEEN 21 PRECEDING AND CURRENT ROW)"""

WIDE = """SELECT s.date, s.barrid, s.price, s.daily_volume, s.specific_risk, s.predicted_beta,
       lag(rs230, 22) OVER w AS momentum,
       -rs22 AS reversal,
       -predicted_beta AS beta,
       lag(-e.ewm5, 1) OVER w AS barra_reversal,
       lag(rss230 / nullif(sd230, 0), 21) OVER w AS barra_momentum,
       lag(-s.specific_risk, 1) OVER w AS ivol
FROM stage1 s JOIN ewm5 e ON s.barrid = e.barrid AND s.date = e.date
WINDOW w AS (PARTITION BY s.barrid ORDER BY s.date)"""

LONG = """SELECT * FROM (
  UNPIVOT wide ON momentum, reversal, beta, barra_reversal, barra_momentum, ivol
  INTO NAME signal_name VALUE signal_value)
WHERE signal_value IS NOT NULL AND predicted_beta IS NOT NULL AND specific_risk IS NOT NULL"""

ZS = """SELECT *, (signal_value - avg(signal_value) OVER d) / nullif(stddev_samp(signal_value) OVER d, 0) AS score
FROM long WHERE signal_name IN ('momentum', 'reversal', 'beta', 'barra_momentum', 'ivol')
WINDOW d AS (PARTITION BY signal_name, date)"""

WZ1 = """SELECT *, CASE WHEN z IS NOT NULL THEN greatest(least(z, 2.0), -2.0) END AS score,
       CASE WHEN daily_volume * price > -1 THEN ln(1 + daily_volume * price) END AS dv
FROM (SELECT *, (signal_value - avg(signal_value) OVER d) / nullif(stddev_samp(signal_value) OVER d, 0) AS z
      FROM long WHERE signal_name = 'barra_reversal'
      WINDOW d AS (PARTITION BY signal_name, date)) x"""

WZ = """SELECT *, coalesce((dv - dvm) / greatest(coalesce(dvs, 1.0), 0.0001), 0.0) AS volume_score FROM (
  SELECT *, CASE WHEN count(dv) OVER a >= 1 THEN avg(dv) OVER a END AS dvm,
            CASE WHEN count(dv) OVER a >= 2 THEN stddev_samp(dv) OVER a END AS dvs
  FROM wz1 WINDOW a AS (PARTITION BY signal_name, barrid ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)) y"""

ALPHAS = """SELECT date, barrid, signal_name, signal_value, score, score * 0.05 * specific_risk AS alpha FROM zs
UNION ALL
SELECT date, barrid, signal_name, signal_value, score,
       CASE WHEN score = 2.0 AND volume_score >= 2.0 THEN 0.0 ELSE score * 0.05 * specific_risk END AS alpha FROM wz"""


def sig_sql(body: str, upto: str = "long") -> str:
    chain = [("uni", UNI), ("ewm_in", EWM_IN), ("ewm5", EWM5), ("stage1", STAGE1), ("wide", WIDE),
             ("long", LONG), ("zs", ZS), ("wz1", WZ1), ("wz", WZ), ("alphas", ALPHAS)]
    names = [n for n, _ in chain]
    extra = chain[: names.index(upto) + 1]
    return with_ctes(body, "assets", extra=extra)


def _assets(spark, sf_dir) -> DataFrame:
    return build_assets_from_fixtures(spark, sf_dir)


def _signals_all(spark, sf_dir):
    from panelforge.plans.combination import checkpoint

    return S.compute_signals(_assets(spark, sf_dir), materialize=checkpoint)


# ---------------------------------------------------------------- F1 assets
@query("assets_panel", with_ctes("SELECT * FROM assets", "assets"))
def q_assets_panel(spark, sf_dir):
    # base values come from exact decimal sums: no rounding needed
    return _assets(spark, sf_dir)


# ---------------------------------------------------------------- H1-H6
def _one_signal(name: str):
    def build(spark, sf_dir):
        reg = {name: S.SIGNALS[name]}
        inp = S.signal_input(_assets(spark, sf_dir))
        long = S.signals_long(S.signal_columns(inp, [name], reg), [name])
        return long.select("date", "barrid", "signal_name", rnd("signal_value").alias("signal_value"))

    return build


for _n in ["momentum", "reversal", "beta", "barra_reversal", "barra_momentum", "ivol"]:
    query(f"sig_{_n}", sig_sql(
        f"SELECT date, barrid, signal_name, {R('signal_value')} AS signal_value FROM long "
        f"WHERE signal_name = '{_n}'"))(_one_signal(_n))


# ---------------------------------------------------------------- H7-H10 on single signals
def _scored(spark, sf_dir, scorer):
    """All signals with this scorer, scored in one pass over the stored long table."""
    from panelforge.plans.combination import checkpoint

    names = [n for n, spec in S.SIGNALS.items() if spec.scorer is scorer]
    inp = S.signal_input(_assets(spark, sf_dir))
    return scorer(checkpoint(S.signals_long(S.signal_columns(inp, names), names)))


@query("zscore", sig_sql(f"SELECT date, barrid, signal_name, {R('score')} AS score FROM zs", "zs"))
def q_zscore(spark, sf_dir):
    return _scored(spark, sf_dir, S.zscore).select("date", "barrid", "signal_name", rnd("score").alias("score"))


@query("alpha_ic", sig_sql(f"SELECT date, barrid, signal_name, {R('score * 0.05 * specific_risk')} AS alpha "
                           "FROM zs", "zs"))
def q_alpha_ic(spark, sf_dir):
    a = S.alpha_ic(_scored(spark, sf_dir, S.zscore))
    return a.select("date", "barrid", "signal_name", rnd("alpha").alias("alpha"))


@query("win_zscore", sig_sql(f"SELECT date, barrid, signal_name, {R('score')} AS score, "
                             f"{R('volume_score')} AS volume_score FROM wz", "wz"))
def q_win_zscore(spark, sf_dir):
    w = _scored(spark, sf_dir, S.win_zscore)
    return w.select("date", "barrid", "signal_name", rnd("score").alias("score"),
                    rnd("volume_score").alias("volume_score"))


@query("alpha_gated", sig_sql(
    "SELECT date, barrid, signal_name, "
    + R("CASE WHEN score = 2.0 AND volume_score >= 2.0 THEN 0.0 ELSE score * 0.05 * specific_risk END")
    + " AS alpha FROM wz", "wz"))
def q_alpha_gated(spark, sf_dir):
    a = S.alpha_gated(_scored(spark, sf_dir, S.win_zscore))
    return a.select("date", "barrid", "signal_name", rnd("alpha").alias("alpha"))


# ---------------------------------------------------------------- H12
@query("signals_long", sig_sql(f"SELECT date, barrid, signal_name, {R('signal_value')} AS signal_value FROM long"))
def q_signals_long(spark, sf_dir):
    sig, _, _ = _signals_all(spark, sf_dir)
    return sig.withColumn("signal_value", rnd("signal_value"))


@query("scores_long", sig_sql(f"SELECT date, barrid, signal_name, {R('score')} AS score FROM alphas", "alphas"))
def q_scores_long(spark, sf_dir):
    _, sc, _ = _signals_all(spark, sf_dir)
    return sc.withColumn("score", rnd("score"))


@query("alphas_long", sig_sql(f"SELECT date, barrid, signal_name, {R('alpha')} AS alpha FROM alphas", "alphas"))
def q_alphas_long(spark, sf_dir):
    _, _, al = _signals_all(spark, sf_dir)
    return al.withColumn("alpha", rnd("alpha"))


# ================================================================ combination chain
from panelforge.operators import portfolio as P  # noqa: E402
from panelforge.operators import weights as Wt  # noqa: E402
from panelforge.plans.combination import Chain, checkpoint  # noqa: E402

_ALL = ["momentum", "reversal", "beta", "barra_reversal", "barra_momentum", "ivol"]
_NAMES_SQL = ", ".join(f"('{n}')" for n in _ALL)
_mu0 = 0.5 * (1e-5 ** 0.5) / (252 ** 0.5)
_PRIOR = 1260 * _mu0 / 1e-5
_Q252 = 1.0 - 2.0 / 253.0

CHAIN_SQL = [
    ("base", """SELECT date, barrid, predicted_beta, specific_risk / 100 AS specific_risk, market_cap,
       market_cap / nullif(sum(market_cap) OVER (PARTITION BY date), 0) AS benchmark_weight
FROM assets WHERE in_universe"""),
    ("names", f"SELECT * FROM (VALUES {_NAMES_SQL}) t(signal_name)"),
    ("opt", """SELECT b.date, b.barrid, b.predicted_beta, b.specific_risk, b.benchmark_weight, n.signal_name,
       coalesce(a.alpha, 0.0) AS alpha
FROM base b CROSS JOIN names n
LEFT JOIN alphas a ON a.date = b.date AND a.barrid = b.barrid AND a.signal_name = n.signal_name"""),
    ("aw2", """SELECT *, sum(iv) OVER g AS s11, sum(alpha * iv) OVER g AS s1a, sum(predicted_beta * iv) OVER g AS s1b,
       sum(predicted_beta * predicted_beta * iv) OVER g AS sbb, sum(predicted_beta * alpha * iv) OVER g AS sba
FROM (SELECT *, 1.0 / (specific_risk * specific_risk) AS iv FROM opt) x
WINDOW g AS (PARTITION BY signal_name, date)"""),
    ("aw3", """SELECT *, CASE WHEN signal_name = 'beta' THEN (alpha - s1a / nullif(s11, 0)) * iv
       ELSE (alpha - (sbb * s1a - s1b * sba) / nullif(s11 * sbb - s1b * s1b, 0)
             - (s11 * sba - s1b * s1a) / nullif(s11 * sbb - s1b * s1b, 0) * predicted_beta) * iv END AS raw
FROM aw2"""),
    ("aw", """SELECT date, barrid, signal_name,
       CASE WHEN count(*) OVER (PARTITION BY signal_name, date) > (CASE WHEN signal_name = 'beta' THEN 1 ELSE 2 END)
       THEN raw * (0.05 / nullif(sqrt(sum(raw * raw * specific_risk * specific_risk) OVER (PARTITION BY signal_name, date)), 0))
       ELSE 0.0 END AS weight
FROM aw3"""),
    ("sr", """SELECT w.signal_name, w.date, coalesce(sum(r.ret * w.lw), 0.0) AS forward_return
FROM (SELECT *, lag(weight) OVER (PARTITION BY signal_name, barrid ORDER BY date) AS lw FROM aw) w
LEFT JOIN (SELECT date, barrid, "return" / 100 AS ret FROM assets) r ON w.date = r.date AND w.barrid = r.barrid
GROUP BY w.signal_name, w.date"""),
    ("sw_wide", """SELECT date, max(CASE WHEN signal_name = 'beta' THEN forward_return END) AS x1,
       max(CASE WHEN signal_name = 'barra_reversal' THEN forward_return END) AS x2,
       max(CASE WHEN signal_name = 'ivol' THEN forward_return END) AS x3
FROM sr WHERE signal_name IN ('beta', 'barra_reversal', 'ivol') GROUP BY date"""),
    ("sw_mom", """SELECT * FROM (
  SELECT date, row_number() OVER (ORDER BY date) - 1 AS rn,
       avg(x1) OVER p AS m1, avg(x2) OVER p AS m2, avg(x3) OVER p AS m3,
       covar_samp(x1, x1) OVER p AS a, covar_samp(x1, x2) OVER p AS b, covar_samp(x1, x3) OVER p AS c,
       covar_samp(x2, x2) OVER p AS d, covar_samp(x2, x3) OVER p AS e, covar_samp(x3, x3) OVER p AS f,
       count(x1) OVER p AS n1, count(x2) OVER p AS n2, count(x3) OVER p AS n3,
       sum(CASE WHEN x1 IS NULL OR x2 IS NULL OR x3 IS NULL THEN 1 ELSE 0 END) OVER p AS nbad
  FROM sw_wide WINDOW p AS (ORDER BY date ROWS BETWEEN 1260 PRECEDING AND 1 PRECEDING)) t
WHERE rn >= 1260"""),
    ("sw_adj", """SELECT date, m1, m2, m3,
       d * f - e * e AS A11, c * e - b * f AS A12, b * e - c * d AS A13,
       a * f - c * c AS A22, b * c - a * e AS A23, a * d - b * b AS A33, a, b, c,
       (n1 = 1260 AND n2 = 1260 AND n3 = 1260 AND nbad = 0) AS ok
FROM sw_mom"""),
    ("sw_raw", f"""SELECT date,
       CASE WHEN ok THEN {_PRIOR!r} + 1260 * (A11 * m1 + A12 * m2 + A13 * m3) / nullif(a * A11 + b * A12 + c * A13, 0) END AS r1,
       CASE WHEN ok THEN {_PRIOR!r} + 1260 * (A12 * m1 + A22 * m2 + A23 * m3) / nullif(a * A11 + b * A12 + c * A13, 0) END AS r2,
       CASE WHEN ok THEN {_PRIOR!r} + 1260 * (A13 * m1 + A23 * m2 + A33 * m3) / nullif(a * A11 + b * A12 + c * A13, 0) END AS r3
FROM sw_adj"""),
    ("sw_norm", """SELECT *, r1 / nullif(abs(r1) + abs(r2) + abs(r3), 0) AS n1,
       r2 / nullif(abs(r1) + abs(r2) + abs(r3), 0) AS n2, r3 / nullif(abs(r1) + abs(r2) + abs(r3), 0) AS n3
FROM sw_raw"""),
    ("sw_tab", """SELECT date, r1, r2, r3, n1, n2, n3,
       exp(n1 - greatest(n1, n2, n3)) / (exp(n1 - greatest(n1, n2, n3)) + exp(n2 - greatest(n1, n2, n3)) + exp(n3 - greatest(n1, n2, n3))) AS s1,
       exp(n2 - greatest(n1, n2, n3)) / (exp(n1 - greatest(n1, n2, n3)) + exp(n2 - greatest(n1, n2, n3)) + exp(n3 - greatest(n1, n2, n3))) AS s2,
       exp(n3 - greatest(n1, n2, n3)) / (exp(n1 - greatest(n1, n2, n3)) + exp(n2 - greatest(n1, n2, n3)) + exp(n3 - greatest(n1, n2, n3))) AS s3
FROM sw_norm"""),
    ("sw_long", """SELECT date, 'beta' AS signal_name, s1 AS w FROM sw_tab
UNION ALL SELECT date, 'barra_reversal', s2 FROM sw_tab
UNION ALL SELECT date, 'ivol', s3 FROM sw_tab"""),
    ("sw_rn", """SELECT *, row_number() OVER (PARTITION BY signal_name ORDER BY date) AS rn,
       count(w) OVER (PARTITION BY signal_name ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM sw_long"""),
    ("sw", f"""SELECT a.date, a.signal_name,
       CASE WHEN a.w IS NOT NULL AND a.cnt >= 1 THEN
         sum(b.w * power(CAST({_Q252!r} AS DOUBLE), a.rn - b.rn))
         / sum(CASE WHEN b.w IS NOT NULL THEN power(CAST({_Q252!r} AS DOUBLE), a.rn - b.rn) END) END AS weight
FROM sw_rn a JOIN sw_rn b ON a.signal_name = b.signal_name AND b.rn <= a.rn
GROUP BY a.date, a.signal_name, a.w, a.cnt"""),
    ("comp", """SELECT a.date, a.barrid, coalesce(sum(a.alpha * w.weight), 0.0) AS alpha
FROM alphas a JOIN sw w ON a.date = w.date AND a.signal_name = w.signal_name
WHERE a.signal_name IN ('beta', 'barra_reversal', 'ivol') AND w.weight IS NOT NULL AND NOT isnan(w.weight)
GROUP BY a.date, a.barrid"""),
    ("copt", """SELECT b.date, b.barrid, b.predicted_beta, b.specific_risk, b.benchmark_weight,
       coalesce(c.alpha, 0.0) AS alpha
FROM base b LEFT JOIN comp c ON b.date = c.date AND b.barrid = c.barrid"""),
    ("cw2", """SELECT *, sum(iv) OVER g AS s11, sum(alpha * iv) OVER g AS s1a, sum(predicted_beta * iv) OVER g AS s1b,
       sum(predicted_beta * predicted_beta * iv) OVER g AS sbb, sum(predicted_beta * alpha * iv) OVER g AS sba
FROM (SELECT *, 1.0 / (specific_risk * specific_risk) AS iv FROM copt) x WINDOW g AS (PARTITION BY date)"""),
    ("cw3", """SELECT *, (alpha - (sbb * s1a - s1b * sba) / nullif(s11 * sbb - s1b * s1b, 0)
             - (s11 * sba - s1b * s1a) / nullif(s11 * sbb - s1b * s1b, 0) * predicted_beta) * iv AS raw FROM cw2"""),
    ("cw", """SELECT date, barrid,
       CASE WHEN count(*) OVER (PARTITION BY date) > 2
       THEN raw * (0.05 / nullif(sqrt(sum(raw * raw * specific_risk * specific_risk) OVER (PARTITION BY date)), 0))
       ELSE 0.0 END AS weight
FROM cw3"""),
    ("fwd", """SELECT date, barrid, market_cap,
       lead("return" / 100, 1) OVER (PARTITION BY barrid ORDER BY date) AS ret FROM assets WHERE in_universe"""),
    ("port", """SELECT w.date, coalesce(sum(f.ret * w.weight), 0.0) AS "return", 'Portfolio' AS portfolio
FROM cw w LEFT JOIN fwd f ON w.date = f.date AND w.barrid = f.barrid GROUP BY w.date"""),
    ("bench", """SELECT date, coalesce(sum(ret * bw), 0.0) AS "return", 'Benchmark' AS portfolio FROM (
  SELECT *, market_cap / nullif(sum(market_cap) OVER (PARTITION BY date), 0) AS bw FROM fwd) x GROUP BY date"""),
]


def chain_sql(body: str, upto: str) -> str:
    names = [n for n, _ in CHAIN_SQL]
    return sig_sql(_CHAIN_MARK + body, "alphas").replace(
        "\n" + _CHAIN_MARK, ",\n" + ",\n".join(f"{n} AS ({s})" for n, s in CHAIN_SQL[: names.index(upto) + 1]) + "\n")


_CHAIN_MARK = "/*chain*/"


_CHAIN_COLUMNS = ["date", "barrid", "price", "market_cap", "return", "specific_return", "specific_risk", "predicted_beta",
                  "daily_volume", "in_universe"]


def _chain(spark, sf_dir) -> Chain:
    """The chain over the columns of the panel that it reads."""
    assets = checkpoint(_assets(spark, sf_dir).select(*_CHAIN_COLUMNS))
    _, _, alphas = S.compute_signals(assets, materialize=checkpoint, store_scored=False)
    return Chain(assets, alphas)


@query("benchmark_weights", with_ctes(
    f"SELECT date, barrid, {R('market_cap / nullif(sum(market_cap) OVER (PARTITION BY date), 0)')} AS benchmark_weight "
    "FROM assets WHERE in_universe", "assets"))
def q_benchmark_weights(spark, sf_dir):
    a = _assets(spark, sf_dir).filter(F.col("in_universe"))
    return P.benchmark_weights(a).select("date", "barrid", rnd("benchmark_weight").alias("benchmark_weight"))


@query("optimizer_panel", chain_sql(
    f"SELECT date, barrid, signal_name, {R('predicted_beta')} AS predicted_beta, {R('specific_risk')} AS specific_risk, "
    f"{R('benchmark_weight')} AS benchmark_weight, {R('alpha')} AS alpha FROM opt", "opt"))
def q_optimizer_panel(spark, sf_dir):
    c = _chain(spark, sf_dir)
    p = P.optimizer_panel(c.assets, c.alphas, signals=_ALL)
    return round_all(p.select("date", "barrid", "signal_name", "predicted_beta", "specific_risk",
                              "benchmark_weight", "alpha"))


@query("alpha_fill_panel", chain_sql(
    f"SELECT date, barrid, {R('alpha')} AS alpha, {R('benchmark_weight')} AS benchmark_weight FROM copt", "copt"))
def q_alpha_fill_panel(spark, sf_dir):
    c = _chain(spark, sf_dir)
    p = P.optimizer_panel(c.assets, c.composite())
    return round_all(p.select("date", "barrid", "alpha", "benchmark_weight"))


@query("active_weights", chain_sql(f"SELECT date, barrid, signal_name, {R('weight')} AS weight FROM aw", "aw"))
def q_active_weights(spark, sf_dir):
    return round_all(_chain(spark, sf_dir).active())


@query("signal_returns", chain_sql(
    f"SELECT date, signal_name, {R('forward_return')} AS forward_return FROM sr", "sr"))
def q_signal_returns(spark, sf_dir):
    return round_all(_chain(spark, sf_dir).signal_returns())


@query("rolling_covariance", chain_sql(
    "SELECT date, " + ", ".join(
        f"CASE WHEN n1 = 1260 AND n2 = 1260 AND n3 = 1260 AND nbad = 0 THEN {R(e, 40)} END AS {n}" for e, n in [
            ("m1", "m_beta"), ("m2", "m_barra_reversal"), ("m3", "m_ivol"),
            ("a", "c_beta__beta"), ("b", "c_beta__barra_reversal"), ("c", "c_beta__ivol"),
            ("d", "c_barra_reversal__barra_reversal"), ("e", "c_barra_reversal__ivol"), ("f", "c_ivol__ivol")])
    + " FROM sw_mom", "sw_mom"))
def q_rolling_covariance(spark, sf_dir):
    c = _chain(spark, sf_dir)
    names = Wt.WEIGHT_SIGNALS
    wide = Wt.pivot_wide(c.signal_returns().filter(F.col("signal_name").isin(names)), ["date"], "signal_name",
                         "forward_return", names)
    return round_all(Wt.rolling_moments(wide, names, Wt.N), bits=40)


# a spike, a NaN and a gap in two daily series, by rule from the panel
_SPIKY = """SELECT date, CASE WHEN month(date) = 5 AND day(date) = 13 AND year(date) = 1993 THEN 1e9 WHEN month(date) = 9 AND day(date) = 21 AND
       year(date) = 1994 THEN CAST('nan' AS DOUBLE) WHEN month(date) = 3 AND day(date) = 5 AND year(date) = 1996 THEN NULL ELSE avg("return") END AS a,
       avg(specific_return) AS b FROM panel GROUP BY date"""


@query("rolling_covariance_spike", with_ctes(
    "SELECT date, " + ", ".join(f"CASE WHEN nbad = 0 AND abs(m1) < 1e5 THEN {R(e)} END AS {n}" for e, n in
                                [("m1", "m_a"), ("m2", "m_b"), ("aa", "c_a__a"), ("ab", "c_a__b"), ("bb", "c_b__b")])
    + " FROM (SELECT date, row_number() OVER (ORDER BY date) AS rn, avg(a) OVER w AS m1, avg(b) OVER w AS m2, covar_samp(a, a) OVER w AS aa, "
    "covar_samp(a, b) OVER w AS ab, covar_samp(b, b) OVER w AS bb, sum(CASE WHEN a IS NULL OR isnan(a) OR b IS NULL THEN 1 ELSE 0 END) OVER w AS nbad "
    "FROM spiky WINDOW w AS (ORDER BY date ROWS BETWEEN 250 PRECEDING AND 1 PRECEDING)) t WHERE rn > 250", "panel", extra=[("spiky", _SPIKY)]))
def q_rolling_covariance_spike(spark, sf_dir):
    """Moments of 250 rows around a spike, a NaN and a gap, which leave no trace."""
    on = lambda y, m, d: F.col("date") == F.lit(f"{y}-{m:02}-{d:02}").cast("date")
    a = F.when(on(1993, 5, 13), 1e9).when(on(1994, 9, 21), float("nan")).when(on(1996, 3, 5), F.lit(None)).otherwise(F.col("a"))
    p = _panel(spark, sf_dir).groupBy("date").agg(F.avg("return").alias("a"), F.avg("specific_return").alias("b")).withColumn("a", a)
    m = Wt.rolling_moments(p, ["a", "b"], 250)
    calm = F.abs("m_a") < 1e5
    return m.select("date", *[rnd(F.when(calm, F.col(c))).alias(c) for c in m.columns[1:]])


@query("signal_weights_raw", chain_sql(
    f"SELECT date, {RR('r1')} AS w_raw_beta, {RR('r2')} AS w_raw_barra_reversal, {RR('r3')} AS w_raw_ivol, "
    f"{R('n1', 16)} AS w_norm_beta, {R('n2', 16)} AS w_norm_barra_reversal, {R('n3', 16)} AS w_norm_ivol, "
    f"{R('s1')} AS w_beta, {R('s2')} AS w_barra_reversal, {R('s3')} AS w_ivol FROM sw_tab", "sw_tab"))
def q_signal_weights_raw(spark, sf_dir):
    t = _chain(spark, sf_dir).weight_table()
    names = Wt.WEIGHT_SIGNALS
    return t.select("date", *[rnd_rel(f"w_raw_{a}").alias(f"w_raw_{a}") for a in names],
                    *[rnd(f"w_norm_{a}", 16).alias(f"w_norm_{a}") for a in names],
                    *[rnd(f"w_{a}").alias(f"w_{a}") for a in names])


@query("signal_weights", chain_sql(f"SELECT date, signal_name, {R('weight')} AS weight FROM sw", "sw"))
def q_signal_weights(spark, sf_dir):
    return round_all(_chain(spark, sf_dir).signal_weights())


@query("composite_alpha", chain_sql(f"SELECT date, barrid, {R('alpha')} AS alpha FROM comp", "comp"))
def q_composite_alpha(spark, sf_dir):
    return round_all(_chain(spark, sf_dir).composite())


@query("composite_weights", chain_sql(f"SELECT date, barrid, {R('weight')} AS weight FROM cw", "cw"))
def q_composite_weights(spark, sf_dir):
    return round_all(_chain(spark, sf_dir).composite_weights())


@query("portfolio_returns", chain_sql(f'SELECT date, portfolio, {R(chr(34) + "return" + chr(34))} AS "return" FROM port', "port"))
def q_portfolio_returns(spark, sf_dir):
    port, _ = _chain(spark, sf_dir).returns()
    return round_all(port)


@query("benchmark_returns", chain_sql(
    f'SELECT date, portfolio, {R(chr(34) + "return" + chr(34))} AS "return", '
    f'{R("100 * sum(CASE WHEN " + chr(34) + "return" + chr(34) + " > -1 THEN ln(1 + " + chr(34) + "return" + chr(34) + ") END) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")} AS cumulative_return FROM bench',
    "bench"))
def q_benchmark_returns(spark, sf_dir):
    _, bench = _chain(spark, sf_dir).returns()
    return round_all(P.cumulative_log_return(bench))


@query("cumulative_log_return", chain_sql(
    f'SELECT date, portfolio, {R("100 * sum(CASE WHEN " + chr(34) + "return" + chr(34) + " > -1 THEN ln(1 + " + chr(34) + "return" + chr(34) + ") END) OVER (PARTITION BY portfolio ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")} AS cumulative_return '
    "FROM (SELECT * FROM port UNION ALL SELECT * FROM bench) u", "bench"))
def q_cumulative_log_return(spark, sf_dir):
    port, bench = _chain(spark, sf_dir).returns()
    return round_all(P.cumulative_log_return(port.unionByName(bench)).select("date", "portfolio", "cumulative_return"))


@query("active_returns", chain_sql(
    'SELECT p.date, ' + R('p."return" - b."return"') + ' AS "return", ' + "'Active' AS portfolio "
    "FROM port p JOIN bench b ON p.date = b.date", "bench"))
def q_active_returns(spark, sf_dir):
    port, bench = _chain(spark, sf_dir).returns()
    return round_all(P.active_returns(port, bench))


@query("performance_summary", chain_sql(
    "SELECT portfolio, " + RR('avg("return") * 25200') + " AS mean_return, "
    + RR(f'stddev_samp("return") * {252 ** 0.5 * 100!r}') + " AS volatility, "
    + RR(f'avg("return") * 25200 / nullif(stddev_samp("return") * {252 ** 0.5 * 100!r}, 0)') + " AS sharpe "
    "FROM (SELECT * FROM port UNION ALL SELECT * FROM bench) u GROUP BY portfolio", "bench"))
def q_performance_summary(spark, sf_dir):
    port, bench = _chain(spark, sf_dir).returns()
    out = P.performance_summary(port.unionByName(bench))
    return out.select("portfolio", *[rnd_rel(c).alias(c) for c in ("mean_return", "volatility", "sharpe")])


# ================================================================ windows, joins, reshape, quality
from panelforge.functions import Rolled, ewm_mean, forward_fill, lag, lead, rolling, rolling_columns, rolling_std, rolling_sum  # noqa: E402
from panelforge.operators import cleaning as C  # noqa: E402
from panelforge.operators import joins as J  # noqa: E402
from panelforge.operators import quality as Q  # noqa: E402
from panelforge.operators import reshape as RS  # noqa: E402
from panelforge.sources import vendor as V  # noqa: E402

# factor names of the fixture (rule: F_ + return flag x line status)
FIXTURE_FACTORS = [f"F_{a}{b}" for a in "ANR" for b in "FO"]
FIXTURE_LINES = [f"F_L{i}" for i in range(1, 8)]


def _panel(spark, sf_dir):
    return fx.panel(spark, sf_dir)


W_ASSET = "WINDOW w AS (PARTITION BY barrid ORDER BY date)"


@query("rolling_sum", with_ctes(
    "SELECT date, barrid, " + R('CASE WHEN count("return") OVER w22 = 22 THEN sum("return") OVER w22 END') +
    " AS rolling_sum FROM panel WINDOW w22 AS (PARTITION BY barrid ORDER BY date ROWS BETWEEN 21 PRECEDING AND CURRENT ROW)",
    "panel"))
def q_rolling_sum(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return p.select("date", "barrid", rnd(rolling_sum("return", 22)).alias("rolling_sum"))


# stretches of equal values, gaps and a far outlier, by rule from the panel
_ROUGH = """SELECT date, barrid, CASE WHEN month(date) IN (3, 4, 5, 6) THEN 1.5 WHEN day(date) = 17 THEN NULL
       WHEN day(date) = 11 AND month(date) = 1 THEN 1e12 ELSE "return" END AS x FROM panel"""


def _rough(p):
    month, day = F.month("date"), F.dayofmonth("date")
    x = F.when(month.between(3, 6), 1.5).when(day == 17, F.lit(None)).when((day == 11) & (month == 1), 1e12).otherwise(F.col("return"))
    return p.select("date", "barrid", x.alias("x"))


@query("rolling_sum_long", with_ctes(
    "SELECT date, barrid, " + R("CASE WHEN count(x) OVER w >= 200 AND max(x) OVER w < 1e9 THEN sum(x) OVER w END") + " AS rolling_sum "
    "FROM rough WINDOW w AS (PARTITION BY barrid ORDER BY date ROWS BETWEEN 229 PRECEDING AND CURRENT ROW)",
    "panel", extra=[("rough", _ROUGH)]))
def q_rolling_sum_long(spark, sf_dir):
    """230 rows over gaps and outliers: an outlier leaves no trace once it is out of the window."""
    r = rolling_columns(_rough(_panel(spark, sf_dir)), 230, {"s": Rolled("sum", "x", 200), "big": Rolled("max", "x", 1)})
    return r.select("date", "barrid", rnd(F.when(F.col("big") < 1e9, F.col("s"))).alias("rolling_sum"))


@query("rolling_all_long", with_ctes(
    "SELECT date, barrid, CASE WHEN n >= 40 THEN lo END AS lo, CASE WHEN n >= 40 THEN hi END AS hi, CASE WHEN n >= 40 THEN n END AS n, "
    + R("CASE WHEN n >= 40 AND hi < 1e9 THEN m END") + " AS mean, CASE WHEN n >= 40 AND hi < 1e9 THEN CASE WHEN lo = hi THEN 0.0 ELSE "
    + R("d") + " END END AS std FROM (SELECT date, barrid, min(x) OVER w AS lo, max(x) OVER w AS hi, count(x) OVER w AS n, avg(x) OVER w AS m, "
    "stddev_samp(x) OVER w AS d FROM rough WINDOW w AS (PARTITION BY barrid ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)) t",
    "panel", extra=[("rough", _ROUGH)]))
def q_rolling_all_long(spark, sf_dir):
    """Every aggregate of 60 rows in one pass, over flat stretches, gaps and outliers."""
    wanted = {"lo": "min", "hi": "max", "n": "count", "m": "mean", "d": "std"}
    r = rolling_columns(_rough(_panel(spark, sf_dir)), 60, {c: Rolled(a, "x", 40) for c, a in wanted.items()})
    calm = lambda c: F.when(F.col("hi") < 1e9, F.col(c))
    return r.select("date", "barrid", "lo", "hi", "n", rnd(calm("m")).alias("mean"), rnd(calm("d")).alias("std"))


@query("rolling_std_flat", with_ctes(
    "SELECT date, barrid, CASE WHEN count(x) OVER w = 5 AND max(x) OVER w < 1e9 THEN "
    "CASE WHEN min(x) OVER w = max(x) OVER w THEN 0.0 ELSE " + R("stddev_samp(x) OVER w") + " END END AS std_5, "
    "CASE WHEN count(x) OVER w = 5 AND min(x) OVER w = max(x) OVER w THEN 1 ELSE 0 END AS flat "
    "FROM rough WINDOW w AS (PARTITION BY barrid ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)",
    "panel", extra=[("rough", _ROUGH)]))
def q_rolling_std_flat(spark, sf_dir):
    """The deviation of a flat window is exactly 0, also right after an outlier."""
    r = _rough(_panel(spark, sf_dir))
    sd = rolling_std("x", 5)
    big = rolling("max", "x", 5, min_samples=1) < 1e9
    return r.select("date", "barrid", rnd(F.when(big, sd)).alias("std_5"), F.when(sd == 0, 1).otherwise(0).alias("flat"))


@query("rolling_mean_std", with_ctes(
    "SELECT date, barrid, "
    + R("CASE WHEN count(daily_volume) OVER w252 >= 1 THEN avg(daily_volume) OVER w252 END") + " AS mean_252, "
    + R("CASE WHEN count(daily_volume) OVER w252 >= 2 THEN stddev_samp(daily_volume) OVER w252 END") + " AS std_252, "
    + R('CASE WHEN count("return") OVER w230 = 230 THEN stddev_samp("return") OVER w230 END') + " AS std_230 "
    "FROM panel WINDOW w252 AS (PARTITION BY barrid ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW), "
    "w230 AS (PARTITION BY barrid ORDER BY date ROWS BETWEEN 229 PRECEDING AND CURRENT ROW)", "panel"))
def q_rolling_mean_std(spark, sf_dir):
    p = _panel(spark, sf_dir)
    r = rolling_columns(p.select("date", "barrid", "daily_volume", "return"), 252,
                        {"mean_252": Rolled("mean", "daily_volume", 1), "std_252": Rolled("std", "daily_volume", 2)})
    r = rolling_columns(r, 230, {"std_230": Rolled("std", "return")})
    return r.select("date", "barrid", *[rnd(c).alias(c) for c in ("mean_252", "std_252", "std_230")])


@query("lag_lead", with_ctes(
    'SELECT date, barrid, lag("return", 1) OVER w AS lag_1, lag("return", 21) OVER w AS lag_21, '
    'lead("return", 1) OVER w AS lead_1 FROM panel ' + W_ASSET, "panel"))
def q_lag_lead(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return p.select("date", "barrid", lag("return", 1).alias("lag_1"), lag("return", 21).alias("lag_21"),
                    lead("return", 1).alias("lead_1"))


@query("forward_fill", with_ctes(
    "SELECT date, barrid, last_value(CASE WHEN day(date) <= 3 THEN specific_risk END IGNORE NULLS) OVER "
    "(PARTITION BY barrid ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM panel", "panel"))
def q_forward_fill(spark, sf_dir):
    p = _panel(spark, sf_dir).withColumn("x", F.when(F.dayofmonth("date") <= 3, F.col("specific_risk")))
    return p.select("date", "barrid", forward_fill("x").alias("filled"))


def _ewm_sql(span: int, min_samples: int, out: str) -> str:
    q = 1.0 - 2.0 / (span + 1.0)
    body = f"""SELECT a.date, a.barrid, {R(f'''CASE WHEN a.x IS NOT NULL AND a.cnt >= {min_samples} THEN
  sum(b.x * power(CAST({q!r} AS DOUBLE), a.rn - b.rn))
  / sum(CASE WHEN b.x IS NOT NULL THEN power(CAST({q!r} AS DOUBLE), a.rn - b.rn) END) END''')} AS {out}
FROM e a JOIN e b ON a.barrid = b.barrid AND b.rn <= a.rn GROUP BY a.date, a.barrid, a.x, a.cnt"""
    e = """SELECT date, barrid, x, row_number() OVER (PARTITION BY barrid ORDER BY date) AS rn,
  count(x) OVER (PARTITION BY barrid ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM (SELECT date, barrid, CASE WHEN in_universe THEN specific_return END AS x FROM assets) s"""
    return with_ctes(body, "assets", extra=[("e", e)])


def _ewm_query(span: int, min_samples: int, out: str):
    def build(spark, sf_dir):
        a = _assets(spark, sf_dir).select(
            "date", "barrid", F.when(F.col("in_universe"), F.col("specific_return")).alias("x"))
        return ewm_mean(a, "x", span, min_samples=min_samples, out=out).select("date", "barrid", rnd(out).alias(out))
    return build


query("ewm_mean_short", _ewm_sql(5, 5, "ewm"))(_ewm_query(5, 5, "ewm"))
query("ewm_mean_long", _ewm_sql(252, 1, "ewm"))(_ewm_query(252, 1, "ewm"))


_LOCAL = "SELECT barrid, asset_id, start_date, end_date FROM ids WHERE asset_id_type = 'LOCALID'"


def _local_ids(p):
    return fx.barra_ids(p).filter(F.col("asset_id_type") == "LOCALID").select("barrid", "asset_id", "start_date",
                                                                               "end_date")


def _asof_query(strategy: str, valid_until: str | None = None):
    def build(spark, sf_dir):
        p = _panel(spark, sf_dir)
        return J.asof_join(p.select("date", "barrid"), _local_ids(p), "date", "start_date", "barrid",
                           strategy=strategy, tie_break=("end_date",), valid_until=valid_until)
    return build


query("asof_backward", with_ctes(
    "SELECT p.date, p.barrid, l.asset_id, l.start_date, l.end_date FROM panel p "
    "ASOF LEFT JOIN local l ON p.barrid = l.barrid AND p.date >= l.start_date", "ids", extra=[("local", _LOCAL)]))(
    _asof_query("backward"))
query("asof_forward", with_ctes(
    "SELECT p.date, p.barrid, l.asset_id, l.start_date, l.end_date FROM panel p "
    "ASOF LEFT JOIN local l ON p.barrid = l.barrid AND p.date <= l.start_date", "ids", extra=[("local", _LOCAL)]))(
    _asof_query("forward"))
query("asof_nearest", with_ctes(
    """SELECT date, barrid,
  CASE WHEN fs IS NULL OR (bs IS NOT NULL AND date_diff('day', bs, date) <= date_diff('day', date, fs)) THEN ba ELSE fa END AS asset_id,
  CASE WHEN fs IS NULL OR (bs IS NOT NULL AND date_diff('day', bs, date) <= date_diff('day', date, fs)) THEN bs ELSE fs END AS start_date,
  CASE WHEN fs IS NULL OR (bs IS NOT NULL AND date_diff('day', bs, date) <= date_diff('day', date, fs)) THEN be ELSE fe END AS end_date
FROM (SELECT p.date, p.barrid, b.asset_id AS ba, b.start_date AS bs, b.end_date AS be,
             f.asset_id AS fa, f.start_date AS fs, f.end_date AS fe
      FROM panel p
      ASOF LEFT JOIN local b ON p.barrid = b.barrid AND p.date >= b.start_date
      ASOF LEFT JOIN local f ON p.barrid = f.barrid AND p.date <= f.start_date) x""",
    "ids", extra=[("local", _LOCAL)]))(_asof_query("nearest"))
query("asof_valid_until", with_ctes(
    "SELECT p.date, p.barrid, CASE WHEN l.end_date >= p.date THEN l.asset_id END AS asset_id, "
    "CASE WHEN l.end_date >= p.date THEN l.start_date END AS start_date, "
    "CASE WHEN l.end_date >= p.date THEN l.end_date END AS end_date FROM panel p "
    "ASOF LEFT JOIN local l ON p.barrid = l.barrid AND p.date >= l.start_date", "ids", extra=[("local", _LOCAL)]))(
    _asof_query("backward", "end_date"))


# both sides with rows without a key, the right side with several rows of one start date
_NULL_LEFT = "SELECT date, CASE WHEN day(date) <> 28 THEN barrid END AS barrid, price FROM panel"
_NULL_RIGHT = """SELECT barrid, asset_id, start_date, end_date FROM local
UNION ALL SELECT barrid, concat(asset_id, 'b'), start_date, CAST(end_date + INTERVAL 1 DAY AS DATE) FROM local
UNION ALL SELECT NULL, asset_id, start_date, end_date FROM local"""
_NULL_TIES = """SELECT barrid, start_date, max_by(asset_id, end_date) AS la, max(end_date) AS le,
       min_by(asset_id, end_date) AS fa, min(end_date) AS fe FROM nr WHERE barrid IS NOT NULL GROUP BY barrid, start_date"""


def _null_sides(p):
    left = p.select("date", F.when(F.dayofmonth("date") != 28, F.col("barrid")).alias("barrid"), "price")
    ids = _local_ids(p)
    right = ids.unionByName(ids.withColumn("asset_id", F.concat("asset_id", F.lit("b"))).withColumn("end_date", F.date_add("end_date", 1)))
    return left, right.unionByName(ids.withColumn("barrid", F.lit(None).cast("string")))


def _null_query(strategy: str, bucketed: bool = False):
    def build(spark, sf_dir):
        left, right = _null_sides(_panel(spark, sf_dir))
        if bucketed:
            return J.asof_join_bucketed(left, right, "date", "start_date", "barrid", F.year, strategy, ("end_date",))
        return J.asof_join(left, right, "date", "start_date", "barrid", strategy=strategy, tie_break=("end_date",))
    return build


_NULL_EXTRA = [("local", _LOCAL), ("nl", _NULL_LEFT), ("nr", _NULL_RIGHT), ("nt", _NULL_TIES)]
_NULL_BACK = with_ctes(
    "SELECT l.date, l.barrid, l.price, t.la AS asset_id, t.start_date, t.le AS end_date FROM nl l "
    "ASOF LEFT JOIN nt t ON l.barrid = t.barrid AND l.date >= t.start_date", "ids", extra=_NULL_EXTRA)
_BACK_NEARER = "(fs IS NULL OR (bs IS NOT NULL AND date_diff('day', bs, date) <= date_diff('day', date, fs)))"
_NULL_NEAR = with_ctes(
    f"""SELECT date, barrid, price, CASE WHEN {_BACK_NEARER} THEN ba ELSE fa END AS asset_id,
  CASE WHEN {_BACK_NEARER} THEN bs ELSE fs END AS start_date, CASE WHEN {_BACK_NEARER} THEN be ELSE fe END AS end_date
FROM (SELECT l.*, b.la AS ba, b.start_date AS bs, b.le AS be, f.fa, f.start_date AS fs, f.fe FROM nl l
      ASOF LEFT JOIN nt b ON l.barrid = b.barrid AND l.date >= b.start_date
      ASOF LEFT JOIN nt f ON l.barrid = f.barrid AND l.date <= f.start_date) x""", "ids", extra=_NULL_EXTRA)
query("asof_null_keys", _NULL_BACK)(_null_query("backward"))
query("asof_null_keys_nearest", _NULL_NEAR)(_null_query("nearest"))
query("asof_null_keys_bucketed", _NULL_BACK)(_null_query("backward", bucketed=True))
query("asof_null_keys_nearest_bucketed", _NULL_NEAR)(_null_query("nearest", bucketed=True))


@query("panel_left_chain", with_ctes(
    'SELECT r.date, r.barrid, r.price, r."return", s.specific_return, k.* EXCLUDE (date, barrid), '
    "v.* EXCLUDE (date, barrid), x.exposures AS exposure_f_af FROM panel r "
    "LEFT JOIN panel s ON r.date = s.date AND r.barrid = s.barrid "
    "LEFT JOIN risk k ON r.date = k.date AND r.barrid = k.barrid "
    "LEFT JOIN volume v ON r.date = v.date AND r.barrid = v.barrid "
    "LEFT JOIN (SELECT * FROM exposures_long WHERE factor = 'F_AF') x ON r.date = x.date AND r.barrid = x.barrid",
    "risk", "volume", "exposures_long"))
def q_panel_left_chain(spark, sf_dir):
    p = _panel(spark, sf_dir)
    x = fx.exposures_long(spark, sf_dir).filter(F.col("factor") == "F_AF").select(
        "date", "barrid", F.col("exposures").alias("exposure_f_af"))
    out = J.left_chain(p.select("date", "barrid", "price", "return"),
                       [fx.vendor_specific_returns(p), fx.vendor_risk(p), fx.vendor_volume(p), x])
    return out


@query("universe_forward_fill", with_ctes(
    "SELECT date, barrid, cusip, russell_1000, russell_2000, in_universe FROM assets", "assets"))
def q_universe_forward_fill(spark, sf_dir):
    return _assets(spark, sf_dir).select("date", "barrid", "cusip", "russell_1000", "russell_2000", "in_universe")


@query("id_type_split", with_ctes(
    "SELECT barrid, regexp_replace(asset_id, 'US', '') AS ticker, start_date, end_date FROM ids "
    "WHERE asset_id_type = 'LOCALID' AND starts_with(barrid, 'US') UNION ALL "
    "SELECT barrid, asset_id, start_date, end_date FROM ids WHERE asset_id_type = 'CUSIP' AND starts_with(barrid, 'US')",
    "ids"))
def q_id_type_split(spark, sf_dir):
    ids = fx.barra_ids(_panel(spark, sf_dir))
    t = C.split_ids(ids, "LOCALID", "ticker", strip_us=True)
    c = C.split_ids(ids, "CUSIP", "cusip").withColumnRenamed("cusip", "ticker")
    return t.unionByName(c)


@query("flag_decode", with_ctes(
    "SELECT date, cusip, russell1000 = 'Y' AS russell_1000, russell2000 = 'Y' AS russell_2000 FROM membership",
    "membership"))
def q_flag_decode(spark, sf_dir):
    m = fx.membership(_panel(spark, sf_dir))
    return C.decode_flags(m, {"russell1000": "russell_1000", "russell2000": "russell_2000"})


def _pivot_sql(index: str, on: str, value: str, names, src: str) -> str:
    cols = ", ".join(f"max(CASE WHEN {on} = '{n}' THEN {value} END) AS \"{n}\"" for n in names)
    return f"SELECT {index}, {cols} FROM {src} GROUP BY {index}"


@query("pivot_exposures", with_ctes(_pivot_sql("date, barrid", "factor", "exposures", FIXTURE_FACTORS,
                                               "exposures_long"), "exposures_long"))
def q_pivot_exposures(spark, sf_dir):
    return RS.pivot_wide(fx.exposures_long(spark, sf_dir), ["date", "barrid"], "factor", "exposures", FIXTURE_FACTORS)


_COV_LONG = """SELECT CAST(l_shipdate AS DATE) AS date, concat('F_', l_returnflag, l_linestatus) AS factor_1,
       concat('F_L', CAST(l_linenumber AS VARCHAR)) AS factor_2,
       CAST(SUM(CAST(l_tax AS DECIMAL(12,2))) AS DOUBLE) AS covariance
FROM lineitem GROUP BY 1, 2, 3"""


def _cov_long(spark, sf_dir):
    li = fx.read_table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat(F.lit("F_"), "l_returnflag", "l_linestatus").alias("factor_1"),
        F.concat(F.lit("F_L"), F.col("l_linenumber").cast("string")).alias("factor_2"),
    ).agg(F.sum(F.col("l_tax").cast("decimal(12,2)")).cast("double").alias("covariance"))


@query("pivot_covariances", with_ctes(_pivot_sql("date, factor_1", "factor_2", "covariance", FIXTURE_LINES, "cl"),
                                      extra=[("cl", _COV_LONG)]))
def q_pivot_covariances(spark, sf_dir):
    return RS.pivot_wide(_cov_long(spark, sf_dir), ["date", "factor_1"], "factor_2", "covariance", FIXTURE_LINES)


_FACT = "SELECT date, factor, sum(exposures) AS value FROM exposures_long GROUP BY date, factor"


def _factor_long(spark, sf_dir):
    return fx.exposures_long(spark, sf_dir).groupBy("date", "factor").agg(F.sum("exposures").alias("value"))


@query("pivot_factors", with_ctes(
    "SELECT date, " + ", ".join(f"{R(chr(34) + n + chr(34))} AS \"{n}\"" for n in FIXTURE_FACTORS) + " FROM ("
    + _pivot_sql("date", "factor", "value", FIXTURE_FACTORS, "fl") + ") p", "exposures_long", extra=[("fl", _FACT)]))
def q_pivot_factors(spark, sf_dir):
    return round_all(RS.pivot_wide(_factor_long(spark, sf_dir), ["date"], "factor", "value", FIXTURE_FACTORS))


@query("unpivot_weights", with_ctes(
    f"SELECT date, regexp_replace(name, 'w_', '') AS factor, {R('value')} AS value FROM (UNPIVOT ("
    + _pivot_sql("date", "'w_' || factor", "value", [f"w_{n}" for n in FIXTURE_FACTORS], "fl")
    + ") ON " + ", ".join(f'"w_{n}"' for n in FIXTURE_FACTORS) + " INTO NAME name VALUE value) u",
    "exposures_long", extra=[("fl", _FACT)]))
def q_unpivot_weights(spark, sf_dir):
    names = [f"w_{n}" for n in FIXTURE_FACTORS]
    fl = _factor_long(spark, sf_dir).withColumn("factor", F.concat(F.lit("w_"), "factor"))
    wide = RS.pivot_wide(fl, ["date"], "factor", "value", names)
    long = RS.unpivot_long(wide, ["date"], names, "factor", "value", strip_prefix="w_")
    return long.filter(F.col("value").isNotNull()).withColumn("value", rnd("value"))


@query("distinct_dates", with_ctes("SELECT DISTINCT date FROM panel", "panel"))
def q_distinct_dates(spark, sf_dir):
    return _panel(spark, sf_dir).select("date").distinct()


@query("last_n_sessions", with_ctes(
    "SELECT date FROM sessions WHERE date < DATE '1999-06-15' ORDER BY date DESC LIMIT 60", "sessions"))
def q_last_n_sessions(spark, sf_dir):
    return C.last_n_sessions(fx.sessions(spark, sf_dir), "1999-06-15", 60)


@query("duplicate_keys", with_ctes(
    "SELECT date, barrid, count(*) AS n FROM exposures_long GROUP BY date, barrid HAVING count(*) > 1",
    "exposures_long"))
def q_duplicate_keys(spark, sf_dir):
    return Q.duplicate_keys(fx.exposures_long(spark, sf_dir), ["date", "barrid"])


@query("cast_drop_nan", with_ctes(
    "SELECT date, barrid, factor, TRY_CAST(CAST(exposures AS VARCHAR) AS DOUBLE) AS exposures FROM exposures_long "
    "WHERE NOT isnan(TRY_CAST(CAST(exposures AS VARCHAR) AS DOUBLE)) "
    "OR TRY_CAST(CAST(exposures AS VARCHAR) AS DOUBLE) IS NULL", "exposures_long"))
def q_cast_drop_nan(spark, sf_dir):
    x = fx.exposures_long(spark, sf_dir).withColumn("exposures", F.col("exposures").cast("string"))
    return C.cast_drop_nan(x, "exposures")


@query("parse_dates", "SELECT l_orderkey, l_linenumber, strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS raw, "
                      "CAST(l_shipdate AS DATE) AS date FROM lineitem")
def q_parse_dates(spark, sf_dir):
    li = fx.read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyyMMdd").alias("raw"))
    return C.parse_dates(li.withColumn("date", F.col("raw")), ["date"])


def raw_returns_frame(p: DataFrame) -> DataFrame:
    """The returns file as the vendor ships it: raw headers, text dates, one
    end-of-file trailer per yearly file."""
    rows = p.select(
        F.date_format("date", "yyyyMMdd").alias("DataDate"), F.col("barrid").alias("!Barrid"),
        F.col("price").alias("Price"), F.col("market_cap").alias("Capt"), F.lit("FIXTURE").alias("PriceSource"),
        F.lit("USD").alias("Currency"), F.col("return").alias("DlyReturn%"))
    trailers = p.select(F.year("date").alias("y")).distinct().select(
        F.lit(None).cast("string").alias("DataDate"), F.lit(C.TRAILER).alias("!Barrid"),
        F.lit(None).cast("double").alias("Price"), F.lit(None).cast("double").alias("Capt"),
        F.lit(None).cast("string").alias("PriceSource"), F.lit(None).cast("string").alias("Currency"),
        F.lit(None).cast("double").alias("DlyReturn%"))
    return rows.unionByName(trailers)


@query("clean_vendor", with_ctes(
    "SELECT barrid, price, market_cap, 'FIXTURE' AS price_source, 'USD' AS currency, \"return\", date FROM panel",
    "panel"))
def q_clean_vendor(spark, sf_dir):
    return V.RETURNS.clean(raw_returns_frame(_panel(spark, sf_dir)))


# ---------------------------------------------------------------- data quality over the signal tables
_SIG_TABLES = [("signals", "long"), ("scores", "alphas"), ("alphas", "alphas")]


@query("count_by_signal", sig_sql(
    """SELECT table_name, signal_name, n, min(n) OVER (PARTITION BY table_name) <> max(n) OVER (PARTITION BY table_name) AS unequal
FROM (SELECT 'signals' AS table_name, signal_name, count(*) AS n FROM long GROUP BY signal_name
      UNION ALL SELECT 'scores', signal_name, count(*) FROM alphas GROUP BY signal_name
      UNION ALL SELECT 'alphas', signal_name, count(*) FROM alphas GROUP BY signal_name) c""", "alphas"))
def q_count_by_signal(spark, sf_dir):
    sig, sc, al = _signals_all(spark, sf_dir)
    return Q.group_counts({"signals": sig, "scores": sc, "alphas": al}, "signal_name")


@query("signal_stats", sig_sql(
    "SELECT signal_name, count(*) AS count, count(*) - count(signal_value) AS nulls, "
    f"{R('min(signal_value)')} AS min, {R('max(signal_value)')} AS max, {R('avg(signal_value)')} AS mean, "
    f"{R('stddev_samp(signal_value)')} AS std FROM long GROUP BY signal_name"))
def q_signal_stats(spark, sf_dir):
    sig, _, _ = _signals_all(spark, sf_dir)
    return round_all(Q.column_stats(sig, "signal_value", ["signal_name"]))


@query("missing_signals", sig_sql(
    "SELECT coalesce(e.signal_name, p.signal_name) AS signal_name, CASE WHEN p.signal_name IS NULL THEN 'missing' "
    "WHEN e.signal_name IS NULL THEN 'extra' ELSE 'present' END AS status FROM (VALUES "
    + ", ".join(f"('{n}')" for n in _ALL) + ") e(signal_name) FULL OUTER JOIN (SELECT DISTINCT signal_name FROM long) p "
    "ON e.signal_name = p.signal_name"))
def q_missing_signals(spark, sf_dir):
    sig, _, _ = _signals_all(spark, sf_dir)
    return Q.completeness(sig, "signal_name", _ALL)


@query("union_signals", sig_sql(
    f"SELECT date, barrid, signal_name, {R('signal_value')} AS signal_value FROM long"))
def q_union_signals(spark, sf_dir):
    inp = checkpoint(S.signal_input(_assets(spark, sf_dir)))
    out = None
    for name in _ALL:
        one = S.signals_long(S.signal_columns(inp, [name]), [name]).select("date", "barrid", "signal_name",
                                                                         rnd("signal_value").alias("signal_value"))
        out = one if out is None else out.unionByName(one)
    return out


# ================================================================ table store
from pyspark.sql import types as T  # noqa: E402

from panelforge.session import shared_dir  # noqa: E402
from panelforge.sources import tables as TB  # noqa: E402

PANEL_SPEC = TB.TableSpec("panel", T.StructType([
    T.StructField("date", T.DateType()), T.StructField("barrid", T.StringType()),
    T.StructField("price", T.DoubleType()), T.StructField("market_cap", T.DoubleType()),
    T.StructField("return", T.DoubleType()), T.StructField("specific_return", T.DoubleType()),
    T.StructField("specific_risk", T.DoubleType()), T.StructField("predicted_beta", T.DoubleType()),
    T.StructField("daily_volume", T.DoubleType())]), ("date", "barrid"))


def _stored_panel(spark, sf_dir, name="panel", where=None):
    p = _panel(spark, sf_dir)
    t = TB.Table(spark, shared_dir(spark, name), PANEL_SPEC)
    t.overwrite(p if where is None else p.filter(where))
    return t, p


@query("scan_year", with_ctes("SELECT * FROM panel WHERE year(date) = 1997", "panel"))
def q_scan_year(spark, sf_dir):
    t, _ = _stored_panel(spark, sf_dir)
    return t.read(years=[1997])


@query("snapshot_overwrite", with_ctes("SELECT * FROM asset_ids", "asset_ids"))
def q_snapshot_overwrite(spark, sf_dir):
    ids = fx.asset_ids(spark, sf_dir)
    spec = TB.TableSpec("asset_ids", ids.schema, ("barrid", "start_date", "rootid", "end_date"), yearly=False)
    t = TB.Table(spark, shared_dir(spark, "ids"), spec)
    t.overwrite(ids)
    t.overwrite(ids)  # idempotent
    return t.read()


_UPSERT_NEW = """SELECT date, barrid, price * 2 AS price, market_cap, "return", specific_return,
       CAST(NULL AS DOUBLE) AS specific_risk, predicted_beta, daily_volume
FROM panel"""
# the store holds the calmer rows of all years; the whole panel comes in corrected
_UPSERT_OLD = "SELECT * FROM panel WHERE predicted_beta < 1.2"


def _upsert_rows(p):
    return p.withColumn("price", F.col("price") * 2).withColumn("specific_risk", F.lit(None).cast("double")) \
        .withColumn("junk", F.lit("dropped"))


_MERGE_SEL = """coalesce(o.date, n.date) AS date, coalesce(o.barrid, n.barrid) AS barrid,
       coalesce(n.price, o.price) AS price, coalesce(n.market_cap, o.market_cap) AS market_cap,
       coalesce(n."return", o."return") AS "return", coalesce(n.specific_return, o.specific_return) AS specific_return,
       coalesce(n.specific_risk, o.specific_risk) AS specific_risk, coalesce(n.predicted_beta, o.predicted_beta) AS predicted_beta,
       coalesce(n.daily_volume, o.daily_volume) AS daily_volume"""


@query("upsert_merge", with_ctes(
    f"SELECT {_MERGE_SEL} FROM old o FULL OUTER JOIN new n ON o.date = n.date AND o.barrid = n.barrid",
    "panel", extra=[("old", _UPSERT_OLD), ("new", _UPSERT_NEW)]))
def q_upsert_merge(spark, sf_dir):
    t, p = _stored_panel(spark, sf_dir, where=F.col("predicted_beta") < 1.2)
    new = _upsert_rows(_panel(spark, sf_dir))
    t.upsert(new)
    t.upsert(new)  # idempotent: a second upsert changes nothing
    return t.read()


@query("update_left", with_ctes(
    f"SELECT {_MERGE_SEL} FROM old o LEFT JOIN new n ON o.date = n.date AND o.barrid = n.barrid",
    "panel", extra=[("old", _UPSERT_OLD), ("new", _UPSERT_NEW)]))
def q_update_left(spark, sf_dir):
    t, p = _stored_panel(spark, sf_dir, where=F.col("predicted_beta") < 1.2)
    t.update(_upsert_rows(_panel(spark, sf_dir)))
    return t.read()


@query("update_custom_key", with_ctes(
    "SELECT o.date, o.barrid, o.price, o.market_cap, o.\"return\", o.specific_return, o.specific_risk, "
    "max(o.predicted_beta) OVER (PARTITION BY o.barrid) AS predicted_beta, o.daily_volume FROM panel o", "panel"))
def q_update_custom_key(spark, sf_dir):
    """B4 on the asset alone: one row without a date changes all years of its asset."""
    t, p = _stored_panel(spark, sf_dir)
    t.update(p.groupBy("barrid").agg(F.max("predicted_beta").alias("predicted_beta")), on=["barrid"])
    return t.read()


@query("create_partition", with_ctes("SELECT * FROM panel", "panel"))
def q_create_partition(spark, sf_dir):
    """B2: an empty typed year beside the stored ones; creating it again, or a
    year that is there, changes nothing."""
    t, _ = _stored_panel(spark, sf_dir)
    for year in (2030, 2030, 1996):
        t.create_partition(year)
    if not (t.exists(2030) and t.read(years=[2030]).schema == PANEL_SPEC.schema):
        raise AssertionError("the created year is missing or has no columns")
    return t.read()


@query("partition_delete", with_ctes("SELECT * FROM panel WHERE year(date) <> 1996", "panel"))
def q_partition_delete(spark, sf_dir):
    t, _ = _stored_panel(spark, sf_dir)
    t.delete(1996)
    return t.read()


@query("merge_schema_evolution", with_ctes(
    "SELECT o.date, o.barrid, coalesce(n.price, o.price) AS price, o.market_cap, o.\"return\", o.specific_return, "
    "o.specific_risk, o.predicted_beta, coalesce(n.daily_volume, o.daily_volume) AS daily_volume, "
    "n.volume_score FROM panel o LEFT JOIN (SELECT date, barrid, price * 2 AS price, daily_volume, "
    + R("ln(1 + daily_volume)") + " AS volume_score FROM panel WHERE year(date) = 1999) n "
    "ON o.date = n.date AND o.barrid = n.barrid", "panel"))
def q_merge_schema_evolution(spark, sf_dir):
    t, p = _stored_panel(spark, sf_dir)
    new = p.filter(F.year("date") == 1999).select(
        "date", "barrid", (F.col("price") * 2).alias("price"), "daily_volume",
        rnd(F.log1p("daily_volume")).alias("volume_score"))
    evolved = TB.merge_with_evolution(t, new, ["date", "barrid"], how="left")
    return evolved.read()


_UA_LEFT = "SELECT date, barrid, price, concat('OLD', barrid) AS asset_id FROM panel"


def _update_asof_query(strategy: str):
    def build(spark, sf_dir):
        p = _panel(spark, sf_dir)
        root = shared_dir(spark, "ua")
        left = p.select("date", "barrid", "price", F.concat(F.lit("OLD"), "barrid").alias("asset_id"))
        t = TB.replace(spark, root, "assets_ids", left)
        return t.store_asof(_local_ids(p), "date", "start_date", "barrid", strategy=strategy, tie_break=("end_date",)).read()
    return build


_UA_OUT = "l.barrid, l.date, coalesce({r}.asset_id, l.asset_id) AS asset_id, l.price, {r}.end_date"
query("update_asof_backward", with_ctes(
    "SELECT " + _UA_OUT.format(r="r") + " FROM lft l ASOF LEFT JOIN local r ON l.barrid = r.barrid AND l.date >= r.start_date",
    "ids", extra=[("local", _LOCAL), ("lft", _UA_LEFT)]))(_update_asof_query("backward"))
query("update_asof_forward", with_ctes(
    "SELECT " + _UA_OUT.format(r="r") + " FROM lft l ASOF LEFT JOIN local r ON l.barrid = r.barrid AND l.date <= r.start_date",
    "ids", extra=[("local", _LOCAL), ("lft", _UA_LEFT)]))(_update_asof_query("forward"))
query("update_asof_nearest", with_ctes(
    """SELECT barrid, date, coalesce(CASE WHEN pick_b THEN ba ELSE fa END, asset_id) AS asset_id, price,
       CASE WHEN pick_b THEN be ELSE fe END AS end_date
FROM (SELECT l.*, b.asset_id AS ba, b.end_date AS be, f.asset_id AS fa, f.end_date AS fe,
             (f.start_date IS NULL OR (b.start_date IS NOT NULL AND
              date_diff('day', b.start_date, l.date) <= date_diff('day', l.date, f.start_date))) AS pick_b
      FROM lft l
      ASOF LEFT JOIN local b ON l.barrid = b.barrid AND l.date >= b.start_date
      ASOF LEFT JOIN local f ON l.barrid = f.barrid AND l.date <= f.start_date) x""",
    "ids", extra=[("local", _LOCAL), ("lft", _UA_LEFT)]))(_update_asof_query("nearest"))


# ================================================================ sources, streaming, flows
from panelforge.plans import flows as FL  # noqa: E402
from panelforge.sources import archives as AR  # noqa: E402
from panelforge.sources import extracts as EX  # noqa: E402
from panelforge.sources.catalog import EXTRACTS  # noqa: E402
from panelforge.streaming.ingest import ingest_folder  # noqa: E402

RET_SPEC = AR.ArchiveSpec("RET_HIST", "RET_", "RET_DAILY", "RET", skip=1)
RAW_RET = ["!Barrid", "Price", "Capt", "PriceSource", "Currency", "DlyReturn%", "DataDate"]


def _raw_rows(p):
    return raw_returns_frame(p).filter(F.col("!Barrid") != C.TRAILER)


@query("src_archive_history", with_ctes(
    "SELECT barrid, price, market_cap, 'FIXTURE' AS price_source, 'USD' AS currency, \"return\", date FROM panel",
    "panel"))
def q_src_archive_history(spark, sf_dir):
    p = _panel(spark, sf_dir)
    root = shared_dir(spark, "archives")
    AR.write_archives(_raw_rows(p), root, F.date_format(F.to_date("DataDate", "yyyyMMdd"), "yyyy_MM"),
                      lambda k: f"RET_HIST_{k}.zip", lambda k: f"RET_{k}.txt", RAW_RET).count()
    return V.RETURNS.clean(AR.read_history(spark, root, RET_SPEC, RAW_RET))


def _daily_archives(spark, sf_dir):
    p = _panel(spark, sf_dir)
    root = shared_dir(spark, "daily")
    d = F.to_date("DataDate", "yyyyMMdd")
    AR.write_archives(_raw_rows(p), root, F.date_format(d, "yyyyMMdd"),
                      lambda k: f"RET_DAILY_{k[2:]}.zip", lambda k: f"RET.{k}", RAW_RET).count()
    # the look-back list: at most 60 dates reach the driver
    sessions = [r[0] for r in C.last_n_sessions(fx.sessions(spark, sf_dir), "1999-06-15", 60).collect()]
    return root, sessions


_LOOKBACK = "SELECT date FROM sessions WHERE date < DATE '1999-06-15' ORDER BY date DESC LIMIT 60"


@query("src_daily_lookback", with_ctes(
    "SELECT barrid, price, market_cap, 'FIXTURE' AS price_source, 'USD' AS currency, \"return\", date FROM panel "
    "WHERE date IN (SELECT date FROM lb)", "panel", "sessions", extra=[("lb", _LOOKBACK)]))
def q_src_daily_lookback(spark, sf_dir):
    root, sessions = _daily_archives(spark, sf_dir)
    return V.RETURNS.clean(AR.read_daily(spark, root, RET_SPEC, RAW_RET, sessions))


@query("src_latest_snapshot", with_ctes(
    "SELECT barrid, price, market_cap, 'FIXTURE' AS price_source, 'USD' AS currency, \"return\", date FROM panel "
    "WHERE date = (SELECT max(date) FROM lb)", "panel", "sessions", extra=[("lb", _LOOKBACK)]))
def q_src_latest_snapshot(spark, sf_dir):
    root, sessions = _daily_archives(spark, sf_dir)
    return V.RETURNS.clean(AR.read_daily(spark, root, RET_SPEC, RAW_RET, sessions, latest_only=True))


FF_SCHEMA = T.StructType([T.StructField(n, T.DoubleType() if n != "date" else T.DateType())
                          for n in ["date", "mkt_rf", "smb", "hml", "rmw", "cma", "rf"]])

_FF_DAILY = """SELECT CAST(l_shipdate AS DATE) AS date,
       SUM(CAST(l_discount AS DECIMAL(12,2))) - SUM(CAST(l_tax AS DECIMAL(12,2))) AS mkt_rf,
       SUM(CAST(l_discount AS DECIMAL(12,2))) AS smb, SUM(CAST(l_tax AS DECIMAL(12,2))) AS hml,
       CAST(COUNT(*) AS DECIMAL(12,2)) AS rmw, MAX(CAST(l_discount AS DECIMAL(12,2))) AS cma,
       MIN(CAST(l_tax AS DECIMAL(12,2))) AS rf
FROM lineitem GROUP BY 1"""


def _ff_text(spark, sf_dir):
    li = fx.read_table(spark, sf_dir, "lineitem")
    dec = lambda c: F.col(c).cast("decimal(12,2)")
    daily = li.groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(
        (F.sum(dec("l_discount")) - F.sum(dec("l_tax"))).alias("mkt_rf"), F.sum(dec("l_discount")).alias("smb"),
        F.sum(dec("l_tax")).alias("hml"), F.count(F.lit(1)).cast("decimal(12,2)").alias("rmw"),
        F.max(dec("l_discount")).alias("cma"), F.min(dec("l_tax")).alias("rf"))
    vals = ["mkt_rf", "smb", "hml", "rmw", "cma", "rf"]
    body = daily.select(F.lit(10).alias("sec"), F.date_format("date", "yyyyMMdd").alias("k"),
                        F.concat_ws(",", F.date_format("date", "yyyyMMdd"),
                                    *[F.concat(F.lit("  "), F.col(v).cast("string")) for v in vals]).alias("line"))
    annual = daily.groupBy(F.year("date").alias("y")).agg(*[F.sum(v).alias(v) for v in vals]).select(
        F.lit(30).alias("sec"), F.col("y").cast("string").alias("k"),
        F.concat_ws(",", F.col("y").cast("string"), *[F.col(v).cast("string") for v in vals]).alias("line"))
    spark_ = spark
    head = spark_.createDataFrame(
        [(0, "0", "This file was created from the fixture tables."), (1, "1", "Daily factors in percent."),
         (2, "2", ""), (5, "5", ",Mkt-RF,SMB,HML,RMW,CMA,RF"), (20, "20", ""),
         (21, "21", " Annual Factors: January-December "), (22, "22", ",Mkt-RF,SMB,HML,RMW,CMA,RF")],
        "sec int, k string, line string")
    text = head.unionByName(body).unionByName(annual)
    path = shared_dir(spark, "ff") + "/factors"
    # one text file: a single ordered task over one row per trading day
    text.repartition(1).sortWithinPartitions("sec", "k").select("line").write.mode("overwrite").text(path)
    return path


@query("src_sectioned_csv", with_ctes(
    "SELECT date, CAST(mkt_rf AS DOUBLE) / 100 AS mkt_rf, CAST(smb AS DOUBLE) / 100 AS smb, "
    "CAST(hml AS DOUBLE) / 100 AS hml, CAST(rmw AS DOUBLE) / 100 AS rmw, CAST(cma AS DOUBLE) / 100 AS cma, "
    "CAST(rf AS DOUBLE) / 100 AS rf FROM ffd", extra=[("ffd", _FF_DAILY)]))
def q_src_sectioned_csv(spark, sf_dir):
    return AR.read_sectioned_csv(spark, _ff_text(spark, sf_dir), FF_SCHEMA)


_EXTRACT_COLS = {"l_shipdate": "date", "l_suppkey": "permno", "l_orderkey": "order_id", "l_linenumber": "line",
                 "l_extendedprice": "prc", "l_quantity": "vol"}


@query("extract_range", "SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS permno, l_orderkey AS order_id, "
                        "l_linenumber AS line, l_extendedprice AS prc, l_quantity AS vol FROM lineitem "
                        "WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def q_extract_range(spark, sf_dir):
    return EX.extract(fx.read_table(spark, sf_dir, "lineitem"), _EXTRACT_COLS, "l_shipdate", "1996-01-01",
                      "1996-12-31")


@query("extract_events", "SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS permno, l_orderkey AS order_id, "
                         "l_linenumber AS line, l_extendedprice AS prc, l_quantity AS vol FROM lineitem "
                         "WHERE l_returnflag = 'R' AND CAST(l_shipdate AS DATE) BETWEEN DATE '1995-01-01' "
                         "AND DATE '2001-12-31'")
def q_extract_events(spark, sf_dir):
    return EX.extract(fx.read_table(spark, sf_dir, "lineitem"), _EXTRACT_COLS, "l_shipdate", "1995-01-01",
                      "2001-12-31", where=F.col("l_returnflag") == "R")


@query("scan_csv_roundtrip", with_ctes("SELECT * FROM panel", "panel"))
def q_scan_csv_roundtrip(spark, sf_dir):
    p = _panel(spark, sf_dir)
    path = shared_dir(spark, "csv") + "/panel"
    EX.write_csv(p, path)
    return EX.read_csv(spark, path, p.schema)


@query("stream_upsert", with_ctes(
    f"SELECT {_MERGE_SEL} FROM panel o FULL OUTER JOIN (SELECT date, barrid, price * 2 AS price, market_cap, "
    "\"return\", specific_return, CAST(NULL AS DOUBLE) AS specific_risk, predicted_beta, daily_volume FROM panel "
    "WHERE year(date) = 1998) n ON o.date = n.date AND o.barrid = n.barrid", "panel"))
def q_stream_upsert(spark, sf_dir):
    p = _panel(spark, sf_dir)
    drop = shared_dir(spark, "drop")
    base = shared_dir(spark, "stream")
    # vendor drops: one file per year (one job), then a later correction file for 1998
    p.withColumn("y", F.year("date")).repartition("y").write.partitionBy("y").parquet(drop + "/in/base")
    corr = p.filter(F.year("date") == 1998).withColumn("price", F.col("price") * 2) \
        .withColumn("specific_risk", F.lit(None).cast("double"))
    corr.write.parquet(drop + "/in/corrections")
    t = TB.Table(spark, base, PANEL_SPEC)
    ingest_folder(spark, drop + "/in/*/*", PANEL_SPEC.schema, t, base + "/_checkpoint", max_files_per_trigger=3)
    return t.read()


@query("signals_pipeline", sig_sql(f"SELECT date, barrid, signal_name, {R('alpha')} AS alpha FROM alphas", "alphas"))
def q_signals_pipeline(spark, sf_dir):
    tables = FL.signals_flow(spark, _assets(spark, sf_dir), shared_dir(spark, "signals"))  # the panel is read once
    return tables["alphas"].read().withColumn("alpha", rnd("alpha"))


# ================================================================ whole flows
RET_TABLE = TB.TableSpec("barra_returns", T.StructType([
    T.StructField("date", T.DateType()), T.StructField("barrid", T.StringType()),
    T.StructField("price", T.DoubleType()), T.StructField("market_cap", T.DoubleType()),
    T.StructField("price_source", T.StringType()), T.StructField("currency", T.StringType()),
    T.StructField("return", T.DoubleType())]), ("date", "barrid"))
_RET_SQL = "SELECT date, barrid, price, market_cap, 'FIXTURE' AS price_source, 'USD' AS currency, \"return\" FROM panel"


@query("flow_vendor_history", with_ctes(_RET_SQL, "panel"))
def q_flow_vendor_history(spark, sf_dir):
    p = _panel(spark, sf_dir)
    root = shared_dir(spark, "archives")
    AR.write_archives(_raw_rows(p), root, F.date_format(F.to_date("DataDate", "yyyyMMdd"), "yyyy_MM"),
                      lambda k: f"RET_HIST_{k}.zip", lambda k: f"RET_{k}.txt", RAW_RET).count()
    t = TB.Table(spark, shared_dir(spark, "store"), RET_TABLE)
    FL.vendor_history_flow(spark, root, RET_SPEC, V.RETURNS, RAW_RET, t)
    return t.read()


@query("flow_vendor_daily_update", with_ctes(
    _RET_SQL + " WHERE date < DATE '1999-01-01' OR date IN (SELECT date FROM lb)", "panel", "sessions",
    extra=[("lb", _LOOKBACK)]))
def q_flow_vendor_daily_update(spark, sf_dir):
    p = _panel(spark, sf_dir)
    root, sessions = _daily_archives(spark, sf_dir)
    t = TB.Table(spark, shared_dir(spark, "store"), RET_TABLE)
    t.upsert(fx.vendor_returns(p).filter(F.col("date") < F.lit("1999-01-01").cast("date")))
    FL.vendor_daily_flow(spark, root, RET_SPEC, V.RETURNS, RAW_RET, t, sessions)
    FL.vendor_daily_flow(spark, root, RET_SPEC, V.RETURNS, RAW_RET, t, sessions)  # nightly re-run: idempotent
    return t.read()


from panelforge.plans.registry import REGISTRY  # noqa: E402
from panelforge.sources.catalog import table_spec  # noqa: E402

IDS_SPEC = AR.ArchiveSpec("IDS_HIST", "IDS_", "IDS_DAILY", "IDS", skip=1)


@query("flow_ids_snapshot", with_ctes(
    "SELECT barrid, asset_id_type, asset_id, start_date, end_date FROM ids "
    "WHERE start_date <= (SELECT max(date) FROM lb)", "ids", "sessions",
    extra=[("lb", _LOOKBACK)]))
def q_flow_ids_snapshot(spark, sf_dir):
    """the id file as shipped on the newest look-back sessions (the ids known
    on that day, of assets at home and abroad); the flow keeps the newest
    existing snapshot and of it the assets whose own identifier holds "US"."""
    sessions = sorted(r[0] for r in C.last_n_sessions(fx.sessions(spark, sf_dir), "1999-06-15", 60).collect())
    root = _id_archives(spark, _panel(spark, sf_dir), sessions[-3:])
    t = TB.Table(spark, shared_dir(spark, "store"), table_spec("barra_ids"))
    FL.snapshot_flow(spark, root, IDS_SPEC, V.IDS, V.IDS.raw_columns(), t, sessions, us_only=True)
    return t.read()


def _id_archives(spark, p, days):
    """Id archives of the given sessions, foreign assets among them."""
    ids = fx.barra_ids(p)
    ids = ids.unionByName(ids.withColumn("barrid", F.concat(F.lit("CAN"), F.substring("barrid", 3, 100))))
    snaps = ids.withColumn("snap", F.explode(F.array(*[F.lit(d) for d in days]))).filter(F.col("start_date") <= F.col("snap"))
    raw = snaps.select(F.col("barrid").alias("!Barrid"), F.col("asset_id_type").alias("AssetIDType"),
                       F.col("asset_id").alias("AssetID"), F.date_format("start_date", "yyyyMMdd").alias("StartDate"),
                       F.date_format("end_date", "yyyyMMdd").alias("EndDate"), "snap")
    root = shared_dir(spark, "ids_daily")
    AR.write_archives(raw, root, F.date_format("snap", "yyyyMMdd"), lambda k: f"IDS_DAILY_{k[2:]}.zip",
                      lambda k: f"IDS.{k}", V.IDS.raw_columns()).count()
    return root


# ---------------------------------------------------------------- the other vendor datasets, archives to tables
_DATASET_FACTORS = {"exposures": FIXTURE_FACTORS, "covariances": FIXTURE_LINES, "factors": FIXTURE_FACTORS}


def _dataset_rows(spark, sf_dir, name):
    p = _panel(spark, sf_dir)
    if name == "exposures":
        return fx.exposures_long(spark, sf_dir)
    if name == "covariances":
        return _cov_long(spark, sf_dir)
    if name == "factors":  # the vendor ships decimals
        return fx.exposures_long(spark, sf_dir).groupBy("date", "factor").agg(F.max("exposures").alias("return"))
    if name == "asset_ids":
        return fx.asset_ids(spark, sf_dir)
    return {"specific_returns": fx.vendor_specific_returns, "risk": fx.vendor_risk, "volume": fx.vendor_volume}[name](p)


def _dataset_query(name: str):
    """The dataset written in the vendor's layout (folders, prefixes, lines
    before the header), read back by its archive rules and stored."""
    spec, vendor = V.archive_specs()[name], V.DATASETS[name]
    daily = spec.history_prefix is None

    def build(spark, sf_dir):
        raw = {c: h for c, h in zip(vendor.columns, vendor.raw_columns(), strict=True)}
        rows = _dataset_rows(spark, sf_dir, name)
        sessions = None
        if daily:  # one archive for each of the look-back's sessions
            sessions = sorted(r[0] for r in C.last_n_sessions(fx.sessions(spark, sf_dir), "1999-06-15", 60).collect())
            if "date" in vendor.columns:
                rows = rows.filter(F.col("date").isin(sessions)).withColumn("_day", F.col("date"))
            else:
                rows = rows.withColumn("_day", F.lit(sessions[-1]))
            key = F.date_format("_day", "yyyyMMdd")
            name_of = lambda k: f"{spec.daily_folder}/{spec.daily_prefix}_{k[2:]}.zip"
            member_of = lambda k: f"{spec.daily_member}.{k}"
        else:
            key = F.date_format("date", "yyyy_MM")  # a year's archives by month, so that no task writes or reads a year
            name_of = lambda k: f"{spec.history_folder}/{spec.history_prefix}_{k}.zip"
            member_of = lambda k: f"{spec.member_prefix}.{k}"
        shown = [(F.date_format(c, "yyyyMMdd") if c in vendor.date_cols else F.col(c)).alias(h) for c, h in raw.items()]
        root = shared_dir(spark, "archives")
        AR.write_archives(rows.select(*shown, key.alias("_key")), root, F.col("_key"), name_of, member_of,
                          list(raw.values()), [f"!line {i}" for i in range(spec.skip)]).count()
        if name in V.WIDE:
            index = V.WIDE[name][0]
            fields = [T.StructField(c, T.DateType() if c == "date" else T.StringType()) for c in index]
            fields += [T.StructField(f, T.DoubleType()) for f in _DATASET_FACTORS[name]]
            table = TB.TableSpec(name, T.StructType(fields), index)
        else:
            table = table_spec(name if name == "asset_ids" else f"barra_{name}")
        t = TB.Table(spark, shared_dir(spark, "store"), table)
        FL.dataset_flow(spark, root, name, t, sessions=sessions, factors=_DATASET_FACTORS.get(name))
        return t.read()
    return build


_FACTOR_DAILY = ("SELECT date, factor, max(exposures) * 100.0 AS value FROM exposures_long "
                 "WHERE date IN (SELECT date FROM lb) GROUP BY date, factor")
query("flow_vendor_specific_returns", with_ctes("SELECT barrid, specific_return, date FROM panel", "panel"))(_dataset_query("specific_returns"))
query("flow_vendor_risk", with_ctes("SELECT * FROM risk", "risk"))(_dataset_query("risk"))
query("flow_vendor_volume", with_ctes("SELECT * FROM volume", "volume"))(_dataset_query("volume"))
query("flow_vendor_asset_ids", with_ctes("SELECT * FROM asset_ids", "asset_ids"))(_dataset_query("asset_ids"))
query("flow_vendor_exposures", REGISTRY["pivot_exposures"].sql)(_dataset_query("exposures"))
query("flow_vendor_covariances", REGISTRY["pivot_covariances"].sql)(_dataset_query("covariances"))
query("flow_vendor_factors", with_ctes(_pivot_sql("date", "factor", "value", FIXTURE_FACTORS, "fd"), "exposures_long", "sessions",
                                       extra=[("lb", _LOOKBACK), ("fd", _FACTOR_DAILY)]))(_dataset_query("factors"))


FTSE_SPEC = TB.TableSpec("ftse_russell", T.StructType([
    T.StructField("date", T.DateType()), T.StructField("cusip", T.StringType()),
    T.StructField("russell_2000", T.BooleanType()), T.StructField("russell_1000", T.BooleanType())]),
    ("date", "cusip"))


@query("flow_warehouse_backfill", with_ctes(
    "SELECT date, cusip, russell2000 = 'Y' AS russell_2000, russell1000 = 'Y' AS russell_1000 FROM membership "
    "WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'", "membership"))
def q_flow_warehouse_backfill(spark, sf_dir):
    src = fx.membership(_panel(spark, sf_dir))  # the warehouse table
    t = TB.Table(spark, shared_dir(spark, "store"), FTSE_SPEC)
    FL.warehouse_backfill_flow(src, {"date": "date", "cusip": "cusip", "russell2000": "russell2000",
                                     "russell1000": "russell1000"}, "date", t, "1996-01-01", "2000-12-31",
                               flags={"russell1000": "russell_1000", "russell2000": "russell_2000"})
    return t.read()


# warehouse source columns by rule from the panel, for all extracts of the catalogue (both engines read these)
_WAREHOUSE = {
    "date": "date", "dlycaldt": "date", "mthcaldt": "date", "permno": "CAST(substring(barrid, 3, 100) AS INT)",
    "cusip": "concat('C', substring(barrid, 3, 100))", "ticker": "concat('T', substring(barrid, 3, 100))",
    "event": "CASE WHEN day(date) = 2 THEN 'NAMES' ELSE 'DIV' END", "shrcd": "10 + month(date)", "exchcd": "1 + month(date) % 3",
    "shrout": "CAST(floor(market_cap) AS BIGINT)", "primaryexch": "CASE WHEN month(date) < 6 THEN 'N' ELSE 'Q' END", "securitytype": "'EQTY'",
    "russell1000": "CASE WHEN specific_risk > 35 THEN 'Y' ELSE 'N' END", "russell2000": "CASE WHEN specific_risk BETWEEN 25 AND 35 THEN 'Y' ELSE 'N' END",
    **{f"{p}{c}": e for p in ("", "dly", "mth") for c, e in (("ret", "`return` / 100"), ("retx", "specific_return / 100"), ("prc", "price"),
                                                             ("vol", "CAST(floor(daily_volume) AS BIGINT)"))},
    "openprc": "price / 2", "askhi": "price * 2", "bidlo": "price / 4", "dlyopen": "price / 2", "dlyhigh": "price * 2", "dlylow": "price / 4", "dlyclose": "price",
}
_WAREHOUSE_RANGE = ("1994-01-01", "1997-12-31")


def _warehouse_sql(name: str) -> str:
    columns, date_col, where = EXTRACTS[name]
    shown = [f"{_WAREHOUSE[c]} = 'Y' AS russell_{o.removeprefix('russell')}" if o.startswith("russell") else f'{_WAREHOUSE[c]} AS "{o}"' for c, o in columns.items()]
    only = " AND day(date) = 1" if name.endswith("_monthly") else " AND day(date) = 2" if where else ""
    lo, hi = _WAREHOUSE_RANGE
    return with_ctes(f"SELECT {', '.join(shown)} FROM panel WHERE date BETWEEN DATE '{lo}' AND DATE '{hi}'{only}".replace("`", '"'), "panel")


def _warehouse_query(name: str):
    def build(spark, sf_dir):
        columns, _, where = EXTRACTS[name]
        p = _panel(spark, sf_dir)
        p = p.filter(F.dayofmonth("date") == 1) if name.endswith("_monthly") else p
        src = p.select(*[F.expr(_WAREHOUSE[c]).alias(c) for c in (*columns, *(["event"] if where else []))])
        t = TB.Table(spark, shared_dir(spark, "store"), table_spec(name))
        FL.warehouse_flow(src, name, t, *_WAREHOUSE_RANGE)
        return t.read()

    return build


for _n in EXTRACTS:
    query(f"warehouse_{_n}", _warehouse_sql(_n))(_warehouse_query(_n))


@query("csv_listing", with_ctes("SELECT DISTINCT CAST(year(date) AS INTEGER) AS year, true AS found FROM panel", "panel"))
def q_csv_listing(spark, sf_dir):
    """The files of a folder of yearly CSV files, listed without being read."""
    root = shared_dir(spark, "csv_years")
    _panel(spark, sf_dir).select("date", "barrid", "price", F.year("date").alias("year")).write.mode("overwrite").option("header", True).partitionBy("year").csv(root)
    files = EX.list_files(spark, root, "*.csv")
    return files.groupBy(F.regexp_extract("path", "/year=([0-9]+)/", 1).cast("int").alias("year")).agg((F.sum("length") > 0).alias("found"))


@query("flow_factor_file", with_ctes(
    "SELECT date, CAST(mkt_rf AS DOUBLE) / 100 AS mkt_rf, CAST(smb AS DOUBLE) / 100 AS smb, "
    "CAST(hml AS DOUBLE) / 100 AS hml, CAST(rmw AS DOUBLE) / 100 AS rmw, CAST(cma AS DOUBLE) / 100 AS cma, "
    "CAST(rf AS DOUBLE) / 100 AS rf FROM ffd", extra=[("ffd", _FF_DAILY)]))
def q_flow_factor_file(spark, sf_dir):
    t = TB.Table(spark, shared_dir(spark, "store"), TB.TableSpec("fama_french", FF_SCHEMA, ("date",), yearly=False))
    FL.factor_file_flow(spark, _ff_text(spark, sf_dir), FF_SCHEMA, t)
    return t.read()


@query("flow_exposures_matrix", with_ctes(_pivot_sql("date, barrid", "factor", "exposures", FIXTURE_FACTORS,
                                                     "exposures_long"), "exposures_long"))
def q_flow_exposures_matrix(spark, sf_dir):
    wide_schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("barrid", T.StringType())]
                               + [T.StructField(f, T.DoubleType()) for f in FIXTURE_FACTORS])
    t = TB.Table(spark, shared_dir(spark, "store"), TB.TableSpec("exposures", wide_schema, ("date", "barrid")))
    FL.factor_matrix_flow(fx.exposures_long(spark, sf_dir), ["date", "barrid"], "factor", "exposures",
                          FIXTURE_FACTORS, t)
    return t.read()


@query("backfill_all", sig_sql(f"SELECT date, barrid, signal_name, {R('alpha')} AS alpha FROM alphas", "alphas"))
def q_backfill_all(spark, sf_dir):
    p = checkpoint(_panel(spark, sf_dir))
    vendor = {
        "returns": fx.vendor_returns(p), "specific_returns": fx.vendor_specific_returns(p),
        "risk": fx.vendor_risk(p), "volume": fx.vendor_volume(p), "asset_ids": fx.asset_ids(spark, sf_dir),
        "membership": fx.membership(p),
    }
    sessions = sorted(r[0] for r in C.last_n_sessions(fx.sessions(spark, sf_dir), "2100-01-01", 60).collect())
    archived = (_id_archives(spark, p, sessions[-1:]), IDS_SPEC, sessions)  # ids come through the snapshot flow
    tables = FL.backfill_all(spark, shared_dir(spark, "store"), vendor, id_archives=archived)
    return tables["alphas"].read().withColumn("alpha", rnd("alpha"))


# ---------------------------------------------------------------- as-of for hot keys (time buckets)
def _asof_bucketed_query(strategy: str):
    def build(spark, sf_dir):
        p = _panel(spark, sf_dir)
        return J.asof_join_bucketed(p.select("date", "barrid"), _local_ids(p), "date", "start_date", "barrid",
                                    F.year, strategy=strategy, tie_break=("end_date",))
    return build


from panelforge.plans.registry import REGISTRY  # noqa: E402

query("asof_backward_bucketed", REGISTRY["asof_backward"].sql)(_asof_bucketed_query("backward"))
query("asof_forward_bucketed", REGISTRY["asof_forward"].sql)(_asof_bucketed_query("forward"))


# ---------------------------------------------------------------- A10, B11, L2
_FACTOR_ROWS = """SELECT date, barrid, "return" / 100 AS a, specific_risk / 100 AS s, predicted_beta - 0.5 AS x,
       0.0001 * (1 + day(date) % 5) AS f FROM panel WHERE specific_risk > 0"""
_FACTOR_SUMS = """SELECT date, any_value(f) AS f, count(*) AS n, sum(x * x / (s * s)) AS xx, sum(x / (s * s)) AS x1, sum(x * a / (s * s)) AS xa,
       sum(1 / (s * s)) AS oo, sum(a / (s * s)) AS oa, sum(a * a / (s * s)) AS aa FROM frows GROUP BY date"""
_FACTOR_SOLVED = """SELECT date, n, f * x1 / (1 + f * xx) AS g1, f * xa / (1 + f * xx) AS ga, oo - x1 * (f * x1 / (1 + f * xx)) AS q11,
       oa - x1 * (f * xa / (1 + f * xx)) AS q1a, aa - xa * (f * xa / (1 + f * xx)) AS qaa FROM fsums"""


@query("factor_active_weights", with_ctes(
    "SELECT r.date, r.barrid, CASE WHEN n <= 1 THEN 0.0 ELSE "
    + R("(a - q1a / q11 - x * (ga - q1a / q11 * g1)) / (s * s) * 0.05 / sqrt(qaa - q1a * q1a / q11)", 16)
    + " END AS weight FROM frows r JOIN fsolved q ON r.date = q.date WHERE n <> 2",
    "panel", extra=[("frows", _FACTOR_ROWS), ("fsums", _FACTOR_SUMS), ("fsolved", _FACTOR_SOLVED)]))
def q_factor_active_weights(spark, sf_dir):
    """P6 under a one-factor risk model and the ZeroInvestment constraint (days of two
    assets, whose weights are fixed up to rounding, are left to the tests)."""
    from panelforge.operators.factor_weights import factor_active_weights

    p = _panel(spark, sf_dir).filter("specific_risk > 0")
    panel = p.select("date", "barrid", (F.col("return") / 100).alias("alpha"), (F.col("specific_risk") / 100).alias("specific_risk"), "predicted_beta")
    exposures = p.select("date", "barrid", (F.col("predicted_beta") - 0.5).alias("market"))
    cov = p.select("date").distinct().select("date", F.lit("market").alias("factor"), (0.0001 * (1 + F.dayofmonth("date") % 5)).alias("market"))
    w = factor_active_weights(panel, exposures, cov, ["market"], zero_beta=False)
    many = w.groupBy("date").agg(F.count(F.lit(1)).alias("n")).filter("n <> 2").select("date")
    return w.join(many, "date").select("date", "barrid", rnd("weight", 16).alias("weight"))


@query("weights_glob_scan", chain_sql(f"SELECT date, signal_name, {R('forward_return')} AS forward_return FROM sr", "sr"))
def q_weights_glob_scan(spark, sf_dir):
    """Signal returns computed from optimiser weight files laid out per
    signal and risk level (one scan for all signals)."""
    c = _chain(spark, sf_dir)
    root = shared_dir(spark, "weights") + "/weights"
    c.active().withColumn("risk", F.lit("0.05")).write.partitionBy("signal_name", "risk").parquet(root)
    weights = EX.read_weight_files(spark, root, "0.05").select("date", "barrid", "signal_name", "weight")
    return round_all(P.signal_returns(weights, c.assets))


@query("optimizer_handoff", chain_sql(
    f"SELECT date, barrid, {R('predicted_beta')} AS predicted_beta, {R('specific_risk')} AS specific_risk, "
    f"{R('benchmark_weight')} AS benchmark_weight, {R('alpha')} AS alpha FROM copt", "copt"))
def q_optimizer_handoff(spark, sf_dir):
    c = _chain(spark, sf_dir)
    panel = P.optimizer_panel(c.assets, c.composite())
    path = EX.write_handoff(panel, shared_dir(spark, "data"), "composite", "1995-01-01", "2001-12-31")
    return round_all(spark.read.parquet(path).select("date", "barrid", "predicted_beta", "specific_risk",
                                                     "benchmark_weight", "alpha"))


_RECENT = """SELECT date FROM sessions WHERE date <= (SELECT max(date) FROM panel WHERE year(date) = 1998)
ORDER BY date DESC LIMIT 60"""


@query("late_corrections", with_ctes(
    "SELECT p.date, p.barrid, CASE WHEN r.date IS NOT NULL THEN p.price * 2 ELSE p.price END AS price, p.market_cap, "
    "p.\"return\", p.specific_return, p.specific_risk, p.predicted_beta, p.daily_volume FROM panel p "
    "LEFT JOIN recent r ON p.date = r.date AND year(p.date) = 1998", "panel", "sessions",
    extra=[("recent", _RECENT)]))
def q_late_corrections(spark, sf_dir):
    """L2: a correction batch for 1998 is merged only for the last 60 sessions
    up to its newest date; older corrections are refused."""
    from panelforge.streaming.ingest import accept_recent

    t, p = _stored_panel(spark, sf_dir)
    corr = p.filter(F.year("date") == 1998).withColumn("price", F.col("price") * 2)
    t.upsert(accept_recent(corr, fx.sessions(spark, sf_dir), 60))
    return t.read()


@query("stream_late_corrections", REGISTRY["late_corrections"].sql)
def q_stream_late_corrections(spark, sf_dir):
    """L2 inside the stream: a correction file for 1998 arrives in the drop folder;
    its micro-batch is merged only for the last 60 sessions up to its newest date."""
    t, _ = _stored_panel(spark, sf_dir)
    drop = shared_dir(spark, "late")
    # the one task that writes the file reads the year's rows only
    t.read(years=[1998]).withColumn("price", F.col("price") * 2).coalesce(1).write.parquet(drop + "/in/corrections")
    ingest_folder(spark, drop + "/in/*", PANEL_SPEC.schema, t, drop + "/_checkpoint",
                  calendar=checkpoint(fx.sessions(spark, sf_dir)), max_age_sessions=60)
    return t.read()


_RECENT_BY = """SELECT date, 1998 AS y FROM (SELECT date FROM sessions WHERE date <= (SELECT max(date) FROM panel WHERE year(date) = 1998)
ORDER BY date DESC LIMIT 60) a UNION ALL SELECT date, 1999 AS y FROM (SELECT date FROM sessions WHERE date <= (SELECT max(date) FROM panel
WHERE year(date) = 1999) ORDER BY date DESC LIMIT 60) b"""


@query("stream_late_splits", with_ctes(
    "SELECT s.files, p.date, p.barrid, CASE WHEN r.date IS NULL THEN p.price WHEN r.y = 1998 THEN p.price * 2 WHEN day(p.date) <= 15 THEN p.price * 7 "
    "ELSE p.price * 3 END AS price, p.\"return\" FROM panel p CROSS JOIN (SELECT unnest([1, 2, 9]) AS files) s "
    "LEFT JOIN recent r ON p.date = r.date AND year(p.date) = r.y", "panel", "sessions", extra=[("recent", _RECENT_BY)]))
def q_stream_late_splits(spark, sf_dir):
    """L2 whatever the batches: four files arrive, the third an old correction that the
    mark of the second refuses; the stream takes one, two or all files at a time."""
    drop = shared_dir(spark, "late_splits")
    source = _panel(spark, sf_dir)
    schema = source.schema
    # stored by year: the one task that writes a correction file reads its year only
    stored = TB.Table(spark, drop + "/source", TB.TableSpec("panel", schema, ("date", "barrid")))
    stored.overwrite(source)
    p = stored.read()
    year, day = F.year("date"), F.dayofmonth("date")
    files = [(1998, year == 1998, 2), (1999, year == 1999, 3), (1998, year == 1998, 5), (1999, (year == 1999) & (day <= 15), 7)]
    for n, (of, some, times) in enumerate(files):
        stored.read(years=[of]).filter(some).withColumns({"price": F.col("price") * times, "return": F.lit(None).cast("double")}).coalesce(1).write.parquet(f"{drop}/in/{n}")
    sessions, out = checkpoint(fx.sessions(spark, sf_dir)), None
    for k in (1, 2, 9):
        t = TB.Table(spark, f"{drop}/store{k}", TB.TableSpec("panel", schema, ("date", "barrid")))
        t.overwrite(p)
        ingest_folder(spark, drop + "/in/*", schema, t, f"{drop}/_checkpoint{k}", k, sessions, 60)
        rows = t.read().select(F.lit(k).alias("files"), "date", "barrid", "price", "return")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- F9 by day
_DAY = "1999-06-15"


def _daily_panel_sql(sql: str, days: int = 60) -> str:
    """``sql`` over the assets of what the store holds after the day's run: all
    rows before 1999 and those of the look-back's sessions."""
    head, rest = sql.split("panel AS (", 1)
    inner, rest = rest.split("),\nids AS (", 1)
    kept = f"SELECT * FROM all_rows WHERE date < DATE '1999-01-01' OR date IN (SELECT date FROM lb)"
    return (f"{head}all_rows AS ({inner}),\nlb AS (SELECT DISTINCT date FROM all_rows WHERE date < DATE '{_DAY}' ORDER BY date DESC LIMIT {days}),"
            f"\npanel AS ({kept}),\nids AS ({rest}")


def _daily_store(spark, sf_dir, days: int):
    """Stored vendor history before 1999, archives of the last ``days`` sessions before
    _DAY, those sessions, and all rows of both."""
    p = checkpoint(_panel(spark, sf_dir))
    sessions = sorted(r[0] for r in C.last_n_sessions(fx.sessions(spark, sf_dir), _DAY, days).collect())
    recent, old = F.col("date").isin(sessions), F.col("date") < F.lit("1999-01-01").cast("date")
    frames = {"returns": fx.vendor_returns(p), "specific_returns": fx.vendor_specific_returns(p), "risk": fx.vendor_risk(p),
              "volume": fx.vendor_volume(p)}
    root, archives = shared_dir(spark, "daily_store"), {}
    for name, rows in frames.items():
        TB.Table(spark, root, table_spec(f"barra_{name}")).upsert(rows.filter(old))
        spec, vendor = V.archive_specs()[name], V.DATASETS[name]
        archives.setdefault((spec.daily_folder, spec.daily_prefix), []).append((spec, vendor, rows.filter(recent)))
    folder = shared_dir(spark, "daily_archives")
    for n, ((place, prefix), members) in enumerate(archives.items()):
        for spec, vendor, rows in members:  # datasets that share a day's archive ship in folders of their own here
            raw = dict(zip(vendor.columns, vendor.raw_columns(), strict=True))
            shown = [(F.date_format(c, "yyyyMMdd") if c in vendor.date_cols else F.col(c)).alias(h) for c, h in raw.items()]
            AR.write_archives(rows.select(*shown, F.date_format("date", "yyyyMMdd").alias("_key")), f"{folder}/{vendor.name}", F.col("_key"),
                              lambda k, place=place, prefix=prefix: f"{place}/{prefix}_{k[2:]}.zip",
                              lambda k, spec=spec: f"{spec.daily_member}.{k}", list(raw.values()),
                              [f"!line {i}" for i in range(spec.skip)]).count()
    return root, lambda name: f"{folder}/{name}", sessions, p.filter(old | recent)


def _stored_assets(tables):
    return tables["assets"].read().select(*[f.name for f in tables["assets"].spec.schema.fields if f.name not in ("isin", "cisn")])


@query("flow_daily_all", _daily_panel_sql(with_ctes("SELECT * FROM assets", "assets")))
def q_flow_daily_all(spark, sf_dir):
    """The daily pipeline over stored history: the four datasets' archives of the
    look-back come in, twice, and the panel and signals are built anew."""
    root, archives, sessions, held = _daily_store(spark, sf_dir, 60)
    for _ in range(2):
        tables = FL.daily_all(spark, root, archives, sessions, fx.membership(held),
                              fx.asset_ids(spark, sf_dir), fx.barra_ids(held), ["reversal"])
    return _stored_assets(tables)


def _daily_continued(spark, sf_dir, names=None):
    """Two daily runs three sessions apart: the first builds, the second continues."""
    from panelforge.plans.daily import daily_incremental

    root, archives, sessions, held = _daily_store(spark, sf_dir, 63)
    for lookback in (sessions[:60], sessions[3:]):
        tables = daily_incremental(spark, root, archives, lookback, fx.membership(held), fx.asset_ids(spark, sf_dir), fx.barra_ids(held), names)
    return tables


@query("flow_daily_incremental", _daily_panel_sql(with_ctes("SELECT * FROM assets", "assets"), 63))
def q_flow_daily_incremental(spark, sf_dir):
    """The panel that a daily run continues from stored state is that of a rebuild."""
    return _stored_assets(_daily_continued(spark, sf_dir, ["reversal"]))


@query("flow_daily_incremental_alphas", _daily_panel_sql(sig_sql(
    f"SELECT date, barrid, signal_name, {R('signal_value')} AS signal_value, {R('score')} AS score, {R('alpha')} AS alpha FROM alphas", "alphas"), 63))
def q_flow_daily_incremental_alphas(spark, sf_dir):
    """All signals, scores and alphas after two continued days are those of a rebuild."""
    t = _daily_continued(spark, sf_dir)
    keys = ["date", "barrid", "signal_name"]
    out = t["signals"].read().join(t["scores"].read(), keys, "left").join(t["alphas"].read(), keys, "left")
    return out.select(*keys, *[rnd(c).alias(c) for c in ("signal_value", "score", "alpha")])


# ---------------------------------------------------------------- catalogue
from panelforge.sources.catalog import TABLES, Catalog  # noqa: E402


def _catalog_select_sql() -> str:
    have = {"yield", "total_risk", "historical_beta", "average_daily_volume_30", "average_daily_volume_60",
            "average_daily_volume_90", "bid_ask_spread", "average_daily_bid_ask_spread_30",
            "average_daily_bid_ask_spread_60", "average_daily_bid_ask_spread_90", "date", "rootid", "barrid", "issuerid", "instrument", "name", "cusip", "ticker", "price", "return",
            "specific_return", "market_cap", "price_source", "currency", "iso_country_code", "iso_currency_code",
            "specific_risk", "predicted_beta", "russell_1000", "russell_2000", "in_universe", "daily_volume"}
    sql_t = {"str": "VARCHAR", "dbl": "DOUBLE", "bool": "BOOLEAN", "date": "DATE", "int": "BIGINT"}
    cols = []
    for n, t in TABLES["assets"][0]:
        cols.append(f'"{n}"' if n in have else f'CAST(NULL AS {sql_t[t]}) AS "{n}"')
    return "SELECT " + ", ".join(cols) + " FROM assets"


@query("catalog_assets_table", with_ctes(_catalog_select_sql(), "assets"))
def q_catalog_assets_table(spark, sf_dir):
    """The asset panel written through the catalogue: declared schema (columns
    the sources do not supply are typed NULLs), yearly partitions."""
    cat = Catalog(spark, shared_dir(spark, "db"), "development")
    cat.assets_table.overwrite(_assets(spark, sf_dir))
    return cat.assets_table.read()


# ---------------------------------------------------------------- hot-key mode of the per-asset windows
@query("signals_long_blocked", REGISTRY["signals_long"].sql)
def q_signals_long_blocked(spark, sf_dir):
    """H12's signal table with every asset's series cut into 300-row blocks
    carrying a 256-row halo (small blocks so the test data spans many)."""
    inp = S.signal_input(_assets(spark, sf_dir))
    names = list(S.SIGNALS)
    wide = S.signal_columns(inp, names, block_rows=300, halo=256)
    long = S.signals_long(wide, names)
    return long.select("date", "barrid", "signal_name", rnd("signal_value").alias("signal_value"))


@query("alphas_long_blocked", REGISTRY["alphas_long"].sql)
def q_alphas_long_blocked(spark, sf_dir):
    """H12 alphas with all per-asset windows (signals and the winsorised
    scorer's volume statistics) in 300-row blocks with a 256-row halo."""
    from panelforge.plans.combination import checkpoint

    _, _, al = S.compute_signals(_assets(spark, sf_dir), materialize=checkpoint, block_rows=300)
    return al.withColumn("alpha", rnd("alpha"))


@query("universe_forward_fill_bucketed", REGISTRY["universe_forward_fill"].sql)
def q_universe_forward_fill_bucketed(spark, sf_dir):
    """D4 with the constituency fill run per (asset, year) and the last flag
    carried from earlier years (hot-asset mode)."""
    a = build_assets_from_fixtures(spark, sf_dir, fill_bucket=F.year)
    return a.select("date", "barrid", "cusip", "russell_1000", "russell_2000", "in_universe")
