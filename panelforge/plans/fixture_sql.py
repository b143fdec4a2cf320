"""SQL twins of ``panelforge.plans.fixtures`` for the DuckDB oracle.

Each constant is a CTE body; ``with_ctes`` assembles the ones a query needs.
"""

from __future__ import annotations

PANEL = """
SELECT barrid, date,
       CAST(spx AS DOUBLE) / CAST(sqty AS DOUBLE) AS price,
       CAST(spx AS DOUBLE) AS market_cap,
       100.0 * CAST(sret AS DOUBLE) AS "return",
       100.0 * CAST(ssret AS DOUBLE) AS specific_return,
       10.0 + CAST(sqty AS DOUBLE) / n AS specific_risk,
       0.5 + CAST(sqty AS DOUBLE) / n / 50.0 AS predicted_beta,
       CAST(sqty AS DOUBLE) AS daily_volume
FROM (
  SELECT concat('US', lpad(CAST(l_suppkey AS VARCHAR), 6, '0')) AS barrid,
         CAST(l_shipdate AS DATE) AS date,
         SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS spx,
         SUM(CAST(l_quantity AS DECIMAL(12,2))) AS sqty,
         SUM(CAST(l_discount AS DECIMAL(12,2)) - CAST(l_tax AS DECIMAL(12,2))) AS sret,
         MAX(CAST(l_discount AS DECIMAL(12,2))) - MAX(CAST(l_tax AS DECIMAL(12,2))) AS ssret,
         COUNT(*) AS n
  FROM lineitem GROUP BY 1, 2
) g
"""

IDS = """
SELECT barrid, 'LOCALID' AS asset_id_type,
       concat('US', CAST(CAST(floor(market_cap) AS BIGINT) % 9973 AS VARCHAR)) AS asset_id,
       date AS start_date, CAST(date + INTERVAL 45 DAY AS DATE) AS end_date
FROM panel WHERE day(date) <= 3
UNION ALL
SELECT barrid, 'CUSIP', concat('C', substr(barrid, 3)), MIN(date), DATE '2099-12-31'
FROM panel GROUP BY barrid
"""

MEMBERSHIP = """
SELECT date, concat('C', substr(barrid, 3)) AS cusip,
       CASE WHEN specific_risk > 35 THEN 'Y' ELSE 'N' END AS russell1000,
       CASE WHEN specific_risk BETWEEN 25 AND 35 THEN 'Y' ELSE 'N' END AS russell2000
FROM panel WHERE day(date) = 1
"""

ASSET_IDS = """
SELECT DATE '1990-01-01' AS start_date, DATE '1998-06-30' AS end_date, barrid AS rootid, barrid,
       issuerid, 'STOCK' AS instrument, name, iso_country_code, 'USD' AS iso_currency_code
FROM (SELECT concat('US', lpad(CAST(s_suppkey AS VARCHAR), 6, '0')) AS barrid, s_name AS name,
             concat('I', CAST(s_nationkey AS VARCHAR)) AS issuerid, substr(n_name, 1, 3) AS iso_country_code
      FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey) b
UNION ALL
SELECT DATE '1998-07-01', DATE '2099-12-31', barrid, barrid, issuerid, 'STOCK', concat(name, ' NEW'),
       iso_country_code, 'USD'
FROM (SELECT concat('US', lpad(CAST(s_suppkey AS VARCHAR), 6, '0')) AS barrid, s_name AS name,
             concat('I', CAST(s_nationkey AS VARCHAR)) AS issuerid, substr(n_name, 1, 3) AS iso_country_code
      FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey) b
"""

RISK = """
SELECT date, barrid, predicted_beta * 2 AS "yield", specific_risk + 5 AS total_risk, specific_risk,
       predicted_beta - 0.25 AS historical_beta, predicted_beta FROM panel
"""

VOLUME = """
SELECT date, barrid, daily_volume, daily_volume / 2 AS average_daily_volume_30, daily_volume / 4 AS average_daily_volume_60,
       daily_volume / 8 AS average_daily_volume_90, price / 1024 AS bid_ask_spread,
       price / 2048 AS average_daily_bid_ask_spread_30, price / 4096 AS average_daily_bid_ask_spread_60,
       price / 8192 AS average_daily_bid_ask_spread_90 FROM panel
"""

EXPOSURES_LONG = """
SELECT CAST(l_shipdate AS DATE) AS date,
       concat('US', lpad(CAST(l_suppkey AS VARCHAR), 6, '0')) AS barrid,
       concat('F_', l_returnflag, l_linestatus) AS factor,
       CAST(SUM(CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) AS exposures
FROM lineitem GROUP BY 1, 2, 3
"""

SESSIONS = "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem"

# The assets panel (flow F1): left chain, three backward as-of joins, membership
# join and rebalance-aware forward fill.
ASSETS = """
SELECT a.date, a.barrid, a.price, a.market_cap, a."return", a.price_source, a.currency,
       a.specific_return, a.specific_risk, a.predicted_beta, a.daily_volume,
       a."yield", a.total_risk, a.historical_beta, a.average_daily_volume_30, a.average_daily_volume_60,
       a.average_daily_volume_90, a.bid_ask_spread, a.average_daily_bid_ask_spread_30,
       a.average_daily_bid_ask_spread_60, a.average_daily_bid_ask_spread_90,
       a.rootid, a.issuerid, a.instrument, a.name, a.iso_country_code, a.iso_currency_code,
       a.ticker, a.cusip,
       a.russell_1000, a.russell_2000,
       a.russell_1000 OR a.russell_2000 AS in_universe
FROM (
  SELECT m.*,
         last_value(r1000 IGNORE NULLS) OVER (PARTITION BY barrid ORDER BY date
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS russell_1000,
         last_value(r2000 IGNORE NULLS) OVER (PARTITION BY barrid ORDER BY date
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS russell_2000
  FROM (
    SELECT j.*,
           CASE WHEN rb.date IS NOT NULL THEN coalesce(f.russell_1000, false) END AS r1000,
           CASE WHEN rb.date IS NOT NULL THEN coalesce(f.russell_2000, false) END AS r2000
    FROM (
      SELECT c.*, ai.rootid, ai.issuerid, ai.instrument, ai.name, ai.iso_country_code,
             ai.iso_currency_code, tk.ticker, cu.cusip
      FROM (
        SELECT p.date, p.barrid, p.price, p.market_cap, p."return", 'FIXTURE' AS price_source,
               'USD' AS currency, p.specific_return, p.specific_risk, p.predicted_beta, p.daily_volume,
               k."yield", k.total_risk, k.historical_beta, v.average_daily_volume_30, v.average_daily_volume_60,
               v.average_daily_volume_90, v.bid_ask_spread, v.average_daily_bid_ask_spread_30,
               v.average_daily_bid_ask_spread_60, v.average_daily_bid_ask_spread_90
        FROM panel p
        JOIN risk k ON p.date = k.date AND p.barrid = k.barrid
        JOIN volume v ON p.date = v.date AND p.barrid = v.barrid
      ) c
      ASOF LEFT JOIN asset_ids ai ON c.barrid = ai.barrid AND c.date >= ai.start_date
      ASOF LEFT JOIN (
        SELECT barrid, regexp_replace(asset_id, 'US', '') AS ticker, start_date FROM ids
        WHERE asset_id_type = 'LOCALID' AND starts_with(barrid, 'US')
      ) tk ON c.barrid = tk.barrid AND c.date >= tk.start_date
      ASOF LEFT JOIN (
        SELECT barrid, asset_id AS cusip, start_date FROM ids
        WHERE asset_id_type = 'CUSIP' AND starts_with(barrid, 'US')
      ) cu ON c.barrid = cu.barrid AND c.date >= cu.start_date
    ) j
    LEFT JOIN (SELECT date, cusip, russell2000 = 'Y' AS russell_2000, russell1000 = 'Y' AS russell_1000
               FROM membership) f
      ON j.date = f.date AND j.cusip = f.cusip
    LEFT JOIN (SELECT DISTINCT date FROM membership) rb ON j.date = rb.date
  ) m
) a
"""

_DEPS = {
    "panel": ("panel", PANEL, ()),
    "ids": ("ids", IDS, ("panel",)),
    "membership": ("membership", MEMBERSHIP, ("panel",)),
    "asset_ids": ("asset_ids", ASSET_IDS, ()),
    "exposures_long": ("exposures_long", EXPOSURES_LONG, ()),
    "sessions": ("sessions", SESSIONS, ()),
    "risk": ("risk", RISK, ("panel",)),
    "volume": ("volume", VOLUME, ("panel",)),
    "assets": ("assets", ASSETS, ("panel", "ids", "membership", "asset_ids", "risk", "volume")),
}


def with_ctes(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs ``names`` (and their dependencies) plus
    ``extra`` (name, sql) pairs appended in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _DEPS[n][2]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{_DEPS[n][0]} AS ({_DEPS[n][1]})" for n in order]
    parts += [f"{n} AS ({s})" for n, s in (extra or [])]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
