"""Reference SQL for every catalogued query, written for DuckDB.

The feeds are spelled out once as CTE text and prepended to each query, so
the oracle reads only the shared test tables, exactly as the Spark side does.
Rules that keep both engines bit-identical:

* fractional outputs are exact DECIMALs rounded half away from zero, then
  cast to DOUBLE at the very end (both sides);
* quotients that must be rounded are computed with ``xround`` (integer
  arithmetic on scaled HUGEINTs), because DuckDB divides decimals in DOUBLE;
* null ordering and zero denominators are always explicit.
"""

from __future__ import annotations

FEED_SQL = {
    "bars": """
bars AS (
  SELECT id, symbol, price_date,
         CAST(open AS DECIMAL(18,4)) AS open, CAST(high AS DECIMAL(18,4)) AS high,
         CAST(low AS DECIMAL(18,4)) AS low, CAST(close AS DECIMAL(18,4)) AS close,
         volume, CAST(0 AS DECIMAL(18,4)) AS dividends, CAST(0 AS DECIMAL(18,4)) AS stock_splits,
         CAST(price_date AS TIMESTAMP) AS fetched_at
  FROM (
    SELECT min(o.o_orderkey) AS id, n.n_name AS symbol, CAST(o.o_orderdate AS DATE) AS price_date,
           min_by(o.o_totalprice, o.o_orderkey) AS open, max(o.o_totalprice) AS high,
           min(o.o_totalprice) AS low, max_by(o.o_totalprice, o.o_orderkey) AS close,
           CAST(nullif(sum(o.o_orderkey % 1000), 0) AS BIGINT) AS volume
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                  JOIN nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY n.n_name, CAST(o.o_orderdate AS DATE)
    UNION ALL
    SELECT -1 - min(event_id), 'EV_' || event_type, CAST(ts AS DATE),
           min_by(value, event_id), max(value), min(value), max_by(value, event_id),
           CAST(CASE WHEN event_type = 'error' AND count(*) % 5 = 0 THEN NULL ELSE count(*) END AS BIGINT)
    FROM events GROUP BY event_type, CAST(ts AS DATE)
  ) u
)""",
    "board": """
board AS (
  SELECT o_orderkey AS id,
         CAST(date_trunc('month', CAST(o_orderdate AS DATE) - INTERVAL 1 DAY) AS TIMESTAMP) AS fetched_at,
         CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE '' END || 'C' || CAST(o_custkey AS VARCHAR)
           || CASE WHEN o_orderkey % 5 = 0 THEN ' XD' ELSE '' END AS symbol,
         'Name ' || CAST(o_custkey AS VARCHAR) AS name,
         CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 23 = 0 THEN NULL
              ELSE ' ' || format('{:,.2f}', o_totalprice) END AS ldcp,
         CASE WHEN o_orderkey % 29 = 0 THEN ''
              ELSE format('{:,.2f}', o_totalprice + (o_orderkey % 21) - 10) END AS "current",
         CAST((o_orderkey % 21) - 10 AS VARCHAR) || '.00' AS change,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN ' % '
              ELSE CAST((o_orderkey % 41) - 20 AS VARCHAR) || '.25%' END AS change_1,
         CAST(o_orderkey % 7 AS VARCHAR) || '.5%' AS idx_wtg,
         CAST(o_orderkey % 9 AS VARCHAR) || '.125' AS idx_point,
         format('{:,.2f}', CAST(o_custkey * 1000 AS DOUBLE)) AS volume,
         '1,000.5' AS shares_m,
         CASE WHEN o_orderkey % 31 = 0 THEN '-' ELSE format('{:,.2f}', o_totalprice * 2) END AS market_cap_m
  FROM orders
)""",
    "sector_map": """
sector_map AS (
  SELECT 'C' || CAST(k AS VARCHAR) AS symbol, r_name AS sector
  FROM (SELECT DISTINCT c_custkey AS k FROM customer) d
  JOIN region ON k % 5 = r_regionkey
  WHERE k % 10 < 9
)""",
    "holdings": """
holdings AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS symbol, n_name AS sector,
         CAST(c_custkey % 40 + 1 AS BIGINT) AS qty_held,
         CAST(abs(c_acctbal) + 100000 AS DECIMAL(18,4)) AS avg_buy_rate,
         CASE WHEN c_custkey % 8 = 0 THEN 'sold' ELSE 'active' END AS status
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 = 0
)""",
    "trades": """
trades AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS trade_id,
         'B' || CAST(l_suppkey AS VARCHAR) AS broker,
         'P' || CAST(l_partkey AS VARCHAR) AS symbol,
         CASE WHEN l_returnflag = 'R' THEN 'sell' ELSE 'buy' END AS trade_type,
         CAST(l_shipdate AS DATE) AS trade_date,
         CAST(trunc(l_quantity) AS BIGINT) AS qty,
         CAST(l_extendedprice AS DECIMAL(18,4)) AS gross_rate,
         CAST(l_tax * 100 AS DECIMAL(18,4)) AS comm,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_discount * 10 AS DECIMAL(18,4)) END AS cdc_amt,
         CAST(0.02 AS DECIMAL(18,4)) AS lsn,
         CAST(l_tax * 10 AS DECIMAL(18,4)) AS sst,
         CAST(NULL AS DECIMAL(18,4)) AS net_amount,
         CASE WHEN l_linenumber = 7 THEN 'rebalance' END AS reason
  FROM lineitem
)""",
    "tax": """
tax AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cgt_id, o_orderpriority AS broker,
         strftime(o_orderdate, '%Y-%m') AS period_month,
         'C' || CAST(o_custkey AS VARCHAR) AS symbol,
         CAST(1 AS BIGINT) AS qty, CAST(o_orderdate AS DATE) AS settlement_date,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_totalprice - 250000 AS DECIMAL(18,4)) END AS capital_gain_loss,
         CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DECIMAL(18,4)) END AS provisional_cgt,
         CAST(o_orderkey % 100000 AS DECIMAL(18,4)) AS cgt_payable_cumulative,
         CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 90000 AS DECIMAL(18,4)) END AS cgt_collected_cumulative,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_custkey AS DECIMAL(18,4)) END AS cgt_shortfall,
         CASE WHEN o_orderkey % 7 = 1 THEN CAST(o_custkey AS DECIMAL(18,4)) END AS cgt_refund
  FROM orders
)""",
}


def with_feeds(body: str, *feeds: str, extra: tuple[str, ...] = ()) -> str:
    """Prefix ``body`` with the CTEs of the named feeds plus extra CTE text."""
    ctes = [FEED_SQL[f].strip() for f in feeds] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()


def xround(num: str, den: str, n: int, scale: int = 8) -> str:
    """SQL for round(num / den, n) with exact half-away-from-zero rounding.

    ``num`` and ``den`` are DECIMAL expressions with at most ``scale``
    fractional digits.  Result is a DECIMAL(38, n); NULL when den is 0/NULL.
    """
    f = 10 ** scale
    N = f"CAST(({num}) * {f} AS HUGEINT)"
    D = f"CAST(({den}) * {f} AS HUGEINT)"
    p = 10 ** n
    q = f"((abs({N}) * {2 * p} + abs({D})) // (2 * abs({D})))"
    signed = f"(sign({N}) * sign({D}) * {q})"
    if n == 0:
        val = f"CAST({signed} AS DECIMAL(38,0))"
    else:
        unit = "0." + "0" * (n - 1) + "1"
        val = f"(CAST({signed} AS DECIMAL({38 - n},0)) * CAST({unit} AS DECIMAL({n},{n})))"
    return f"(CASE WHEN ({den}) = 0 THEN NULL ELSE {val} END)"


def exact(value: str) -> str:
    """SQL for the DOUBLE nearest to a DECIMAL of many digits (a direct cast can be off by one unit)."""
    return f"CAST(CAST({value} AS VARCHAR) AS DOUBLE)"
