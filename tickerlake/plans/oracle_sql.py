"""DuckDB oracle text per catalogued query (see ``oracle`` for the rules)."""

from __future__ import annotations

from tickerlake.plans.oracle import exact, with_feeds, xround

ORACLE: dict[str, str] = {}


def _d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


ORACLE["stg_bars"] = with_feeds("""
SELECT id, symbol, price_date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
       CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume,
       CAST(dividends AS DOUBLE) AS dividends, CAST(stock_splits AS DOUBLE) AS stock_splits, fetched_at
FROM bars""", "bars")

# Frame statistics of every priced bar, shared by the indicator queries.
_FRAMES = """
frames AS (
  SELECT symbol, price_date, close, volume, chg,
         CAST(sum(close) OVER w50 AS DECIMAL(30,4)) AS s50, count(close) OVER w50 AS n50,
         CAST(sum(close) OVER w200 AS DECIMAL(30,4)) AS s200, count(close) OVER w200 AS n200,
         max(high) OVER w252 AS hi, min(low) OVER w252 AS lo,
         CAST(sum(volume) OVER w20 AS DECIMAL(30,0)) AS sv, count(volume) OVER w20 AS nv,
         CAST(sum(CASE WHEN chg > 0 THEN chg ELSE 0 END) OVER w14 AS DECIMAL(30,4)) AS g,
         CAST(sum(CASE WHEN chg < 0 THEN -chg ELSE 0 END) OVER w14 AS DECIMAL(30,4)) AS l,
         count(chg) OVER w14 AS nc,
         row_number() OVER (PARTITION BY symbol ORDER BY price_date DESC) AS rn
  FROM (SELECT symbol, price_date, high, low, close, volume,
               close - lag(close) OVER (PARTITION BY symbol ORDER BY price_date) AS chg
        FROM bars WHERE close IS NOT NULL) c
  WINDOW w50 AS (PARTITION BY symbol ORDER BY price_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
         w200 AS (PARTITION BY symbol ORDER BY price_date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW),
         w252 AS (PARTITION BY symbol ORDER BY price_date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW),
         w20 AS (PARTITION BY symbol ORDER BY price_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
         w14 AS (PARTITION BY symbol ORDER BY price_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
)"""

def indicator_cols(double: bool = True) -> str:
    d = _d if double else (lambda e: e)
    return f"""
symbol, price_date, {d('close')} AS close, volume,
{d("CASE WHEN n50 = 50 THEN round(s50 * 0.02, 4) END")} AS sma_50,
{d("CASE WHEN n50 = 50 THEN " + xround("100 * (50 * close - s50)", "s50", 2) + " END")} AS pct_vs_sma_50,
{d("CASE WHEN n200 = 200 THEN round(s200 * 0.005, 4) END")} AS sma_200,
{d("CASE WHEN n200 = 200 THEN " + xround("100 * (200 * close - s200)", "s200", 2) + " END")} AS pct_vs_sma_200,
{d("CASE WHEN nc = 14 THEN CASE WHEN coalesce(l, 0) = 0 THEN 100 ELSE " + xround("100 * g", "g + l", 2) + " END END")} AS rsi_14,
{d('hi')} AS high_52w, {d('lo')} AS low_52w,
{d(xround("100 * (close - hi)", "hi", 2))} AS pct_vs_high_52w,
{d("CASE WHEN nv = 20 THEN round(sv * 0.05, 2) END")} AS avg_volume_20,
{d("CASE WHEN nv = 20 THEN " + xround("20 * CAST(volume AS DECIMAL(30,0))", "sv", 2) + " END")} AS volume_ratio_20
"""


_INDICATOR_COLS = indicator_cols()

ORACLE["technical_indicators"] = with_feeds(
    f"SELECT {_INDICATOR_COLS} FROM frames WHERE rn = 1", "bars", extra=(_FRAMES,))


# --- raw scans and cleaning -------------------------------------------------------

ORACLE["scan_board"] = with_feeds("SELECT * FROM board", "board")
ORACLE["scan_bars"] = ORACLE["stg_bars"]

ORACLE["clean_strings"] = with_feeds("""
SELECT id, trim(replace(symbol, ' XD', '')) AS symbol,
       replace(trim(ldcp), ',', '') AS ldcp_clean,
       replace(trim("current"), ',', '') AS current_clean,
       replace(replace(trim(change_1), '%', ''), ',', '') AS change_pct_clean,
       replace(replace(trim(idx_wtg), '%', ''), ',', '') AS idx_weight_clean,
       replace(trim(market_cap_m), ',', '') AS market_cap_clean
FROM board""", "board")

_NUMERIC = (("ldcp", "ldcp", False), ("current_price", '"current"', False), ("change_amount", "change", False),
            ("change_pct", "change_1", True), ("idx_weight", "idx_wtg", True), ("idx_point", "idx_point", False),
            ("volume", "volume", False), ("shares_m", "shares_m", False), ("market_cap_m", "market_cap_m", False))


def stg_board_cte(exclusions, partition="fetched_at", name="stg_board") -> str:
    cleaned = ",\n      ".join(
        (f"replace(replace(trim({src}), '%', ''), ',', '')" if pct else f"replace(trim({src}), ',', '')")
        + f" AS {out}_clean" for out, src, pct in _NUMERIC)
    typed = ",\n    ".join(f"TRY_CAST(nullif({out}_clean, '') AS DECIMAL(20,6)) AS {out}" for out, _, _ in _NUMERIC)
    excl = "".join(
        f"\n    AND NOT (symbol = '{s}' AND ldcp_clean = '{a}' AND current_price_clean = '{b}')"
        for s, a, b in exclusions)
    return f"""
{name} AS (
  SELECT id, fetched_at, symbol, name,
    {typed}
  FROM (
    SELECT id, fetched_at, symbol, name,
      {cleaned},
      row_number() OVER (PARTITION BY {partition}, symbol ORDER BY id DESC NULLS FIRST) AS rn
    FROM (SELECT * REPLACE (trim(replace(symbol, ' XD', '')) AS symbol) FROM board) s
  ) c
  WHERE rn = 1{excl}
)"""


# Fixed values (same list as the Spark default).
_DEFAULT_EXCL = (("ENGRO", "285.50", "287.00"), ("LUCK", "920.00", "915.00"), ("HBL", "145.00", "146.50"),
                 ("PSO", "310.00", "308.00"), ("TRG", "98.50", "99.00"))
_TEST_EXCL = tuple((f"C{k}", "", "") for k in range(0, 100, 7))

STG_BOARD = stg_board_cte(_DEFAULT_EXCL)

_BOARD_OUT = "id, fetched_at, symbol, name, " + ", ".join(
    f"CAST({o} AS DOUBLE) AS {o}" for o, _, _ in _NUMERIC)

ORACLE["stg_board"] = with_feeds(f"SELECT {_BOARD_OUT} FROM stg_board", "board", extra=(STG_BOARD,))
ORACLE["stg_board_dedupe"] = with_feeds(
    f"SELECT {_BOARD_OUT} FROM stg_board", "board",
    extra=(stg_board_cte((), partition="CAST(fetched_at AS DATE)"),))
ORACLE["stg_board_intraday"] = with_feeds(
    f"SELECT {_BOARD_OUT} FROM stg_board", "board",
    extra=("hourly AS (SELECT * REPLACE (fetched_at + to_hours(CAST(id % 24 AS INT)) AS fetched_at) FROM board)",
           stg_board_cte((), partition="CAST(fetched_at AS DATE)").replace("FROM board)", "FROM hourly)")))
ORACLE["clean_strict"] = with_feeds("""
SELECT id, CAST(replace(replace(trim(idx_wtg), '%', ''), ',', '') AS DOUBLE) AS idx_weight,
       CAST(replace(trim(volume), ',', '') AS DOUBLE) AS volume, true AS refused FROM board""", "board")
ORACLE["stg_board_exclusions"] = with_feeds(
    f"SELECT {_BOARD_OUT} FROM stg_board", "board", extra=(stg_board_cte(_DEFAULT_EXCL + _TEST_EXCL),))


def _board_q(body: str, *more_feeds: str, extra=()) -> str:
    return with_feeds(body, "board", *more_feeds, extra=(STG_BOARD,) + tuple(extra))


# --- market marts --------------------------------------------------------------------

_MOVER = ("fetched_at, symbol, name, CAST(ldcp AS DOUBLE) AS ldcp, CAST(current_price AS DOUBLE) AS current_price, "
          "CAST(change_amount AS DOUBLE) AS change_amount, CAST(change_pct AS DOUBLE) AS change_pct, "
          "CAST(volume AS DOUBLE) AS volume, CAST(market_cap_m AS DOUBLE) AS market_cap_m")

ORACLE["top_movers"] = _board_q(f"SELECT {_MOVER} FROM stg_board WHERE change_pct IS NOT NULL")
ORACLE["top_movers_k"] = _board_q(f"""
SELECT {_MOVER}, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY fetched_at ORDER BY change_pct DESC, symbol ASC) AS rank
  FROM stg_board WHERE change_pct IS NOT NULL) t
WHERE rank <= 3""")
ORACLE["top_movers_global_k"] = _board_q(f"""
SELECT {_MOVER} FROM stg_board WHERE change_pct IS NOT NULL
ORDER BY change_pct DESC, symbol ASC, fetched_at ASC LIMIT 10""")
ORACLE["volume_leaders_k"] = _board_q("""
SELECT fetched_at, symbol, name, CAST(current_price AS DOUBLE) AS current_price,
       CAST(change_pct AS DOUBLE) AS change_pct, CAST(volume AS DOUBLE) AS volume, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY fetched_at ORDER BY volume DESC NULLS LAST, symbol ASC) AS rank
  FROM stg_board WHERE volume IS NOT NULL) t
WHERE rank <= 5""")
ORACLE["market_trend"] = _board_q(f"""
SELECT fetched_at, count(DISTINCT symbol) AS symbols,
       count(*) FILTER (WHERE change_pct > 0) AS advancers,
       count(*) FILTER (WHERE change_pct < 0) AS decliners,
       count(*) FILTER (WHERE change_pct = 0) AS unchanged,
       {_d(xround('sum(change_pct)', 'count(change_pct)', 2))} AS avg_change_pct,
       CAST(sum(volume) AS DOUBLE) AS total_volume, CAST(sum(market_cap_m) AS DOUBLE) AS total_market_cap_m
FROM stg_board GROUP BY fetched_at""")

_SECTOR = f"""
sector_summary AS (
  SELECT s.fetched_at, coalesce(m.sector, 'Unknown') AS sector,
         count(DISTINCT s.symbol) AS total_stocks,
         {xround('sum(s.change_pct)', 'count(s.change_pct)', 2)} AS avg_change_pct,
         sum(s.volume) AS total_volume, sum(s.market_cap_m) AS total_market_cap_m,
         {xround('sum(s.current_price)', 'count(s.current_price)', 2)} AS avg_price
  FROM stg_board s LEFT JOIN sector_map m ON s.symbol = m.symbol
  GROUP BY s.fetched_at, coalesce(m.sector, 'Unknown')
)"""

ORACLE["sector_summary"] = _board_q("""
SELECT fetched_at, sector, total_stocks, CAST(avg_change_pct AS DOUBLE) AS avg_change_pct,
       CAST(total_volume AS DOUBLE) AS total_volume, CAST(total_market_cap_m AS DOUBLE) AS total_market_cap_m,
       CAST(avg_price AS DOUBLE) AS avg_price
FROM sector_summary""", "sector_map", extra=(_SECTOR,))
ORACLE["sector_market_cap"] = _board_q("""
SELECT fetched_at, sector, CAST(total_market_cap_m AS DOUBLE) AS total_market_cap_m,
       CAST(avg_change_pct AS DOUBLE) AS avg_change_pct
FROM sector_summary WHERE fetched_at = (SELECT max(fetched_at) FROM sector_summary)""",
    "sector_map", extra=(_SECTOR,))

# --- portfolio marts ------------------------------------------------------------------

_LATEST = """
latest_board AS (
  SELECT symbol, current_price, change_pct, CAST(fetched_at AS DATE) AS price_date
  FROM stg_board WHERE CAST(fetched_at AS DATE) = (SELECT max(CAST(fetched_at AS DATE)) FROM stg_board)
)"""

_SNAPSHOT = f"""
snapshot AS (
  SELECT h.symbol, h.sector, h.qty_held, h.avg_buy_rate,
         h.qty_held * h.avg_buy_rate AS total_cost,
         p.current_price, p.change_pct AS todays_change_pct,
         h.qty_held * p.current_price AS current_value,
         h.qty_held * p.current_price - h.qty_held * h.avg_buy_rate AS unrealized_pnl,
         {xround('(p.current_price - h.avg_buy_rate) * 100', 'h.avg_buy_rate', 2)} AS unrealized_pct,
         p.price_date
  FROM holdings h JOIN latest_board p ON h.symbol = p.symbol
  WHERE h.status = 'active'
)"""


def _snap_q(body: str) -> str:
    return _board_q(body, "holdings", extra=(_LATEST, _SNAPSHOT))


ORACLE["latest_board"] = _board_q("""
SELECT symbol, CAST(current_price AS DOUBLE) AS current_price, CAST(change_pct AS DOUBLE) AS change_pct, price_date
FROM latest_board""", extra=(_LATEST,))
ORACLE["holdings_active"] = with_feeds("""
SELECT symbol, sector, qty_held, CAST(avg_buy_rate AS DOUBLE) AS avg_buy_rate, status
FROM holdings WHERE status = 'active'""", "holdings")
ORACLE["portfolio_snapshot"] = _snap_q("""
SELECT symbol, sector, qty_held, CAST(avg_buy_rate AS DOUBLE) AS avg_buy_rate, CAST(total_cost AS DOUBLE) AS total_cost,
       CAST(current_price AS DOUBLE) AS current_price, CAST(todays_change_pct AS DOUBLE) AS todays_change_pct,
       CAST(current_value AS DOUBLE) AS current_value, CAST(unrealized_pnl AS DOUBLE) AS unrealized_pnl,
       CAST(unrealized_pct AS DOUBLE) AS unrealized_pct, price_date
FROM snapshot""")
_SUMMARY = f"""
summary AS (
  SELECT price_date, sum(total_cost) AS total_invested, sum(current_value) AS total_current_value,
         sum(unrealized_pnl) AS total_unrealized_pnl,
         {xround('sum(unrealized_pnl) * 100', 'sum(total_cost)', 2)} AS total_unrealized_pct,
         count(symbol) AS holdings_count
  FROM snapshot GROUP BY price_date
)"""
ORACLE["portfolio_summary"] = _board_q("""
SELECT price_date, CAST(total_invested AS DOUBLE) AS total_invested,
       CAST(total_current_value AS DOUBLE) AS total_current_value,
       CAST(total_unrealized_pnl AS DOUBLE) AS total_unrealized_pnl,
       CAST(total_unrealized_pct AS DOUBLE) AS total_unrealized_pct, holdings_count
FROM summary""", "holdings", extra=(_LATEST, _SNAPSHOT, _SUMMARY))
ORACLE["portfolio_weights"] = _snap_q(f"""
SELECT s.symbol, s.price_date, CAST(s.current_value AS DOUBLE) AS current_value,
       {_d(xround('s.current_value * 100', 't.total', 2))} AS weight_pct
FROM snapshot s JOIN (SELECT price_date, sum(current_value) AS total FROM snapshot GROUP BY price_date) t
  ON s.price_date = t.price_date""")
ORACLE["portfolio_weighted_change"] = _snap_q(f"""
SELECT price_date,
       {_d(xround('sum(current_value * todays_change_pct)', 'sum(CASE WHEN todays_change_pct IS NOT NULL THEN current_value END)', 2, scale=12))} AS weighted_change_pct
FROM snapshot GROUP BY price_date""")

_CHARGES = "coalesce(comm, 0) + coalesce(cdc_amt, 0) + coalesce(lsn, 0) + coalesce(sst, 0)"

ORACLE["trade_charges"] = with_feeds(f"""
SELECT trade_id, broker, symbol, trade_type, trade_date, CAST({_CHARGES} AS DOUBLE) AS charges
FROM trades""", "trades")

_AVG_BUY = f"""
avg_buy AS (
  SELECT broker, symbol,
         {xround('sum(qty * gross_rate)', 'sum(qty)', 4)} AS avg_buy_rate,
         sum(qty) AS total_buy_qty, sum({_CHARGES}) AS total_buy_charges
  FROM trades WHERE trade_type = 'buy'
  GROUP BY broker, symbol
)"""

ORACLE["avg_buy"] = with_feeds("""
SELECT broker, symbol, CAST(avg_buy_rate AS DOUBLE) AS avg_buy_rate, CAST(total_buy_qty AS BIGINT) AS total_buy_qty,
       CAST(total_buy_charges AS DOUBLE) AS total_buy_charges
FROM avg_buy""", "trades", extra=(_AVG_BUY,))

_REALIZED = f"""
realized AS (
  SELECT s.trade_id, s.broker, s.symbol, s.trade_date AS sell_date, s.qty AS sell_qty, s.gross_rate AS sell_rate,
         b.avg_buy_rate,
         s.qty * s.gross_rate AS gross_proceeds,
         s.qty * b.avg_buy_rate AS cost_basis,
         s.qty * s.gross_rate - s.qty * b.avg_buy_rate AS gross_pnl,
         ({_CHARGES.replace('coalesce(', 'coalesce(s.')}) + {xround('b.total_buy_charges * s.qty', 'b.total_buy_qty', 12)} AS allocated_charges,
         s.qty * s.gross_rate - s.qty * b.avg_buy_rate - ({_CHARGES.replace('coalesce(', 'coalesce(s.')})
           - {xround('b.total_buy_charges * s.qty', 'b.total_buy_qty', 12)} AS net_pnl,
         {xround('(s.qty * s.gross_rate - s.qty * b.avg_buy_rate) * 100', 's.qty * b.avg_buy_rate', 2)} AS gross_pnl_pct,
         s.reason
  FROM trades s LEFT JOIN avg_buy b ON s.broker = b.broker AND s.symbol = b.symbol
  WHERE s.trade_type = 'sell'
)"""

_REALIZED_OUT = f"""
SELECT trade_id, broker, symbol, sell_date, sell_qty, CAST(sell_rate AS DOUBLE) AS sell_rate,
       CAST(avg_buy_rate AS DOUBLE) AS avg_buy_rate, CAST(gross_proceeds AS DOUBLE) AS gross_proceeds,
       CAST(cost_basis AS DOUBLE) AS cost_basis, CAST(gross_pnl AS DOUBLE) AS gross_pnl,
       {exact('allocated_charges')} AS allocated_charges, {exact('net_pnl')} AS net_pnl,
       CAST(gross_pnl_pct AS DOUBLE) AS gross_pnl_pct, reason
FROM realized"""
ORACLE["portfolio_trades"] = with_feeds(_REALIZED_OUT, "trades", extra=(_AVG_BUY, _REALIZED))

# As of each day: every buy of the pair dated up to it, summed by a range join.
_AVG_BUY_ASOF = f"""
avg_buy AS (
  SELECT s.broker, s.symbol, s.trade_date,
         {xround('sum(b.qty * b.gross_rate)', 'sum(b.qty)', 4)} AS avg_buy_rate,
         sum(b.qty) AS total_buy_qty, sum({_CHARGES.replace('coalesce(', 'coalesce(b.')}) FILTER (b.trade_type = 'buy') AS total_buy_charges
  FROM (SELECT DISTINCT broker, symbol, trade_date FROM trades WHERE trade_type = 'sell') s
  LEFT JOIN trades b ON b.trade_type = 'buy' AND b.broker = s.broker AND b.symbol = s.symbol AND b.trade_date <= s.trade_date
  WHERE s.broker IS NOT NULL AND s.symbol IS NOT NULL AND s.trade_date IS NOT NULL
  GROUP BY s.broker, s.symbol, s.trade_date
)"""
ORACLE["avg_buy_asof"] = with_feeds("""
SELECT broker, symbol, trade_date, CAST(avg_buy_rate AS DOUBLE) AS avg_buy_rate, CAST(total_buy_qty AS BIGINT) AS total_buy_qty,
       CAST(total_buy_charges AS DOUBLE) AS total_buy_charges
FROM avg_buy""", "trades", extra=(_AVG_BUY_ASOF,))
ORACLE["portfolio_trades_asof"] = with_feeds(_REALIZED_OUT, "trades", extra=(
    _AVG_BUY_ASOF, _REALIZED.replace("s.symbol = b.symbol", "s.symbol = b.symbol AND s.trade_date = b.trade_date")))
ORACLE["realized_pnl"] = with_feeds(f"""
SELECT {exact('coalesce(sum(net_pnl), 0)')} AS realized_pnl, count(*) AS closed_trades
FROM realized""", "trades", extra=(_AVG_BUY, _REALIZED))

ORACLE["tax_summary"] = with_feeds("""
SELECT broker, period_month,
  CAST(round(sum(coalesce(capital_gain_loss, 0)), 2) AS DOUBLE) AS net_gain_loss,
  CAST(round(sum(coalesce(provisional_cgt, 0)), 2) AS DOUBLE) AS provisional_cgt,
  CAST(round(max(coalesce(cgt_payable_cumulative, 0)), 2) AS DOUBLE) AS cgt_payable_cumulative,
  CAST(round(max(coalesce(cgt_collected_cumulative, 0)), 2) AS DOUBLE) AS cgt_collected_cumulative,
  CAST(round(max(coalesce(cgt_shortfall, 0)), 2) AS DOUBLE) AS cgt_shortfall,
  CAST(round(max(coalesce(cgt_refund, 0)), 2) AS DOUBLE) AS cgt_refund,
  CAST(round(max(coalesce(cgt_collected_cumulative, 0)) - max(coalesce(cgt_payable_cumulative, 0)), 2) AS DOUBLE)
    AS cgt_over_under_collected
FROM tax GROUP BY broker, period_month""", "tax")


# --- indicator history ----------------------------------------------------------------------

_HISTORY = f"history AS (SELECT {_INDICATOR_COLS} FROM frames)"


def _hist_q(cols: str) -> str:
    return with_feeds(f"SELECT {cols} FROM history", "bars", extra=(_FRAMES, _HISTORY))


ORACLE["indicator_history"] = _hist_q("*")
ORACLE["sma_history"] = _hist_q("symbol, price_date, close, sma_50, pct_vs_sma_50, sma_200, pct_vs_sma_200")
ORACLE["range_52w_history"] = _hist_q("symbol, price_date, close, high_52w, low_52w, pct_vs_high_52w")
ORACLE["volume_ratio_history"] = _hist_q("symbol, price_date, volume, avg_volume_20, volume_ratio_20")
ORACLE["rsi_history"] = _hist_q("symbol, price_date, close, rsi_14")
ORACLE["technical_indicators_via_history"] = ORACLE["technical_indicators"]
ORACLE["price_changes"] = with_feeds("""
SELECT symbol, price_date, CAST(close AS DOUBLE) AS close, CAST(prev AS DOUBLE) AS prev_close,
       CAST(close - prev AS DOUBLE) AS price_change
FROM (SELECT symbol, price_date, close, lag(close) OVER (PARTITION BY symbol ORDER BY price_date) AS prev
      FROM bars WHERE close IS NOT NULL) t""", "bars")

# --- data quality ------------------------------------------------------------------------------

ORACLE["dq_not_null"] = _board_q("SELECT id, fetched_at, symbol FROM stg_board WHERE ldcp IS NULL")
ORACLE["dq_unique"] = _board_q("""
SELECT symbol, count(*) AS n_records FROM stg_board WHERE symbol IS NOT NULL
GROUP BY symbol HAVING count(*) > 1""")
ORACLE["dq_unique_combo"] = with_feeds("""
SELECT trade_id, broker, count(*) AS n_records FROM trades GROUP BY trade_id, broker HAVING count(*) > 1""",
                                       "trades")
ORACLE["dq_relationships"] = _board_q("""
SELECT id, symbol FROM stg_board s
WHERE symbol IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sector_map m WHERE m.symbol = s.symbol)""", "sector_map")
ORACLE["dq_expression"] = _board_q("""
SELECT id, symbol, CAST(change_amount AS DOUBLE) AS change_amount FROM stg_board
WHERE change_amount IS NOT NULL AND NOT (change_amount >= 0)""")


# Name, dataset and failing rows (or keys) of each declared check, written out apart from the library's list.
_CHECKS = (
    ("stg_board.id.unique", "stg_board", "(SELECT id FROM stg_board WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)"),
    ("stg_board.id.not_null", "stg_board", "stg_board WHERE id IS NULL"),
    ("stg_board.symbol.not_null", "stg_board", "stg_board WHERE symbol IS NULL"),
    ("stg_board.fetched_at.not_null", "stg_board", "stg_board WHERE fetched_at IS NULL"),
    ("stg_board.current_price.positive", "stg_board", "stg_board WHERE current_price <= 0"),
    ("stg_board.change_pct.range", "stg_board", "stg_board WHERE change_pct < -50 OR change_pct > 50"),
    ("stg_board.volume.non_negative", "stg_board", "stg_board WHERE volume < 0"),
    ("stg_bars.symbol.not_null", "stg_bars", "stg_bars WHERE symbol IS NULL"),
    ("stg_bars.price_date.not_null", "stg_bars", "stg_bars WHERE price_date IS NULL"),
    ("stg_bars.close.not_null", "stg_bars", "stg_bars WHERE close IS NULL"),
    ("stg_bars.volume.non_negative", "stg_bars", "stg_bars WHERE volume < 0"),
    ("stg_bars.symbol_price_date.unique", "stg_bars", "(SELECT symbol FROM stg_bars GROUP BY symbol, price_date HAVING count(*) > 1)"),
    ("snapshot.symbol.unique", "portfolio_snapshot", "(SELECT symbol FROM portfolio_snapshot WHERE symbol IS NOT NULL GROUP BY symbol HAVING count(*) > 1)"),
    ("snapshot.symbol.not_null", "portfolio_snapshot", "portfolio_snapshot WHERE symbol IS NULL"),
    ("snapshot.symbol.in_holdings", "portfolio_snapshot", "portfolio_snapshot WHERE symbol NOT IN (SELECT symbol FROM holdings WHERE symbol IS NOT NULL)"),
    ("snapshot.qty_held.not_null", "portfolio_snapshot", "portfolio_snapshot WHERE qty_held IS NULL"),
    ("snapshot.qty_held.positive", "portfolio_snapshot", "portfolio_snapshot WHERE qty_held <= 0"),
    ("snapshot.avg_buy_rate.not_null", "portfolio_snapshot", "portfolio_snapshot WHERE avg_buy_rate IS NULL"),
    ("snapshot.avg_buy_rate.positive", "portfolio_snapshot", "portfolio_snapshot WHERE avg_buy_rate <= 0"),
    ("snapshot.total_cost.not_null", "portfolio_snapshot", "portfolio_snapshot WHERE total_cost IS NULL"),
    ("snapshot.total_cost.positive", "portfolio_snapshot", "portfolio_snapshot WHERE total_cost <= 0"),
    ("snapshot.unrealized_pct.range", "portfolio_snapshot", "portfolio_snapshot WHERE unrealized_pct < -100 OR unrealized_pct > 1000"),
    ("summary.price_date.unique", "portfolio_summary", "(SELECT price_date FROM portfolio_summary WHERE price_date IS NOT NULL GROUP BY price_date HAVING count(*) > 1)"),
    ("summary.price_date.not_null", "portfolio_summary", "portfolio_summary WHERE price_date IS NULL"),
    ("summary.total_invested.not_null", "portfolio_summary", "portfolio_summary WHERE total_invested IS NULL"),
    ("summary.total_invested.positive", "portfolio_summary", "portfolio_summary WHERE total_invested <= 0"),
    ("summary.total_current_value.not_null", "portfolio_summary", "portfolio_summary WHERE total_current_value IS NULL"),
    ("summary.total_current_value.positive", "portfolio_summary", "portfolio_summary WHERE total_current_value <= 0"),
    ("summary.holdings_count.not_null", "portfolio_summary", "portfolio_summary WHERE holdings_count IS NULL"),
    ("summary.holdings_count.positive", "portfolio_summary", "portfolio_summary WHERE holdings_count <= 0"),
    ("indicators.symbol.unique", "technical_indicators", "(SELECT symbol FROM technical_indicators WHERE symbol IS NOT NULL GROUP BY symbol HAVING count(*) > 1)"),
    ("indicators.symbol.not_null", "technical_indicators", "technical_indicators WHERE symbol IS NULL"),
    ("indicators.close.not_null", "technical_indicators", "technical_indicators WHERE close IS NULL"),
)


def _dq_report_sql() -> str:
    body = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS check_name, '{table}' AS \"table\", count(*) AS failures FROM {bad}" for name, table, bad in _CHECKS)
    marts = (
        "stg_bars AS (SELECT * FROM bars)",
        _LATEST, _SNAPSHOT, _SUMMARY,
        "portfolio_snapshot AS (SELECT * FROM snapshot)",
        "portfolio_summary AS (SELECT * FROM summary)",
        _FRAMES,
        f"technical_indicators AS (SELECT {_INDICATOR_COLS} FROM frames WHERE rn = 1)",
    )
    return with_feeds(f'SELECT check_name, "table", failures, failures = 0 AS passed FROM ({body}) r',
                      "board", "bars", "holdings", extra=(STG_BOARD,) + marts)


ORACLE["dq_report"] = _dq_report_sql()

# --- report --------------------------------------------------------------------------------------

_GREEN, _RED = "#0a7d2c", "#c02626"


def _fixed(x: str, n: int, plus: bool = False) -> str:
    sign = f"CASE WHEN {x} < 0 THEN '-' ELSE '{'+' if plus else ''}' END"
    return f"({sign} || CAST(CAST(round_even(abs({x}), {n}) AS DECIMAL(38,{n})) AS VARCHAR))"


def _money(x: str) -> str:
    return f"coalesce({_fixed(x, 2)}, 'n/a')"


def _color(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN '{_GREEN}' ELSE '{_RED}' END"


ORACLE["report_summary"] = _board_q(f"""
SELECT s.price_date,
       {_money('s.total_current_value')} AS total_current_value, {_money('s.total_invested')} AS total_invested,
       {_money('s.total_unrealized_pnl')} AS total_unrealized_pnl,
       {_money('s.total_unrealized_pct')} AS total_unrealized_pct,
       {_color('s.total_unrealized_pnl')} AS unrealized_color, s.holdings_count,
       {_money('p.realized_pnl')} AS realized_pnl, {_color('p.realized_pnl')} AS realized_color, p.closed_trades,
       'Portfolio Update — ' || CAST(s.price_date AS VARCHAR) AS subject
FROM (SELECT * FROM summary ORDER BY price_date DESC LIMIT 1) s,
     (SELECT coalesce(sum(net_pnl), 0) AS realized_pnl, count(*) AS closed_trades FROM realized) p""",
    "holdings", "trades", extra=(_LATEST, _SNAPSHOT, _SUMMARY, _AVG_BUY, _REALIZED))
ORACLE["report_holdings"] = _snap_q(f"""
SELECT symbol, {_money('current_price')} AS current_price, {_money('todays_change_pct')} AS todays_change_pct,
       {_color('todays_change_pct')} AS change_color, {_money('current_value')} AS current_value,
       {_money('unrealized_pnl')} AS unrealized_pnl, {_color('unrealized_pnl')} AS pnl_color
FROM snapshot""")

_LINES = f"""
lines AS (
  SELECT symbol,
         'vs 200DMA: ' || coalesce({_fixed('pct_vs_sma_200', 0, plus=True)} || '%', 'n/a')
         || ' | RSI: ' || coalesce({_fixed('rsi_14', 0)}, 'n/a')
         || ' | vol: ' || coalesce({_fixed('volume_ratio_20', 1)} || 'x', 'n/a') AS technicals_line
  FROM (SELECT {indicator_cols(double=False)} FROM frames WHERE rn = 1) i
)"""

ORACLE["technicals_lines"] = with_feeds("SELECT symbol, technicals_line FROM lines", "bars",
                                        extra=(_FRAMES, _LINES))
ORACLE["report_technicals"] = _board_q("""
SELECT s.symbol, coalesce(l.technicals_line, 'n/a') AS technicals_line
FROM snapshot s LEFT JOIN lines l ON s.symbol = l.symbol""", "holdings", "bars",
    extra=(_LATEST, _SNAPSHOT, _FRAMES, _LINES))

# --- JSON payloads ---------------------------------------------------------------------------------

ORACLE["json_props"] = """
SELECT event_id,
       CASE WHEN props IS NULL OR NOT json_valid(props) THEN -1
            ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS k
FROM events"""
ORACLE["json_explode"] = """
SELECT event_id, 2 AS number, 2 AS n_people, CAST(0 AS BIGINT) AS pos,
       'user ' || CAST(user_id AS VARCHAR) || ' is currently in space flying on the ' || event_type
       || '! Hello! :)' AS line
FROM events
UNION ALL
SELECT event_id, 2, 2, CAST(1 AS BIGINT),
       'event ' || CAST(event_id AS VARCHAR) || ' is currently in space flying on the ground! Hello! :)'
FROM events"""

# --- ingestion --------------------------------------------------------------------------------------

_BROKEN = "(event_type = 'error' AND event_id % 7 = 0)"
_NO_CLOSE = "(event_type = 'signup' AND event_id % 11 = 0)"

ORACLE["ingest_bars_quarantine"] = f"""
SELECT event_id, CASE WHEN {_BROKEN} THEN 'unparseable' ELSE 'missing field' END AS reason
FROM events WHERE {_BROKEN} OR {_NO_CLOSE}"""
ORACLE["ingest_bars_normalize"] = f"""
SELECT event_id, upper(event_type) AS symbol,
       CAST(timezone('UTC', timezone('Asia/Karachi', ts)) AS DATE) AS price_date,
       CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS open,
       CAST(CAST(value + 1 AS DECIMAL(18,4)) AS DOUBLE) AS high,
       CAST(CAST(value - 1 AS DECIMAL(18,4)) AS DOUBLE) AS low,
       CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS close,
       CAST(trunc(user_id * 1.5) AS BIGINT) AS volume,
       0.0::DOUBLE AS dividends, 0.0::DOUBLE AS stock_splits,
       TIMESTAMP '2024-02-01 13:15:00' AS fetched_at
FROM events WHERE NOT ({_BROKEN} OR {_NO_CLOSE})"""
ORACLE["ingest_bars_normalize_local"] = ORACLE["ingest_bars_normalize"].replace(
    "CAST(timezone('UTC', timezone('Asia/Karachi', ts)) AS DATE)", "CAST(ts AS DATE)")
ORACLE["upsert_insert_only"] = with_feeds("""
SELECT id, symbol, price_date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
       CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume,
       CAST(dividends AS DOUBLE) AS dividends, CAST(stock_splits AS DOUBLE) AS stock_splits, fetched_at
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, price_date ORDER BY arrival, id) AS rn
      FROM (SELECT *, 0 AS arrival FROM bars
            UNION ALL SELECT * REPLACE (close + 1 AS close), 1 AS arrival FROM bars) b) f
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM bars t WHERE t.price_date < DATE '1998-01-01'
                             AND t.symbol = f.symbol AND t.price_date = f.price_date)""", "bars")
ORACLE["incremental_copy"] = """
SELECT * FROM events
WHERE event_id > (SELECT coalesce(max(event_id), 0) FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00')"""

# --- ticks ---------------------------------------------------------------------------------------------

ORACLE["daily_bars"] = """
SELECT event_type AS symbol, CAST(ts AS DATE) AS price_date, min_by(value, event_id) AS open,
       max(value) AS high, min(value) AS low, max_by(value, event_id) AS close, count(*) AS volume
FROM events GROUP BY event_type, CAST(ts AS DATE)"""

ORACLE["stream_daily_bars"] = f"""
SELECT * FROM ({ORACLE["daily_bars"]}) d
WHERE price_date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""
ORACLE["stream_upsert_insert_only"] = ORACLE["stg_bars"]
ORACLE["stream_incremental_copy"] = "SELECT * FROM events"
ORACLE["seed_load"] = with_feeds("""
SELECT trade_id, broker, symbol, trade_type, trade_date, qty, CAST(gross_rate AS DOUBLE) AS gross_rate,
       CAST(comm AS DOUBLE) AS comm, CAST(cdc_amt AS DOUBLE) AS cdc_amt, CAST(lsn AS DOUBLE) AS lsn,
       CAST(sst AS DOUBLE) AS sst, CAST(net_amount AS DOUBLE) AS net_amount, reason
FROM trades""", "trades")

ORACLE["seed_load_holdings"] = with_feeds("""
SELECT symbol, sector, qty_held, CAST(avg_buy_rate AS DOUBLE) AS avg_buy_rate, status FROM holdings""", "holdings")
ORACLE["seed_load_sector_map"] = with_feeds("SELECT symbol, sector FROM sector_map", "sector_map")
_TAX_MONEY = ("capital_gain_loss", "provisional_cgt", "cgt_payable_cumulative", "cgt_collected_cumulative",
              "cgt_shortfall", "cgt_refund")
_TAX_EMPTY = ("holding_days", "cgt_slab_pct", "net_gain_loss_month", "gross_cgt_month", "net_cgt_month")
ORACLE["seed_load_tax"] = with_feeds(f"""
SELECT cgt_id, broker, period_month, symbol, qty, settlement_date,
       {", ".join(f"{_d(c)} AS {c}" for c in _TAX_MONEY)},
       {", ".join(f"{_d('NULL')} AS {c}" for c in _TAX_EMPTY)}
FROM tax""", "tax")
_TOO_LARGE = "event_id % 13 IN (1, 2)"
ORACLE["landed_files_quarantine"] = f"""
SELECT upper(event_type) AS symbol, CAST(timezone('UTC', timezone('Asia/Karachi', ts)) AS DATE) AS price_date,
       CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS close, CAST(trunc(user_id * 1.5) AS BIGINT) AS volume,
       NULL::VARCHAR AS reason
FROM events WHERE NOT ({_BROKEN} OR {_NO_CLOSE} OR {_TOO_LARGE})
UNION ALL
SELECT NULL, NULL, NULL, NULL,
       CASE WHEN {_BROKEN} THEN 'unparseable'
            WHEN {_NO_CLOSE} THEN 'missing field' ELSE 'bad value' END
FROM events WHERE {_BROKEN} OR {_NO_CLOSE} OR {_TOO_LARGE}"""

# Columns of the built datasets that hold text or days; all others are numbers.
_TEXTS = {"symbol", "name", "sector", "trade_id", "broker", "reason", "period_month"}
_DAYS = {"fetched_at", "price_date", "sell_date"}
_BOARD_COLS = "symbol name ldcp current_price change_amount change_pct volume market_cap_m"
_BUILT = {
    "stg_board": f"id fetched_at {_BOARD_COLS} idx_weight idx_point shares_m",
    "stg_bars": "id symbol price_date open high low close volume dividends stock_splits fetched_at",
    "top_movers": f"fetched_at {_BOARD_COLS}",
    "sector_summary": "fetched_at sector total_stocks avg_change_pct total_volume total_market_cap_m avg_price",
    "technical_indicators": "symbol price_date close volume sma_50 pct_vs_sma_50 sma_200 pct_vs_sma_200 rsi_14 high_52w "
                            "low_52w pct_vs_high_52w avg_volume_20 volume_ratio_20",
    "portfolio_snapshot": "symbol sector qty_held avg_buy_rate total_cost current_price todays_change_pct current_value "
                          "unrealized_pnl unrealized_pct price_date",
    "portfolio_summary": "price_date total_invested total_current_value total_unrealized_pnl total_unrealized_pct "
                         "holdings_count",
    "portfolio_trades": "trade_id broker symbol sell_date sell_qty sell_rate avg_buy_rate gross_proceeds cost_basis "
                        "gross_pnl allocated_charges net_pnl gross_pnl_pct reason",
    "tax_summary": "broker period_month net_gain_loss provisional_cgt cgt_payable_cumulative cgt_collected_cumulative "
                   "cgt_shortfall cgt_refund cgt_over_under_collected",
}


def _number(c: str) -> str:
    if c in _TEXTS:
        return f"length({c})"
    return f"date_diff('day', DATE '1970-01-01', CAST({c} AS DATE))" if c in _DAYS else c


ORACLE["build_all"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS dataset, '{c}' AS column_name, (SELECT count(*) FROM {name}_) AS n_rows, count({c}) AS n_values, "
    f"{exact(f'sum(CAST({_number(c)} AS DECIMAL(38,4)))')} AS total FROM {name}_"
    for name, cols in _BUILT.items() for c in cols.split())
# The 12-place amounts of trades are summed as decimals, as their doubles would round to 4 places differently.
_MART_SQL = {**ORACLE, "portfolio_trades": with_feeds("SELECT * FROM realized", "trades", extra=(_AVG_BUY, _REALIZED))}
ORACLE["build_all"] = ("WITH " + ",\n".join(f"{name}_ AS MATERIALIZED ({_MART_SQL[name]})" for name in _BUILT)
                       + "\n" + ORACLE["build_all"])
ORACLE["ingest_default_stamp"] = f"SELECT event_id, true AS stamped_now FROM events WHERE NOT ({_BROKEN} OR {_NO_CLOSE})"
ORACLE["marts_in_order"] = with_feeds("""
SELECT 'technical_indicators' AS dataset, count(DISTINCT symbol) AS n_rows, true AS in_order FROM bars WHERE close IS NOT NULL
UNION ALL SELECT 'tax_summary', count(DISTINCT (broker, period_month)), true FROM tax""", "bars", "tax")
ORACLE["landed_files_isolated"] = f"""
SELECT upper(event_type) AS symbol, CAST(timezone('UTC', timezone('Asia/Karachi', ts)) AS DATE) AS price_date,
       CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS close, NULL::VARCHAR AS reason
FROM events WHERE NOT ({_BROKEN} OR {_NO_CLOSE})
UNION ALL SELECT NULL, NULL, NULL, 'missing field' FROM events WHERE {_NO_CLOSE} AND NOT ({_BROKEN})
UNION ALL SELECT NULL, NULL, NULL, 'no readable record'"""
ORACLE["copy_by_id"] = """
SELECT event_id, ts, event_type, value, true AS files_apart FROM events
WHERE event_id > 0 AND NOT (event_id <= (SELECT max(event_id) * 4 // 10 FROM events) AND event_id % 97 = 0)"""
ORACLE["read_bars_range"] = (f"SELECT * FROM ({ORACLE['stg_bars']}) b "
                             "WHERE price_date BETWEEN DATE '1996-02-10' AND DATE '1997-03-20'")
ORACLE["read_board"] = ORACLE["scan_board"]
ORACLE["catalog_objects"] = with_feeds("""
SELECT symbol, sector, qty_held, CAST(avg_buy_rate AS DOUBLE) AS avg_buy_rate, true AS refused
FROM holdings WHERE status = 'active'""", "holdings")
ORACLE["stream_bars_sink"] = with_feeds("""
SELECT id, symbol, price_date, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low,
       CAST(close + raised AS DOUBLE) AS close, volume, CAST(dividends AS DOUBLE) AS dividends,
       CAST(stock_splits AS DOUBLE) AS stock_splits, fetched_at + to_days(raised) AS fetched_at
FROM (SELECT *, CASE WHEN price_date >= DATE '1998-01-01' AND id % 2 <> 0 THEN 1 ELSE 0 END AS raised FROM bars) b""", "bars")
_HELD = "ts < TIMESTAMP '2024-01-05' AND event_id % 50 = 0"
ORACLE["stream_dedupe_carried"] = f"""
SELECT event_id, ts, event_type, value,
       (SELECT count(*) FROM events WHERE {_HELD} OR CAST(ts AS DATE) = DATE '2024-01-08') AS late_rows
FROM events WHERE NOT ({_HELD})"""
# The second attempt repeats every fiftieth bar and fails that one check; the first attempt's datasets stay live.
ORACLE["publish_gate"] = f"""
WITH report AS MATERIALIZED ({ORACLE["dq_report"]}), twice AS (
  SELECT count(*) AS n FROM ({ORACLE["stg_bars"]}) b WHERE id % 50 = 0
), """ + ",\n".join(f"{name}_ AS ({_MART_SQL[name]})" for name in _BUILT) + """
SELECT 1 AS attempt, check_name AS item, failures AS n, passed FROM report
UNION ALL
SELECT 2, check_name, CASE WHEN hurt THEN twice.n ELSE failures END, CASE WHEN hurt THEN twice.n = 0 ELSE passed END
FROM (SELECT *, check_name = 'stg_bars.symbol_price_date.unique' AS hurt FROM report) r, twice
""" + "\n".join(f"UNION ALL SELECT 0, '{name}', count(*), true FROM {name}_" for name in _BUILT)
ORACLE["stream_dedupe"] = "SELECT event_id, ts, event_type, value FROM events"
