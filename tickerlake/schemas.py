"""Declared schemas of the raw feeds and seeds (never inferred)."""

from pyspark.sql.types import (
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    DoubleType,
)

MONEY = DecimalType(18, 4)
BOARD_NUM = DecimalType(20, 6)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


BOARD_RAW = _s(
    ("id", LongType()), ("fetched_at", TimestampNTZType()), ("symbol", StringType()),
    ("name", StringType()), ("ldcp", StringType()), ("current", StringType()),
    ("change", StringType()), ("change_1", StringType()), ("idx_wtg", StringType()),
    ("idx_point", StringType()), ("volume", StringType()), ("shares_m", StringType()),
    ("market_cap_m", StringType()),
)

BARS = _s(
    ("id", LongType()), ("symbol", StringType()), ("price_date", DateType()),
    ("open", MONEY), ("high", MONEY), ("low", MONEY), ("close", MONEY),
    ("volume", LongType()), ("dividends", MONEY), ("stock_splits", MONEY),
    ("fetched_at", TimestampNTZType()),
)

QUOTES = _s(
    ("symbol", StringType()), ("ts", TimestampNTZType()), ("open", DoubleType()),
    ("high", DoubleType()), ("low", DoubleType()), ("close", DoubleType()),
    ("volume", DoubleType()), ("dividends", DoubleType()), ("stock_splits", DoubleType()),
)

HOLDINGS = _s(
    ("symbol", StringType()), ("sector", StringType()), ("qty_held", LongType()),
    ("avg_buy_rate", MONEY), ("status", StringType()),
)

TRADES = _s(
    ("trade_id", StringType()), ("broker", StringType()), ("symbol", StringType()),
    ("trade_type", StringType()), ("trade_date", DateType()), ("qty", LongType()),
    ("gross_rate", MONEY), ("comm", MONEY), ("cdc_amt", MONEY), ("lsn", MONEY),
    ("sst", MONEY), ("net_amount", MONEY), ("reason", StringType()),
)

# Trades as they sit in the seed CSV: the date is M/d/yyyy text.
TRADES_CSV = _s(*[(f.name, StringType() if f.name == "trade_date" else f.dataType)
                  for f in TRADES.fields])

TAX = _s(
    ("cgt_id", StringType()), ("broker", StringType()), ("period_month", StringType()),
    ("symbol", StringType()), ("qty", LongType()), ("settlement_date", DateType()),
    ("capital_gain_loss", MONEY), ("holding_days", MONEY), ("cgt_slab_pct", MONEY),
    ("provisional_cgt", MONEY), ("net_gain_loss_month", MONEY), ("gross_cgt_month", MONEY),
    ("net_cgt_month", MONEY), ("cgt_payable_cumulative", MONEY),
    ("cgt_collected_cumulative", MONEY), ("cgt_shortfall", MONEY), ("cgt_refund", MONEY),
)

SECTOR_MAP = _s(("symbol", StringType()), ("sector", StringType()))

TICKS = _s(("event_id", LongType()), ("ts", TimestampType()), ("event_type", StringType()),
           ("value", DoubleType()))
