"""Portfolio marts: mark-to-market, totals, weights, realized P&L, tax roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tickerlake.functions.numeric import coalesce0, pct_of, ratio
from tickerlake.operators.rolling import DEFAULT_BUCKET_DAYS, day_bucket

# Types that keep all 12 places of an allocated charge through the sums below:
# wider operands would make Spark fall back to 6 fractional digits.
AMOUNT = DecimalType(24, 4)
SHARE = DecimalType(32, 12)


def latest_board(board: DataFrame) -> DataFrame:
    """Silver-board rows on the globally latest snapshot date.

    The latest date is a scalar subquery, so the date predicate moves below
    the de-duplication.  Two snapshots on that date both qualify (as specified).
    """
    day = F.to_date("fetched_at")
    latest = board.agg(F.max(day).alias("price_date")).scalar()
    return (board.where(day == latest).withColumn("price_date", day)
            .select("symbol", "current_price", "change_pct", "price_date"))


def holdings_active(holdings: DataFrame) -> DataFrame:
    return holdings.where(F.col("status") == "active")


def portfolio_snapshot(holdings: DataFrame, board: DataFrame) -> DataFrame:
    """Active holdings priced on the latest board date (unpriced ones drop out)."""
    h = holdings_active(holdings)
    p = latest_board(board)
    qty, avg, price = F.col("qty_held"), F.col("avg_buy_rate"), F.col("current_price")
    return h.join(p, "symbol").select(
        "symbol", "sector", "qty_held", "avg_buy_rate",
        (qty * avg).alias("total_cost"),
        "current_price",
        F.col("change_pct").alias("todays_change_pct"),
        (qty * price).alias("current_value"),
        (qty * price - qty * avg).alias("unrealized_pnl"),
        pct_of(price - avg, avg, 2).alias("unrealized_pct"),
        "price_date",
    )


def portfolio_summary(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("price_date").agg(
        F.sum("total_cost").alias("total_invested"),
        F.sum("current_value").alias("total_current_value"),
        F.sum("unrealized_pnl").alias("total_unrealized_pnl"),
        pct_of(F.sum("unrealized_pnl"), F.sum("total_cost"), 2).alias("total_unrealized_pct"),
        F.count("symbol").alias("holdings_count"),
    )


def portfolio_weights(snapshot: DataFrame) -> DataFrame:
    """Each holding's share of the day's portfolio value, in percent.

    Day totals are a grouped aggregate (partial per task) broadcast back to
    the rows: all holdings share one date, so a shuffle join on the date would
    put them in one task.  The totals have at most one row per calendar date.
    """
    totals = snapshot.groupBy("price_date").agg(F.sum("current_value").alias("_total"))
    return (snapshot.join(F.broadcast(totals), "price_date")
            .select("symbol", "price_date", "current_value",
                    pct_of(F.col("current_value"), F.col("_total"), 2).alias("weight_pct")))


def portfolio_weighted_change(snapshot: DataFrame) -> DataFrame:
    """Value-weighted average day change per date (holdings with a change only)."""
    v, c = F.col("current_value"), F.col("todays_change_pct")
    return snapshot.groupBy("price_date").agg(
        F.round(ratio(F.sum(v * c), F.sum(F.when(c.isNotNull(), v))), 2).alias("weighted_change_pct"))


def _charges():
    return coalesce0("comm", "cdc_amt", "lsn", "sst")


def trade_charges(trades: DataFrame) -> DataFrame:
    """Per trade: the null-safe sum of broker, depository, levy and tax charges."""
    return trades.select("trade_id", "broker", "symbol", "trade_type", "trade_date",
                         _charges().alias("charges"))


def avg_buy(trades: DataFrame) -> DataFrame:
    """Quantity-weighted average buy rate and buy totals per (broker, symbol)."""
    buys = trades.where(F.col("trade_type") == "buy")
    q, r = F.col("qty"), F.col("gross_rate")
    return buys.groupBy("broker", "symbol").agg(
        F.round(ratio(F.sum(q * r), F.sum(q)), 4).alias("avg_buy_rate"),
        F.sum(q).alias("total_buy_qty"),
        F.sum(_charges()).alias("total_buy_charges"),
    )


def _buy_share(qty):
    """The buy charges of the pair that fall on ``qty`` sold shares, to 12 places."""
    return (ratio(F.col("total_buy_charges") * qty, F.col("total_buy_qty"))).cast(SHARE)


def _pair_key():
    return F.xxhash64("broker", "symbol").alias("_pair")


def realized_trades(trades: DataFrame) -> DataFrame:
    """Realized P&L of each sell against the average buy of its (broker, symbol).

    The average is over all buys of the pair (not only earlier ones) and is
    rounded to 4 places before use; sells without buys keep NULL cost and P&L.
    Buy charges are allocated pro rata to sold quantity, uncapped.

    Scale: the buy side is aggregated before the join (one row per pair).  The
    extra join key ``_pair`` is not what the aggregate is partitioned by, so
    both sides of the join get an exchange of their own and AQE's skew join
    can split the sells of a hot pair (it cannot split next to an aggregate).
    """
    buys = avg_buy(trades).withColumn("_pair", _pair_key())
    return _realized(_sells(trades).join(buys, ["broker", "symbol", "_pair"], "left"))


def _sells(trades: DataFrame) -> DataFrame:
    return trades.where(F.col("trade_type") == "sell").select(
        "trade_id", "broker", "symbol", F.col("trade_date").alias("sell_date"),
        F.col("qty").alias("sell_qty"), F.col("gross_rate").alias("sell_rate"),
        _charges().alias("sell_charges"), "reason", _pair_key())


def _realized(j: DataFrame) -> DataFrame:
    """Proceeds, cost, charges and P&L of sells that carry their average buy."""
    q, rate, avg = F.col("sell_qty"), F.col("sell_rate"), F.col("avg_buy_rate")
    proceeds = q * rate
    cost = q * avg
    gross = proceeds - cost
    buy_part = _buy_share(q)
    sell_part = F.col("sell_charges").cast(AMOUNT)
    return j.select(
        "trade_id", "broker", "symbol", "sell_date", "sell_qty", "sell_rate", "avg_buy_rate",
        proceeds.alias("gross_proceeds"),
        cost.alias("cost_basis"),
        gross.alias("gross_pnl"),
        (sell_part + buy_part).alias("allocated_charges"),
        ((gross - sell_part).cast(AMOUNT) - buy_part).alias("net_pnl"),
        pct_of(gross, cost, 2).alias("gross_pnl_pct"),
        "reason",
    )


def avg_buy_asof(trades: DataFrame, bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Average buy rate and buy totals of each (broker, symbol) as of each day that it sells on.

    Only buys dated up to and including that day count; undated buys never do.
    The columns are those of ``avg_buy`` plus ``trade_date``.

    Scale: buys and sells are first summed up by pair and day, so a hot pair
    is at most one row a calendar day.  Running totals are taken within
    (pair, bucket of days) and start from what the earlier buckets add up to,
    a window over one row for each bucket; there is no range join.
    """
    pair = ["broker", "symbol"]
    buy = F.col("trade_type") == "buy"
    q, r = F.col("qty"), F.col("gross_rate")
    sums = ("_amount", "_qty", "_charges")
    daily = (trades.where(F.col("trade_type").isin("buy", "sell")).dropna(subset=[*pair, "trade_date"])
             .groupBy(*pair, "trade_date").agg(
                 F.sum(F.when(buy, q * r)).alias("_amount"), F.sum(F.when(buy, q)).alias("_qty"),
                 F.sum(F.when(buy, _charges())).alias("_charges"), F.max(~buy).alias("_sold"))
             .withColumn("_bucket", day_bucket("trade_date", bucket_days)))
    totals = daily.groupBy(*pair, "_bucket").agg(*[F.sum(c).alias(c) for c in sums])
    before = Window.partitionBy(*pair).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*pair, "_bucket", *[F.sum(c).over(before).alias(f"{c}_before") for c in sums])
    upto = Window.partitionBy(*pair, "_bucket").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def running(c: str):
        own, earlier = F.sum(c).over(upto), F.col(f"{c}_before")
        return F.when(earlier.isNull(), own).when(own.isNull(), earlier).otherwise(own + earlier).alias(c)

    series = daily.join(carried, [*pair, "_bucket"]).select(*pair, "trade_date", "_sold", *[running(c) for c in sums])
    return series.where("_sold").select(
        *pair, "trade_date", F.round(ratio(F.col("_amount"), F.col("_qty")), 4).alias("avg_buy_rate"),
        F.col("_qty").alias("total_buy_qty"), F.col("_charges").alias("total_buy_charges"))


def realized_trades_asof(trades: DataFrame, bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """``realized_trades`` against the average buy as of the day of the sell.

    Later buys neither change a sell's cost nor take part of its charges; a
    sell with no buy up to its day keeps NULL cost and P&L.  As there, an
    extra key gives the join exchanges of its own, so that AQE can split a
    pair that sells a lot on one day.
    """
    asof = avg_buy_asof(trades, bucket_days).withColumnRenamed("trade_date", "sell_date").withColumn("_pair", _pair_key())
    return _realized(_sells(trades).join(asof, ["broker", "symbol", "sell_date", "_pair"], "left"))


def realized_totals(trades: DataFrame) -> DataFrame:
    """One row: total net P&L (0 when none) and closed trades, without the per-sell join.

    Every term of a sell's net P&L is a sum except the buy-charge share, a
    quotient to 12 places that depends only on the pair and the sold quantity.
    Sells are therefore pre-aggregated by (broker, symbol, qty) (partial
    aggregation: a hot pair collapses to one row per distinct quantity) and
    only those groups are joined to the average buy; the result equals
    summing ``realized_trades(...).net_pnl``.
    """
    sells = trades.where(F.col("trade_type") == "sell")
    proceeds = F.col("qty") * F.col("gross_rate")
    groups = sells.groupBy("broker", "symbol", "qty").agg(
        F.count(F.lit(1)).alias("_all"),
        F.count(proceeds).alias("_ok"),
        F.sum(proceeds).alias("_proceeds"),
        F.sum(F.when(proceeds.isNotNull(), _charges())).alias("_charges"),
    )
    j = groups.join(avg_buy(trades), ["broker", "symbol"], "left")
    q, n = F.col("qty"), F.col("_ok")
    gross = (F.col("_proceeds") - n * q * F.col("avg_buy_rate") - F.col("_charges")).cast(AMOUNT)
    shares = (n.cast(DecimalType(12, 0)) * _buy_share(q).cast(DecimalType(25, 12))).cast(DecimalType(36, 12))
    net = F.when(n > 0, gross - shares)
    return j.agg(
        F.coalesce(F.sum(net), F.lit(0).cast(DecimalType(38, 12))).alias("realized_pnl"),
        F.coalesce(F.sum("_all"), F.lit(0)).alias("closed_trades"),
    )


def realized_pnl(realized: DataFrame) -> DataFrame:
    """One row: total net P&L (0 when none) and the number of closed trades."""
    return realized.agg(
        F.coalesce(F.sum("net_pnl"), F.lit(0).cast(DecimalType(38, 12))).alias("realized_pnl"),
        F.count(F.lit(1)).alias("closed_trades"),
    )


TAX_FLOWS = ("capital_gain_loss", "provisional_cgt")
TAX_STOCKS = ("cgt_payable_cumulative", "cgt_collected_cumulative", "cgt_shortfall", "cgt_refund")


def tax_summary(tax: DataFrame, ordered: bool = True) -> DataFrame:
    """Monthly tax roll-up per broker: flows summed, cumulative figures maxed.

    NULLs count as 0 in both, so a NULL lifts a negative maximum to 0.
    """
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    g = tax.groupBy("broker", "period_month").agg(
        F.sum(z("capital_gain_loss")).alias("net_gain_loss"),
        F.sum(z("provisional_cgt")).alias("provisional_cgt"),
        *[F.max(z(c)).alias(c) for c in TAX_STOCKS],
    )
    out = g.select(
        "broker", "period_month",
        *[F.round(c, 2).alias(c) for c in ("net_gain_loss", "provisional_cgt") + TAX_STOCKS],
        F.round(F.col("cgt_collected_cumulative") - F.col("cgt_payable_cumulative"), 2)
        .alias("cgt_over_under_collected"),
    )
    return out.orderBy("broker", "period_month") if ordered else out
