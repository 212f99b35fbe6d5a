"""Daily report rows: headline, per-holding lines and technicals lines.

The report is data, not HTML: each function returns a small DataFrame of
formatted strings that any renderer can template.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.functions.formatting import (
    MISSING,
    fmt_int,
    fmt_money,
    fmt_ratio,
    fmt_signed_pct,
    sign_color,
)

# Subject prefix and the technicals line layout.
SUBJECT_PREFIX = "Portfolio Update — "


def report_summary(summary: DataFrame, realized: DataFrame) -> DataFrame:
    """Headline row: the latest summary row plus the realized P&L total.

    ``realized`` is either the per-sell P&L (with ``net_pnl``) or the one-row
    totals of ``portfolio.realized_totals``.  The latest row is a global
    ``max_by`` aggregate (exactly one row) and the realized totals enter as
    one struct-valued scalar subquery, so there is no join.  An empty summary
    fails the job: the report cannot be produced without it.
    """
    if "net_pnl" in realized.columns:
        totals = [F.coalesce(F.sum("net_pnl"), F.lit(0)).alias("realized_pnl"),
                  F.count(F.lit(1)).alias("closed_trades")]
    else:
        totals = [F.first("realized_pnl").alias("realized_pnl"), F.first("closed_trades").alias("closed_trades")]
    pnl = realized.agg(F.struct(*totals).alias("p")).scalar()
    latest = summary.agg(
        F.max_by(F.struct(*summary.columns), F.col("price_date")).alias("s"),
        F.count(F.lit(1)).alias("n_summary"),
    ).select("s.*", "n_summary", pnl["realized_pnl"].alias("realized_pnl"),
             pnl["closed_trades"].alias("closed_trades"))
    checked = F.when(F.col("n_summary") == 0, F.raise_error(F.lit("portfolio summary returned no rows")))
    return latest.select(
        F.coalesce(checked.cast("date"), F.col("price_date")).alias("price_date"),
        fmt_money("total_current_value").alias("total_current_value"),
        fmt_money("total_invested").alias("total_invested"),
        fmt_money("total_unrealized_pnl").alias("total_unrealized_pnl"),
        fmt_money("total_unrealized_pct").alias("total_unrealized_pct"),
        sign_color("total_unrealized_pnl").alias("unrealized_color"),
        F.col("holdings_count"),
        fmt_money("realized_pnl").alias("realized_pnl"),
        sign_color("realized_pnl").alias("realized_color"),
        F.col("closed_trades"),
        F.concat(F.lit(SUBJECT_PREFIX), F.col("price_date").cast("string")).alias("subject"),
    )


def report_holdings(snapshot: DataFrame) -> DataFrame:
    """One formatted line per holding (price, day change, value, P&L)."""
    return snapshot.select(
        "symbol",
        fmt_money("current_price").alias("current_price"),
        fmt_money("todays_change_pct").alias("todays_change_pct"),
        sign_color("todays_change_pct").alias("change_color"),
        fmt_money("current_value").alias("current_value"),
        fmt_money("unrealized_pnl").alias("unrealized_pnl"),
        sign_color("unrealized_pnl").alias("pnl_color"),
    ).orderBy("symbol")


def technicals_line(df: DataFrame) -> DataFrame:
    """``vs 200DMA: +3% | RSI: 45 | vol: 0.9x`` for each indicator row."""
    line = F.concat(
        F.lit("vs 200DMA: "), fmt_signed_pct("pct_vs_sma_200"),
        F.lit(" | RSI: "), fmt_int("rsi_14"),
        F.lit(" | vol: "), fmt_ratio("volume_ratio_20"))
    return df.select("symbol", line.alias("technicals_line"))


def report_technicals(snapshot: DataFrame, indicators: DataFrame) -> DataFrame:
    """Technicals line per holding; holdings without indicators get ``n/a``."""
    lines = technicals_line(indicators).withColumnRenamed("symbol", "_sym")
    return (snapshot.select("symbol")
            .join(lines, F.col("symbol") == F.col("_sym"), "left")
            .select("symbol", F.coalesce("technicals_line", F.lit(MISSING)).alias("technicals_line"))
            .orderBy("symbol"))


def daily_report(summary: DataFrame, realized: DataFrame, snapshot: DataFrame,
                 indicators: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(headline, lines): the one-row headline and one line per holding with its technicals."""
    lines = report_holdings(snapshot).join(
        report_technicals(snapshot, indicators), "symbol", "left").orderBy("symbol")
    return report_summary(summary, realized), lines
