"""Report headline failure mode and JSON payload fallback."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tickerlake.operators import payload as pl
from tickerlake.operators import report as rpt
from tickerlake.schemas import TRADES

SUMMARY = ("price_date date, total_invested decimal(38,4), total_current_value decimal(38,6), "
           "total_unrealized_pnl decimal(38,6), total_unrealized_pct decimal(38,2), holdings_count bigint")


def test_report_summary_picks_latest_and_totals(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, 1), D("10"), D("12"), D("2"), D("20.00"), 1),
                               (dt.date(2024, 1, 2), D("10"), D("9.005"), D("-0.995"), D("-9.95"), 1)], SUMMARY)
    realized = spark.createDataFrame([(D("1.125"),), (None,)], "net_pnl decimal(38,6)")
    r = rpt.report_summary(s, realized).first()
    assert r.price_date == dt.date(2024, 1, 2)
    # half-even like Python's format: 9.005 -> 9.00, -0.995 -> -1.00
    assert (r.total_current_value, r.total_unrealized_pnl, r.unrealized_color) == ("9.00", "-1.00", "#c02626")
    assert f"{D('-0.995'):.2f}" == "-1.00" and f"{D('9.005'):.2f}" == "9.00"
    # NULL P&L rows are skipped by the sum but counted as closed trades
    assert (r.realized_pnl, r.closed_trades, r.realized_color) == ("1.12", 2, "#0a7d2c")
    assert r.subject.endswith("2024-01-02")


def test_report_summary_fails_without_summary(spark):
    empty = spark.createDataFrame([], SUMMARY)
    realized = spark.createDataFrame([], TRADES).select(F.lit(None).cast("decimal(38,6)").alias("net_pnl"))
    with pytest.raises(Exception, match="no rows"):
        rpt.report_summary(empty, realized).collect()


def test_parse_payload_falls_back_on_bad_text(spark):
    fallback = F.struct(F.lit(1).alias("number"),
                        F.array(F.struct(F.lit("ISS").alias("craft"), F.lit("Fallback").alias("name")))
                        .alias("people"))
    df = spark.createDataFrame([(1, '{"number": 2, "people": [{"craft": "A", "name": "x"}, '
                                    '{"craft": "B", "name": "y"}]}'),
                                (2, '{"number": '), (3, None)], "id int, body string")
    parsed = df.select("id", pl.parse_payload("body", pl.PEOPLE_SCHEMA, fallback).alias("payload"))
    lines = {(r.id, r.pos): r.line for r in pl.explode_lines(parsed, keep=("id",)).collect()}
    assert lines == {
        (1, 0): "x is currently in space flying on the A! Hello! :)",
        (1, 1): "y is currently in space flying on the B! Hello! :)",
        (2, 0): "Fallback is currently in space flying on the ISS! Hello! :)",
        (3, 0): "Fallback is currently in space flying on the ISS! Hello! :)",
    }


def test_daily_report_lines_have_technicals(spark):
    from tickerlake.operators import indicators as ind
    from tickerlake.operators import portfolio as pf
    from tickerlake.operators import staging as stg
    from tickerlake.sources.feeds import Feeds

    f = Feeds(spark, "/root/testdata/sf0.001")
    snap = pf.portfolio_snapshot(f.holdings(), stg.stage_board(f.board()))
    head, lines = rpt.daily_report(pf.portfolio_summary(snap), pf.realized_trades(f.trades()), snap,
                                   ind.technical_indicators(stg.stage_bars(f.bars())))
    assert head.count() == 1
    got = lines.collect()
    assert len(got) == snap.count() and all(r.technicals_line for r in got)
    assert [r.symbol for r in got] == sorted(r.symbol for r in got)
