"""The derived feeds keep the statistics documented in FIXTURES.md §3 (sf0.01)."""

from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tickerlake.operators import portfolio as pf
from tickerlake.operators.staging import stage_board
from tickerlake.sources.feeds import Feeds


def test_feed_statistics(spark):
    f = Feeds(spark, SF_MID)
    bars = f.bars()
    b = bars.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("symbol").alias("s"),
                 F.count_if(F.col("volume").isNull()).alias("nv")).first()
    assert (b.n, b.s, b.nv) == (13433, 30, 22)
    assert bars.groupBy("symbol", "price_date").count().where("count > 1").count() == 0
    board = f.board()
    assert board.count() == 15000
    staged = stage_board(board)
    assert staged.count() == 14061 and staged.select("symbol").distinct().count() == 1500
    assert f.sector_map().count() == 1350
    t = f.trades().agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("trade_type") == "sell").alias("sells"),
                       F.count_distinct("trade_id").alias("ids")).first()
    assert (t.n, t.sells, t.ids) == (60000, 20046, 45832)
    h = f.holdings()
    assert h.count() == 500 and h.where("status = 'active'").count() == 437
    assert f.tax().select("broker", "period_month").distinct().count() == 397


def test_some_holdings_are_priced_at_every_scale(spark):
    """About as many of the active holdings are on the latest board at each scale, none at none."""
    for sf in (SF_SMALL, SF_MID):
        f = Feeds(spark, sf)
        active = pf.holdings_active(f.holdings()).count()
        priced = pf.portfolio_snapshot(f.holdings(), stage_board(f.board())).count()
        assert 0.08 < priced / active < 0.3
