"""Full build on derived feeds; seed loading."""

import datetime as dt

from tickerlake.operators import quality as dq
from tickerlake.plans.build import build_all, materialize
from tickerlake.sources import seeds
from tickerlake.sources.feeds import Feeds


def _inputs(spark, sf="/root/testdata/sf0.001"):
    f = Feeds(spark, sf)
    return {"board": f.board(), "bars": f.bars(), "sector_map": f.sector_map(), "holdings": f.holdings(),
            "trades": f.trades(), "tax": f.tax()}


def test_build_all_and_checks(spark, scratch):
    inputs = _inputs(spark)
    marts = build_all(inputs)
    materialize(marts, f"{scratch}/gold")
    assert spark.read.parquet(f"{scratch}/gold/technical_indicators").count() == \
        marts["technical_indicators"].count()
    tables = dict(marts, holdings=inputs["holdings"])
    rep = {r.check_name: r.failures for r in dq.quality_report(dq.standard_checks(), tables).collect()}
    assert len(rep) == 33
    # the gold marts keep their declared invariants on the derived feeds
    for name in ("stg_board.id.unique", "stg_bars.symbol_price_date.unique", "snapshot.symbol.in_holdings",
                 "indicators.symbol.unique", "summary.holdings_count.positive"):
        assert rep[name] == 0, name


def test_load_trades_seed_parses_month_first_dates(spark, scratch):
    path = f"{scratch}/trades.csv"
    with open(path, "w") as fh:
        fh.write("trade_id,broker,symbol,trade_type,trade_date,qty,gross_rate,comm,cdc_amt,lsn,sst,"
                 "net_amount,reason\n")
        fh.write("T1,B1,ABC,buy,3/7/2025,10,12.5,1.0,,0.02,0.1,125.0,\n")
    r = seeds.load_trades(spark, path).first()
    assert r.trade_date == dt.date(2025, 3, 7) and r.cdc_amt is None and r.reason is None


def test_stored_bars_round_trip_and_prune(spark, scratch, capsys):
    from pyspark.sql import functions as F

    from tickerlake.sources import tables

    bars = Feeds(spark, "/root/testdata/sf0.001").bars()
    tables.write_bars(bars, f"{scratch}/bars")
    back = tables.read_bars(spark, f"{scratch}/bars")
    assert back.count() == bars.count() and back.columns == bars.columns
    lo, hi = dt.date(1996, 2, 10), dt.date(1997, 3, 20)
    part = tables.read_bars(spark, f"{scratch}/bars", since=lo, until=hi)
    day = F.col("price_date")
    assert part.exceptAll(bars.where(day.between(lo, hi))).isEmpty() and part.count() == bars.where(day.between(lo, hi)).count() > 0
    part.explain()
    assert "PartitionFilters: [isnotnull(price_month" in capsys.readouterr().out
    only = tables.read_bars(spark, f"{scratch}/bars", since=hi)
    assert only.count() == bars.where(day >= hi).count()


def test_register_views_exposes_marts_to_sql(spark):
    from tickerlake.plans.build import register_views

    marts = build_all(_inputs(spark), share=None)
    register_views(marts)
    n = spark.sql("SELECT count(*) AS n FROM top_movers WHERE change_pct IS NOT NULL").first().n
    assert n == marts["top_movers"].count() > 0
    assert spark.sql("SELECT count(*) FROM technical_indicators").first()[0] == marts["technical_indicators"].count()


def test_tax_seed_pads_short_lines_and_fails_on_bad_values(spark, scratch):
    import pytest
    from pyspark.errors import PySparkException

    from tickerlake.schemas import TAX

    header = ",".join(TAX.fieldNames())
    full = "1,A,2025-10,X,60,2025-10-08,5313.39,,,,5313.39,1594.02,1594.02,1594.02,1594.02,0.00"

    def load(name, line):
        with open(f"{scratch}/{name}.csv", "w") as fh:
            fh.write(f"{header}\n{line}\n")
        return seeds.load_tax(spark, f"{scratch}/{name}.csv").collect()

    short = load("short", full)[0]
    assert short.cgt_refund is None and short.cgt_shortfall == 0 and short.settlement_date == dt.date(2025, 10, 8)
    assert str(load("full", full + ",1.5")[0].cgt_refund) == "1.5000"
    for name, line in (("value", full.replace("5313.39", "53l3.39")), ("surplus", full + ",1.5,9")):
        with pytest.raises(PySparkException):
            load(name, line)


def test_failed_check_leaves_the_published_version(spark, scratch):
    """Publish, refuse a build with a failed check, refuse one that dies, publish again: what readers resolve after each."""
    import pytest
    from pyspark.sql import functions as F

    from tickerlake.plans import publish as pub

    good, base = _inputs(spark), f"{scratch}/gold"
    bad = dict(good, bars=good["bars"].unionByName(good["bars"].where("id % 50 = 0")))
    with pytest.raises(FileNotFoundError):
        pub.read_live(spark, base, "stg_bars")
    with pytest.raises(dq.QualityError, match="stg_bars.symbol_price_date.unique"):
        pub.publish(bad, base)
    assert pub.live_version(spark, base) is None
    first = pub.publish(good, base)
    n = good["bars"].count()
    old = pub.read_live(spark, base, "stg_bars")
    with pytest.raises(dq.QualityError):
        pub.publish(bad, base)
    broken = dict(good, tax=good["tax"].withColumn("period_month", F.raise_error(F.lit("lost source")).cast("string")))
    with pytest.raises(Exception, match="lost source"):
        pub.publish(broken, base)
    assert pub.live_version(spark, base) == first and pub.read_live(spark, base, "stg_bars").count() == n
    second = pub.publish(dict(good, bars=good["bars"].where("id % 50 != 0")), base)
    assert pub.live_version(spark, base) == second != first
    assert pub.read_live(spark, base, "stg_bars").count() < n == old.count()  # a resolved reader keeps its version
    with pytest.raises(Exception, match="already exists"):  # a publisher that took the same number
        spark.createDataFrame([("x",)], "version string").write.parquet(f"{base}/published/seq=2")


def test_build_and_check_leaves_nothing_cached(spark, scratch):
    from tickerlake.plans.build import build_and_check

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert build_and_check(_inputs(spark), f"{scratch}/gold", raise_on_failure=False).count() == 33
    assert build_and_check(_inputs(spark)).count() == 33
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
