"""Insert-only upsert, incremental copy, quote normalisation, report formatting."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tickerlake.functions.formatting import fmt_int, fmt_money, fmt_ratio, fmt_signed_pct, sign_color
from tickerlake.schemas import QUOTES
from tickerlake.sources import ingest as ing


def test_insert_only_first_write_wins(spark):
    target = spark.createDataFrame([("A", 1, 10)], "sym string, d int, close int")
    batch = spark.createDataFrame([("A", 1, 99, 0), ("B", 1, 20, 0), ("B", 1, 21, 1), ("C", 2, 30, 0)],
                                  "sym string, d int, close int, arrival int")
    new = ing.insert_only(target, batch, ["sym", "d"], ["arrival"])
    assert sorted((r.sym, r.close) for r in new.collect()) == [("B", 20), ("C", 30)]


def test_append_insert_only_replay_is_noop(spark, scratch):
    path = f"{scratch}/bars"
    batch = spark.createDataFrame([("A", 1, 10, 0), ("A", 1, 11, 1), ("B", 2, 20, 0)],
                                  "sym string, d int, close int, arrival int")
    assert ing.append_insert_only(spark, path, batch, ["sym", "d"], ["arrival"]) == 2
    assert ing.append_insert_only(spark, path, batch, ["sym", "d"], ["arrival"]) == 0
    later = spark.createDataFrame([("A", 1, 12, 0), ("C", 3, 30, 0)], "sym string, d int, close int, arrival int")
    assert ing.append_insert_only(spark, path, later, ["sym", "d"], ["arrival"]) == 1
    got = sorted((r.sym, r.close) for r in spark.read.parquet(path).collect())
    assert got == [("A", 10), ("B", 20), ("C", 30)]


def test_incremental_copy_marks(spark, scratch):
    src = spark.createDataFrame([(i, f"r{i}") for i in (1, 2, 3, 5)], "id long, v string")
    empty = spark.createDataFrame([], src.schema)
    assert ing.high_water_mark(empty) == 0
    assert ing.incremental_copy(src, empty).count() == 4
    assert ing.incremental_copy(src, src).count() == 0
    # a late row with a low id is never copied
    late = src.unionByName(spark.createDataFrame([(4, "late")], src.schema))
    assert ing.incremental_copy(late, src).count() == 0
    path = f"{scratch}/copy"
    assert ing.copy_new_rows(spark, src, path) == 4
    more = src.unionByName(spark.createDataFrame([(9, "r9")], src.schema))
    assert ing.copy_new_rows(spark, more, path) == 1
    assert spark.read.parquet(path).count() == 5


def test_normalize_quotes_utc_day_shift(spark):
    rows = [("LUCK.KA", dt.datetime(2026, 8, 3, 0, 0), 1.0, 2.0, 0.5, 1.23456, 1234.9, 0.0, 0.0)]
    df = spark.createDataFrame(rows, QUOTES)
    stamp = F.lit("2026-08-03 13:15:00").cast("timestamp_ntz")
    utc = ing.normalize_quotes(df, ingested_at=stamp).first()
    assert utc.symbol == "LUCK"
    assert utc.price_date == dt.date(2026, 8, 2)          # Karachi midnight is the previous UTC day
    assert utc.close == D("1.2346") and utc.volume == 1234
    local = ing.normalize_quotes(df, day_of="exchange", ingested_at=stamp).first()
    assert local.price_date == dt.date(2026, 8, 3)


def test_split_corrupt(spark):
    text = spark.createDataFrame([('{"symbol":"A.KA","ts":"2024-01-01T10:00:00","close":1.5}',),
                                  ('{"symbol":"B.KA",',), ('{"symbol":"C.KA","ts":"2024-01-01T10:00:00"}',)],
                                 "value string")
    parsed = text.select(ing.parse_quotes(F.col("value")).alias("q")).select("q.*")
    good, bad = ing.split_corrupt(parsed)
    assert [r.symbol for r in good.collect()] == ["A.KA"]
    assert sorted(r.reason for r in bad.collect()) == ["missing field", "unparseable"]


def test_report_formatting_half_even(spark):
    vals = [D("0.5"), D("1.5"), D("2.5"), D("-0.3"), None, D("3.25")]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(10,2)")
    got = [tuple(r) for r in df.select(fmt_signed_pct("x"), fmt_int("x"), fmt_ratio("x"), fmt_money("x"),
                                       sign_color("x")).collect()]
    # Python: f"{v:+.0f}%", f"{v:.0f}", f"{v:.1f}x", f"{v:.2f}" on Decimal values
    for v, g in zip(vals, got):
        if v is None:
            assert g[:4] == ("n/a",) * 4 and g[4] == "#c02626"
        else:
            assert g[:4] == (f"{v:+.0f}%", f"{v:.0f}", f"{v:.1f}x", f"{v:.2f}"), (v, g)


def test_create_if_absent_and_positional_append(spark, scratch):
    from tickerlake.schemas import BOARD_RAW

    name = "board_copy_" + scratch.rsplit("-", 1)[-1].replace("_", "")
    ing.ensure_table(spark, name, BOARD_RAW, path=f"{scratch}/t")
    ing.ensure_table(spark, name, BOARD_RAW, path=f"{scratch}/t")  # idempotent
    rows = spark.createDataFrame([(7, dt.datetime(2024, 1, 1), "A", "n", "1", "2", "0", "1%", "1%", "1", "1", "1",
                                   "1")], BOARD_RAW)
    # positional: column names of the frame do not matter
    ing.append_positional(rows.toDF(*[f"c{i}" for i in range(13)]), name)
    got = spark.table(name).collect()
    assert len(got) == 1 and got[0].id == 7 and got[0].symbol == "A"
    spark.sql(f"DROP TABLE {name}")


def test_insert_only_pruned_target_read(spark, capsys):
    target = spark.createDataFrame([("A", d, 1) for d in range(100)], "sym string, d int, close int")
    batch = spark.createDataFrame([("A", 98, 5, 0), ("A", 100, 6, 0)], "sym string, d int, close int, arrival int")
    new = ing.insert_only(target, batch, ["sym", "d"], ["arrival"], prune_on="d")
    assert [(r.sym, r.d) for r in new.collect()] == [("A", 100)]
    new.explain()
    plan = capsys.readouterr().out
    assert ">= 98" in plan and "<= 100" in plan


def test_append_keeps_the_month_layout(spark, scratch):
    """A table written by write_bars takes new rows in its folders; a replay adds nothing."""
    from pyspark.sql import functions as F

    from tests.conftest import SF_SMALL
    from tickerlake.sources.feeds import Feeds
    from tickerlake.sources.ingest import append_insert_only
    from tickerlake.sources.tables import read_bars, write_bars

    bars = Feeds(spark, SF_SMALL).bars()
    path = f"{scratch}/bars"
    write_bars(bars, path)
    before = read_bars(spark, path).count()
    batch = bars.limit(5).unionByName(bars.limit(5).withColumn("symbol", F.concat(F.lit("NEW"), "symbol")))
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    added = append_insert_only(spark, path, batch, ["symbol", "price_date"], ["id"])
    assert added == 5 and read_bars(spark, path).count() == before + 5
    assert append_insert_only(spark, path, batch, ["symbol", "price_date"], ["id"]) == 0
    assert read_bars(spark, path).count() == before + 5
    assert read_bars(spark, path).where("symbol like 'NEW%'").count() == 5


def test_values_that_do_not_fit_are_quarantined(spark):
    ts = dt.datetime(2024, 1, 2)
    rows = [("ok", ts, 1.0, 2.0, 1.0, 1.5, 10.0, 0.0, 0.0), ("big", ts, 1.0, 2.0, 1.0, 1e15, 10.0, 0.0, 0.0),
            ("nan", ts, 1.0, 2.0, 1.0, float("nan"), 10.0, 0.0, 0.0), ("vol", ts, None, 2.0, 1.0, 1.5, 1e30, 0.0, 0.0),
            ("none", ts, 1.0, 2.0, 1.0, None, 10.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, QUOTES).withColumn(ing.CORRUPT, F.lit(None).cast("string"))
    good, bad = ing.split_corrupt(df)
    assert [r.symbol for r in good.collect()] == ["ok"] and good.columns == QUOTES.fieldNames()
    assert {r.symbol: r.reason for r in bad.collect()} == {
        "big": "bad value", "nan": "bad value", "vol": "bad value", "none": "missing field"}


def test_mark_comes_from_footers(spark, scratch):
    """The mark of a stored target: pushed into the footers, settings restored, 0 for no table; copies are apart by id."""
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList")
    source = spark.range(1, 5001).withColumn("x", F.col("id") * 2).repartition(4)
    assert ing.stored_mark(spark, f"{scratch}/t", source.schema) == 0
    for top, n in ((1200, 1200), (1200, 0), (3000, 1800), (5000, 2000)):
        assert ing.copy_new_rows(spark, source.where(F.col("id") <= top), f"{scratch}/t") == n
        seen = []
        plain = ing.high_water_mark
        ing.high_water_mark = lambda df, c, seen=seen: (seen.append(df.agg(F.max(c))._jdf.queryExecution().executedPlan().toString()), plain(df, c))[1]
        try:
            assert ing.stored_mark(spark, f"{scratch}/t", source.schema) == top
        finally:
            ing.high_water_mark = plain
        assert "PushedAggregation: [MAX(id)]" in seen[0]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == v1
    target = spark.read.schema(source.schema).parquet(f"{scratch}/t")
    assert target.count() == 5000
    ranges = ing.id_ranges(target)
    assert ranges.count() >= 3 and ranges.where("not apart").isEmpty()


def test_files_that_overlap_are_not_apart(spark, scratch):
    spark.range(0, 100).coalesce(1).write.parquet(f"{scratch}/t")
    spark.range(50, 150).coalesce(1).write.mode("append").parquet(f"{scratch}/t")
    assert ing.id_ranges(spark.read.parquet(f"{scratch}/t")).where("not apart").count() == 1


def test_damaged_file_is_reported_once(spark, scratch):
    """Good files load; a damaged file and one without a record are a row each, whatever stands in their names."""
    rows = [("ABC.KA", "2025-01-02 00:00:00", 1.0), ("XYZ.KA", "2025-01-03 00:00:00", 2.0)]
    quotes = spark.createDataFrame(rows, "symbol string, ts string, close double").withColumn("ts", F.to_timestamp("ts")).coalesce(1)
    for k in (1, 2):
        quotes.write.parquet(f"{scratch}/in/good {k}+a%20")
    quotes.limit(0).coalesce(1).write.parquet(f"{scratch}/in/none")
    with open(f"{scratch}/in/torn %20+b.parquet", "wb") as fh:
        fh.write(b"PAR1 and then nothing")
    read = ing.read_quotes(spark, f"{scratch}/in", fmt="parquet", isolate=True)
    assert read.count() == 4
    bad = [r.file for r in ing.files_without_records(spark, f"{scratch}/in", read).collect()]
    assert len(bad) == 2 and any(x.endswith("/torn %20+b.parquet") for x in bad) and any("/none/" in x for x in bad)
    with pytest.raises(Exception):
        ing.read_quotes(spark, f"{scratch}/in/*.parquet", fmt="parquet").count()


def test_table_by_ddl_and_insert_by_position(spark, scratch):
    from pyspark.errors import AnalysisException
    from pyspark.sql.types import StructType

    from tickerlake.plans import build

    schema = StructType.fromDDL("a string, b bigint")
    ing.ensure_table(spark, "positional_t", schema, f"{scratch}/t")
    ing.append_positional(spark.createDataFrame([("x", 1)], "b string, a bigint"), "positional_t")
    ing.ensure_table(spark, "positional_t", schema, f"{scratch}/t")  # exists: rows stay
    for wrong in ("b string", "a string, b bigint, c int"):
        frame = spark.createDataFrame([], wrong)
        with pytest.raises(AnalysisException):
            ing.append_positional(frame, "positional_t")
    build.create_view(spark, "positional_v", "SELECT b AS n FROM positional_t WHERE a = 'x'")
    assert [tuple(r) for r in spark.newSession().sql("SELECT n FROM positional_v").collect()] == [(1,)]
