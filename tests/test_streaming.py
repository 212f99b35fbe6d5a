"""Structured Streaming jobs against their batch definitions (AvailableNow runs)."""

import datetime as dt

from pyspark.sql import functions as F

from tickerlake.streaming import bars as sb
from tickerlake.streaming import ingest as si

SF = "/root/testdata/sf0.001"


def _land_events_by_day(spark, folder, cut_days):
    """Write the events table as one Parquet file per day range (arrival order)."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    bounds = [None] + cut_days + [None]
    for i in range(len(bounds) - 1):
        part = ev
        if bounds[i]:
            part = part.where(F.col("ts") >= F.lit(bounds[i]).cast("timestamp_ntz"))
        if bounds[i + 1]:
            part = part.where(F.col("ts") < F.lit(bounds[i + 1]).cast("timestamp_ntz"))
        part.coalesce(1).write.parquet(f"{folder}/part={i}")
    return ev


def test_stream_bars_equal_batch_on_closed_days(spark, scratch):
    ev = _land_events_by_day(spark, f"{scratch}/src", ["2024-01-10", "2024-01-20"])
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{scratch}/src"))
    q = si.run_stream_bars(stream, f"{scratch}/out", f"{scratch}/ckpt", delay="1 day")
    q.awaitTermination(240)
    got = {(r.symbol, r.price_date): tuple(r)[2:] for r in spark.read.parquet(f"{scratch}/out").collect()}
    batch = {(r.symbol, r.price_date): tuple(r)[2:] for r in sb.daily_bars(ev).collect()}
    last_day = max(d for _, d in batch)
    assert got and all(batch[k] == v for k, v in got.items())
    closed = {k for k in batch if k[1] <= last_day - dt.timedelta(days=2)}
    assert closed <= set(got)


def test_stream_insert_only_two_batches_and_replay(spark, scratch):
    schema = "symbol string, price_date date, close int, arrival int"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    spark.createDataFrame([("A", d1, 10, 0), ("B", d1, 20, 0), ("B", d1, 21, 1)], schema) \
        .coalesce(1).write.parquet(f"{scratch}/in/b=1")
    spark.createDataFrame([("A", d1, 99, 0), ("A", d2, 11, 0)], schema).coalesce(1).write.parquet(f"{scratch}/in/b=2")

    def run(ckpt):
        s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
             .option("recursiveFileLookup", "true").parquet(f"{scratch}/in"))
        si.stream_insert_only(s, f"{scratch}/target", ["symbol", "price_date"], ["arrival"], ckpt) \
            .awaitTermination(240)

    run(f"{scratch}/ck1")
    want = [("A", d1, 10), ("A", d2, 11), ("B", d1, 20)]
    got = sorted((r.symbol, r.price_date, r.close) for r in spark.read.parquet(f"{scratch}/target").collect())
    assert got == want
    run(f"{scratch}/ck2")  # full replay from scratch: nothing new
    got = sorted((r.symbol, r.price_date, r.close) for r in spark.read.parquet(f"{scratch}/target").collect())
    assert got == want


def test_dedupe_stream_matches_distinct_keys(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "event_type")
    ev.unionByName(ev).coalesce(2).write.parquet(f"{scratch}/dup")
    s = spark.readStream.schema(ev.schema).parquet(f"{scratch}/dup")
    out = si.dedupe_stream(s, ["event_id"], "ts", "1 hour")
    q = (out.writeStream.format("parquet").option("path", f"{scratch}/dd")
         .option("checkpointLocation", f"{scratch}/ddck").trigger(availableNow=True).start())
    q.awaitTermination(240)
    assert spark.read.parquet(f"{scratch}/dd").count() == ev.count()


def test_stream_copy_is_incremental(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.where("event_id < 100").write.parquet(f"{scratch}/src/p=1")

    def run():
        s = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(f"{scratch}/src")
        si.stream_copy(s, f"{scratch}/dst", f"{scratch}/ck").awaitTermination(240)

    run()
    assert spark.read.parquet(f"{scratch}/dst").count() == 100
    ev.where("event_id >= 100").write.parquet(f"{scratch}/src/p=2")
    run()
    assert spark.read.parquet(f"{scratch}/dst").count() == ev.count()


def test_stream_bars_emitted_day_is_final(spark, scratch):
    """Append mode emits a closed day once; a tick for it arriving later is not re-emitted."""
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    t = lambda d, h: dt.datetime(2024, 1, d, h)
    batches = [
        [(1, t(1, 10), "a", 1.0), (2, t(1, 12), "a", 3.0), (3, t(5, 9), "a", 5.0)],
        [(4, t(6, 10), "a", 6.0)],          # watermark now past Jan 1: its bar is emitted
        [(5, t(1, 23), "a", 100.0), (6, t(7, 10), "a", 7.0)],   # late tick for Jan 1
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/src/b={i}")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{scratch}/src"))
    si.run_stream_bars(stream, f"{scratch}/out", f"{scratch}/ck", delay="1 day").awaitTermination(240)
    rows = [r for r in spark.read.parquet(f"{scratch}/out").collect() if r.price_date == dt.date(2024, 1, 1)]
    assert [(r.open, r.high, r.close, r.volume) for r in rows] == [(1.0, 3.0, 3.0, 2)]


def test_stream_bars_accepts_instant_timestamps(spark, scratch):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ltz = ev.withColumn("ts", F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))
    ltz.write.parquet(f"{scratch}/src")
    stream = spark.readStream.schema(ltz.schema).parquet(f"{scratch}/src")
    si.run_stream_bars(stream, f"{scratch}/out", f"{scratch}/ck").awaitTermination(240)
    got = {(r.symbol, r.price_date): tuple(r)[2:] for r in spark.read.parquet(f"{scratch}/out").collect()}
    batch = {(r.symbol, r.price_date): tuple(r)[2:] for r in sb.daily_bars(ev).collect()}
    assert got and all(batch[k] == v for k, v in got.items())


def test_stream_reads_files_and_folders(spark, scratch):
    """The registered streams read a table alike whether it is one file or a folder of part files."""
    import os

    from tickerlake.plans.catalog import QUERIES

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{scratch}/events.parquet")
    assert os.path.isdir(f"{scratch}/events.parquet")
    assert QUERIES["stream_incremental_copy"](spark, scratch).count() == events.count()
    assert QUERIES["stream_incremental_copy"](spark, "/root/testdata/sf0.001").count() == events.count()
    assert QUERIES["stream_daily_bars"](spark, scratch).count() == QUERIES["stream_daily_bars"](spark, "/root/testdata/sf0.001").count()


def test_sink_that_dies_after_its_write_adds_nothing_on_restart(spark, scratch, monkeypatch):
    """A run stopped between a micro-batch's append and its commit repeats that batch; the month table keeps each key once."""
    import pytest

    from tickerlake.sources import tables
    from tickerlake.sources.feeds import Feeds

    bars = Feeds(spark, SF).bars()
    old, new = bars.where("price_date < '1998-01-01'"), bars.where("price_date >= '1998-01-01'")
    tables.write_bars(old, f"{scratch}/target")
    bars.repartition(6).write.parquet(f"{scratch}/in")
    append, calls = si.append_insert_only, []

    def dies_once(*args):
        calls.append(append(*args))
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return calls[-1]

    def run():
        stream = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 2).parquet(f"{scratch}/in")
        q = si.stream_insert_only(stream, f"{scratch}/target", ["symbol", "price_date"], ["fetched_at", "id"], f"{scratch}/ckpt")
        si.await_available_now(q)
        return q

    monkeypatch.setattr(si, "append_insert_only", dies_once)
    with pytest.raises(Exception, match="executor lost"):
        run()
    run()
    assert len(calls) == 4 and calls[2] == 0 and sum(calls) == new.count() > 0
    back = tables.read_bars(spark, f"{scratch}/target")
    assert back.count() == bars.count() and back.exceptAll(bars).isEmpty()
    assert "price_month" in spark.read.parquet(f"{scratch}/target").columns


def test_state_is_carried_over_a_restart_and_late_rows_are_counted(spark, scratch):
    """A copy in a later run is dropped by the state of the run before; a row beyond the delay is dropped and counted."""
    schema = "event_id long, ts timestamp_ntz"
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    parts = [[(1, t(1)), (2, t(5)), (2, t(5))], [(2, t(5)), (3, t(6)), (1, t(1)), (4, t(2))], [(3, t(6)), (5, t(9))]]
    late = []
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/in/p={i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{scratch}/in")
        q = si.stream_dedupe(stream, f"{scratch}/out", ["event_id"], "ts", "1 day", f"{scratch}/ckpt")
        si.await_available_now(q)
        late.append(si.late_rows(q))
    assert sorted(r.event_id for r in spark.read.parquet(f"{scratch}/out").collect()) == [1, 2, 3, 5]
    assert late == [0, 2, 0]
