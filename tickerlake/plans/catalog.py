"""Query catalogue: name -> callable(spark, sf_dir) -> DataFrame.

Each entry derives its feeds from the test tables under ``sf_dir`` and runs
one mart or operator on them.  ``finalize`` casts exact DECIMAL outputs to
DOUBLE at the very end so results compare bit-for-bit with the SQL oracle.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from tickerlake import schemas
from tickerlake.functions.cleaning import clean_numeric, clean_text, strip_token
from tickerlake.operators import indicators as ind
from tickerlake.operators import market as mkt
from tickerlake.operators import payload as pl
from tickerlake.operators import portfolio as pf
from tickerlake.operators import quality as dq
from tickerlake.operators import report as rpt
from tickerlake.operators import staging as stg
from tickerlake.plans import build
from tickerlake.plans.build import GOLD, build_stored
from tickerlake.sources import ingest as ing
from tickerlake.sources import tables
from tickerlake.sources.feeds import Feeds
from tickerlake.streaming import bars as sbars

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else c)
    return df.select(*cols)


def query(name: str):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(Feeds(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


# --- silver -----------------------------------------------------------------

@query("stg_bars")
def _stg_bars(f: Feeds) -> DataFrame:
    return stg.stage_bars(f.bars())


# --- indicators ---------------------------------------------------------------

@query("technical_indicators")
def _technical_indicators(f: Feeds) -> DataFrame:
    return ind.technical_indicators(stg.stage_bars(f.bars()))


# --- raw scans and cleaning -----------------------------------------------------


@query("scan_board")
def _scan_board(f: Feeds) -> DataFrame:
    return f.board()


@query("scan_bars")
def _scan_bars(f: Feeds) -> DataFrame:
    return f.bars()


@query("clean_strings")
def _clean_strings(f: Feeds) -> DataFrame:
    b = f.board()
    return b.select(
        "id",
        F.trim(strip_token("symbol", stg.XD_MARKER)).alias("symbol"),
        clean_text("ldcp").alias("ldcp_clean"),
        clean_text("current").alias("current_clean"),
        clean_text("change_1", ("%", ",")).alias("change_pct_clean"),
        clean_text("idx_wtg", ("%", ",")).alias("idx_weight_clean"),
        clean_text("market_cap_m").alias("market_cap_clean"),
    )


@query("stg_board")
def _stg_board(f: Feeds) -> DataFrame:
    return stg.stage_board(f.board())


@query("stg_board_dedupe")
def _stg_board_dedupe(f: Feeds) -> DataFrame:
    return stg.stage_board(f.board(), exclusions=(), grain="day")


@query("stg_board_intraday")
def _stg_board_intraday(f: Feeds) -> DataFrame:
    """Several snapshots a day, kept to the latest row of each symbol and day."""
    hours = F.make_dt_interval(hours=(F.col("id") % 24).cast("int"))
    return stg.stage_board(f.board().withColumn("fetched_at", F.col("fetched_at") + hours), exclusions=(), grain="day")


@query("clean_strict")
def _clean_strict(f: Feeds) -> DataFrame:
    """Board fields cast strictly: index weights always cast; ``refused`` tells that the dash of an unknown market cap raises."""
    from pyspark.errors import PySparkException

    board = f.board()
    try:
        board.select(clean_numeric("market_cap_m", mode="strict")).write.format("noop").mode("overwrite").save()
        refused = False
    except PySparkException:
        refused = True
    return board.select("id", clean_numeric("idx_wtg", ("%", ","), mode="strict").alias("idx_weight"),
                        clean_numeric("volume", mode="strict").alias("volume"), F.lit(refused).alias("refused"))


# Exclusion entries built by rule: every 7th symbol with blank ldcp and
# current text.  They hit rows whose fields are both blank (dropped: TRUE)
# and rows whose ldcp is NULL with a blank current (dropped: NULL).
TEST_EXCLUSIONS = tuple((f"C{k}", "", "") for k in range(0, 100, 7))


@query("stg_board_exclusions")
def _stg_board_exclusions(f: Feeds) -> DataFrame:
    return stg.stage_board(f.board(), exclusions=stg.DEFAULT_EXCLUSIONS + TEST_EXCLUSIONS)


def _board(f: Feeds) -> DataFrame:
    return stg.stage_board(f.board())


# --- market marts -----------------------------------------------------------------

@query("top_movers")
def _top_movers(f: Feeds) -> DataFrame:
    return mkt.top_movers(_board(f))


@query("top_movers_k")
def _top_movers_k(f: Feeds) -> DataFrame:
    return mkt.top_movers(_board(f), k=3, per="fetched_at")


@query("top_movers_global_k")
def _top_movers_global_k(f: Feeds) -> DataFrame:
    return mkt.top_movers(_board(f), k=10, per=None)


@query("volume_leaders_k")
def _volume_leaders_k(f: Feeds) -> DataFrame:
    return mkt.volume_leaders(_board(f), k=5)


@query("market_trend")
def _market_trend(f: Feeds) -> DataFrame:
    return mkt.market_trend(_board(f))


@query("sector_summary")
def _sector_summary(f: Feeds) -> DataFrame:
    return mkt.sector_summary(_board(f), f.sector_map())


@query("sector_market_cap")
def _sector_market_cap(f: Feeds) -> DataFrame:
    return mkt.sector_market_cap(mkt.sector_summary(_board(f), f.sector_map(), ordered=False))


# --- portfolio marts ----------------------------------------------------------------

@query("latest_board")
def _latest_board(f: Feeds) -> DataFrame:
    return pf.latest_board(_board(f))


@query("holdings_active")
def _holdings_active(f: Feeds) -> DataFrame:
    return pf.holdings_active(f.holdings())


def _snapshot(f: Feeds) -> DataFrame:
    return pf.portfolio_snapshot(f.holdings(), _board(f))


@query("portfolio_snapshot")
def _portfolio_snapshot(f: Feeds) -> DataFrame:
    return _snapshot(f)


@query("portfolio_summary")
def _portfolio_summary(f: Feeds) -> DataFrame:
    return pf.portfolio_summary(_snapshot(f))


@query("portfolio_weights")
def _portfolio_weights(f: Feeds) -> DataFrame:
    return pf.portfolio_weights(_snapshot(f))


@query("portfolio_weighted_change")
def _portfolio_weighted_change(f: Feeds) -> DataFrame:
    return pf.portfolio_weighted_change(_snapshot(f))


@query("trade_charges")
def _trade_charges(f: Feeds) -> DataFrame:
    return pf.trade_charges(f.trades())


@query("avg_buy")
def _avg_buy(f: Feeds) -> DataFrame:
    return pf.avg_buy(f.trades())


@query("portfolio_trades")
def _portfolio_trades(f: Feeds) -> DataFrame:
    return pf.realized_trades(f.trades())


@query("realized_pnl")
def _realized_pnl(f: Feeds) -> DataFrame:
    return pf.realized_totals(f.trades())


@query("avg_buy_asof")
def _avg_buy_asof(f: Feeds) -> DataFrame:
    return pf.avg_buy_asof(f.trades())


@query("portfolio_trades_asof")
def _portfolio_trades_asof(f: Feeds) -> DataFrame:
    return pf.realized_trades_asof(f.trades())


@query("tax_summary")
def _tax_summary(f: Feeds) -> DataFrame:
    return pf.tax_summary(f.tax())


# --- indicator history (every bar) -------------------------------------------------------

def _history(f: Feeds) -> DataFrame:
    return ind.indicator_history(stg.stage_bars(f.bars()))


@query("technical_indicators_via_history")
def _technical_indicators_via_history(f: Feeds) -> DataFrame:
    """Last row per symbol of the history plan: must equal the latest-day plan."""
    from pyspark.sql import Window

    h = _history(f)
    w = Window.partitionBy("symbol").orderBy(F.col("price_date").desc())
    return h.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


@query("price_changes")
def _price_changes(f: Feeds) -> DataFrame:
    return ind.price_changes(stg.stage_bars(f.bars()))


@query("indicator_history")
def _indicator_history(f: Feeds) -> DataFrame:
    return _history(f)


@query("sma_history")
def _sma_history(f: Feeds) -> DataFrame:
    return _history(f).select("symbol", "price_date", "close", "sma_50", "pct_vs_sma_50", "sma_200",
                              "pct_vs_sma_200")


@query("range_52w_history")
def _range_history(f: Feeds) -> DataFrame:
    return _history(f).select("symbol", "price_date", "close", "high_52w", "low_52w", "pct_vs_high_52w")


@query("volume_ratio_history")
def _volume_history(f: Feeds) -> DataFrame:
    return _history(f).select("symbol", "price_date", "volume", "avg_volume_20", "volume_ratio_20")


@query("rsi_history")
def _rsi_history(f: Feeds) -> DataFrame:
    return _history(f).select("symbol", "price_date", "close", "rsi_14")


# --- data quality ---------------------------------------------------------------------------


@query("dq_not_null")
def _dq_not_null(f: Feeds) -> DataFrame:
    return dq.not_null(_board(f), "ldcp").select("id", "fetched_at", "symbol")


@query("dq_unique")
def _dq_unique(f: Feeds) -> DataFrame:
    return dq.unique(_board(f), "symbol")


@query("dq_unique_combo")
def _dq_unique_combo(f: Feeds) -> DataFrame:
    return dq.unique_combination(f.trades(), ["trade_id", "broker"])


@query("dq_relationships")
def _dq_relationships(f: Feeds) -> DataFrame:
    return dq.relationships(_board(f), "symbol", f.sector_map(), "symbol").select("id", "symbol")


@query("dq_expression")
def _dq_expression(f: Feeds) -> DataFrame:
    return (dq.expression_is_true(_board(f), "change_amount >= 0", where="change_amount is not null")
            .select("id", "symbol", "change_amount"))


def _inputs(f: Feeds) -> dict[str, DataFrame]:
    return {"board": f.board(), "bars": f.bars(), "sector_map": f.sector_map(), "holdings": f.holdings(),
            "trades": f.trades(), "tax": f.tax()}


def mart_tables(f: Feeds) -> dict[str, DataFrame]:
    """The datasets under check, stored once and read back."""
    inputs = _inputs(f)
    names = ("portfolio_snapshot", "portfolio_summary", "technical_indicators")
    return {**build_stored(inputs, _landing(f, "checked"), names), "holdings": inputs["holdings"]}


@query("dq_report")
def _dq_report(f: Feeds) -> DataFrame:
    return dq.quality_report(dq.standard_checks(), mart_tables(f))


@query("publish_gate")
def _publish_gate(f: Feeds) -> DataFrame:
    """A build that passes its checks and one that does not (some bars twice), and what readers resolve then.

    Attempts 1 and 2: the checks and their failures.  Attempt 0: the rows of each dataset that is live afterwards.
    """
    from tickerlake.plans import publish as pub

    base, inputs = _landing(f, "publish"), _inputs(f)
    twice = inputs["bars"].where(F.col("id") % 50 == 0)
    first = pub.publish(inputs, base)
    second = pub.write_checked(dict(inputs, bars=inputs["bars"].unionByName(twice)), base)
    try:
        pub.make_live(f.spark, base, second)
    except dq.QualityError:
        pass
    out = None
    for attempt, version in ((1, first), (2, second)):
        report = pub.read_report(f.spark, base, version)
        part = report.select(F.lit(attempt).alias("attempt"), F.col("check_name").alias("item"), F.col("failures").alias("n"), "passed")
        out = part if out is None else out.unionByName(part)
    for name in ("stg_board", "stg_bars", *GOLD):
        live = pub.read_live(f.spark, base, name)
        out = out.unionByName(live.agg(F.count("*").alias("n")).select(
            F.lit(0).alias("attempt"), F.lit(name).alias("item"), "n", F.lit(True).alias("passed")))
    return out


# --- report ----------------------------------------------------------------------------------

@query("report_summary")
def _report_summary(f: Feeds) -> DataFrame:
    return rpt.report_summary(pf.portfolio_summary(_snapshot(f)), pf.realized_totals(f.trades()))


@query("report_holdings")
def _report_holdings(f: Feeds) -> DataFrame:
    return rpt.report_holdings(_snapshot(f))


@query("report_technicals")
def _report_technicals(f: Feeds) -> DataFrame:
    return rpt.report_technicals(_snapshot(f), ind.technical_indicators(stg.stage_bars(f.bars())))


@query("technicals_lines")
def _technicals_lines(f: Feeds) -> DataFrame:
    return rpt.technicals_line(ind.technical_indicators(stg.stage_bars(f.bars())))


# --- JSON payloads -----------------------------------------------------------------------------

@query("json_props")
def _json_props(f: Feeds) -> DataFrame:
    schema = StructType.fromDDL("k int")
    fallback = F.struct(F.lit(-1).alias("k"))
    e = f.table("events")
    return e.select("event_id", pl.parse_payload("props", schema, fallback)["k"].alias("k"))


def events_payload(events: DataFrame) -> DataFrame:
    """A two-person payload per event, serialised to JSON text."""
    people = F.array(
        F.struct(F.col("event_type").alias("craft"),
                 F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name")),
        F.struct(F.lit("ground").alias("craft"),
                 F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("name")))
    return events.select("event_id", F.to_json(F.struct(F.lit(2).alias("number"),
                                                        people.alias("people"))).alias("body"))


@query("json_explode")
def _json_explode(f: Feeds) -> DataFrame:
    p = events_payload(f.table("events")).select(
        "event_id", pl.parse_payload("body", pl.PEOPLE_SCHEMA).alias("payload"))
    return pl.explode_lines(p, keep=("event_id",))


# --- ingestion ---------------------------------------------------------------------------------

# Fixed value used as the ingestion stamp in the catalogued runs.
INGESTED_AT = "2024-02-01 13:15:00"


def landed_quotes(events: DataFrame) -> DataFrame:
    """Quote records as landed JSON text, one per event; some are damaged.

    Error events with id divisible by 7 lose their closing brace
    (unparseable); signup events with id divisible by 11 lack a close.
    """
    rec = F.to_json(F.struct(
        F.concat(F.upper("event_type"), F.lit(ing.TICKER_SUFFIX)).alias("symbol"),
        F.col("ts"),
        F.col("value").alias("open"),
        (F.col("value") + 1).alias("high"),
        (F.col("value") - 1).alias("low"),
        F.when(~((F.col("event_type") == "signup") & (F.col("event_id") % 11 == 0)), F.col("value")).alias("close"),
        (F.col("user_id") * 1.5).alias("volume"),
        F.lit(0.0).alias("dividends"),
        F.lit(0.0).alias("stock_splits")))
    broken = (F.col("event_type") == "error") & (F.col("event_id") % 7 == 0)
    text = F.when(broken, F.regexp_replace(rec, r"\}$", "")).otherwise(rec)
    return events.select("event_id", text.alias("value"))


@query("ingest_bars_normalize_local")
def _ingest_normalize_local(f: Feeds) -> DataFrame:
    """Same quotes dated by the exchange-local day instead of the UTC day."""
    good, _ = ing.split_corrupt(_parsed_quotes(f))
    stamp = F.lit(INGESTED_AT).cast("timestamp_ntz")
    return ing.normalize_quotes(good, day_of="exchange", ingested_at=stamp, keep=("event_id",))


def _parsed_quotes(f: Feeds) -> DataFrame:
    # a generator: as a plain column the parse would be repeated for every field of it
    return landed_quotes(f.table("events")).select("event_id", F.inline(F.array(ing.parse_quotes(F.col("value")))))


@query("ingest_bars_quarantine")
def _ingest_quarantine(f: Feeds) -> DataFrame:
    _, bad = ing.split_corrupt(_parsed_quotes(f))
    return bad.select("event_id", "reason")


@query("ingest_bars_normalize")
def _ingest_normalize(f: Feeds) -> DataFrame:
    good, _ = ing.split_corrupt(_parsed_quotes(f))
    stamp = F.lit(INGESTED_AT).cast("timestamp_ntz")
    return ing.normalize_quotes(good, ingested_at=stamp, keep=("event_id",))


@query("ingest_default_stamp")
def _ingest_default_stamp(f: Feeds) -> DataFrame:
    """Quotes stamped with the current UTC time: each within an hour of the engine's own clock, whatever the session zone."""
    good, _ = ing.split_corrupt(_parsed_quotes(f))
    now = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    age = F.timestamp_diff("MINUTE", F.col("fetched_at").cast("timestamp"), now.cast("timestamp"))
    return ing.normalize_quotes(good, keep=("event_id",)).select("event_id", age.between(-60, 60).alias("stamped_now"))


@query("upsert_insert_only")
def _upsert_insert_only(f: Feeds) -> DataFrame:
    """A re-fetch that overlaps history: first write per key wins, existing keys are skipped."""
    bars = f.bars()
    target = bars.where(F.col("price_date") < F.lit("1998-01-01").cast("date"))
    refetch = (bars.withColumn("arrival", F.lit(0))
               .unionByName(bars.withColumn("close", F.col("close") + 1).withColumn("arrival", F.lit(1))))
    return ing.insert_only(target, refetch, ["symbol", "price_date"], [F.col("arrival"), F.col("id")]) \
        .drop("arrival")


def _digest(name: str, df: DataFrame) -> DataFrame:
    """Per column of a dataset: its row count, values, and their exact total (days of dates, lengths of text)."""
    def number(field):
        c = F.col(field.name)
        kind = field.dataType.simpleString()
        if kind == "string":
            c = F.char_length(c)
        elif kind in ("date", "timestamp_ntz"):
            c = F.datediff(c, F.lit("1970-01-01").cast("date"))
        return c.cast(DecimalType(38, 4))

    fields = df.schema.fields
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*[
        F.struct(F.lit(x.name).alias("column_name"), F.count(x.name).alias("n_values"),
                 F.sum(number(x)).alias("total")) for x in fields]).alias("c"))
    return one.select(F.lit(name).alias("dataset"), "n_rows", F.inline("c"))


@query("build_all")
def _build_all(f: Feeds) -> DataFrame:
    """The full build: every dataset written to the shared folder, read back and digested by column."""
    parts = [_digest(name, df) for name, df in build_stored(_inputs(f), _landing(f, "build")).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("marts_in_order")
def _marts_in_order(f: Feeds) -> DataFrame:
    """Marts written by their sort key: rows, and whether their files hold ranges of the first key that do not overlap."""
    names = {"technical_indicators": "symbol", "tax_summary": "broker"}
    stored = build_stored(_inputs(f), _landing(f, "ordered"), tuple(names))
    out = None
    for name, key in names.items():
        files = ing.id_ranges(stored[name], key)  # equal keys of neighbouring files may meet at their ends
        part = files.agg(F.sum("n").alias("n_rows"), F.coalesce(F.bool_and("in_order"), F.lit(True)).alias("in_order"))
        part = part.select(F.lit(name).alias("dataset"), "n_rows", "in_order")
        out = part if out is None else out.unionByName(part)
    return out


def _landing(f: Feeds, kind: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    import uuid

    from tickerlake.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(f.spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


@query("seed_load")
def _seed_load(f: Feeds) -> DataFrame:
    """The trades feed written as a seed CSV (M/d/yyyy dates), loaded back with the declared schema."""
    from tickerlake.sources import seeds

    path = _landing(f, "seeds")
    (f.trades().withColumn("trade_date", F.date_format("trade_date", seeds.TRADE_DATE_FORMAT))
     .write.option("header", True).csv(path))
    return seeds.load_trades(f.spark, path)


@query("seed_load_holdings")
def _seed_load_holdings(f: Feeds) -> DataFrame:
    """The holdings feed as a seed CSV, loaded back."""
    from tickerlake.sources import seeds

    path = _landing(f, "seeds")
    f.holdings().write.option("header", True).csv(path)
    return seeds.load_holdings(f.spark, path)


@query("seed_load_sector_map")
def _seed_load_sector_map(f: Feeds) -> DataFrame:
    """The sector map feed as a seed CSV, loaded back."""
    from tickerlake.sources import seeds

    path = _landing(f, "seeds")
    f.sector_map().write.option("header", True).csv(path)
    return seeds.load_sector_map(f.spark, path)


@query("seed_load_tax")
def _seed_load_tax(f: Feeds) -> DataFrame:
    """The tax feed as seed CSVs, loaded back; lines without a refund end one field early."""
    from tickerlake.sources import seeds

    path, tax = _landing(f, "seeds"), f.tax()
    tax.where(F.col("cgt_refund").isNotNull()).write.option("header", True).csv(f"{path}/full")
    tax.where(F.col("cgt_refund").isNull()).drop("cgt_refund").write.option("header", True).csv(f"{path}/short")
    return seeds.load_tax(f.spark, f"{path}/*")


@query("landed_files_quarantine")
def _landed_files_quarantine(f: Feeds) -> DataFrame:
    """Quote files with truncated, incomplete, NaN and too large records, read back: bar rows and quarantine.

    On top of the damage of ``landed_quotes``, ids that leave 1 modulo 13 have a NaN close and
    ids that leave 2 a volume beyond a bigint.
    """
    path, events = _landing(f, "quotes"), f.table("events")
    hurt = F.col("event_id") % 13
    text = F.when(hurt == 1, F.regexp_replace("value", r'"close":[^,}]*', '"close":"NaN"')) \
        .when(hurt == 2, F.regexp_replace("value", r'"volume":[^,}]*', '"volume":1e30')).otherwise(F.col("value"))
    landed_quotes(events).select(text.alias("value")).write.text(path)
    good, bad = ing.split_corrupt(ing.read_quotes(f.spark, path))
    stamp = F.lit(INGESTED_AT).cast("timestamp_ntz")
    bars = ing.normalize_quotes(good, ingested_at=stamp).select("symbol", "price_date", "close", "volume")
    return (bars.withColumn("reason", F.lit(None).cast("string"))
            .unionByName(bad.select("reason"), allowMissingColumns=True))


@query("landed_files_isolated")
def _landed_files_isolated(f: Feeds) -> DataFrame:
    """Quotes landed as Parquet files next to a damaged one: every bar, and one row for that file."""
    base = _landing(f, "landed")
    quotes = _parsed_quotes(f).drop("event_id")
    # dealt to a few files, so that none of them is without a record
    quotes.where(F.col(ing.CORRUPT).isNull()).drop(ing.CORRUPT).repartition(4).write.parquet(f"{base}/day=1")
    f.spark.createDataFrame([("PAR1 cut short",)], "value string").coalesce(1).write.text(f"{base}/day=2")
    read = ing.read_quotes(f.spark, base, fmt="parquet", isolate=True)
    good, bad = ing.split_corrupt(read)
    bars = ing.normalize_quotes(good, ingested_at=F.lit(INGESTED_AT).cast("timestamp_ntz"))
    files = ing.files_without_records(f.spark, base, read)
    return (bars.select("symbol", "price_date", "close", F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select("reason"), allowMissingColumns=True)
            .unionByName(files.select("reason"), allowMissingColumns=True))


@query("incremental_copy")
def _incremental_copy(f: Feeds) -> DataFrame:
    """Events above the mark of a target that was last synced on 2024-01-20."""
    events = f.table("events")
    target = events.where(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return ing.incremental_copy(events, target, "event_id")


@query("copy_by_id")
def _copy_by_id(f: Feeds) -> DataFrame:
    """Events copied in three runs as they come in, each from the mark in the target's footers: the target by id.

    Every 97th event of the first run arrives only after it, below the mark, and is never copied.
    ``files_apart`` tells that no two files of the target share a range of ids.
    """
    base, events, k = _landing(f, "copy"), f.table("events"), F.col("event_id")
    top = events.agg(F.max("event_id")).first()[0] or 0
    first = events.where((k <= top * 4 // 10) & (k % 97 != 0))
    for arrived in (first, events.where(k <= top * 7 // 10), events, events):
        ing.copy_new_rows(f.spark, arrived, base, "event_id")
    copied = f.spark.read.schema(events.schema).parquet(base)
    apart = ing.id_ranges(copied, "event_id").agg(F.coalesce(F.bool_and("apart"), F.lit(True))).scalar()
    return copied.select("event_id", "ts", "event_type", "value", apart.alias("files_apart"))


@query("read_bars_range")
def _read_bars_range(f: Feeds) -> DataFrame:
    """A range of days of the stored bars: only the folders of its months are scanned."""
    import datetime as dt

    path = _landing(f, "bars")
    tables.write_bars(f.bars(), path)
    return tables.read_bars(f.spark, path, since=dt.date(1996, 2, 10), until=dt.date(1997, 3, 20))


@query("read_board")
def _read_board(f: Feeds) -> DataFrame:
    """The raw board stored as it came and read with its declared schema."""
    path = _landing(f, "board")
    tables.write_board(f.board(), path)
    return tables.read_board(f.spark, path)


@query("catalog_objects")
def _catalog_objects(f: Feeds) -> DataFrame:
    """A table created by DDL if absent (twice), filled by position, and a persistent view over it, read by name.

    An insert with a column too few is refused and adds nothing (``refused``).
    """
    import uuid

    from pyspark.errors import AnalysisException

    spark, path, name = f.spark, _landing(f, "ddl"), f"holdings_{uuid.uuid4().hex}"
    holdings = f.holdings()
    for _ in range(2):
        ing.ensure_table(spark, name, schemas.HOLDINGS, path)
    renamed = holdings.toDF(*[f"c{i}" for i in range(len(holdings.columns))])  # by position, whatever the names
    ing.append_positional(renamed, name)
    try:
        ing.append_positional(renamed.drop("c4"), name)
        refused = False
    except AnalysisException:
        refused = True
    build.create_view(spark, f"{name}_active", f"SELECT symbol, sector, qty_held, avg_buy_rate FROM {name} WHERE status = 'active'")
    return spark.table(f"{name}_active").withColumn("refused", F.lit(refused))


# --- ticks ---------------------------------------------------------------------------------------


@query("daily_bars")
def _daily_bars(f: Feeds) -> DataFrame:
    return sbars.daily_bars(f.ticks())


@query("stream_upsert_insert_only")
def _stream_upsert_insert_only(f: Feeds) -> DataFrame:
    """Bars history plus a landed re-fetch, ingested by the insert-only stream: the final table.

    The target already holds the bars before 1998; two landed batches carry every bar, the
    second a day later with changed closes.  First write wins, so the table ends up equal to
    the original bars.
    """
    import uuid

    from tickerlake.session import ensure_checkpoint_dir
    from tickerlake.streaming import ingest as sing

    spark = f.spark
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/insert_only/{uuid.uuid4().hex}"
    bars = f.bars()
    bars.where(F.col("price_date") < F.lit("1998-01-01").cast("date")).write.parquet(f"{base}/target")
    bars.write.parquet(f"{base}/landing/batch=0")
    (bars.withColumn("close", (F.col("close") + 1).cast(bars.schema["close"].dataType))
     .withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 DAY"))
     .write.parquet(f"{base}/landing/batch=1"))
    stream = spark.readStream.schema(bars.schema).option("recursiveFileLookup", "true") \
        .parquet(f"{base}/landing")
    sing.await_available_now(sing.stream_insert_only(
        stream, f"{base}/target", ["symbol", "price_date"], [F.col("fetched_at"), F.col("id")],
        f"{base}/ckpt", prune_on="price_date"))
    return spark.read.parquet(f"{base}/target")


def _stream_path(sf_dir: str, name: str) -> str:
    """A glob for exactly one table, be it a file or a folder of part files (a plain path must be a folder)."""
    return f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet"


@query("stream_incremental_copy")
def _stream_incremental_copy(f: Feeds) -> DataFrame:
    """The events file copied by the file-source stream, run twice on one checkpoint.

    The second run finds no new files, so the target holds every event exactly once.
    """
    import uuid

    from tickerlake.session import ensure_checkpoint_dir
    from tickerlake.streaming import ingest as sing

    spark = f.spark
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/copy/{uuid.uuid4().hex}"
    schema = f.table("events").schema
    for _ in range(2):
        stream = spark.readStream.schema(schema).parquet(_stream_path(f.sf_dir, "events"))
        sing.await_available_now(sing.stream_copy(stream, f"{base}/target", f"{base}/ckpt"))
    return spark.read.parquet(f"{base}/target")


@query("stream_dedupe")
def _stream_dedupe(f: Feeds) -> DataFrame:
    """Events landed twice, streamed through the watermark de-duplication: every event once."""
    import uuid

    from tickerlake.session import ensure_checkpoint_dir
    from tickerlake.streaming import ingest as sing

    spark = f.spark
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/dedupe/{uuid.uuid4().hex}"
    ticks = f.ticks()
    for copy in (0, 1):
        ticks.write.parquet(f"{base}/landing/copy={copy}")
    stream = spark.readStream.schema(ticks.schema).option("recursiveFileLookup", "true") \
        .parquet(f"{base}/landing")
    q = (sing.dedupe_stream(stream, ["event_id"], "ts", "1 hour").writeStream.format("parquet")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    sing.await_available_now(q)
    return spark.read.parquet(f"{base}/out")


@query("stream_bars_sink")
def _stream_bars_sink(f: Feeds) -> DataFrame:
    """Landed bars into the month-partitioned bars table: micro-batches, a restart, late re-fetches and a full replay.

    The table holds the bars before 1998.  The first run brings the bars of even ids and stops.
    Then all bars land twice more with closes raised by 1 and 2; the second run goes on from the
    checkpoint, a few files a micro-batch.  A third run with a checkpoint of its own replays
    everything and adds nothing.  First write wins, so odd ids since 1998 have closes raised by 1.
    """
    from tickerlake.streaming import ingest as sing

    spark, base, bars = f.spark, _landing(f, "streams/bars_sink"), f.bars()
    money = bars.schema["close"].dataType

    def land(n: int, rows: DataFrame) -> None:
        raised = rows.withColumn("close", (F.col("close") + n).cast(money))
        raised.withColumn("fetched_at", F.col("fetched_at") + F.expr(f"INTERVAL {n} DAY")).write.parquet(f"{base}/landing/batch={n}")

    def run(checkpoint: str) -> None:
        stream = (spark.readStream.schema(bars.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 4)
                  .parquet(f"{base}/landing"))
        sing.await_available_now(sing.stream_insert_only(
            stream, f"{base}/target", ["symbol", "price_date"], [F.col("fetched_at"), F.col("id")], f"{base}/{checkpoint}"))

    tables.write_bars(bars.where(F.col("price_date") < F.lit("1998-01-01").cast("date")), f"{base}/target")
    land(0, bars.where(F.col("id") % 2 == 0))
    run("ckpt")
    land(1, bars)
    land(2, bars)
    run("ckpt")
    run("replay")
    return tables.read_bars(spark, f"{base}/target")


@query("stream_dedupe_carried")
def _stream_dedupe_carried(f: Feeds) -> DataFrame:
    """Events with copies in later files, de-duplicated over three runs of one checkpoint; ``late_rows`` counts what came too late.

    Copies of the half day before each cut arrive after it and are known from the carried state.
    Every 50th event before January 5th arrives only after the first cut, and the events of January
    8th once more after the second, later than the delay of a day allows.
    """
    from tickerlake.streaming import ingest as sing

    spark, base, ticks = f.spark, _landing(f, "streams/dedupe_carried"), f.ticks()
    ts, held = F.col("ts"), (F.col("ts") < "2024-01-05") & (F.col("event_id") % 50 == 0)
    arrivals = (
        ticks.where((ts < "2024-01-10") & ~held),
        ticks.where(((ts >= "2024-01-09 12:00:00") & (ts < "2024-01-20")) | held),
        ticks.where((ts >= "2024-01-19 12:00:00") | ts.between("2024-01-08", "2024-01-08 23:59:59.999999")),
    )
    late = 0
    for n, rows in enumerate(arrivals):
        rows.write.parquet(f"{base}/landing/part={n}")
        stream = spark.readStream.schema(ticks.schema).option("recursiveFileLookup", "true").parquet(f"{base}/landing")
        run = sing.stream_dedupe(stream, f"{base}/out", ["event_id"], "ts", "1 day", f"{base}/ckpt")
        sing.await_available_now(run)
        late += sing.late_rows(run)
    return spark.read.parquet(f"{base}/out").withColumn("late_rows", F.lit(late).cast("bigint"))


@query("stream_daily_bars")
def _stream_daily_bars(f: Feeds) -> DataFrame:
    """The events file replayed as a stream (1-day watermark, AvailableNow run): the emitted bars.

    Append mode emits a day once the watermark (latest tick - 1 day) passes its end, so the
    result equals the batch bars of every closed day.  Output and checkpoint go to a fresh
    folder under the session's checkpoint directory.
    """
    import uuid

    from tickerlake.session import ensure_checkpoint_dir
    from tickerlake.streaming import ingest as sing

    spark = f.spark
    schema = f.table("events").schema
    stream = spark.readStream.schema(schema).parquet(_stream_path(f.sf_dir, "events"))
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/daily_bars/{uuid.uuid4().hex}"
    sing.await_available_now(sing.run_stream_bars(stream, f"{base}/out", f"{base}/ckpt", delay="1 day"))
    return spark.read.parquet(f"{base}/out")
