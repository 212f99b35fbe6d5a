"""Technical indicators over daily bars.

Two physical shapes of one definition:

* ``technical_indicators`` (latest day per symbol): ``row_number() <= 252``
  over descending dates is planned as a WindowGroupLimit on the map side, so
  each input partition ships at most 252 rows per symbol through the shuffle;
  the frames then collapse into one grouped aggregate with ``FILTER``-style
  conditional sums.
* ``indicator_history`` (every day): trailing-row frames evaluated on
  skew-proof chunks (see ``rolling``), sums and counts from running totals.

Both keep prices as DECIMAL so rounding is exact; ``tests`` check that the
latest plan equals the last row of the history plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tickerlake.functions.numeric import gated, ratio
from tickerlake.operators.rolling import (
    DEFAULT_BUCKET_DAYS,
    DEFAULT_CHUNK_ROWS,
    chunk_window,
    chunked_series,
    day_bucket,
)

# Frame lengths in trading rows.
SMA_SHORT = 50
SMA_LONG = 200
RANGE_ROWS = 252  # 52 weeks of trading days, approximated by rows
VOLUME_ROWS = 20
RSI_ROWS = 14

VOL_DEC = DecimalType(20, 0)

OUTPUT = ("symbol", "price_date", "close", "volume", "sma_50", "pct_vs_sma_50", "sma_200",
          "pct_vs_sma_200", "rsi_14", "high_52w", "low_52w", "pct_vs_high_52w",
          "avg_volume_20", "volume_ratio_20")


def _priced(bars: DataFrame) -> DataFrame:
    # Rows without a close are removed before any lag or frame.
    return (bars.where(F.col("close").isNotNull())
            .select("symbol", "price_date", "high", "low", "close", "volume"))


def _finish(df: DataFrame) -> DataFrame:
    """Gates, percentages and rounding from frame statistics.

    Expects: close, volume, sma50/n50, sma200/n200, hi, lo, vavg/nvol,
    gain, loss (sums over the RSI frame), nchg.
    """
    c = F.col("close")
    rsi = F.when(F.coalesce(F.col("loss"), F.lit(0)) == 0, F.lit(100).cast(DecimalType(5, 2))) \
        .otherwise(F.round(ratio(F.lit(100) * F.col("gain"), F.col("gain") + F.col("loss")), 2))
    return df.select(
        "symbol", "price_date", "close", "volume",
        gated(F.round("sma50", 4), "n50", SMA_SHORT).alias("sma_50"),
        gated(F.round(ratio(F.lit(100) * (c - F.col("sma50")), "sma50"), 2), "n50", SMA_SHORT).alias("pct_vs_sma_50"),
        gated(F.round("sma200", 4), "n200", SMA_LONG).alias("sma_200"),
        gated(F.round(ratio(F.lit(100) * (c - F.col("sma200")), "sma200"), 2), "n200", SMA_LONG).alias("pct_vs_sma_200"),
        gated(rsi, "nchg", RSI_ROWS).alias("rsi_14"),
        F.round("hi", 4).alias("high_52w"),
        F.round("lo", 4).alias("low_52w"),
        F.round(ratio(F.lit(100) * (c - F.col("hi")), "hi"), 2).alias("pct_vs_high_52w"),
        gated(F.round("vavg", 2), "nvol", VOLUME_ROWS).alias("avg_volume_20"),
        gated(F.round(ratio(F.col("volume").cast(VOL_DEC), "vavg"), 2), "nvol", VOLUME_ROWS).alias("volume_ratio_20"),
    )


def technical_indicators(bars: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per symbol: indicators on the symbol's latest trading day; ``ordered`` by symbol."""
    desc = Window.partitionBy("symbol").orderBy(F.col("price_date").desc())
    # The filter must stand alone above row_number so Catalyst plans a
    # pre-shuffle WindowGroupLimit; lead() is evaluated in a later window.
    recent = (_priced(bars).withColumn("rn", F.row_number().over(desc))
              .where(F.col("rn") <= RANGE_ROWS))
    recent = recent.withColumn("chg", F.col("close") - F.lead("close").over(desc))
    rn = F.col("rn")
    chg = F.col("chg")
    in_rsi = rn <= RSI_ROWS
    stats = recent.groupBy("symbol").agg(
        F.max(F.when(rn == 1, F.col("price_date"))).alias("price_date"),
        F.max(F.when(rn == 1, F.col("close"))).alias("close"),
        F.max(F.when(rn == 1, F.col("volume"))).alias("volume"),
        F.avg(F.when(rn <= SMA_SHORT, F.col("close"))).alias("sma50"),
        F.count(F.when(rn <= SMA_SHORT, F.col("close"))).alias("n50"),
        F.avg(F.when(rn <= SMA_LONG, F.col("close"))).alias("sma200"),
        F.count(F.when(rn <= SMA_LONG, F.col("close"))).alias("n200"),
        F.max("high").alias("hi"),
        F.min("low").alias("lo"),
        F.avg(F.when(rn <= VOLUME_ROWS, F.col("volume").cast(VOL_DEC))).alias("vavg"),
        F.count(F.when(rn <= VOLUME_ROWS, F.col("volume"))).alias("nvol"),
        F.sum(F.when(in_rsi & (chg > 0), chg).otherwise(F.lit(0))).alias("gain"),
        F.sum(F.when(in_rsi & (chg < 0), -chg).otherwise(F.lit(0))).alias("loss"),
        F.count(F.when(in_rsi, chg)).alias("nchg"),
    )
    out = _finish(stats)
    return out.orderBy("symbol") if ordered else out


def price_changes(bars: DataFrame, bucket_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """close - previous close per symbol, for every priced bar.

    Skew-proof without row numbering: rows are windowed per (symbol, date
    bucket), so a symbol's series is split across tasks; the first row of a
    bucket takes the last close of the symbol's previous non-empty bucket from
    a small per-bucket table (one row per symbol and bucket).
    """
    p = _priced(bars).withColumn("_bucket", day_bucket("price_date", bucket_days))
    last = (p.groupBy("symbol", "_bucket").agg(F.max_by("close", "price_date").alias("_last"))
            .withColumn("_carry", F.lag("_last").over(Window.partitionBy("symbol").orderBy("_bucket")))
            .select(F.col("symbol").alias("_s"), F.col("_bucket").alias("_b"), "_carry"))
    w = Window.partitionBy("symbol", "_bucket").orderBy("price_date")
    prev = F.coalesce(F.lag("close").over(w), F.col("_carry"))
    joined = p.join(last, p["symbol"].eqNullSafe(last["_s"]) & p["_bucket"].eqNullSafe(last["_b"]))
    return joined.select("symbol", "price_date", "close", prev.alias("prev_close"),
                         (F.col("close") - prev).alias("price_change"))


def indicator_history(bars: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """The indicator row of every bar (trailing frames end at that bar).

    Spark evaluates a bounded ROWS frame by re-aggregating the whole frame for
    every row.  Trailing sums and counts are therefore taken from running
    totals instead: the sum of the last ``n`` rows is ``total(k) - total(k-n)``
    with the earlier total fetched by ``lag(n)``, which is exact on DECIMAL and
    costs O(1) per row.  Inside a chunk the halo guarantees row ``k-n`` is
    present; in a series' first chunk a missing row means the frame starts at
    the series start (total 0).  The 252-row max/min stay sliding frames (cheap
    comparisons; a block decomposition measured slower because of extra sorts).
    """
    halo = RANGE_ROWS - 1
    s = chunked_series(_priced(bars), ["symbol"], ["price_date"], halo,
                       day_bucket("price_date"), chunk_rows)
    w = chunk_window(["symbol"])
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("chg", F.col("close") - F.lag("close").over(w))
    chg = F.col("chg")
    s = s.select(
        "symbol", "price_date", "high", "low", "close", "volume", "_seq", "_chunk", "_halo",
        F.sum("close").over(upto).alias("t_close"),
        F.sum(F.col("volume").cast(VOL_DEC)).over(upto).alias("t_vol"),
        F.count("volume").over(upto).alias("t_nvol"),
        F.sum(F.when(chg > 0, chg).otherwise(F.lit(0))).over(upto).alias("t_gain"),
        F.sum(F.when(chg < 0, -chg).otherwise(F.lit(0))).over(upto).alias("t_loss"),
        F.count(chg).over(upto).alias("t_nchg"),
    )

    def last(total: str, n: int):
        return F.coalesce(F.col(total), F.lit(0)) - F.coalesce(F.lag(total, n).over(w), F.lit(0))

    def frame(n):
        return w.rowsBetween(-(n - 1), 0)

    n50 = F.least(F.col("_seq") + 1, F.lit(SMA_SHORT))
    n200 = F.least(F.col("_seq") + 1, F.lit(SMA_LONG))
    nvol = last("t_nvol", VOLUME_ROWS)
    stats = s.select(
        "symbol", "price_date", "close", "volume", "_halo",
        ratio(last("t_close", SMA_SHORT), n50).alias("sma50"), n50.alias("n50"),
        ratio(last("t_close", SMA_LONG), n200).alias("sma200"), n200.alias("n200"),
        F.max("high").over(frame(RANGE_ROWS)).alias("hi"),
        F.min("low").over(frame(RANGE_ROWS)).alias("lo"),
        ratio(last("t_vol", VOLUME_ROWS), nvol).alias("vavg"), nvol.alias("nvol"),
        last("t_gain", RSI_ROWS).alias("gain"),
        last("t_loss", RSI_ROWS).alias("loss"),
        last("t_nchg", RSI_ROWS).alias("nchg"),
    ).where(~F.col("_halo"))
    return _finish(stats)
