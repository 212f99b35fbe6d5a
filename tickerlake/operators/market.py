"""Board marts: movers, volume leaders, market trend, sector roll-ups.

All inputs are the silver board (one row per snapshot and symbol).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: bucket for symbols missing from the sector map.
UNKNOWN_SECTOR = "Unknown"

MOVER_COLUMNS = ("fetched_at", "symbol", "name", "ldcp", "current_price", "change_amount",
                 "change_pct", "volume", "market_cap_m")


def top_movers(board: DataFrame, k: int | None = None, per: str | None = "fetched_at",
               ordered: bool = True) -> DataFrame:
    """Rows with a change %, highest first.

    ``k=None`` is the full ranked list (all snapshots together, as specified).
    With ``k``, the ``k`` best rows per ``per`` value are kept (ties broken by
    symbol); the ``row_number <= k`` filter becomes a pre-shuffle group limit.
    With ``k`` and ``per=None`` the overall top ``k`` is returned.
    """
    movers = board.where(F.col("change_pct").isNotNull()).select(*MOVER_COLUMNS)
    if k is not None and not per:
        # global top-k: per-partition top-k then one merge (TakeOrderedAndProject)
        return movers.orderBy(F.col("change_pct").desc(), F.col("symbol").asc(),
                              F.col("fetched_at").asc()).limit(k)
    if k is not None:
        w = Window.partitionBy(per).orderBy(F.col("change_pct").desc(), F.col("symbol").asc())
        movers = (movers.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                  .withColumn("rank", F.col("rank").cast("bigint")))
    if ordered:
        # A total order (snapshot and symbol break ties) lets the range
        # partitioner of the global sort split even a very frequent change value.
        lead = [F.col(per).asc()] if k is not None else []
        movers = movers.orderBy(*lead, F.col("change_pct").desc_nulls_first(), F.col("symbol").asc(),
                                F.col("fetched_at").asc())
    return movers


def volume_leaders(board: DataFrame, k: int = 10, per: str = "fetched_at") -> DataFrame:
    """The ``k`` highest-volume symbols of each snapshot (dashboard tile)."""
    w = Window.partitionBy(per).orderBy(F.col("volume").desc_nulls_last(), F.col("symbol").asc())
    return (board.where(F.col("volume").isNotNull())
            .select(per, "symbol", "name", "current_price", "change_pct", "volume")
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .withColumn("rank", F.col("rank").cast("bigint")))


def market_trend(board: DataFrame) -> DataFrame:
    """Per-snapshot market breadth and totals (dashboard trend line)."""
    chg = F.col("change_pct")
    return board.groupBy("fetched_at").agg(
        F.count_distinct("symbol").alias("symbols"),
        F.count_if(chg > 0).alias("advancers"),
        F.count_if(chg < 0).alias("decliners"),
        F.count_if(chg == 0).alias("unchanged"),
        F.round(F.avg(chg), 2).alias("avg_change_pct"),
        F.sum("volume").alias("total_volume"),
        F.sum("market_cap_m").alias("total_market_cap_m"),
    )


def sector_summary(board: DataFrame, sector_map: DataFrame, unknown: str = UNKNOWN_SECTOR,
                   ordered: bool = True) -> DataFrame:
    """Per snapshot and sector: stocks, average change and price, volume and cap.

    The map is a dimension; the planner broadcasts it when its estimated size
    is under the broadcast threshold and AQE re-checks the real size at run
    time, so no unchecked hint is given here.
    """
    sector = F.coalesce(F.col("sector"), F.lit(unknown))
    out = (board.join(sector_map.select("symbol", "sector"), "symbol", "left")
           .groupBy("fetched_at", sector.alias("sector"))
           .agg(F.count_distinct("symbol").alias("total_stocks"),
                F.round(F.avg("change_pct"), 2).alias("avg_change_pct"),
                F.sum("volume").alias("total_volume"),
                F.sum("market_cap_m").alias("total_market_cap_m"),
                F.round(F.avg("current_price"), 2).alias("avg_price")))
    if ordered:
        out = out.orderBy(F.col("fetched_at").asc(), F.col("total_market_cap_m").desc_nulls_last())
    return out


def sector_market_cap(summary: DataFrame, fetched_at=None) -> DataFrame:
    """Sectors of one snapshot by market cap (default: the latest snapshot).

    The latest snapshot is a one-row global aggregate, so joining it is a
    broadcast of exactly one row.
    """
    if fetched_at is None:
        latest = summary.agg(F.max("fetched_at").alias("fetched_at"))
        rows = summary.join(F.broadcast(latest), "fetched_at")
    else:
        rows = summary.where(F.col("fetched_at") == F.lit(fetched_at))
    return (rows.select("fetched_at", "sector", "total_market_cap_m", "avg_change_pct")
            .orderBy(F.col("total_market_cap_m").desc_nulls_last(), F.col("sector")))
