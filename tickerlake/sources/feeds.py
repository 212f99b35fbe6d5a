"""Market feeds derived from the driver's TPC-H-style tables.

The reference reads a scraped price board, daily OHLCV bars and four seed
CSVs.  Those inputs are reproduced here as pure Spark derivations of the
shared test tables so that every mart's work grows with the data:

* ``bars``       one bar per (nation, order day) and per (event type, day)
* ``board``      one raw, text-typed board row per order (dirty on purpose)
* ``sector_map`` customer-key buckets mapped to region names
* ``holdings``   one position per third customer
* ``trades``     one buy/sell per line item
* ``tax``        one tax line per order

All aggregations are partial-aggregated before their shuffle; dimension
joins (nation, region) are left to the planner's size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 4)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _money(c):
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def _fmt(c):
    return F.format_number(c, 2)


def bars_feed(orders: DataFrame, customer: DataFrame, nation: DataFrame,
              events: DataFrame) -> DataFrame:
    """Daily OHLCV bars: nations from orders, ``EV_<type>`` from events."""
    o = (orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
         .join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
         .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
         .groupBy(F.col("n_name").alias("symbol"), F.to_date("o_orderdate").alias("price_date"))
         .agg(F.min("o_orderkey").alias("id"),
              F.min_by("o_totalprice", "o_orderkey").alias("open"),
              F.max("o_totalprice").alias("high"),
              F.min("o_totalprice").alias("low"),
              F.max_by("o_totalprice", "o_orderkey").alias("close"),
              F.nullif(F.sum(F.col("o_orderkey") % 1000).cast("bigint"), F.lit(0)).alias("volume")))
    e = (events.select("event_id", "event_type", "value", "ts")
         .groupBy(F.concat(F.lit("EV_"), F.col("event_type")).alias("symbol"),
                  F.to_date("ts").alias("price_date"), "event_type")
         .agg((F.lit(-1) - F.min("event_id")).alias("id"),
              F.min_by("value", "event_id").alias("open"),
              F.max("value").alias("high"),
              F.min("value").alias("low"),
              F.max_by("value", "event_id").alias("close"),
              F.count(F.lit(1)).alias("n"))
         .withColumn("volume", F.when((F.col("event_type") == "error") & (F.col("n") % 5 == 0),
                                      F.lit(None)).otherwise(F.col("n")).cast("bigint"))
         .drop("event_type", "n"))
    cols = ["id", "symbol", "price_date", "open", "high", "low", "close", "volume"]
    return (o.select(*cols).unionByName(e.select(*cols))
            .select("id", "symbol", "price_date",
                    *[_money(c).alias(c) for c in ("open", "high", "low", "close")],
                    "volume",
                    F.lit(0).cast(MONEY).alias("dividends"),
                    F.lit(0).cast(MONEY).alias("stock_splits"),
                    F.col("price_date").cast("timestamp_ntz").alias("fetched_at")))


def board_feed(orders: DataFrame) -> DataFrame:
    """Raw, all-text price board (13 columns) with blanks, junk and XD suffixes.

    One row per order, one symbol per customer; the stamp is the month of the day before the order.
    """
    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    p = F.col("o_totalprice")
    return (orders.select(
                k.alias("id"),
                F.trunc(F.date_sub(F.to_date("o_orderdate"), 1), "month").cast("timestamp_ntz").alias("fetched_at"),
                F.concat(F.when(k % 11 == 0, F.lit(" ")).otherwise(F.lit("")),
                         F.lit("C"), _s(ck),
                         F.when(k % 5 == 0, F.lit(" XD")).otherwise(F.lit(""))).alias("symbol"),
                F.concat(F.lit("Name "), _s(ck)).alias("name"),
                F.when(k % 17 == 0, F.lit("")).when(k % 23 == 0, F.lit(None))
                 .otherwise(F.concat(F.lit(" "), _fmt(p))).alias("ldcp"),
                F.when(k % 29 == 0, F.lit("")).otherwise(_fmt(p + (k % 21) - 10)).alias("current"),
                F.concat(_s(k % 21 - 10), F.lit(".00")).alias("change"),
                F.when(k % 13 == 0, F.lit(None)).when(k % 19 == 0, F.lit(" % "))
                 .otherwise(F.concat(_s(k % 41 - 20), F.lit(".25%"))).alias("change_1"),
                F.concat(_s(k % 7), F.lit(".5%")).alias("idx_wtg"),
                F.concat(_s(k % 9), F.lit(".125")).alias("idx_point"),
                _fmt((F.col("o_custkey") * 1000).cast("double")).alias("volume"),
                F.lit("1,000.5").alias("shares_m"),
                F.when(k % 31 == 0, F.lit("-")).otherwise(_fmt(p * 2)).alias("market_cap_m"),
            ))


def sector_map_feed(customer: DataFrame, region: DataFrame) -> DataFrame:
    """Symbols of customers mapped to region names; keys that end in 9 stay unmapped."""
    keys = customer.select(F.col("c_custkey").alias("k")).distinct().where(F.col("k") % 10 < 9)
    return (keys.join(region, (F.col("k") % 5) == F.col("r_regionkey"))
            .select(F.concat(F.lit("C"), _s("k")).alias("symbol"),
                    F.col("r_name").alias("sector")))


def holdings_feed(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One position per third customer; those that ordered in the board's last month are quoted there."""
    k = F.col("c_custkey")
    return (customer.where(k % 3 == 0).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.concat(F.lit("C"), _s(k)).alias("symbol"),
                    F.col("n_name").alias("sector"),
                    (k % 40 + 1).cast("bigint").alias("qty_held"),
                    _money(F.abs("c_acctbal") + 100000).alias("avg_buy_rate"),
                    F.when(k % 8 == 0, F.lit("sold")).otherwise(F.lit("active")).alias("status")))


def trades_feed(lineitem: DataFrame) -> DataFrame:
    ln = F.col("l_linenumber")
    return lineitem.select(
        _s(F.col("l_orderkey") * 10 + ln).alias("trade_id"),
        F.concat(F.lit("B"), _s("l_suppkey")).alias("broker"),
        F.concat(F.lit("P"), _s("l_partkey")).alias("symbol"),
        F.when(F.col("l_returnflag") == "R", F.lit("sell")).otherwise(F.lit("buy")).alias("trade_type"),
        F.to_date("l_shipdate").alias("trade_date"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        _money("l_extendedprice").alias("gross_rate"),
        _money(F.col("l_tax") * 100).alias("comm"),
        F.when(ln == 1, F.lit(None)).otherwise(_money(F.col("l_discount") * 10)).cast(MONEY).alias("cdc_amt"),
        F.lit("0.02").cast(MONEY).alias("lsn"),
        _money(F.col("l_tax") * 10).alias("sst"),
        F.lit(None).cast(MONEY).alias("net_amount"),
        F.when(ln == 7, F.lit("rebalance")).alias("reason"),
    )


def tax_feed(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    p = F.col("o_totalprice")
    none = F.lit(None).cast(MONEY)
    return orders.select(
        _s(k).alias("cgt_id"),
        F.col("o_orderpriority").alias("broker"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period_month"),
        F.concat(F.lit("C"), _s("o_custkey")).alias("symbol"),
        F.lit(1).cast("bigint").alias("qty"),
        F.to_date("o_orderdate").alias("settlement_date"),
        F.when(k % 10 == 0, none).otherwise(_money(p - 250000)).alias("capital_gain_loss"),
        none.alias("holding_days"), none.alias("cgt_slab_pct"),
        F.when(k % 3 == 0, _money(p)).alias("provisional_cgt"),
        none.alias("net_gain_loss_month"), none.alias("gross_cgt_month"), none.alias("net_cgt_month"),
        _money(k % 100000).alias("cgt_payable_cumulative"),
        F.when(k % 4 != 0, _money(k % 90000)).alias("cgt_collected_cumulative"),
        F.when(k % 7 == 0, _money("o_custkey")).alias("cgt_shortfall"),
        F.when(k % 7 == 1, _money("o_custkey")).alias("cgt_refund"),
    )


def ticks_feed(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", "event_type", "value")


class Feeds:
    """Lazily derived feeds for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def bars(self) -> DataFrame:
        return bars_feed(self.table("orders"), self.table("customer"), self.table("nation"),
                         self.table("events"))

    def board(self) -> DataFrame:
        return board_feed(self.table("orders"))

    def sector_map(self) -> DataFrame:
        return sector_map_feed(self.table("customer"), self.table("region"))

    def holdings(self) -> DataFrame:
        return holdings_feed(self.table("customer"), self.table("nation"))

    def trades(self) -> DataFrame:
        return trades_feed(self.table("lineitem"))

    def tax(self) -> DataFrame:
        return tax_feed(self.table("orders"))

    def ticks(self) -> DataFrame:
        return ticks_feed(self.table("events"))
