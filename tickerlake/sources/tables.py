"""Readers for stored bronze tables with their declared schemas (never inferred).

Production inputs are tables, not the derived test feeds: the raw board
(13 text columns) and the OHLCV bars.  Parquet is the default format; CSV
(header, empty -> NULL) is accepted for landed exports.  Bars are stored in
one folder for each month (``write_bars``); ``read_bars`` turns a range of
days into the range of months that it reads.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickerlake import schemas


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", "").option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def read_board(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, schemas.BOARD_RAW, fmt)


MONTH = "price_month"


def month_of(day: str):
    return F.date_format(day, "yyyy-MM")


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet", since: dt.date | None = None,
              until: dt.date | None = None) -> DataFrame:
    """The bars stored at ``path``, of ``since`` to ``until`` (both included) where given.

    A range needs the month layout of ``write_bars``: only the folders of its
    months are listed for the scan, and the days are filtered within them.
    """
    if since is None and until is None:
        return read_table(spark, path, schemas.BARS, fmt).drop(MONTH)
    laid_out = StructType([*schemas.BARS.fields, StructField(MONTH, StringType())])
    bars = read_table(spark, path, laid_out, fmt)
    if since is not None:
        bars = bars.where((F.col(MONTH) >= f"{since:%Y-%m}") & (F.col("price_date") >= F.lit(since)))
    if until is not None:
        bars = bars.where((F.col(MONTH) <= f"{until:%Y-%m}") & (F.col("price_date") <= F.lit(until)))
    return bars.drop(MONTH)


def write_bars(df: DataFrame, path: str, mode: str = "append") -> None:
    """Store bars in one folder for each month of ``price_date``."""
    df.withColumn(MONTH, month_of("price_date")).write.mode(mode).partitionBy(MONTH).parquet(path)


def write_board(df: DataFrame, path: str, mode: str = "append") -> None:
    """Store raw board rows as they came (13 text columns)."""
    df.select(*schemas.BOARD_RAW.fieldNames()).write.mode(mode).parquet(path)
