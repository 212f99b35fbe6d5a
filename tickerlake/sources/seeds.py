"""Seed CSV loading with declared schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickerlake import schemas

# Fixed value: trade dates in the trades seed are written month/day/year.
TRADE_DATE_FORMAT = "M/d/yyyy"

SURPLUS = "_surplus"


def _typed(field: StructField) -> Column:
    """The text of a field as its declared type; text that is no such value fails the read."""
    text, value = F.col(field.name), F.col(field.name).try_cast(field.dataType)
    fault = F.raise_error(F.concat(F.lit(f"seed column {field.name}: not a {field.dataType.simpleString()}: "), text))
    return F.when(text.isNotNull() & value.isNull(), fault).otherwise(value).alias(field.name)


def load_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV with a declared schema.

    Empty fields become NULL and short lines are padded with NULL; values that
    do not parse and lines with surplus fields fail the read.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField(SURPLUS, StringType())])
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .option("nullValue", "").schema(text).csv(path))
    surplus = F.raise_error(F.concat(F.lit("seed line has a surplus field: "), F.col(SURPLUS)))
    first, *rest = schema.fields
    return raw.select(F.when(F.col(SURPLUS).isNotNull(), surplus).otherwise(_typed(first)).alias(first.name),
                      *[_typed(f) for f in rest])


def load_trades(spark: SparkSession, path: str) -> DataFrame:
    raw = load_seed(spark, path, schemas.TRADES_CSV)
    return raw.withColumn("trade_date", F.to_date("trade_date", TRADE_DATE_FORMAT)) \
        .select(*schemas.TRADES.fieldNames())


def load_holdings(spark: SparkSession, path: str) -> DataFrame:
    return load_seed(spark, path, schemas.HOLDINGS)


def load_tax(spark: SparkSession, path: str) -> DataFrame:
    return load_seed(spark, path, schemas.TAX)


def load_sector_map(spark: SparkSession, path: str) -> DataFrame:
    return load_seed(spark, path, schemas.SECTOR_MAP)
