"""Quote ingestion: landed files -> quarantine / normalise -> insert-only sink.

The reference pulls five days of bars per symbol, one symbol at a time, and
inserts with first-write-wins.  Here all symbols are processed in parallel:
bad records are quarantined instead of rolling back a symbol, and the
first-write-wins upsert is a first-per-key filter plus a left anti-join
against the target, appended as new files (idempotent on replay).
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from tickerlake.functions.cleaning import strip_token
from tickerlake.schemas import QUOTES
from tickerlake.sources.tables import month_of

MONEY = DecimalType(18, 4)
CORRUPT = "_corrupt_record"

# Ticker suffix of the quote source and the exchange time zone.
TICKER_SUFFIX = ".KA"
EXCHANGE_TZ = "Asia/Karachi"

REQUIRED = ("symbol", "ts", "close")


def read_quotes(spark: SparkSession, path: str, fmt: str = "json", isolate: bool = False) -> DataFrame:
    """Read landed quote files with the declared schema plus a corrupt-record column.

    A file that cannot be opened or decoded fails the read; with ``isolate``
    such a file is left out (what was decoded before the damage stays) and
    ``files_without_records`` names it.
    """
    schema = StructType(QUOTES.fields + [StructField(CORRUPT, StringType())])
    reader = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if isolate:
        reader = reader.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
    return reader.format(fmt).load(path)


def files_without_records(spark: SparkSession, path: str, quotes: DataFrame) -> DataFrame:
    """(file, length, reason) of the landed files that gave no record to ``quotes`` (read with ``isolate``).

    That is a damaged file, or one that holds no record.  Files are listed,
    not read (only a file's path and length are asked for); files of no bytes
    are not listed.
    """
    landed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
              .select(F.col("path").alias("file"), "length"))
    seen = quotes.select(F.col("_metadata.file_path").alias("seen")).distinct()
    reason = F.lit("no readable record")
    # row metadata writes a file's path as a URL, the listing as it is; both differ in the slashes behind the scheme
    opened = F.url_decode(F.regexp_replace("seen", r"\+", "%2B"))
    same = _one_slash(F.col("file")) == _one_slash(opened)
    return landed.join(seen, same, "left_anti").withColumn("reason", reason)


def _one_slash(path: Column) -> Column:
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def parse_quotes(text: Column) -> Column:
    """Parse one JSON quote record held in a string column (same rules as files)."""
    schema = StructType(QUOTES.fields + [StructField(CORRUPT, StringType())])
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _bar_values() -> dict[str, Column]:
    """The numeric fields of a quote as a bar holds them; NULL where a value does not fit (NaN, too large)."""
    money = ("open", "high", "low", "close", "dividends", "stock_splits")
    return {**{c: F.col(c).try_cast(MONEY) for c in money}, "volume": F.col("volume").try_cast("bigint")}


def split_corrupt(df: DataFrame, required: Sequence[str] = REQUIRED) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad = unparseable records, records missing a required field or with a value that does not fit."""
    missing = reduce(or_, [F.col(c).isNull() for c in required])
    unfit = reduce(or_, [F.col(c).isNotNull() & v.isNull() for c, v in _bar_values().items() if c in df.columns])
    reason = (F.when(F.col(CORRUPT).isNotNull(), F.lit("unparseable"))
              .when(missing, F.lit("missing field")).when(unfit, F.lit("bad value")))
    judged = df.withColumn("reason", reason)
    return judged.where(F.col("reason").isNull()).drop(CORRUPT, "reason"), judged.where(F.col("reason").isNotNull())


def normalize_quotes(df: DataFrame, suffix: str = TICKER_SUFFIX, tz: str = EXCHANGE_TZ,
                     day_of: str = "utc", ingested_at: Column | None = None,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Quote rows -> bar rows.

    ``day_of="utc"`` (specified behaviour) dates a bar by the UTC day of its
    exchange-local timestamp, so an exchange midnight lands on the previous
    day; ``"exchange"`` keeps the local date.  Prices round half-up to 4
    places on DECIMAL, volume truncates toward zero.  ``keep`` columns are
    passed through in front (e.g. a record id).
    """
    ts = F.col("ts")
    if day_of == "utc":
        day = F.to_date(F.convert_timezone(F.lit(tz), F.lit("UTC"), ts))
    elif day_of == "exchange":
        day = F.to_date(ts)
    else:
        raise ValueError(f"unknown day_of {day_of!r}")
    # default stamp: the current UTC wall clock, whatever the session time zone
    stamp = ingested_at if ingested_at is not None else \
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    value = _bar_values()
    return df.select(
        *keep,
        strip_token("symbol", suffix).alias("symbol"),
        day.alias("price_date"),
        *[value[c].alias(c) for c in ("open", "high", "low", "close", "volume", "dividends", "stock_splits")],
        stamp.cast("timestamp_ntz").alias("fetched_at"),
    )


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row of each key in ``order`` (the in-batch first write)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return batch.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def insert_only(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence,
                prune_on: str | None = None) -> DataFrame:
    """Rows of ``batch`` that an INSERT ... ON CONFLICT DO NOTHING would add.

    ``prune_on`` names a key column (e.g. the bar date): the target is then
    read only within the batch's [min, max] of it, a literal range that
    reaches the Parquet scan (partition and row-group pruning), so a small
    batch does not anti-join against the whole history.
    """
    first = first_per_key(batch, keys, order)
    existing = target.select(*keys)
    if prune_on is not None:
        lo, hi = batch.agg(F.min(prune_on), F.max(prune_on)).first()
        if lo is None:
            return first
        existing = existing.where(F.col(prune_on).between(F.lit(lo), F.lit(hi)))
    return first.join(existing, list(keys), "left_anti")


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The Parquet table at ``path``; an empty frame when it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)


def _by_month(spark: SparkSession, path: str) -> bool:
    """True if the table at ``path`` is laid out by ``price_month`` (see ``tables.write_bars``)."""
    try:
        return "price_month" in spark.read.parquet(path).columns
    except AnalysisException:
        return False


def _append_counted(df: DataFrame, path: str, by_month: bool = False) -> int:
    """Append ``df`` to Parquet at ``path`` in the table's layout and return the rows written (one pass)."""
    obs = Observation("appended")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if by_month:
        df.withColumn("price_month", month_of("price_date")).write.mode("append").partitionBy("price_month").parquet(path)
    else:
        df.write.mode("append").parquet(path)
    return int(obs.get.get("rows", 0))


def append_insert_only(spark: SparkSession, target_path: str, batch: DataFrame,
                       keys: Sequence[str], order: Sequence, prune_on: str | None = None) -> int:
    """Append the new rows of ``batch`` to the Parquet table at ``target_path``.

    Returns the number of rows written.  Re-running with the same batch adds
    nothing (the anti-join sees the rows of the first run), so a retried or
    replayed micro-batch is harmless.  A table laid out by ``price_month`` is
    appended to in that layout, and only the batch's months are read if
    ``price_date`` is a key.
    """
    by_month = _by_month(spark, target_path)
    schema = StructType([*batch.schema.fields, StructField("price_month", StringType())]) if by_month else batch.schema
    target = _read_or_empty(spark, target_path, schema)
    if by_month and "price_date" in keys:
        lo, hi = batch.agg(F.min(month_of("price_date")), F.max(month_of("price_date"))).first()
        if lo is not None:
            target = target.where(F.col("price_month").between(lo, hi))
    return _append_counted(insert_only(target, batch, keys, order, prune_on), target_path, by_month)


def high_water_mark(target: DataFrame, id_col: str = "id") -> int:
    """``coalesce(max(id), 0)`` of the target (a single scalar to the driver)."""
    return target.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]


def stored_mark(spark: SparkSession, path: str, schema: StructType, id_col: str = "id") -> int:
    """The high-water mark of a Parquet table from its files' footers: no row of it is read.

    Spark pushes a maximum into Parquet only on its newer reader, which the
    two settings choose; they hold for this one aggregate.
    """
    v1 = "spark.sql.sources.useV1SourceList"
    wanted = {v1: ",".join(s for s in spark.conf.get(v1).split(",") if s != "parquet"),
              "spark.sql.parquet.aggregatePushdown": "true"}
    old = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        return high_water_mark(_read_or_empty(spark, path, schema), id_col)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def incremental_copy(source: DataFrame, target: DataFrame, id_col: str = "id") -> DataFrame:
    """Source rows above the target's high-water mark.

    The mark is fetched as one scalar so the ``id > mark`` predicate is a
    literal that Parquet row-group statistics can prune on.  Late rows with
    ids below the mark are never copied (as specified).
    """
    return above_mark(source, high_water_mark(target, id_col), id_col)


def above_mark(source: DataFrame, mark: int, id_col: str = "id") -> DataFrame:
    return source.where(F.col(id_col) > F.lit(mark))


def copy_new_rows(spark: SparkSession, source: DataFrame, target_path: str, id_col: str = "id") -> int:
    """Append the rows above the high-water mark to ``target_path``, by id; returns the count.

    The new rows are dealt by range of the id and sorted, so files (and the
    row groups in them) hold ranges that do not overlap, in one copy or in
    several: a reader's ``id > x`` skips all files but a few.
    """
    mark = stored_mark(spark, target_path, source.schema, id_col)
    new = above_mark(source, mark, id_col).repartitionByRange(id_col).sortWithinPartitions(id_col)
    return _append_counted(new, target_path)


def id_ranges(table: DataFrame, id_col: str = "id") -> DataFrame:
    """(file, low, high, n, apart, in_order) of each file of a stored table.

    ``apart``: its ids lie above all of the file before it; ``in_order``: or begin with the last of them.
    """
    files = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(id_col).alias("low"), F.max(id_col).alias("high"), F.count("*").alias("n"))
    before = F.lag("high").over(Window.partitionBy(F.lit(0)).orderBy("low", "high"))  # one row for each file
    return files.withColumn("apart", before.isNull() | (before < F.col("low"))).withColumn(
        "in_order", before.isNull() | (before <= F.col("low")))


def ensure_table(spark: SparkSession, name: str, schema: StructType, path: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS with an explicit column list (Parquet, optional location)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{where}")


def append_positional(df: DataFrame, name: str) -> None:
    """Append by column position (``insertInto``), as a VALUES-style insert does."""
    df.write.insertInto(name, overwrite=False)
