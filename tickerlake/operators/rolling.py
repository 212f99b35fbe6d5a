"""Skew-proof trailing-row windows.

``Window.partitionBy(key)`` sends a key's whole series to one task.  When a
single key may hold a large share of the rows, that task becomes the job.
``chunked_series`` instead numbers each key's rows and cuts the series into
fixed-size chunks, copying the last ``halo`` rows of every chunk into the
next one.  A trailing frame of up to ``halo + 1`` rows is then complete for
every non-halo row when the window is partitioned by ``(key, _chunk)``.

Numbering itself avoids a per-key window: rows are first counted per
``(key, bucket)`` (a small aggregate), the running offset of each bucket is
a window over that small table, and positions inside a bucket come from a
``row_number`` partitioned by ``(key, bucket)``.  The join back to the
offsets shuffles on ``(key, bucket)``, which is exactly the partitioning the
in-bucket ``row_number`` needs, so it adds no exchange.

Bounds: with one row per key and day (the bars' declared uniqueness), a
92-day bucket holds at most 92 rows, a window task at most one chunk plus
its halo, and the offset window at most one row per bucket of a key.
Pass a finer ``bucket`` for denser series (e.g. hourly for intraday data).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK_ROWS = 65_536
DEFAULT_BUCKET_DAYS = 92


def day_bucket(order_col: str, bucket_days: int = DEFAULT_BUCKET_DAYS) -> Column:
    days = F.datediff(F.col(order_col), F.lit("1970-01-01").cast("date"))
    return F.floor(days / F.lit(bucket_days)).cast("long")


def sequence_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], bucket: Column) -> DataFrame:
    """Add ``_seq``: 0-based position of each row inside its key, by ``order``."""
    key = list(key)
    with_bucket = df.withColumn("_bucket", bucket)
    counts = with_bucket.groupBy(*key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    in_bucket = Window.partitionBy(*key, "_bucket").orderBy(*order)
    # null-safe: a NULL key (or bucket) is one group, as in PARTITION BY
    offsets = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in key + ["_bucket"]], "_off")
    cond = None
    for c in key + ["_bucket"]:
        eq = with_bucket[c].eqNullSafe(offsets[f"_o_{c}"])
        cond = eq if cond is None else cond & eq
    return (with_bucket.join(offsets, cond)
            .drop(*[f"_o_{c}" for c in key + ["_bucket"]])
            .withColumn("_seq", F.col("_off") + F.row_number().over(in_bucket) - 1)
            .drop("_off", "_bucket"))


def chunked_series(df: DataFrame, key: Sequence[str], order: Sequence[str], halo: int,
                   bucket: Column, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Rows tagged with ``_seq``, ``_chunk`` and ``_halo`` (copied from the previous chunk)."""
    if chunk_rows < halo:
        raise ValueError("chunk_rows must be at least the halo")
    seq = sequence_rows(df, key, order, bucket)
    pos = F.col("_seq") % chunk_rows
    copies = F.when(pos >= chunk_rows - halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (seq.withColumn("_copy", F.explode(copies))
            .withColumn("_chunk", F.floor(F.col("_seq") / chunk_rows).cast("long") + F.col("_copy"))
            .withColumn("_halo", F.col("_copy") == 1)
            .drop("_copy"))


def chunk_window(key: Sequence[str]) -> Window:
    return Window.partitionBy(*key, "_chunk").orderBy("_seq")
