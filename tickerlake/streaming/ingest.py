"""Streaming ingestion: insert-only bars, bounded-state de-duplication, incremental copy.

All jobs take a streaming DataFrame (``spark.readStream...``) and a
checkpoint folder; by default it is a subfolder of the session's
``spark.checkpoint.dir`` (shared storage on a cluster).
Replays after a failure are safe: the insert-only sink anti-joins against
what is already written, and the file source remembers consumed files.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from tickerlake.session import ensure_checkpoint_dir
from tickerlake.sources.ingest import append_insert_only
from tickerlake.streaming.bars import event_time


def stream_checkpoint(stream: DataFrame, name: str, checkpoint: str | None) -> str:
    """Explicit location, else ``<spark.checkpoint.dir>/streams/<name>`` (shared storage)."""
    if checkpoint:
        return checkpoint
    return f"{ensure_checkpoint_dir(stream.sparkSession).rstrip('/')}/streams/{name}"


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or "1 minute")


def stream_insert_only(stream: DataFrame, target_path: str, keys: Sequence[str], order: Sequence,
                       checkpoint: str | None = None, available_now: bool = True,
                       interval: str | None = None, prune_on: str | None = None) -> StreamingQuery:
    """Each micro-batch appends only keys not yet in the target (first write wins)."""
    keys = list(keys)
    order = list(order)

    def upsert(batch, batch_id):  # runs on the driver, work stays distributed
        batch.persist()  # read twice (bounds + anti-join); dropped right after
        try:
            append_insert_only(batch.sparkSession, target_path, batch, keys, order, prune_on)
        finally:
            batch.unpersist()

    ckpt = stream_checkpoint(stream, "insert_only", checkpoint)
    w = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", ckpt)
    return _trigger(w, available_now, interval).start()


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop repeated keys seen within ``delay`` of event time (state is bounded by the watermark)."""
    is_ntz = isinstance(stream.schema[ts].dataType, TimestampNTZType)
    return (stream.withColumn("_et", event_time(F.col(ts)) if is_ntz else F.col(ts))
            .withWatermark("_et", delay)
            .dropDuplicatesWithinWatermark(list(keys))
            .drop("_et"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that a finished run dropped as later than the watermark allows, by its progress reports.

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates``
    reports of a run; a run with more batches than that is refused.
    """
    reports = query.recentProgress
    kept = int(query._jsq.sparkSession().conf().get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if len(reports) >= kept:
        raise ValueError(f"the run has {kept} or more progress reports: raise spark.sql.streaming.numRecentProgressUpdates")
    return sum(op["numRowsDroppedByWatermark"] for r in reports for op in r["stateOperators"])


def stream_dedupe(stream: DataFrame, target_path: str, keys: Sequence[str], ts: str, delay: str,
                  checkpoint: str | None = None, available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Write the stream without repeated keys; the state that knows them is carried by the checkpoint over restarts."""
    w = (dedupe_stream(stream, keys, ts, delay).writeStream.format("parquet").option("path", target_path)
         .option("checkpointLocation", stream_checkpoint(stream, "dedupe", checkpoint)).outputMode("append"))
    return _trigger(w, available_now, interval).start()


def stream_copy(stream: DataFrame, target_path: str, checkpoint: str | None = None, available_now: bool = True,
                interval: str | None = None) -> StreamingQuery:
    """Incremental copy: the file source's checkpoint plays the high-water mark."""
    w = (stream.writeStream.format("parquet").option("path", target_path)
         .option("checkpointLocation", stream_checkpoint(stream, "copy", checkpoint)).outputMode("append"))
    return _trigger(w, available_now, interval).start()


def run_stream_bars(stream: DataFrame, target_path: str, checkpoint: str | None = None, delay: str = "1 day",
                    available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Write closed daily bars from a tick stream to Parquet (append mode)."""
    from tickerlake.streaming.bars import stream_bars

    w = (stream_bars(stream, delay).writeStream.format("parquet").option("path", target_path)
         .option("checkpointLocation", stream_checkpoint(stream, "bars", checkpoint)).outputMode("append"))
    return _trigger(w, available_now, interval).start()


def await_available_now(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an AvailableNow run to finish (no time limit by default; beyond one, stop it and raise)."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_s}s")
