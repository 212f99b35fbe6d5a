"""Sharding by fixed virtual slots and a versioned slot-to-shard map (DataFrame operations only).

A record is hashed into one of ``SLOTS`` virtual slots.  Bytes and rows are
summed per slot, and a map gives each slot its shard.  Version 0 of the map
deals the slots in turn; ``rebalance`` edits it: each shard keeps slots, the
heaviest first, while they fit its fair share of bytes, and gives up the rest,
which go one by one, the heaviest first, to the shard that is lightest then.
Every version is stored, so a reader can follow what moved.

Law: ``bytes`` - the shards' sizes are near equal.

The map and the sums per slot have a fixed size (SLOTS rows, and SLOTS x PARTS
for the places of rows in shards), so sending them to all tasks is bounded
whatever the input.  Rows are numbered within (slot, part) groups, whose size
is a 1 / 65,536 share of the rows, and lifted by the groups' running totals.

Defined results: a null text has no bytes (size 8, crc 0); null ids are
hashed like any value; rows equal in id and text lie in one slot; a very long
text weighs what it weighs; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerlake.llm.common import scratch_path, stored

SHARDS = 24
SLOTS = 4096
PARTS = 16
OVERHEAD = 8


def sized(documents: DataFrame, slots: int = SLOTS, parts: int = PARTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, part."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    h = F.xxhash64("doc_id", "text_crc32", "size")
    return rows.withColumn("virtual_slot", F.pmod(h, F.lit(slots)).cast("int")).withColumn(
        "part", F.pmod(F.floor(h / F.lit(slots)), F.lit(parts)).cast("int"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("virtual_slot", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt in turn."""
    slot = F.col("id").cast("int")
    return spark.range(slots).select(F.lit(0).alias("version"), slot.alias("virtual_slot"), F.pmod(slot, F.lit(shards)).alias("shard"))


def rebalance(current: DataFrame, weights: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of the map: (version, virtual_slot, shard), edited so that bytes are near equal.

    ``current`` is one version of the map, ``weights`` has virtual_slot and
    bytes (slots without rows may lack).  Both are bounded by the number of
    slots, which is fixed.
    """
    weight = weights.groupBy("virtual_slot").agg(F.sum("bytes").alias("bytes"))
    slots = current.join(weight, "virtual_slot", "left").fillna(0, ["bytes"])
    even = slots.agg((F.sum("bytes") / F.lit(shards)).alias("even")).scalar()
    heavy = F.col("bytes") > even  # a slot beyond an even share fills a shard alone; the others share the rest
    fair = slots.agg(F.ceil(F.sum(F.when(~heavy, F.col("bytes")).otherwise(0)) / (F.lit(shards) - F.sum(heavy.cast("int")))).alias("fair"))
    own = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    marked = slots.withColumn("filled", F.sum("bytes").over(own)).withColumn("stays", F.col("filled") <= fair.scalar())
    kept = marked.where("stays")
    loads = kept.groupBy("shard").agg(F.sum("bytes").alias("bytes"))
    start = loads.agg(F.map_from_entries(F.collect_list(F.struct("shard", "bytes"))).alias("m"))
    moving = marked.where("not stays").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("w"), F.col("virtual_slot").alias("s")))).alias("moving"))
    dealt = moving.withColumn("m", start.scalar()).selectExpr(f"""explode(aggregate(
        moving,
        named_struct('loads', transform(sequence(0, {shards - 1}), i -> coalesce(m[i], 0L)),
                     'dealt', cast(array() as array<struct<virtual_slot: int, shard: int>>)),
        (acc, x) -> named_struct(
            'loads', transform(acc.loads, (v, i) -> if(i + 1 = array_position(acc.loads, array_min(acc.loads)), v - x.w, v)),
            'dealt', concat(acc.dealt, array(named_struct('virtual_slot', x.s,
                     'shard', cast(array_position(acc.loads, array_min(acc.loads)) - 1 as int)))))
        ).dealt) as d""").selectExpr("d.virtual_slot", "d.shard")
    version = current.agg((F.max("version") + 1).alias("version"))
    return kept.select("virtual_slot", "shard").union(dealt).select(version.scalar().alias("version"), "virtual_slot", "shard")


def save_map(table: DataFrame, path: str) -> None:
    """Add a version to the stored map."""
    table.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One stored version of the map (default: the latest)."""
    maps = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version).select("version", "virtual_slot", "shard")


def shard(documents: DataFrame, shards: int = SHARDS, slots: int = SLOTS, parts: int = PARTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard, virtual_slot, map_version."""
    spark = documents.sparkSession
    path = map_path or scratch_path(spark, "slot-map")
    rows = stored(sized(documents, slots, parts), "shard-rows")
    sums = stored(slot_bytes(rows), "slot-bytes")
    if map_path is None:
        save_map(first_map(spark, shards, slots), path)
    save_map(rebalance(read_map(spark, path), sums, shards), path)
    current = read_map(spark, path)

    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    places = sums.join(F.broadcast(current), "virtual_slot").select(
        "virtual_slot", "part", "shard", "version", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("nth", F.row_number().over(within))
    return numbered.join(F.broadcast(places), ["virtual_slot", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", F.col("version").alias("map_version"))
