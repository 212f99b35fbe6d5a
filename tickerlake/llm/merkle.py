"""Merkle manifest of a table, with sibling proofs, by concatenated-level strings (SQL functions only).

Rows of a group (a source) are leaves in the order of their id; every FANOUT
consecutive nodes of a level become the digest of their hex strings until one
node, the subroot, remains, and the subroots of all groups, in the order of
their names, likewise give the root.

A group is cut into aligned blocks of FANOUT ** LEVELS leaves.  A block is one
row that holds each of its levels as one string of hex digits: the parents of
a level are the digests of its substrings of FANOUT * 64 digits, and the siblings of a
node are what flanks it in its substring.  The digests that blocks end
with are the leaves of the next tier, which is cut into blocks in turn, until
every group is one block; the subroots go through the same steps as one
group.  There is one shuffle by range to number the leaves, which puts a hot
group on many tasks, and one by block; a block has a fixed size, tiers grow
with the logarithm of the largest group, and no text is shuffled.  Each tier
is stored in the shared folder.

Defined results: a null field counts as ``-`` and a null group is a group of
its own, before all others; a null id comes first in its group; rows of equal
id are ordered by their leaves, equal rows are leaves of their own with
proofs of their own; an empty text is ``0:``; an empty table gives an empty
result; columns that are not asked for are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.llm.common import stored

FANOUT = 3
LEVELS = 6
DIGITS = 64
PATH = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated strings."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def fold(path: Column, node: Column) -> Column:
    """The root that a node and its siblings, level by level, lead to."""
    return F.aggregate(path, node, lambda acc, s: digest(s["left"], acc, s["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of the concatenated siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Append ``pos``, the place of a row in its group from 0, and ``size``, the rows of the group.

    Rows are dealt by range over group and order, so a large group lies on
    many tasks; only one row for each group and range is numbered by a window.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "merkle-order").withColumn("range", F.shiftright("at", 33))
    counts = kept.groupBy(*group, "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "range", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                           F.sum("n").over(whole).alias("size"))
    return (kept.alias("a").join(starts.alias("b"), _same("a", "b", group) & (F.col("a.range") == F.col("b.range")))
            .select(*[f"a.{c}" for c in rows.columns], "b.size", (F.col("b.before") + F.col("a.at") - F.col("b.first")).alias("pos")))


def _same(a: str, b: str, group: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in group], F.lit(True))


def _blocks(rows: DataFrame, group: list[str], fanout: int, levels: int) -> DataFrame:
    """One row for each block: group, block, size, items (in order) and levels (strings of digits, as binary).

    ``rows`` has group, pos, size, node and any further columns, which the items carry.
    A block of a group of several blocks climbs all its levels; an only block climbs to one node.
    """
    width, run = fanout ** levels, fanout * DIGITS
    carried = [c for c in rows.columns if c not in (*group, "size", "pos")]
    items = F.sort_array(F.collect_list(F.struct("pos", *carried)))
    gathered = rows.groupBy(*group, "size", F.floor(F.col("pos") / width).alias("block")).agg(items.alias("items"))

    def parents(level: Column) -> Column:
        starts = F.sequence(F.lit(1), F.octet_length(level), F.lit(run))
        return F.array_join(F.transform(starts, lambda i: F.sha2(F.substring(level, i, F.lit(run)), 256)), "").cast("binary")

    def climbed(acc: Column, _: Column) -> Column:
        last = F.element_at(acc, -1)
        done = (F.col("size") <= width) & (F.octet_length(last) == DIGITS)
        return F.when(done, acc).otherwise(F.concat(acc, F.array(parents(last))))

    lowest = F.array_join(F.transform("items", lambda x: x["node"]), "").cast("binary")
    return gathered.withColumn("levels", F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.array(lowest), climbed))


def _with_paths(blocks: DataFrame, fanout: int) -> Column:
    """The items of the blocks, there named ``a``, with ``path``: what flanks their node at each level."""
    def flanks(level: Column, k: Column, i: Column) -> Column:
        node = F.floor(i / F.pow(F.lit(float(fanout)), k)).cast("int")
        place = F.pmod(node, F.lit(fanout))
        start = (node - place) * DIGITS + 1
        left = F.substring(level, start, place * DIGITS)
        right = F.substring(level, start + (place + 1) * DIGITS, (F.lit(fanout - 1) - place) * DIGITS)
        return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))

    below = F.slice("a.levels", F.lit(1), F.size("a.levels") - 1)
    names = [f.name for f in blocks.schema["items"].dataType.elementType]
    return F.transform("a.items", lambda x, i: F.struct(
        *[x[n].alias(n) for n in names], F.transform(below, lambda level, k: flanks(level, k, i)).cast(PATH).alias("path")))


def climb(rows: DataFrame, group: list[str], fanout: int = FANOUT, levels: int = LEVELS) -> list[DataFrame]:
    """The stored tiers of blocks of all groups, lowest first; ``rows`` has group, pos, size and node."""
    width = fanout ** levels
    tiers = [stored(_blocks(rows, group, fanout, levels), "merkle-tier")]
    most = tiers[0].agg(F.max("size")).first()[0] or 0
    while most > width:
        most = -(-most // width)
        ends = tiers[-1].where(F.col("size") > width).select(
            *group, F.col("block").alias("pos"), F.ceil(F.col("size") / width).alias("size"), _end().alias("node"))
        tiers.append(stored(_blocks(ends, group, fanout, levels), "merkle-tier"))
    return tiers


def _end() -> Column:
    """The node that a block ends with."""
    return F.element_at("levels", -1).cast("string")


def subroots(tiers: list[DataFrame], group: list[str], fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Group and ``subroot``: the end of each group's only block at its highest tier."""
    only = [t.where(F.col("size") <= fanout ** levels).select(*group, _end().alias("subroot")) for t in tiers]
    return reduce(DataFrame.unionByName, only)


def descend(tiers: list[DataFrame], group: list[str], tops: DataFrame | None = None,
            fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The leaves with ``path`` (siblings as left and right strings, level by level), ``subroot`` and ``root``.

    ``tops`` has group, path and root: the way on from each subroot; without it subroots are roots.
    What lies above is joined to whole blocks, so that no long path is shuffled with its leaf.
    """
    none = F.array().cast(PATH)
    above = leaves = None
    for tier in reversed(tiers):
        only = tier.where(F.col("size") <= fanout ** levels).select(*group, "block", _end().alias("subroot"))
        if tops is None:
            rest = only.select("*", none.alias("rest"), F.col("subroot").alias("root"))
        else:
            rest = only.alias("a").join(tops.alias("b"), _same("a", "b", group)).select("a.*", F.col("b.path").alias("rest"), "b.root")
        if above is not None:
            rest = rest.unionByName(above.select(*group, F.col("pos").alias("block"), "subroot", F.col("path").alias("rest"), "root"))
        leaves = (tier.alias("a").join(rest.alias("b"), _same("a", "b", group) & (F.col("a.block") == F.col("b.block")))
                  .select(*[f"a.{c}" for c in group], F.explode(_with_paths(tier, fanout)).alias("item"), "b.subroot", "b.root", "b.rest")
                  .select(*group, "item.*", "subroot", "root", "rest").withColumn("path", F.concat("path", "rest")).drop("rest"))
        above = leaves
    return leaves


def manifest(rows: DataFrame, group: str, order: str, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The rows with ``subroot``, ``root``, ``path`` (all siblings up to the root) and ``pos`` in the group.

    ``rows`` has ``leaf`` (hex) beside group and order; further columns stay.
    """
    kept = stored(rows.withColumnRenamed("leaf", "node"), "merkle-leaves")
    tiers = climb(numbered(kept, [group], [order, "node"]), [group], fanout, levels)
    named = stored(subroots(tiers, [group], fanout, levels).withColumnRenamed("subroot", "node"), "merkle-subroots")
    tops = descend(climb(numbered(named, [], [group]), [], fanout, levels), [], None, fanout, levels)
    return descend(tiers, [group], tops.select(group, "path", "root"), fanout, levels).withColumnRenamed("node", "leaf")
