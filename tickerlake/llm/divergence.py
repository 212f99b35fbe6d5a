"""Source divergence audit: how the term shares of sources differ, from exact counts of packed terms.

Counting (one pass over whole texts, no text is shuffled): a task cuts the
texts of some Arrow batches into terms at once and puts the terms into buckets
by their length in bytes.  Terms of up to 8 bytes become one uint64 word, of
up to 16 bytes two; a bucket is radix-sorted by 16-bit digits (as many as its
length has) and then by group, and equal neighbours are counted as runs, with
the documents that they lie in.  Longer terms have buckets of their own,
sorted as bytes.  So (lang, source, term, n, docs) leaves a task summed up,
and Spark sums up the rest.

Auditing: a lang keeps its terms that lie in enough documents.  The share of a
term in a group is a whole number of billionths, smoothed by two; the
divergence of two groups is the sum of (p-q)^2/(p+q), rounded down for each
term.  Groups that lack a term have one share for all such terms, so that only
terms that occur have to be met.  They are met in blocks: kept terms by hash
(BLOCK_TERMS of a lang), sources by number (TILE_SOURCES), a block holding
every pair of two tiles once.  All pairs of sources of a lang are the result
itself; terms of a block are dense numpy rows, so no pair of rows is ever joined.

Defined results: null text, lang or source count as empty; a text without
terms counts as a document of its group; every occurring group has its
``pair`` rows (value 0 where its lang keeps no term); repeated rows are
documents of their own; values that tie are ranked by item; an empty table
gives an empty result; other columns are ignored.  Terms of any length count
whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.llm.common import ship, stored

LEAST_DOCS = 10
SCALE = 1_000_000_000
TERM_RANKS = 10
FLUSH_BYTES = 16 << 20
BLOCK_TERMS = 4096
TILE_SOURCES = 64

# Term bytes are ASCII letters, lower-cased, and all bytes of non-ASCII characters; others become 0.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 0 for b in range(256))

_COUNTS = "lang string, source string, term string, n long, docs long"


# counting


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The term bytes of the texts (others 0), eight zeros behind them, and the texts' starts and end."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = bytes(data)[offsets[0]:offsets[-1]] if data is not None and len(texts) else b""
    return np.frombuffer(raw.translate(_TERM_BYTES) + bytes(8), np.uint8), offsets - offsets[0]


def _radix(order: np.ndarray, word: np.ndarray, n_bytes: int) -> np.ndarray:
    """``order`` sorted, stably, by the low ``n_bytes`` bytes of ``word``, 16 bits at a time."""
    for shift in range(0, 8 * n_bytes, 16):
        digit = (word >> np.uint64(shift)).astype(np.uint16)
        order = order[np.argsort(digit[order], kind="stable")]
    return order


def _words(data: np.ndarray, starts: np.ndarray, length: int) -> list[np.ndarray]:
    """Terms of one length (at most 16) as one or two words, first bytes highest."""
    loads = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))  # the eight bytes from each place
    if length <= 8:
        return [loads[starts].astype(np.uint64) >> np.uint64(64 - 8 * length)]
    return [loads[starts].astype(np.uint64), loads[starts + 8].astype(np.uint64) >> np.uint64(128 - 8 * length)]


def _sorted_runs(data: np.ndarray, starts: np.ndarray, length: int, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the terms of one length by group and term, and where a run of equal ones starts."""
    order = np.arange(len(starts))
    if length <= 16:
        keys = _words(data, starts, length)
        for word, n in zip(reversed(keys), [length] if length <= 8 else [length - 8, 8], strict=True):
            order = _radix(order, word, n)
    else:
        keys = [data[starts[:, None] + np.arange(length)].view(f"S{length}")[:, 0]]
        order = np.argsort(keys[0], kind="stable")
    order = _radix(order, group.astype(np.uint64), max(1, (groups - 1).bit_length() + 7 >> 3))
    new = np.ones(len(order), bool)
    same = group[order[1:]] == group[order[:-1]]
    for k in keys:
        same &= k[order[1:]] == k[order[:-1]]
    new[1:] = ~same
    return order, new


def count_terms(texts: pa.Array, group: np.ndarray, groups: int) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """(group, term, occurrences, documents) of the texts' terms, by length; ``group`` numbers each text's group."""
    data, bounds = _joined(texts)
    on = data != 0
    begins, ends = on.copy(), on.copy()
    begins[1:] &= ~on[:-1]
    ends[:-1] &= ~on[1:]
    cut = bounds[1:-1]  # neighbouring texts are not parted by a byte
    cut = cut[cut < len(data)]
    begins[cut] |= on[cut]
    before = cut[cut > 0] - 1
    ends[before] |= on[before]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    doc = np.searchsorted(bounds, starts, "right") - 1
    by_length = np.argsort(lengths.astype(np.uint16), kind="stable") if len(lengths) and lengths.max() < 65536 else np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[by_length])) + 1
    for bucket in np.split(by_length, edges):
        if not len(bucket):
            continue
        length, at, d = int(lengths[bucket[0]]), starts[bucket], doc[bucket]
        g = group[d]
        order, new = _sorted_runs(data, at, length, g, groups)
        first = np.flatnonzero(new)
        d = d[order]
        other = new.copy()  # a run lies in as many documents as its document number changes
        other[1:] |= d[1:] != d[:-1]
        n = np.diff(first, append=len(order))
        lead = order[first]
        chars = data[at[lead][:, None] + np.arange(length)]
        spans = np.arange(len(lead) + 1, dtype=np.int64) * length
        terms = pa.LargeStringArray.from_buffers(len(lead), pa.py_buffer(spans), pa.py_buffer(np.ascontiguousarray(chars)))
        yield g[lead], terms, n, np.add.reduceat(other.astype(np.int64), first)


def _flush(batches: list[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    whole = pa.Table.from_batches(batches).combine_chunks()
    numbers: dict[tuple, int] = {}
    keys = zip(whole["lang"].to_pylist(), whole["source"].to_pylist(), strict=True)
    group = np.fromiter((numbers.setdefault(k, len(numbers)) for k in keys), np.int64, whole.num_rows)
    langs, sources = (pa.array([k[i] for k in numbers], pa.string()) for i in (0, 1))
    for g, terms, n, docs in count_terms(whole["text"].chunk(0), group, len(numbers)):
        g = pa.array(g)
        yield pa.RecordBatch.from_arrays([langs.take(g), sources.take(g), terms.cast(pa.string()), pa.array(n), pa.array(docs)],
                                         names=["lang", "source", "term", "n", "docs"])


def term_counts(documents: DataFrame, flush_bytes: int = FLUSH_BYTES) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""
    ship(documents.sparkSession)
    rows = documents.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in it:
            for part in _parts(batch, flush_bytes):
                held.append(part)
                size += part.nbytes
                if size >= flush_bytes:
                    yield from _flush(held)
                    held, size = [], 0
        if held:
            yield from _flush(held)

    return rows.mapInArrow(batches, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _parts(batch: pa.RecordBatch, flush_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``flush_bytes``, of one row at least."""
    pieces = max(1, batch.nbytes // flush_bytes)
    step = max(1, -(-batch.num_rows // pieces))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


# auditing


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), in whole numbers of any size."""
    wide = "decimal(28,0)"
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count.cast(wide) + F.lit(2).cast("decimal(1,0)")),
                           total.cast(wide) + F.lit(2).cast("decimal(1,0)") * kept.cast(wide)) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are below 2^31, so a long holds the square."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _block_sums(key: tuple, block: pa.Table, tile_sources: int) -> pa.Table:
    """Sums of a block over its terms, for every pair of its sources: (lang, a, b, value, terms), a < b.

    Rows without a term name the block's sources with the share of a term that they lack.
    """
    lacking = pc.is_null(block["term"])
    heads = block.filter(lacking)
    ids = heads["sid"].to_numpy()
    order = np.argsort(ids)
    ids, base = ids[order], heads["p"].to_numpy()[order]
    rows = block.filter(pc.invert(lacking))
    terms = rows["term"].combine_chunks().dictionary_encode()
    if isinstance(terms, pa.ChunkedArray):
        terms = terms.chunk(0)
    width = len(terms.dictionary)
    shares = np.repeat(base[:, None], width, axis=1)
    shares[np.searchsorted(ids, rows["sid"].to_numpy()), terms.indices.to_numpy()] = rows["p"].to_numpy()
    low, high, value = [], [], []
    left, right = key[1].as_py(), key[2].as_py()
    tile = ids // tile_sources
    for k in np.flatnonzero(tile == left):
        others = np.flatnonzero((tile == right) & (ids > ids[k]))
        if not len(others):
            continue
        q = shares[others]
        away = shares[k] - q
        value.append((away * away // (shares[k] + q)).sum(axis=1))
        low.append(np.full(len(others), ids[k]))
        high.append(ids[others])
    made = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (low, high, value)]
    return pa.table({"lang": pa.array([key[0].as_py()] * len(made[0]), pa.string()), "a": pa.array(made[0], pa.int64()),
                     "b": pa.array(made[1], pa.int64()), "value": pa.array(made[2], pa.int64()),
                     "terms": pa.array(np.full(len(made[0]), width), pa.int64())})


def _tile_pairs(rows: DataFrame, tile_sources: int) -> DataFrame:
    """Each row once for every pair of tiles (left <= right) that its source's tile is in."""
    own = F.floor(F.col("sid") / tile_sources)
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("sources") - 1) / tile_sources)))).select(
        "lang", F.least(own, "other").alias("left"), F.greatest(own, "other").alias("right"), "bucket", "sid", "term", "p")


def audit(documents: DataFrame, least_docs: int = LEAST_DOCS, term_ranks: int = TERM_RANKS, flush_bytes: int = FLUSH_BYTES,
          block_terms: int = BLOCK_TERMS, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    spark = documents.sparkSession
    ship(spark)
    counts = stored(term_counts(documents, flush_bytes), "term-counts")
    by_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs"))
    kept = stored(by_lang.where(F.col("docs") >= least_docs).select("lang", "term", "whole"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("whole").alias("all"))
    found = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "whole"), "kept-counts")

    groups = documents.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_lang = Window.partitionBy("lang")
    named = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "v", "all"])
    named = stored(named.withColumn("sid", F.row_number().over(per_lang.orderBy("source")).cast("long") - 1)
                   .withColumn("sources", F.count("*").over(per_lang))
                   .withColumn("lack", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v")))), "audit-groups")

    shares = found.join(named, ["lang", "source"]).select(
        "*", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("whole"), F.col("all"), F.col("v")).alias("q"))
    buckets = F.ceil(F.col("v") / block_terms)
    bucket = F.pmod(F.xxhash64("term"), buckets)
    heads = named.where("v > 0").withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)))
    blocks = _tile_pairs(shares.withColumn("bucket", bucket), tile_sources).union(
        _tile_pairs(heads.withColumn("term", F.lit(None).cast("string")).withColumn("p", F.col("lack")), tile_sources))

    def block_sums(key: tuple, block: pa.Table) -> pa.Table:
        return _block_sums(key, block, tile_sources)

    sums = (blocks.groupBy("lang", "left", "right", "bucket").applyInArrow(block_sums, "lang string, a long, b long, value long, terms long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")))
    both = stored(sums, "audit-sums")
    both = both.select("lang", F.col("a").alias("sid"), F.col("b").alias("other"), "value", "terms").union(
        both.select("lang", F.col("b").alias("sid"), F.col("a").alias("other"), "value", "terms"))

    ends = named.select("lang", F.col("sid").alias("other"), F.col("source").alias("item"), F.col("lack").alias("lack_too"))
    pairs = named.join(ends, "lang").where("sid != other").join(both, ["lang", "sid", "other"], "left")
    unseen = F.col("v") - F.coalesce("terms", F.lit(0))
    value = F.coalesce("value", F.lit(0)) + F.coalesce(unseen * gap(F.col("lack"), F.col("lack_too")), F.lit(0))
    pair_rows = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    term_rows = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                             gap(F.col("p"), F.col("q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pair_rows.withColumn("rank", F.row_number().over(ranked)).union(
        term_rows.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= term_ranks))
