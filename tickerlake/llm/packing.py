"""Packing of documents into fixed-length sequences along a space-filling curve.

1. Every document is tokenised once; its token counts, hashed into
   ``FEATURES`` slots, are projected onto ``DIMS`` dimensions, quantised and
   turned into a Hilbert key.  (doc_id, key, n, ids) is stored.
2. Key quantiles cut the curve into ranges; tokens per range are summed (one
   row per range on the driver, as many as a multiple of the shuffle
   partitions), which gives each range its place on the token line.
3. The rows are dealt to their ranges, sorted by key, and every document is
   laid end to end on the line; cutting it every ``length`` tokens gives the
   sequences.  Only the very last one is shorter (and padded).

The low bits of the key are a hash of the document, so a group of equal
vectors, however large, is cut by the quantiles like any other.

Defined results: a null or empty text is the single end id; equal documents
lie side by side and each gets its own pieces; rows with equal doc_id are
packed each on their own; very long texts are cut over many sequences; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import map_rows, stored
from tickerlake.llm.tokens import loaded

LENGTH = 2048
END_ID = 1
FEATURES = 128
DIMS = 3
BITS = 13
TIE_BITS = 22
RANGES_PER_PARTITION = 4


def hilbert_keys(coords: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of unsigned ``bits``-bit coordinates (n x dims), vectorised over rows."""
    x = coords.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations and reflections of each level, highest bit first
        low = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0]) ^ swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def projection(seed: int = 17) -> np.ndarray:
    """Orthonormal projection FEATURES x DIMS."""
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((FEATURES, DIMS)))
    return q


def feature_of_id(size: int) -> np.ndarray:
    """Hash slot of each token id (multiplicative hashing)."""
    h = (np.arange(size, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(57)).astype(np.int64) % FEATURES


def curve_keys(vectors: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed count vectors (square roots, unit length, projected, quantised)."""
    v = np.sqrt(vectors)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    side = 1 << BITS
    coords = np.clip(((v @ projection() + 1) / 2 * side).astype(np.int64), 0, side - 1)
    return hilbert_keys(coords, BITS)


def tokenised(documents: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """doc_id, curve key, token count and ids (16-bit little-endian, with the end id) of every document."""
    docs = documents.select("doc_id", "text")
    end = np.asarray([END_ID], dtype="<u2").tobytes()

    def make():
        encode = loaded(ranks_path, added=True)
        slots = feature_of_id(1 << 16)

        def run(rows):
            for at in range(0, len(rows), 512):
                part = rows[at:at + 512]
                ids = [encode(text) + end for _, text in part]
                counts = np.stack([np.bincount(slots[np.frombuffer(b, "<u2")[:-1]], minlength=FEATURES) for b in ids])
                keys = curve_keys(counts.astype(np.float64))
                for (doc_id, _), b, key in zip(part, ids, keys.tolist(), strict=True):
                    tie = zlib.crc32(b, zlib.crc32(repr(doc_id).encode())) & ((1 << TIE_BITS) - 1)
                    yield doc_id, (key << TIE_BITS) | tie, len(b) // 2, b
        return run

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, make, f"doc_id {kind}, key long, n long, ids binary")


def pack(documents: DataFrame, length: int = LENGTH, ranks_path: str | None = None) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (binary, 32-bit little-endian)."""
    spark = documents.sparkSession
    rows = stored(tokenised(documents, ranks_path), "pack-tokens")
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [k / ranges for k in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("key", steps, 20 * ranges)).first()[0] or []
    edges = np.unique(np.asarray(bounds, dtype=np.int64))

    @F.arrow_udf("long")
    def range_of(key: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, key.to_numpy(), side="right"), pa.int64())

    totals = {r.curve_range: r.n for r in rows.select(range_of("key").alias("curve_range"), "n").groupBy("curve_range").agg(F.sum("n").alias("n")).collect()}
    base: dict[int, int] = {}
    at = 0
    for k in sorted(totals):
        base[k], at = at, at + totals[k]

    dealt = rows.withColumn("curve_range", range_of("key")).repartition(ranges, "curve_range")
    ordered = dealt.sortWithinPartitions("curve_range", "key", "doc_id").select("curve_range", "doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make():
        here: dict[int, int] = {}

        def run(batch):
            for k, doc_id, ids in batch:
                place = here.get(k, base[k])
                n = len(ids) // 2
                wide = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                start = 0
                while start < n:
                    offset = place % length
                    take = min(length - offset, n - start)
                    piece = wide[4 * start:4 * (start + take)]
                    yield doc_id, start, take, zlib.crc32(piece), n, place // length, offset, piece
                    start, place = start + take, place + take
                here[k] = place
        return run

    return map_rows(ordered, make, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


