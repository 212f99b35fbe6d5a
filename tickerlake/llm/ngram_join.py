"""N-gram Jaccard self-join with Bayesian pruning of candidates.

1. Texts become sets of hashed shingles of ``SHINGLE`` words.  Documents with
   equal sets collapse to one node (a digest), so copies never meet as pairs.
2. Candidates: banded MinHash keys (at similarity 0.8 a pair shares no key
   with probability 3e-6).  A key's nodes hang on their least node - a star,
   not all pairs - and the stars' connected components are candidate groups.
3. Within a candidate group, nodes are compared in blocks of ``BLOCK``: a pair
   compares ``SIGNATURE`` other MinHash values ``STEP`` at a time and is
   dropped once the posterior probability (uniform prior) that its similarity
   reaches the threshold is below ``TOLERANCE``; the rest are verified on the
   whole sets.
4. A block returns the link counts of its nodes and a spanning forest of its
   links, never the pairs; forests of groups with several blocks are joined
   by connected components again.

Words are ``common.words``.  A text of fewer than five words, but not none, is
one shingle.

Defined results: a null or wordless text is its own class without links (its
copies are not linked); repeated rows are copies; ties take the least doc_id
(null last); very long texts use all their shingles; an empty table gives an
empty result; other columns are ignored (``similarity_classes``) or passed
through (``one_per_class``).
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import map_groups, map_rows, stored, words
from tickerlake.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 4
SIGNATURE = 64
STEP = 16
TOLERANCE = 1e-6
BLOCK = 512
MEMO = 500_000

_MIX = np.uint64(0xFF51AFD7ED558CCD)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class _Codes(dict):
    """Word -> 64-bit code; bounded, starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(word)
        if len(self) >= MEMO:
            self.clear()
        self[word] = code
        return code


def shingles(ws: list[bytes], codes: _Codes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    if not ws:
        return np.zeros(0, np.uint64)
    code = np.fromiter(map(codes.__getitem__, ws), np.uint64, len(ws))
    n = max(1, len(ws) - size + 1)
    width = min(size, len(ws))
    h = np.full(n, np.uint64(width))
    for i in range(width):
        h = (h ^ (code[i:i + n] >> np.uint64(7))) * _GOLD + code[i:i + n]
    h ^= h >> np.uint64(33)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return np.unique(h)


def _coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


_BAND_HASH = _coefficients(BANDS * ROWS, 5)
_COMPARE_HASH = _coefficients(SIGNATURE, 6)


def minhash(s: np.ndarray, coefficients: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """MinHash values (32 bits each) of a set."""
    a, b = coefficients
    least = np.full(len(a), np.uint64(1 << 32))
    for at in range(0, len(s), 1024):
        np.minimum(least, ((s[at:at + 1024, None] * a + b) >> np.uint64(32)).min(axis=0), out=least)
    return least


def band_keys(s: np.ndarray) -> list[int]:
    values = minhash(s, _BAND_HASH).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = (key * _GOLD) ^ values[:, r]
        key = (key ^ (key >> np.uint64(31))) * _MIX
    return key.view(np.int64).tolist()


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """Matches that a pair needs after each number of compared values to stay a candidate.

    With a uniform prior and m of n matches, P(similarity >= t) is the
    probability of at most m successes in n + 1 trials of chance t.
    """
    out = {}
    for n in range(STEP, SIGNATURE + 1, STEP):
        p, m = 0.0, 0
        while True:
            p += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if p >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def candidate_pairs(a: np.ndarray, b: np.ndarray, same: bool, needed: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of two signature matrices that survive the pruning."""
    m = np.zeros((len(a), len(b)), np.int16)
    for k in range(STEP):
        m += a[:, k, None] == b[None, :, k]
    keep = m >= needed[STEP]
    if same:
        keep &= np.triu(np.ones_like(keep), 1)
    i, j = np.nonzero(keep)
    found = m[i, j].astype(np.int64)
    for at in range(STEP, SIGNATURE, STEP):
        found += (a[i, at:at + STEP] == b[j, at:at + STEP]).sum(axis=1)
        on = found >= needed[at + STEP]
        i, j, found = i[on], j[on], found[on]
    return i, j


def intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs of sets (i, j)."""
    used = np.unique(np.concatenate([i, j]))
    universe, place = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True)
    size = sum(len(sets[k]) for k in used) / len(used)
    if len(i) * (20e-6 + size * 60e-9) < len(used) ** 2 * len(universe) / 4e9:
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j, strict=True)])
    row = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used])
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    common = np.zeros((len(used), len(used)), np.float32)
    for low in range(0, len(universe), 4096):  # incidence matrix, some columns at a time
        part = slice(*np.searchsorted(place, [low, low + 4096]))
        m = np.zeros((len(used), min(4096, len(universe) - low)), np.float32)
        m[row[part], place[part] - low] = 1
        common += m @ m.T
    return common[np.searchsorted(used, i), np.searchsorted(used, j)].round().astype(np.int64)


def links(sets: list[np.ndarray], signatures: np.ndarray, first: np.ndarray, second: np.ndarray, same: bool,
          needed: dict[int, int], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs between two lists of members (indices into the sets)."""
    i, j = candidate_pairs(signatures[first], signatures[second], same, needed)
    i, j = first[i], second[j]
    size = np.array([len(s) for s in sets])
    on = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])
    i, j = i[on], j[on]
    if not len(i):
        return i, j
    common = intersections(sets, i, j)
    on = common >= threshold * (size[i] + size[j] - common) - 1e-9
    return i[on], j[on]


def _nodes(documents: DataFrame) -> DataFrame:
    """rk, th (hashes of row and text), doc_id, digest, bands of every document."""
    docs = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rk"), F.xxhash64("text").alias("th"))

    def make():
        codes = _Codes()

        def run(rows):
            for doc_id, text, rk, th in rows:
                s = shingles(words(text), codes)
                if len(s):
                    yield rk, th, doc_id, hashlib.blake2b(s.tobytes(), digest_size=16).digest(), band_keys(s)
                else:
                    yield rk, th, doc_id, None, None
        return run

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(map_rows(docs, make, f"rk long, th long, doc_id {kind}, digest binary, bands array<long>"), "ngram-documents")


def _candidate_groups(nodes: DataFrame) -> DataFrame:
    """(node, label) of all nodes that share a band key with another."""
    keyed = nodes.select(F.explode("bands").alias("key"), "digest")
    star = keyed.groupBy("key").agg(F.min("digest").alias("v"), F.count("*").alias("n")).where("n > 1").select("key", "v")
    return components(keyed.join(star, "key").select(F.col("digest").alias("u"), "v"))


def _linked(documents: DataFrame, nodes: DataFrame, groups: DataFrame, threshold: float, block: int) -> DataFrame:
    """Per block and node with links: (node, root, texts, docs, blocks)."""
    sizes = groups.groupBy("label").agg(F.count("*").alias("members"))
    placed = groups.join(sizes, "label").withColumn("blocks", F.ceil(F.col("members") / F.lit(block)).cast("int"))
    placed = placed.withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    wanted = placed.join(nodes.select(F.col("digest").alias("node"), "rep", "copies"), "node").select(
        "node", "label", "blocks", "b", "copies", F.col("rep.rk").alias("rk"), F.col("rep.th").alias("th"))
    texts = documents.select("text", F.xxhash64("doc_id", "text").alias("rk"), F.xxhash64("text").alias("th"))

    def sets():
        codes = _Codes()

        def run(rows):
            for node, label, blocks, b, copies, text in rows:
                s = shingles(words(text), codes)
                yield node, label, blocks, b, copies, minhash(s, _COMPARE_HASH).astype("<u4").tobytes(), s.tobytes()
        return run

    fetched = texts.join(wanted, ["rk", "th"]).select("node", "label", "blocks", "b", "copies", "text")
    members = map_rows(fetched, sets, "node binary, label binary, blocks int, b int, copies long, signature binary, shingles binary")
    members = members.withColumn("x", F.explode(F.expr("sequence(0, blocks - 1)")))
    members = members.select("label", F.least("b", "x").alias("lo"), F.greatest("b", "x").alias("hi"),
                             "b", "node", "copies", "blocks", "signature", "shingles")

    def compare():
        needed = least_matches(threshold)

        def run(key, rows):
            _, lo, hi = key
            rows = list({r[1]: r for r in rows}.values())  # repeated rows fetch a node twice
            rows.sort(key=lambda r: r[1])
            b = np.array([r[0] for r in rows])
            first, second = np.flatnonzero(b == lo), np.flatnonzero(b == hi)
            if len(rows) < 2 or not len(first) or not len(second):
                return
            signatures = np.stack([np.frombuffer(r[4], "<u4") for r in rows])
            i, j = links([np.frombuffer(r[5], np.uint64) for r in rows], signatures, first, second, lo == hi, needed, threshold)
            if not len(i):
                return
            copies = np.array([r[2] for r in rows])
            texts = np.bincount(i, minlength=len(rows)) + np.bincount(j, minlength=len(rows))
            docs = np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))
            root = np.arange(len(rows))
            while True:  # spread the least index over the links
                low = np.minimum(root[i], root[j])
                new = root.copy()
                np.minimum.at(new, i, low)
                np.minimum.at(new, j, low)
                new = new[new]
                if (new == root).all():
                    break
                root = new
            for k in np.flatnonzero(texts).tolist():
                yield rows[k][1], rows[root[k]][1], int(texts[k]), int(docs[k]), rows[k][3]
        return run

    return map_groups(members, ["label", "lo", "hi"], compare, "node binary, root binary, texts long, docs long, blocks int")


def _classified(documents: DataFrame, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(documents with digests, one row per node: digest, class, copies, n_links, n_linked_texts, rep, class_rep)."""
    docs = _nodes(documents)
    rep = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rk", "th")
    nodes = stored(docs.where("digest is not null").groupBy("digest").agg(
        F.min(rep).alias("rep"), F.count("*").alias("copies"), F.min("bands").alias("bands")), "ngram-nodes")
    groups = stored(_candidate_groups(nodes), "ngram-groups")
    linked = stored(_linked(documents, nodes, groups, threshold, block), "ngram-links")
    counts = linked.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"), F.min("root").alias("root"), F.max("blocks").alias("blocks"))
    several = components(linked.where("blocks > 1").select(F.col("node").alias("u"), F.col("root").alias("v")))
    label = counts.join(several, "node", "left").select(
        F.col("node").alias("digest"), "texts", "docs", F.coalesce("label", F.col("root")).alias("class"))
    rows = nodes.drop("bands").join(label, "digest", "left").withColumn("class", F.coalesce("class", "digest"))
    best = rows.groupBy("class").agg(F.min("rep").alias("class_rep"))
    out = rows.join(best, "class").select(
        "digest", "rep", "class_rep", (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_linked_texts"))
    return docs, stored(out, "ngram-classes")


def similarity_classes(documents: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class), n_links (other documents whose
    similarity reaches the threshold, copies included), n_linked_texts (other shingle sets that reach it)."""
    docs, nodes = _classified(documents, threshold, block)
    nodes = nodes.select("digest", F.col("class_rep.doc_id").alias("class_id"), "n_links", "n_linked_texts")
    found = docs.where("digest is not null").join(nodes, "digest").select("doc_id", "class_id", "n_links", "n_linked_texts")
    none = F.lit(0).cast("long")
    return found.union(docs.where("digest is null").select("doc_id", "doc_id", none, none))


def one_per_class(documents: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """The documents without near-duplicates: the one with the least doc_id of every class, all wordless ones."""
    docs, nodes = _classified(documents, threshold, block)
    keep = nodes.where("rep = class_rep").select("rep.rk", "rep.th").withColumn("once", F.lit(True))
    keep = keep.union(docs.where("digest is null").select("rk", "th", F.lit(False).alias("once")).distinct())
    repeated = docs.groupBy("rk", "th").agg(F.count("*").alias("n")).where("n > 1")
    keep = keep.join(repeated, ["rk", "th"], "left").select("rk", "th", (F.col("once") & F.col("n").isNotNull()).alias("repeated"))
    # The documents' own columns travel in a struct, as any of them may have a name used here.
    own = documents.select(F.xxhash64("doc_id", "text").alias("rk"), F.xxhash64("text").alias("th"),
                           F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("own"))
    kept = own.join(keep, ["rk", "th"])
    single = kept.where("not repeated").select("own.*")
    return single.union(kept.where("repeated").dropDuplicates(["rk", "th"]).select("own.*"))
