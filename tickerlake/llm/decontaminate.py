"""Benchmark decontamination by a prefix-filtered containment join.

Every benchmark item gives windows of ``size`` consecutive words (an item of
fewer words, but not none, is one window).  A document contains a window only
if it contains all its words in a row, so one word of the window is a
sufficient prefix: the words of each window are ordered by rarity (document
frequency over the whole corpus) and the rarest is joined with the document's
words.  The position of the joined word fixes where the window would start;
length and position bounds drop impossible starts, and the rest is verified
word by word.

The index of windows is sent to the tasks only within ``block_bytes``; a
larger benchmark is cut into blocks of items and every block is joined with
all documents.

Defined results: a null or wordless text has ``n_words`` 0 and no hits; rows
of the benchmark without words or with a null item_id give no window; items
with equal ids count once; repeated documents each get their row.  Very long
texts are processed whole.  An empty benchmark hits nothing, an empty document
table gives an empty result.  Columns other than doc_id, text and item_id are
ignored (``decontaminate``) or passed through (``clean_documents``).
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import annotate, map_rows, stored, words

SIZE = 10
BLOCK_BYTES = 16_000_000


def item_windows(text: str | None, size: int = SIZE) -> list[tuple[bytes, ...]]:
    ws = words(text)
    if not ws:
        return []
    return [tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))]


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """Cut the benchmark into blocks whose texts have about ``block_bytes`` at most."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // block_bytes) + 1
    if n == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def _document_frequency(documents: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """Documents holding each benchmark word; the result is bounded by the block's vocabulary."""

    def make():
        def count(rows):
            c: Counter = Counter()
            for (text,) in rows:
                c.update(vocabulary.intersection(words(text)))
            return c.items()
        return count

    df = map_rows(documents.select("text"), make, "word binary, n long")
    return {bytes(r.word): r.n for r in df.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _index(items: list[tuple[str, str]], frequency: dict[bytes, int], size: int) -> dict[bytes, list]:
    """rarest word -> [(window, place of that word in it, item ids)]."""
    owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item_id, text in items:
        for w in item_windows(text, size):
            owners[w].add(item_id)
    index: dict[bytes, list] = defaultdict(list)
    for w, ids in owners.items():
        at = min(range(len(w)), key=lambda i: (frequency.get(w[i], 0), w[i], i))
        if frequency.get(w[at], 0):
            index[w[at]].append((list(w), at, sorted(ids)))
    return dict(index)


def match(ws: list[bytes], index: dict[bytes, list]) -> tuple[bytearray, set[str]]:
    """Mark the words of a document that lie in an occurrence of a window; the items that occur."""
    hit = bytearray(len(ws))
    found: set[str] = set()
    for pos in [i for i, w in enumerate(ws) if w in index]:
        for window, at, ids in index[ws[pos]]:
            start, n = pos - at, len(window)
            if start < 0 or start + n > len(ws):
                continue
            if ws[start:start + n] == window:
                hit[start:start + n] = b"\1" * n
                found.update(ids)
    return hit, found


def _digest(found) -> str:
    return hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def decontaminate(documents: DataFrame, benchmark: DataFrame, size: int = SIZE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items (the sorted ids)."""
    return _annotated(documents.select("doc_id", "text"), benchmark, size, block_bytes).drop("text")


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"


def _annotated(documents: DataFrame, benchmark: DataFrame, size: int, block_bytes: int) -> DataFrame:
    blocks = _blocks(benchmark, block_bytes)
    if len(blocks) > 1:
        documents = documents.withColumns({"__hit": F.lit(None).cast("binary"), "__items": F.lit(None).cast("array<string>")})
    for k, block in enumerate(blocks):
        items = [(r.item_id, r.text) for r in block.collect()]
        vocabulary = frozenset(w for _, t in items for w in words(t))
        index = _index(items, _document_frequency(documents, vocabulary), size) if vocabulary else {}
        shared = documents.sparkSession.sparkContext.broadcast(index)
        last = k == len(blocks) - 1
        documents = _block_pass(documents, shared, len(blocks) > 1, last)
        if not last:
            documents = stored(documents, "decontaminate-block")
    return documents.drop("__hit", "__items")


def _block_pass(documents: DataFrame, shared, carried: bool, last: bool) -> DataFrame:
    def make():
        index = shared.value

        def run(rows):
            for row in rows:
                ws = words(row[0])
                hit, found = match(ws, index)
                if carried and row[1] is not None:
                    hit = bytearray(a | b for a, b in zip(hit, row[1], strict=True))
                    found |= set(row[2])
                if last:
                    yield len(ws), sum(hit), len(found), _digest(found), any(hit), sorted(found)
                else:
                    yield bytes(hit), sorted(found)
        return run

    return annotate(documents, make, ["text", "__hit", "__items"] if carried else ["text"],
                    RESULT if last else "__hit binary, __items array<string>")


def clean_documents(documents: DataFrame, benchmark: DataFrame, size: int = SIZE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without any hit, with their own columns."""
    own = documents.select("text", F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("own"))
    return _annotated(own, benchmark, size, block_bytes).where(~F.col("contaminated")).select("own.*")
