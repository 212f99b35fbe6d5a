"""Cross-entropy difference of matched target and background bigram models.

Both models are interpolated bigram models with the same smoothing; the target
counts come from the target documents, the background counts from all documents.
Words and bigrams are counted exactly (by 64-bit hashes):

    p(w | v) = L * c(v, w) / max(c(v), 1) + (1 - L) * (c(w) + A) / (N + A * WORDS)

with c(v) = 0 making the bigram part 0; ``WORDS`` only sets the smoothing mass.
The score of a document is the mean over its tokens of
-log p_target + log p_background : low where the text is more like the target.

1. Documents are stored in chunks of about ``CHUNK_TOKENS`` tokens: the hashes of
   the chunk's words and the tokens as places among them.
2. Every chunk adds up its words and bigrams and sends them to buckets by hash.
   A bucket adds up what the chunks sent and answers each chunk with the counts
   of the corpus.  A chunk sends a word or bigram once, so a hot one adds one
   entry a chunk.  The number of buckets grows with the corpus, so what a task
   holds does not, and nothing but three totals reaches the driver.
3. Every chunk meets its answers and scores its documents.

Defined results: a null or wordless text has 0 tokens and score 0; a label row
with a null doc_id joins nothing, several label rows of a document are one;
with an empty target or corpus all probabilities are the smoothed uniform
ones; repeated rows count and are scored each; very long texts are read whole;
other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from tickerlake.llm.common import _batch, map_rows, ship, stored, words

WORDS = 1 << 17
SHARE = 0.6
ADD = 0.1
START = 0  # hash of the beginning of a text
CHUNK_TOKENS = 1_000_000
BUCKET_TOKENS = 1_000_000
MEMO = 500_000


class _Hashes(dict):
    """Word -> 64-bit hash; bounded, starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _packed(values: np.ndarray) -> bytes:
    """64-bit values, all their first bytes before all their second ones, so that small values pack well."""
    flat = np.ascontiguousarray(values, "<u8").reshape(-1)
    return pa.compress(np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).reshape(-1).view("<u8")


def _chunks(documents: DataFrame, chunk_tokens: int) -> DataFrame:
    """chunk, n_tokens, doc_ids, sizes (tokens per document), hashes (of the chunk's words), tokens (places in hashes)."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"chunk long, n_tokens long, doc_ids array<{kind}>, sizes array<int>, hashes binary, tokens binary"
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in _parse_datatype_string(schema)])
    ship(documents.sparkSession)

    def cut(it):
        known = _Hashes()
        number = TaskContext.get().partitionId() << 32
        doc_ids, sizes, tokens = [], [], array("Q")

        def made():
            hashes, places, n = np.unique(np.frombuffer(tokens, np.uint64), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")  # small places for frequent words
            rank = np.empty(len(n), np.int64)
            rank[order] = np.arange(len(n))
            return _batch([(number, len(tokens), doc_ids, sizes, hashes[order].astype("<u8").tobytes(), _packed(rank[places]))], arrow)

        for batch in it:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ws = words(text)
                doc_ids.append(doc_id)
                sizes.append(len(ws))
                tokens.extend(map(known.__getitem__, ws))
                if len(tokens) >= chunk_tokens or len(doc_ids) >= chunk_tokens:
                    yield made()
                    number += 1
                    doc_ids, sizes, tokens = [], [], array("Q")
        if doc_ids:
            yield made()

    return documents.select("doc_id", "text").mapInArrow(cut, schema)


class _Chunk:
    """Words and bigrams of a chunk in the order in which they are sent: by bucket, then by hash."""

    def __init__(self, sizes: list[int], hashes: bytes, tokens: bytes, buckets: int):
        self.sizes = np.array(sizes, np.int64)
        n = int(self.sizes.sum())
        self.word = _unpacked(tokens, n).astype(np.int64) + 1  # place 0 is START
        self.hashes = np.concatenate([np.array([START], np.uint64), np.frombuffer(hashes, "<u8")])
        self.context = np.empty(n, np.int64)
        self.context[1:] = self.word[:-1]
        first = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        self.context[first] = 0
        pair, self.pair = np.unique(self.context * len(self.hashes) + self.word, return_inverse=True)
        self.pair_context, self.pair_word = np.divmod(pair, len(self.hashes))
        v, w = self.hashes[self.pair_context], self.hashes[self.pair_word]
        keys = _mixed(_mixed(v) * np.uint64(0x9E3779B97F4A7C15) + w)
        # Bigrams go to buckets 0 .., words (fewer) to those behind.
        self.pair_keys, self.pair_bucket, self.pair_order = _dealt(keys, 0, buckets)
        self.word_keys, self.word_bucket, self.word_order = _dealt(_mixed(self.hashes), buckets, buckets // 8 + 1)

    def counts(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of (background, target) bigrams and of (background, target) words and contexts in sending order."""
        on = np.repeat(chosen, self.sizes)
        pairs = [np.bincount(self.pair[s], minlength=len(self.pair_word)) for s in (slice(None), on)]
        places = [np.bincount(x[s], minlength=len(self.hashes)) for x in (self.word, self.context) for s in (slice(None), on)]
        return np.array(pairs)[:, self.pair_order], np.array(places)[:, self.word_order]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _dealt(keys: np.ndarray, first: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key within its bucket, bucket, place among the given) in order of buckets, then keys."""
    within, bucket = np.divmod(keys, np.uint64(buckets))
    order = np.lexsort((within, bucket))
    return within[order], bucket[order].astype(np.int64) + first, order


def _by_group(df: DataFrame, key: str, order: str, fn: Callable[[list], Iterable[tuple]], schema: str) -> DataFrame:
    """Call ``fn`` with the rows of each ``key`` in ``order``; one group at a time is held."""
    ship(df.sparkSession)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in _parse_datatype_string(schema)])
    at = df.columns.index(key)

    def run(it):
        rows, out, weight = [], [], 0
        for batch in it:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and rows[0][at] != row[at]:
                    out += fn(rows)
                    rows = []
                    weight = sum(64 + sum(len(v) for v in r if isinstance(v, bytes)) for r in out)
                    if weight > 8_000_000:
                        yield _batch(out, arrow)
                        out = []
                rows.append(row)
        if rows:
            out += fn(rows)
        if out:
            yield _batch(out, arrow)

    return df.repartition(key).sortWithinPartitions(key, order).mapInArrow(run, schema)


def _answers(chunks: DataFrame, chosen: DataFrame, buckets: int) -> DataFrame:
    """chunk, bucket, counts: what the corpus holds of the words or bigrams that the chunk sent to the bucket."""

    def make():
        def run(rows):
            for chunk, _, sizes, hashes, tokens, places in rows:
                if not any(sizes):
                    continue
                c = _Chunk(sizes, hashes, tokens, buckets)
                on = np.zeros(len(sizes), bool)
                on[places or []] = True
                for keys, bucket, counts in zip((c.pair_keys, c.word_keys), (c.pair_bucket, c.word_bucket), c.counts(on), strict=True):
                    low = 0
                    for high in [*(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]:
                        steps = np.diff(keys[low:high], prepend=np.uint64(0))
                        yield chunk, int(bucket[low]), high - low, _packed(steps), _packed(counts[:, low:high])
                        low = high
        return run

    marked = chunks.join(chosen.select("chunk", "places").hint("merge"), "chunk", "left")
    sent = map_rows(marked.select(*chunks.columns, "places"), make, "chunk long, bucket long, n int, keys binary, counts binary")

    def add(rows):
        kinds = 2 if rows[0][1] < buckets else 4
        keys, place = np.unique(np.concatenate([np.cumsum(_unpacked(r[3], r[2])) for r in rows]), return_inverse=True)
        total = np.zeros((kinds, len(keys)), np.int64)
        low = 0
        for _, _, n, _, counts in rows:
            total[:, place[low:low + n]] += _unpacked(counts, kinds * n).reshape(kinds, n).astype(np.int64)  # a chunk sends a key once
            low += n
        low = 0
        for chunk, bucket, n, _, _ in rows:
            yield chunk, bucket, _packed(total[:, place[low:low + n]])
            low += n

    return _by_group(sent, "bucket", "chunk", add, "chunk long, bucket long, counts binary")


def score(documents: DataFrame, targets: DataFrame, chunk_tokens: int = CHUNK_TOKENS, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (nats per token) and score of every document.

    ``targets`` lists the doc_id of the target documents.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    chunks = stored(_chunks(documents, chunk_tokens), "lm-chunks")
    listed = targets.select("doc_id").where("doc_id is not null").distinct()
    rows = chunks.select("chunk", F.posexplode(F.arrays_zip("doc_ids", "sizes")).alias("place", "d")).select("chunk", "place", "d.doc_ids", "d.sizes")
    # A merge join at every size: the list of targets grows with the corpus.
    found = rows.join(listed.hint("merge"), rows["doc_ids"] == listed["doc_id"])
    chosen = stored(found.groupBy("chunk").agg(F.collect_list("place").alias("places"), F.sum("sizes").alias("n_tokens")), "lm-targets")
    n_background = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    n_target = chosen.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = n_background // bucket_tokens + 1
    # The chunks are dealt by their number once, for both joins (the same exchange).
    dealt = chunks.select("chunk", "doc_ids", "sizes", "hashes", "tokens")
    answers = _answers(dealt, chosen, buckets).groupBy("chunk").agg(F.collect_list(F.struct("bucket", "counts")).alias("answers"))

    def loss(c: _Chunk, pair: np.ndarray, word: np.ndarray, context: np.ndarray, total: int) -> np.ndarray:
        """Mean loss of every document."""
        single = (word[c.pair_word] + ADD) / (total + ADD * WORDS)
        n = context[c.pair_context]
        p = SHARE * np.where(n > 0, pair / np.maximum(n, 1), 0.0) + (1 - SHARE) * single
        owner = np.repeat(np.arange(len(c.sizes)), c.sizes)
        return np.bincount(owner, -np.log(p)[c.pair], len(c.sizes)) / np.maximum(c.sizes, 1)

    def make():
        def run(rows):
            for doc_ids, sizes, hashes, tokens, found in rows:
                if not any(sizes):
                    yield from ((d, 0, 0.0, 0.0, 0.0) for d in doc_ids)
                    continue
                c = _Chunk(sizes, hashes, tokens, buckets)
                pairs, places = np.empty((2, len(c.pair_keys)), np.int64), np.empty((4, len(c.word_keys)), np.int64)
                for answer in found:
                    bucket = answer["bucket"]
                    of, to, order = (c.pair_bucket, pairs, c.pair_order) if bucket < buckets else (c.word_bucket, places, c.word_order)
                    low, high = np.searchsorted(of, [bucket, bucket + 1])
                    to[:, order[low:high]] = _unpacked(answer["counts"], len(to) * (high - low)).reshape(len(to), -1)
                b = loss(c, pairs[0], places[0], places[2], n_background)
                t = loss(c, pairs[1], places[1], places[3], n_target)
                yield from zip(doc_ids, sizes, t.tolist(), b.tolist(), (t - b).tolist(), strict=True)
        return run

    met = dealt.join(answers.hint("merge"), "chunk", "left").select("doc_ids", "sizes", "hashes", "tokens", "answers")
    return map_rows(met, make, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double, score double")
