"""Document fingerprints: improbable-feature digests in chained Bloom filters.

Every WINDOW consecutive bytes of a text are a candidate feature.  Its entropy
falls into one of BINS, and bins rank by how rare they are among all windows
of the corpus (``entropy_counts``, one pass, summed by Spark); windows of
hardly any entropy rank last, as rules and padding say nothing about a text.
A window becomes a feature if it is the best-ranked one, the leftmost of
equals, in LEAST_WINS or more of the SPAN wide stretches that hold it.
Distinct features are hashed into Bloom filters of FILTER_BITS, in the order of
their first places; after FEATURES a new filter is chained on.  A fingerprint is the
number of filters, a colon and their bits in base64.

Two fingerprints are alike by their common bits: of each filter of the shorter
chain, the share of bits common with the best filter of the other beyond what
chance makes common, weighted by its bits.

Entropies of all windows come from how often a byte recurs in the WINDOW - 1 bytes before and
after it, which 2 * (WINDOW - 1) vector comparisons count, so whole texts of any length
take constant time a byte and bounded memory.

Neighbours in descending id (``with_next``): ranges of ids with equal shares of the rows are
sorted by Spark and streamed, each with a copy of the next range's first row behind
it; nothing is held but two rows.

Defined results: a null text counts as empty; an empty text has no filter (two
such are alike, any other is not); a text of fewer than WINDOW bytes is filled up
and is one window; equal texts have equal fingerprints; rows of equal id follow
one another by a hash of their texts, null ids come last; an only row follows
itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import annotate, map_rows, ship, utf8

WINDOW = 16
SPAN = 16
LEAST_WINS = 4
FEATURES = 160
FILTER_BITS = 2048
HASHES = 5
LOW_ENTROPY = 2.0
BLOCK = 1 << 18
RANGE_BYTES = 32 << 20
PAD = 0xFF  # no UTF-8 text holds it

# WINDOW times the entropy is WINDOW log2(WINDOW) - sum of c log2 c over the counts; in units of 1 / 1024, whole numbers.
_UNIT = 1024
_CLOGC = np.round(_UNIT * np.array([c * np.log2(c) if c else 0.0 for c in range(WINDOW + 1)])).astype(np.int64)
_STEP = np.diff(_CLOGC)  # from c to c + 1 equal bytes
_MOST = int(_CLOGC[WINDOW])
BINS = _MOST // _UNIT + 1
_WORST = 255


def _bins(data: np.ndarray) -> np.ndarray:
    """The entropy bin of each window of the bytes (len - WINDOW + 1 of them); 0 is the highest entropy."""
    n = len(data)
    after, before = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        after[:-d] += same
        before[d:] += same
    first = int(_CLOGC[np.bincount(data[:WINDOW], minlength=256)].sum())
    total = np.empty(n - WINDOW + 1, np.int64)
    total[0] = first
    np.cumsum(_STEP[before[WINDOW:]] - _STEP[after[:-WINDOW]], out=total[1:])
    total[1:] += first
    return (total // _UNIT).astype(np.uint8)


class Layout:
    """Texts one after another, filled up to WINDOW bytes; windows that cross an end are void."""

    def __init__(self, texts: list[bytes]):
        filled = [t if len(t) >= WINDOW or not t else t + bytes([PAD]) * (WINDOW - len(t)) for t in texts]
        gap = bytes([PAD]) * SPAN
        self.data = np.frombuffer(b"".join([gap, *filled, gap]), np.uint8)
        lengths = np.array([len(t) for t in filled], np.int64)
        self.ends = SPAN + np.cumsum(lengths)
        self.starts = self.ends - lengths

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, bins, void) of the windows, to - from of them, SPAN more on both sides."""
        last = len(self.data) - WINDOW + 1
        for a in range(SPAN, last, BLOCK):
            b = min(a + BLOCK, last)
            low, high = a - SPAN, min(b + SPAN, last)
            void = np.zeros(high - low + 1, np.int32)
            cut = self.ends - WINDOW + 1  # void from there to the end of its text
            ends = self.ends[self.ends > self.starts]
            cut = cut[self.ends > self.starts]
            np.add.at(void, np.clip(cut - low, 0, high - low), 1)
            np.add.at(void, np.clip(ends - low, 0, high - low), -1)
            void = np.cumsum(void)[:-1] > 0
            place = np.arange(low, high)
            void |= (place < SPAN) | (place >= self.ends[-1])
            yield a, b, _bins(self.data[low:high + WINDOW - 1]), void


def entropy_counts(documents: DataFrame) -> DataFrame:
    """(bin, n): windows of all texts by entropy bin."""

    def make():
        def count(rows: list) -> Iterable[tuple]:
            for part in _parts([utf8(t) for (t,) in rows]):
                layout, total = Layout(part), np.zeros(BINS, np.int64)
                for a, b, bins, void in layout.blocks():
                    own = slice(SPAN, SPAN + b - a)
                    total += np.bincount(bins[own][~void[own]], minlength=BINS)
                yield from ((int(k), int(total[k])) for k in np.flatnonzero(total))
        return count

    return map_rows(documents.select("text"), make, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))


def _parts(texts: list[bytes], size: int = 1 << 21) -> Iterator[list[bytes]]:
    """The texts in runs of about ``size`` bytes."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def ranks(counts: dict[int, int]) -> np.ndarray:
    """The rank of each bin: the rarest first, those of low entropy last."""
    low = (np.arange(BINS) * _UNIT) > _MOST - LOW_ENTROPY * WINDOW * _UNIT
    n = np.array([counts.get(k, 0) for k in range(BINS)])
    out = np.empty(BINS, np.uint8)
    out[np.lexsort((np.arange(BINS), n, low))] = np.arange(BINS)
    return out


def corpus_ranks(documents: DataFrame) -> np.ndarray:
    """Ranks by all texts of ``documents``; at most BINS rows come to the driver."""
    return ranks({r.bin: r.n for r in entropy_counts(documents).collect()})


def _features(layout: Layout, rank: np.ndarray) -> np.ndarray:
    """Places of the chosen windows."""
    chosen = []
    for a, b, bins, void in layout.blocks():
        own = np.where(void, np.uint8(_WORST), rank[bins]).astype(np.int64)
        best = own << 32 | np.arange(len(own))  # the least is the best rank, then the leftmost place
        step = 1
        while step < SPAN:
            best = np.minimum(best[:-step], best[step:])
            step *= 2
        wins = np.bincount(best & 0xFFFFFFFF, minlength=len(own))
        mine = slice(SPAN, SPAN + b - a)
        chosen.append(a + np.flatnonzero((wins[mine] >= LEAST_WINS) & ~void[mine]))
    return np.concatenate(chosen) if chosen else np.empty(0, np.int64)


def _mixed(words: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of uint64 words."""
    h = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(words.shape[1]):
        h = (h ^ words[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


def digests(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """The filters of each text, as rows of FILTER_BITS / 64 words."""
    out = []
    for part in _parts(texts):
        layout = Layout(part)
        at = _features(layout, rank)
        hashed = _mixed(np.lib.stride_tricks.sliding_window_view(layout.data, WINDOW)[at].view(np.uint64))
        text = np.searchsorted(layout.ends, at, "right")
        order = np.lexsort((at, hashed, text))
        once = np.ones(len(at), bool)
        same = (hashed[order][1:] == hashed[order][:-1]) & (text[order][1:] == text[order][:-1])
        once[order[1:][same]] = False
        hashed, text = hashed[once], text[once]
        n = np.bincount(text, minlength=len(part))
        filters = -(-n // FEATURES)
        begins = np.cumsum(filters) - filters
        nth = np.arange(len(text)) - (np.cumsum(n) - n)[text]
        bits = np.zeros((int(filters.sum()), FILTER_BITS), bool)
        row = begins[text] + nth // FEATURES
        for k in range(HASHES):
            bits[row, (hashed >> np.uint64(11 * k)).astype(np.int64) % FILTER_BITS] = True
        words = np.packbits(bits, axis=1).view(np.uint64) if len(bits) else np.empty((0, FILTER_BITS // 64), np.uint64)
        out += [words[s:s + f] for s, f in zip(begins.tolist(), filters.tolist(), strict=True)]
    return out


def written(filters: np.ndarray) -> str:
    return f"{len(filters)}:{base64.b64encode(filters.tobytes()).decode()}"


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.split(":")[1]), np.uint64).reshape(-1, FILTER_BITS // 64)


def _one_way(a: np.ndarray, b: np.ndarray) -> float:
    """The filters of ``a`` by their best match in ``b``, weighted by their bits."""
    bits_a, bits_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    total = 0.0
    for f, n in zip(a, bits_a.tolist(), strict=True):
        common = np.bitwise_count(f & b).sum(axis=1, dtype=np.int64)
        chance = n * bits_b / FILTER_BITS
        most = np.minimum(n, bits_b)
        noise = 3 * np.sqrt(chance * (1 - np.maximum(n, bits_b) / FILTER_BITS))
        beyond = np.where((common > chance + noise) | (common == most), (common - chance) / np.maximum(most - chance, 1e-9), 0)
        total += n * float(beyond.max())
    return min(1.0, total / int(bits_a.sum()))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1, the same both ways; 1 for equal filters."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) != len(b):
        return _one_way(*sorted((a, b), key=len))
    return (_one_way(a, b) + _one_way(b, a)) / 2


def fingerprint(documents: DataFrame, rank: np.ndarray) -> DataFrame:
    """The rows with ``fingerprint``."""

    def make():
        return lambda rows: ((written(f),) for f in digests([utf8(t) for (t,) in rows], rank))

    return annotate(documents, make, ["text"], "fingerprint string")


# neighbours


def with_next(documents: DataFrame, make, schema: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Call ``make()(rows)`` on runs of (doc_id, text, next text) as bytes, next in descending id, after the last the first.

    The first ids of the ranges (about one for every ``range_bytes`` of text)
    are ids of the table, found by Spark's approximate percentiles; only they
    come to the driver and back to the tasks, 8 bytes for each range.  Texts are
    compressed for the one shuffle.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("b"), F.max("doc_id").alias("m"),
                    F.sum(F.col("doc_id").isNull().cast("long")).alias("nulls")).first()
    n = max(1, -(-(size.b or 0) // range_bytes))
    parts = ", ".join(f"{k / n:.12f}" for k in range(1, n + 1))
    inner = rows.agg(F.expr(f"approx_percentile(doc_id, array({parts}), {max(10_000, 2 * n)})")).first()[0] or []
    edges = np.array(sorted({*inner, *([] if size.m is None else [size.m])}))  # the first ids of the ranges, backwards
    after = len(edges)  # the number of the range of null ids
    ranges = after + (1 if size.nulls else 0)

    kind = documents.schema["doc_id"].dataType.simpleString()
    order = F.xxhash64("text").alias("h")
    firsts = spark.createDataFrame([(e,) for e in edges.tolist()] + [(None,)], f"edge {kind}")
    heads = (rows.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("edge")), "left_semi").groupBy("doc_id")
             .agg(F.min(F.struct(order, "text")).alias("x")).select("doc_id", "x.text", "x.h", F.lit(True).alias("head")))

    def packed():
        press = zstandard.ZstdCompressor(level=1)

        def pack(batch: list) -> Iterable[tuple]:
            for doc_id, text, h, head in batch:
                own = after if doc_id is None else after - 1 - int(np.searchsorted(edges, doc_id, "left"))
                yield (own - 1) % ranges if head else own, head, doc_id, h, press.compress(utf8(text))
        return pack

    dealt = map_rows(rows.select("doc_id", "text", order, F.lit(False).alias("head")).union(heads.select("doc_id", "text", "h", "head")),
                     packed, f"part long, head boolean, doc_id {kind}, h long, packed binary")
    sorted_ = dealt.repartitionById(max(1, ranges), F.col("part").cast("int")).sortWithinPartitions("part", "head", F.desc_nulls_last("doc_id"), "h").select("part", "head", "doc_id", "packed")

    def chained():
        unpress, fn, last = zstandard.ZstdDecompressor(), make(), []

        def chain(batch: list) -> Iterable[tuple]:
            run, held = [], 0
            for part, head, doc_id, text in batch:
                text = unpress.decompress(text)
                if last and last[0][0] == part:
                    run.append((*last[0][1:], text))
                    held += len(text)
                last[:] = [] if head else [(part, doc_id, text)]
                if held > 1 << 20:
                    yield from fn(run)
                    run, held = [], 0
            yield from fn(run)
        return chain

    return map_rows(sorted_, chained, schema)


def edited(text: str, other: str) -> str:
    """The last half of the text (rounded down) replaced by the first as many code points of the other."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def compare_edits(documents: DataFrame, rank: np.ndarray, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of every text and of its text edited with the next document, and how alike they are."""

    def make():
        def compare(rows: list) -> Iterable[tuple]:
            whole = [t.decode("utf-8", "replace") for _, t, _ in rows]
            changed = [edited(t, n.decode("utf-8", "replace")).encode("utf-8", "replace") for t, (_, _, n) in zip(whole, rows, strict=True)]
            own, other = digests([t for _, t, _ in rows], rank), digests(changed, rank)
            following = _following(rows, own, rank)
            for (doc_id, _, _), text, new, f, g, h in zip(rows, whole, changed, own, other, following, strict=True):
                yield doc_id, len(text), hashlib.sha256(new).hexdigest(), written(f), written(g), likeness(f, g), likeness(f, h)
        return compare

    kind = documents.schema["doc_id"].dataType.simpleString()
    return with_next(documents, make, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                      "near_edited double, near_next double", range_bytes)


def _following(rows: list, own: list[np.ndarray], rank: np.ndarray) -> list[np.ndarray]:
    """The filters of the next texts: mostly those of the next row of the run."""
    known = [i + 1 < len(rows) and rows[i + 1][1] is rows[i][2] for i in range(len(rows))]
    rest = iter(digests([r[2] for r, k in zip(rows, known, strict=True) if not k], rank))
    return [own[i + 1] if k else next(rest) for i, k in enumerate(known)]
