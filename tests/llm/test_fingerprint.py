"""Improbable-feature digests against a plain reading of their definition."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerlake.llm import fingerprint as fp
from tickerlake.llm import queries

PROSE = "The quick brown fox jumps over the lazy dog while seven wise men watch from a distant hill and take careful notes of it. "
TEXTS = [None, "", "a", "short text", "fifteen letters", "sixteen letters!", PROSE, PROSE * 3, "é漢" * 40, "-" * 500, PROSE[:70] + "-" * 300 + PROSE,
         "".join(f"line {i}: {i * i} é\n" for i in range(900)), "\x00\x1f" * 30, PROSE.upper() + PROSE[::-1], "b"]


def texts_as_bytes():
    return [(t or "").encode() for t in TEXTS]


def windows(text):
    text = text + b"\xff" * (fp.WINDOW - len(text)) if text else text
    return [text[i:i + fp.WINDOW] for i in range(len(text) - fp.WINDOW + 1)]


def bin_of(window):
    return sum(round(1024 * c * math.log2(c)) for c in Counter(window).values()) // 1024


def plain_features(text, rank):
    """Distinct chosen windows in order of their first places."""
    w = windows(text)
    keys = [(rank[bin_of(x)], i) for i, x in enumerate(w)]
    wins = Counter(min(keys[max(0, a):a + fp.SPAN])[1] for a in range(1 - fp.SPAN, len(w))) if w else {}
    return list(dict.fromkeys(w[i] for i in sorted(wins) if wins[i] >= fp.LEAST_WINS))


def plain_filters(text, rank):
    chosen = plain_features(text, rank)
    out = []
    for at in range(0, len(chosen), fp.FEATURES):
        bits = set()
        for x in chosen[at:at + fp.FEATURES]:
            h = int(fp._mixed(np.frombuffer(x, np.uint64)[None])[0])
            bits |= {(h >> 11 * k) % fp.FILTER_BITS for k in range(fp.HASHES)}
        out.append(bits)
    return out


def bits_of(filters):
    return [set(np.flatnonzero(np.unpackbits(row.view(np.uint8))).tolist()) for row in filters]


def plain_ranks(texts):
    n = Counter(bin_of(w) for t in texts for w in windows(t))
    most = fp.WINDOW * math.log2(fp.WINDOW)
    order = sorted(range(fp.BINS), key=lambda k: (k > most - fp.LOW_ENTROPY * fp.WINDOW, n[k], k))
    return {k: i for i, k in enumerate(order)}


def test_digests_equal_plain_reading(spark, monkeypatch):
    texts = texts_as_bytes()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, fingerprint string")
    rank = fp.corpus_ranks(docs.repartition(3))
    assert {k: int(r) for k, r in enumerate(rank)} == plain_ranks(texts)
    expected = [plain_filters(t, rank) for t in texts]
    assert [bits_of(f) for f in fp.digests(texts, rank)] == expected
    assert len(expected[11]) > 3 and not expected[1] and all(expected[2:])
    monkeypatch.setattr(fp, "BLOCK", 64)  # windows near the ends of blocks
    assert [bits_of(f) for f in fp.digests(texts, rank)] == expected
    monkeypatch.undo()
    got = fp.fingerprint(docs, rank).orderBy("doc_id").collect()
    assert [bits_of(fp.read(r.fingerprint)) for r in got] == expected
    assert fp.fingerprint(docs.limit(0), rank).count() == 0 and not fp.entropy_counts(docs.limit(0)).count()


def test_likeness():
    rank = fp.ranks({})
    rng = np.random.default_rng(1)
    long = " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(4000))
    a, half, none, empty, tail = fp.digests([long.encode(), (long[:len(long) // 2] + long[::-1][:len(long) // 2]).encode(), long[::-1].encode(), b"",
                                             (long + " and more").encode()], rank)
    assert fp.likeness(a, a) == 1 and fp.likeness(empty, empty) == 1 and fp.likeness(a, empty) == 0 == fp.likeness(empty, a)
    assert 0.4 < fp.likeness(a, half) < 0.6 and fp.likeness(a, none) < 0.02 and fp.likeness(a, tail) > 0.95
    assert fp.likeness(a, half) == fp.likeness(half, a) and fp.likeness(a, tail) == fp.likeness(tail, a)


def plain_rows(rows, rank):
    import xxhash

    def hashed(text):
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        return h - 2**64 if h >= 2**63 else h

    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashed(r[1])))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        new = t[:len(t) - half] + after[:half]
        own, edited, following = fp.digests([x.encode() for x in (t, new, after)], rank)
        out.append((-1 if i is None else i, len(t), hashlib.sha256(new.encode()).hexdigest(), fp.written(own), fp.written(edited),
                    fp.likeness(own, edited), fp.likeness(own, following)))
    return sorted(out)


@pytest.mark.parametrize("range_bytes", [fp.RANGE_BYTES, 2000])
def test_edits_equal_plain_reading(spark, range_bytes):
    rows = [(i * 7 - 20, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (None, PROSE), (None, None), (1, PROSE), (1, PROSE), (1, "other"), (1, "")]
    rows += [(1000 + i, PROSE * (i % 5)) for i in range(60)]
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, head string, h double").repartition(5)
    rank = fp.corpus_ranks(docs)
    got = fp.compare_edits(docs, rank, range_bytes).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == plain_rows(rows, rank)


def test_small_tables(spark):
    schema = "doc_id long, text string"
    for rows in ([], [(5, PROSE)], [(None, PROSE)], [(2, "ab"), (1, None)]):
        docs = spark.createDataFrame(rows, schema)
        rank = fp.corpus_ranks(docs)
        got = fp.compare_edits(docs, rank).collect()
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == plain_rows(rows, rank)


def test_query_tells_edits_from_neighbours(spark):
    rows = queries.op11_fingerprint(spark, "/root/testdata/sf0.001").where(F.col("n_chars") >= 200).collect()
    assert len(rows) > 150
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.97 and np.median([r.near_edited for r in rows]) > 0.4
