"""The source divergence audit against a plain reading of its definition."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tickerlake.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_audit(rows, least, ranks=10):
    """Sorted (lang, source, part, item, value, rank) of rows (doc_id, text, lang, source)."""
    counts, lies_in = defaultdict(Counter), defaultdict(Counter)
    groups = {(r[2] or "", r[3] or "") for r in rows}
    for _, text, lang, source in rows:
        counts[lang or "", source or ""].update(terms(text))
        lies_in[lang or ""].update(set(terms(text)))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in lies_in[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(counter, kept=kept):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = sorted((-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            own = sorted((-gap(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:ranks]
            for part, found in (("pair", pairs), ("term", own)):
                out += [(lang, s, part, item.decode(), -value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


def odd_rows():
    rng = np.random.default_rng(11)
    vocabulary = ["a", "it", "The", "ÉTÉ", "été", "word", "seven", "eightxyz", "ninechars", "sixteenletters16", "seventeen-letters", "漢字漢字漢字漢字",
                  "x" * 40, "y" * 70_000, "Sünde", "12", "über7und8", "#tag", "\x00", "ÿþ"]
    weights = np.arange(len(vocabulary), 0, -1) / np.arange(len(vocabulary), 0, -1).sum()
    rows = []
    for i in range(160):
        text = " ".join(rng.choice(vocabulary, rng.integers(0, 12), p=weights))
        rows.append((i, text, ["en", "de", None, ""][i % 4], ["hot", "hot", "s1", "s2", None, "Ä", "z"][int(rng.integers(0, 7))]))
    rows += [(None, None, "en", "silent"), (1, "", "en", "silent"), (2, "123 !!", "xx", "a"), (2, "rare", "xx", "b"), (3, None, None, None)]
    rows += [(9, "same text every time", "fr", "copies")] * 30 + [(9, "same day", "fr", "other")]
    rows += [(10, "word " * 50_000 + "tail", "en", "long")]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"flush_bytes": 500, "block_terms": 2, "tile_sources": 2}])
def test_audit_equals_plain_reading(spark, sizes):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("term", "n", "p", "item", "value", "rank", "total"):
        docs = docs.selectExpr("*", f"'clash' as {name}")
    for least in (3, 10) if sizes else (10,):
        got = divergence.audit(docs, least_docs=least, **sizes)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == plain_audit(rows, least)


def test_empty_and_termless_tables(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "12", "en", "a"), (2, None, "en", "b"), (3, "one", "en", "c"), (4, "one", "de", "a")]
    got = sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == plain_audit(rows, 10) and len(got) == 6 and not any(r[4] for r in got)


def test_counts_of_any_length_and_neighbours():
    """Runs of equal terms over length buckets; neighbouring texts are not joined; slices of a column count alone."""
    texts = ["ab", "cd ab", None, "", "AB" * 40, "é" * 9, "ab" * 40, "q" * 8, "q" * 9, "q" * 16, "q" * 17, "zz" * 33_000, "ab"]
    group = np.array([i % 2 for i in range(len(texts))])
    column = pa.array(["junk", *texts, "junk"])[1:-1]
    got = Counter()
    for g, t, n, d in divergence.count_terms(column, group, 2):
        for row in zip(g.tolist(), t.to_pylist(), n.tolist(), d.tolist(), strict=True):
            assert row[:2] not in got
            got[row[:2]] = row[2:]
    plain, docs = Counter(), Counter()
    for t, g in zip(texts, group.tolist(), strict=True):
        plain.update((g, w) for w in terms(t))
        docs.update({(g, w) for w in terms(t)})
    assert got == {k: (plain[k], docs[k]) for k in plain}


def test_radix_sorts_like_numpy():
    rng = np.random.default_rng(2)
    word = rng.integers(0, 2**48, 5000, dtype=np.uint64) >> rng.integers(0, 40, 5000).astype(np.uint64)
    assert (divergence._radix(np.arange(5000), word, 6) == np.argsort(word, kind="stable")).all()
