"""Operators on rows: quality, decontamination, language, LM scoring, against brute force and on odd input."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerlake.llm import decontaminate, langid, lm_score, quality
from tickerlake.llm.common import words
from tickerlake.llm.tokens import BpeIds

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "The quick brown fox jumps over the lazy dog while seven wise men watch from a distant hill and take careful notes of it"


def frame(spark, texts, langs=None):
    rows = [(i, t, (langs or ["en"] * len(texts))[i], "s", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " \n\t", "one", "ÄB ça 漢字 x", "a  b\n\nc\r\n", PROSE, PROSE, " ".join(f"w{i % 977}x" for i in range(30_000)), "!!! ???", "\x00\x1f"]


def test_words_match_pattern():
    for t in ODD:
        assert [w.decode() for w in words(t)] == WORD.findall((t or "").translate(LOWER))


def test_token_ids_equal_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    own = BpeIds()
    public = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    public.encode_special_tokens = True
    rng = np.random.default_rng(3)
    parts = ["a", "Bc", " ", "  ", "\n", "\t", "é", "'s", "12", "!", "　", "\xa0", "漢", "🙂", "\r\n", "<|endoftext|>"]
    texts = [t or "" for t in ODD] + ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(3000)]
    for t in texts:
        assert np.frombuffer(own(t), "<u2").tolist() == public.encode(t, add_special_tokens=False).ids


def test_packed_ids_equal_default_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tickerlake.llm import packing

    public = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(4)
    parts = ["a", "Bc", " ", "  ", "\n", "é", "12", "<|endoftext|>", "<|endoftext", "|>"]
    texts = ["end <|endoftext|> of", "<|endoftext|>", "<|endoftext|><|endoftext|>x", *("".join(rng.choice(parts, 12)) for _ in range(300))]
    own = BpeIds(added=True)
    for t in texts:
        assert np.frombuffer(own(t), "<u2").tolist() == public.encode(t, add_special_tokens=False).ids
    piece = packing.pack(frame(spark, texts[:1]), length=64).first()
    assert np.frombuffer(piece.ids, "<u4").tolist()[:4] == [437, 220, 50256, 286] and piece.doc_tokens == 5


# quality


def brute_counts(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    inside = {k for i in range(len(ws) - 7) if grams[tuple(ws[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_base_counts_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["a", "bb", "#x", "é", "漢字", "c|d"]
    texts = ODD[:8] + ["".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in rng.choice(vocabulary[:k], 40)) for k in (1, 2, 3, 6) for _ in range(12)]
    texts += [" ".join([PROSE] * 3), PROSE + "\n" + PROSE]
    got = quality.annotate_quality(frame(spark, texts)).orderBy("doc_id").collect()
    for t, r in zip(texts, got, strict=True):
        expected = brute_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (r.base_failed and r.kept)


def test_fertility_measures_and_bands():
    import public_tokenizers
    import sentencepiece

    f = quality.Fertility()
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for t in ["Ñandú 漢字 🙂 ßü", "ก็ԱԲ abc", PROSE]:
        fallback = sum(pieces.is_byte(i) for i in pieces.encode(t))
        assert fallback == sum(len(c.encode()) for c in t if c not in f.known)
    good = quality.judge(PROSE + " " + PROSE.upper(), f, quality.BANDS)
    assert good[6] and good[7] == "latin" and 2 < good[8] < 8
    words_ = (PROSE + " " + PROSE.upper()).split()
    assert not quality.judge(" ".join(w + "###" for w in words_), f, quality.BANDS)[6]
    assert not quality.judge(" | ".join(words_), f, quality.BANDS)[6]
    assert not quality.judge(" ".join(w for w in words_[:7] for _ in range(8)), f, quality.BANDS)[6]
    assert quality.script_of("Это русский текст") == "cyrillic" and quality.script_of("漢字と") == "han"


def test_quality_edges(spark):
    clash = frame(spark, ODD).withColumnsRenamed({"source": "kept"})
    out = quality.annotate_quality(clash)
    assert out.columns.count("kept") == 1 and dict(out.dtypes)["kept"] == "boolean" and out.count() == len(ODD)
    assert set(quality.kept_documents(clash).columns) == set(clash.columns)
    assert quality.kept_documents(clash).count() == 2  # both copies of the prose; the long text repeats itself
    assert quality.annotate_quality(clash.limit(0)).count() == 0


# decontamination


def brute_hits(text, items, size=10):
    ws = WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item_id, t in items:
        iw = WORD.findall((t or "").translate(LOWER))
        n = min(size, len(iw))
        if item_id is None or not n:
            continue
        grams = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)}
        for i in range(len(ws) - n + 1):
            if tuple(ws[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(str(item_id))
    return len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


ITEMS = [(1, PROSE), (2, "seven wise MEN"), (3, None), (None, "one"), (10, "a a a a a a a a a a a a"), (2, "ça"), (11, "")]


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 40])
def test_decontamination_equals_brute_force(spark, block_bytes):
    texts = ODD + ["x " + PROSE.upper() + " y", PROSE[:60], "a " * 25, "wise men seven wise men, seven! wise? men", " ".join(PROSE.split()[3:14])]
    docs = frame(spark, texts).withColumnsRenamed({"source": "items", "n_chars": "contaminated"})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("item_id", "text", "'z' as n_hit")
    got = decontaminate.decontaminate(docs, items, block_bytes=block_bytes).orderBy("doc_id").collect()
    for t, r in zip(texts, got, strict=True):
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute_hits(t, ITEMS)
    clean = decontaminate.clean_documents(docs, items, block_bytes=block_bytes)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, t in enumerate(texts) if not brute_hits(t, ITEMS)[1]]


def test_decontamination_empty_tables(spark):
    docs = frame(spark, ODD[:4])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).where("contaminated").count() == 0


# language


def test_gradients_and_pooling():
    rng = np.random.default_rng(0)
    m = langid.initial(["a", "b", "c"], 3)
    m = langid.Model(m.labels, *[langid.Direction(*[w.astype(float) for w in d]) for d in (m.forward, m.backward)], m.out.astype(float), m.bias.astype(float))
    x, y = rng.integers(60, 130, (5, 4)).astype(np.uint8), rng.integers(0, 3, 4)
    _, grads = langid.loss_and_gradients(m, x, y)
    for w, g in zip(langid._weights(m), grads, strict=True):
        k = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, e = w[k], 1e-3
        w[k] = kept + e
        up = langid.loss_and_gradients(m, x, y)[0]
        w[k] = kept - e
        down = langid.loss_and_gradients(m, x, y)[0]
        w[k] = kept
        assert abs((up - down) / (2 * e) - g[k]) < 1e-4
    texts = [rng.integers(32, 255, n).astype(np.uint8).tobytes() for n in (1, 40, 256, 300, 700)]
    m = langid.initial(["a", "b", "c"], 4)
    got = langid.pooled(m, [*texts, b"", b"123"])
    for t, p in zip(texts, got, strict=False):
        total, n = np.zeros(3), 0
        for at in range(0, len(t), langid.WINDOW):
            x = np.frombuffer(t[at:at + langid.WINDOW], np.uint8)[:, None]
            f, _ = langid._run(m.forward, x, range(len(x)))
            b, _ = langid._run(m.backward, x, range(len(x) - 1, -1, -1))
            q = langid._softmax(np.concatenate([f, b], axis=2) @ m.out + m.bias)[:, 0]
            on = langid._LETTER[x[:, 0]]
            total, n = total + q[on].sum(0), n + on.sum()
        assert np.allclose(p, total / max(1, n), atol=1e-4)
    assert not got[-2:].any()


def test_language_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out(docs.doc_id)))
    judged = langid.annotate_language(docs, model).withColumn("held_out", langid.held_out(F.col("doc_id")))
    held = [r for r in judged.collect() if r.held_out]
    assert len(held) > 150 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in held)
    odd = langid.annotate_language(frame(spark, ODD).withColumnsRenamed({"source": "score"}), model).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in odd] == [not any(c.isalpha() for c in t or "") for t in ODD]
    assert odd[6].score == odd[7].score
    assert langid.annotate_language(docs.limit(0), model).count() == 0


def test_language_without_labels(spark):
    docs = frame(spark, ODD, [None] * len(ODD))
    assert langid.fit(docs) is None
    assert {r.lang_pred for r in langid.annotate_language(docs, None).collect()} == {"und"}


def test_many_languages_are_all_learned(spark):
    """No label is left out of the sample, the rarest of 250 neither; the model grows with the labels and learns the last."""
    rng = np.random.default_rng(4)
    letters = [chr(0x4E00 + 40 * k) + chr(0x4E07 + 40 * k) + chr(0x4E0F + 40 * k) for k in range(250)]

    def text(k, n=60):
        return "".join(rng.choice(list(letters[k]), n))

    rows = [(text(k), f"l{k:03}") for k in range(250) for _ in range(8 if k < 249 else 2)]
    assert Counter(langid.sample(spark.createDataFrame(rows, "text string, lang string"))[1]) == Counter(r[1] for r in rows)
    few = spark.createDataFrame([r for r in rows if r[1] < "l016"], "text string, lang string")
    model = langid.fit(few)
    assert len(model.labels) == 16 and model.out.shape[0] > 2 * langid.HIDDEN
    fresh = spark.createDataFrame([(k, text(k, 80)) for k in range(16)], "k int, text string")
    right = [r.lang_pred == f"l{r.k:03}" for r in langid.annotate_language(fresh, model).orderBy("k").collect()]
    assert np.mean(right) > 0.9 and right[15]


# LM scoring


def brute_loss(chosen):
    """Mean loss of a text under the interpolated bigram model of the chosen texts, by exact counts; and the number of words."""
    single, context, pair = Counter(), Counter(), Counter()
    for t in chosen:
        ws = words(t)
        single.update(ws)
        context.update([None, *ws][:-1] if ws else [])
        pair.update(zip([None, *ws], ws, strict=False))
    total = sum(single.values())

    def loss(t):
        ws = words(t)
        out = [-math.log(0.6 * (pair[v, w] / context[v] if context[v] else 0) + 0.4 * (single[w] + 0.1) / (total + 0.1 * lm_score.WORDS))
               for v, w in zip([None, *ws], ws, strict=False)]
        return sum(out) / len(out) if out else 0.0
    return loss, len(single)


def test_scores_equal_brute_force(spark):
    texts = [*ODD, "the dog and the fox", "the fox and the dog"]
    targets = [6, 7, 11, 99, None]
    got = lm_score.score(frame(spark, texts), spark.createDataFrame([(t, 1) for t in targets + [6]], "doc_id long, text int")).orderBy("doc_id").collect()
    (target, _), (background, _) = brute_loss([texts[i] for i in (6, 7, 11)]), brute_loss(texts)
    for t, r in zip(texts, got, strict=True):
        assert r.n_tokens == len(words(t))
        assert math.isclose(r.score, target(t) - background(t), abs_tol=1e-9)
    assert lm_score.score(frame(spark, ODD).limit(0), frame(spark, [])).count() == 0


def test_scores_count_exact_bigrams_of_a_large_vocabulary(spark):
    """More words than WORDS, cut into many chunks and buckets: equal to exact counts."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{k}" for k in np.minimum(rng.zipf(1.2, 500), 10**9)) for _ in range(100)]
    texts += [" ".join(f"u{i}x{k}" for k in range(2500)) for i in range(60)] + ["", None, texts[0], texts[0]]
    ids = [*range(len(texts) - 1), None]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
    targets = spark.createDataFrame([(i,) for i in range(0, 160, 3)] + [(None,)], "doc_id long")
    got = lm_score.score(docs, targets, chunk_tokens=20_000, bucket_tokens=10_000).collect()

    (target, _), (background, n_words) = brute_loss(texts[0:160:3]), brute_loss(texts)
    assert n_words > lm_score.WORDS
    expected = sorted((-1 if i is None else i, len(words(t)), target(t), background(t)) for i, t in zip(ids, texts, strict=True))
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in got)
    assert np.allclose(expected, found, atol=1e-9)
    assert all(math.isclose(r.score, r.target_loss - r.background_loss, abs_tol=1e-9) for r in got)
