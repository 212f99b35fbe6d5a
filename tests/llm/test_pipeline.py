"""The pipeline stage by stage against plain versions of its operators, on whole documents."""

import math
from collections import Counter

import numpy as np

from tests.llm.test_rows import brute_counts, brute_hits
from tests.llm.test_tables import brute_classes
from tickerlake.llm import langid, quality
from tickerlake.llm.tokens import loaded

SF = "/root/testdata/sf0.001"


def plain_kept():
    """Text -> kept by the quality rules, from the public tokenisers' own output."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    bpe.encode_special_tokens = True
    spelled = {i: token for token, i in loaded(None).ranks.items()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    single = {pieces.id_to_piece(i) for i in range(pieces.get_piece_size())} | set(quality.BLANKS)

    def kept(text):
        n, chars, _, _, repeats = brute_counts(text)
        if n < 20 or 100 * repeats > 30 * n:
            return False
        tokens = [spelled[i] for i in bpe.encode(text, add_special_tokens=False).ids]
        tokens = [t for t in tokens if t.strip()]
        band = quality.BANDS[quality.script_of(text)]
        short = min(1.0, (50 / n) ** 4)
        symbols = sum(not any(b >= 128 or chr(b).isalnum() for b in t) for t in tokens) / len(tokens)
        entropy = -sum(c / len(tokens) * math.log2(c / len(tokens)) for c in Counter(tokens).values())
        fallback = sum(c not in single for c in text) / chars
        return (band.least_chars <= chars / len(tokens) <= band.most_chars and fallback <= band.most_fallback
                and symbols <= band.most_symbols + 0.05 * short and entropy >= band.least_entropy - 0.8 * short)
    return kept


def plain_language(model):
    """Text -> (label, score): windows read one after another by the two layers, letters pooled."""

    def judged(text):
        data, total, n = text.encode(), np.zeros(len(model.labels)), 0
        for at in range(0, len(data), langid.WINDOW):
            x = np.frombuffer(data[at:at + langid.WINDOW], np.uint8)[:, None]
            f, _ = langid._run(model.forward, x, range(len(x)))
            b, _ = langid._run(model.backward, x, range(len(x) - 1, -1, -1))
            p = langid._softmax(np.concatenate([f, b], axis=2) @ model.out + model.bias)[:, 0]
            on = langid._LETTER[x[:, 0]]
            total, n = total + p[on].sum(0), n + on.sum()
        return total.max() / max(1, n)
    return judged


def test_stages_and_run_equal_plain_versions(spark):
    import corpus_pipeline

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs = source
    expected = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: r[0])
    stages = dict(corpus_pipeline.STAGES)

    def ran(name, frame):
        rows = stages[name](spark, frame, SF).collect()
        assert {r.doc_id for r in rows} == {i for i, _ in expected} and len(rows) == len(expected), name
        assert sorted((r.doc_id, r.text) for r in rows) == sorted(expected)  # texts and columns pass through
        return spark.createDataFrame(rows, source.schema)

    good = plain_kept()
    expected = [(i, t) for i, t in expected if t and good(t)]
    docs = ran("quality_rules", docs)

    score = plain_language(langid.fit(docs.where(~langid.held_out(docs.doc_id)).select("doc_id", "text", "lang")))
    expected = [(i, t) for i, t in expected if any(map(str.isalpha, t)) and score(t) >= corpus_pipeline.LEAST_SCORE]
    docs = ran("language_id", docs)

    classes = brute_classes([t for _, t in expected])
    expected = [row for k, row in enumerate(expected) if classes[k][0] == k]
    docs = ran("ngram_join", docs)

    expected = [(i, t) for i, t in expected if not brute_hits(t, items)[1]]
    docs = ran("benchmark_decontamination", docs)
    assert 100 < len(expected) < 200

    pieces = stages["pack_sequences"](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in expected}
    whole = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in whole} == {i for i, _ in expected}
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32) for p in whole)
    by_doc = {i: sum(p.length for p in whole if p.doc_id == i) for i, _ in expected}
    assert all(p.doc_tokens == by_doc[p.doc_id] for p in whole)
