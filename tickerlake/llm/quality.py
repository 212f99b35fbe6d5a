"""Quality rules from tokeniser fertility.

Base counts look at words, symbols, repeated lines and repeated 8-word
windows.  The method measures how public vocabularies cut the words of a text:

* characters per token of a byte-level BPE vocabulary,
* the share of characters that a second vocabulary can only spell as bytes
  (a character falls back exactly when no piece consists of it),
* the entropy of the token distribution in bits,
* the share of tokens without any letter or digit.

Each measure has a band of accepted values for the dominant script of the
text; a text outside one is rejected.  Texts of up to ``SHORT_WORDS`` words
vary more and get wider bands, an allowance that fades out beyond that length.

Defined results: a null, empty or blank text has no words, all counts of words
0, its measures null, and fails the base rule; ties do not arise; repeated rows
are judged alike; very long texts are measured whole; an empty table stays
empty.  Columns of the input pass through ``annotate_quality`` unless they have
the name of a result column.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import annotate
from tickerlake.llm.tokens import loaded

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
SHORT_WORDS = 50
SHORT_SYMBOLS = 0.05
SHORT_ENTROPY = 0.8


class Band(NamedTuple):
    """Accepted values for one script."""

    least_chars: float  # characters per token
    most_chars: float
    most_fallback: float  # share of characters spelled as bytes
    most_symbols: float  # share of tokens without letter or digit
    least_entropy: float  # bits


# Script by code point range; letters outside all ranges count as "other".
SCRIPTS: list[tuple[str, int, int]] = [
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F), ("indic", 0x900, 0xDFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]

BANDS: dict[str, Band] = {
    "latin": Band(1.2, 8.0, 0.10, 0.20, 5.0),
    "greek": Band(0.5, 4.0, 0.10, 0.20, 5.0),
    "cyrillic": Band(0.5, 5.0, 0.10, 0.20, 5.0),
    "hebrew": Band(0.3, 4.0, 0.50, 0.20, 4.5),
    "arabic": Band(0.3, 4.0, 0.50, 0.20, 4.5),
    "indic": Band(0.15, 3.0, 1.0, 0.20, 4.0),
    "kana": Band(0.25, 3.0, 0.80, 0.25, 4.5),
    "han": Band(0.25, 3.0, 0.90, 0.25, 4.5),
    "hangul": Band(0.2, 3.0, 1.0, 0.20, 4.0),
    "other": Band(0.1, 8.0, 1.0, 0.25, 4.0),
}


def script_of(text: str) -> str:
    """The script with most characters of the text among SCRIPTS."""
    if text.isascii():
        return "latin"
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    high = codes[codes >= 0x250]
    if not len(high):
        return "latin"
    counts = {name: int(((codes >= low) & (codes <= top)).sum()) for name, low, top in SCRIPTS}
    counts["other"] = int(((high > 0x52F) & (high < 0x2000)).sum()) + int((high > 0xFFFF).sum()) - sum(
        counts[n] for n in ("hebrew", "arabic", "indic"))
    best = max(counts, key=lambda n: (counts[n], n))
    return best if counts[best] else "other"


def repeat_words(words: list, window: int = WINDOW) -> int:
    """Words that lie in windows found twice or more in the text, the first occurrence included.

    Exact: windows get dense ranks by doubling (pairs of words, pairs of pairs, ...).
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    whole = np.zeros(n, np.uint64)
    for i in range(window):  # equal windows have equal sums; without equal sums nothing repeats
        whole = whole * np.uint64(0x9E3779B97F4A7C15) + hashed[i:i + n]
    whole.sort()
    if (whole[1:] != whole[:-1]).all():
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    rank = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    width = 1
    while width < window:
        step = min(width, window - width)
        pair = rank[:len(rank) - step] * np.int64(len(words) + 1) + rank[step:]
        _, rank, count = np.unique(pair, return_inverse=True, return_counts=True)
        if count.max() < 2:
            return 0
        width += step
    starts = np.flatnonzero(count[rank] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str | None) -> tuple[list[bytes], int, int, int, int]:
    """(words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return words, chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


class Measures(NamedTuple):
    chars_per_token: float
    byte_fallback_share: float
    symbol_token_share: float
    token_entropy: float


class Fertility:
    """Token measures of texts under two public vocabularies."""

    def __init__(self, ranks_path: str | None = None, piece_path: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.bpe = loaded(ranks_path)
        self.is_symbol, self.is_blank = np.zeros((2, self.bpe.size), bool)
        for token, i in self.bpe.ranks.items():
            self.is_symbol[i] = not any(b >= 128 or chr(b).isalnum() for b in token)
            self.is_blank[i] = not token.strip()
        pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path or public_tokenizers.path("piece_bpe_32k.model"))
        self.known = {p for p in map(pieces.id_to_piece, range(pieces.get_piece_size())) if len(p) == 1} | set(BLANKS)

    def measure(self, text: str, word_chars: int) -> Measures:
        ids = np.frombuffer(self.bpe(text), "<u2")
        ids = ids[~self.is_blank[ids]]
        counts = np.bincount(ids) if len(ids) > 20_000 else np.diff(np.flatnonzero(np.diff(np.sort(ids), prepend=-1, append=1 << 20)))
        counts = counts[counts > 0]
        share = counts / len(ids)
        unknown = sum(text.count(c) for c in set(text) - self.known)
        return Measures(word_chars / len(ids), unknown / word_chars, float(self.is_symbol[ids].mean()),
                        float(-(share * np.log2(share)).sum()) + 0.0)


def accepted(script: str, n_words: int, m: Measures, bands: dict[str, Band]) -> bool:
    band = bands[script]
    short = min(1.0, (SHORT_WORDS / max(1, n_words)) ** 4)  # fades out beyond SHORT_WORDS words
    return (band.least_chars <= m.chars_per_token <= band.most_chars
            and m.byte_fallback_share <= band.most_fallback
            and m.symbol_token_share <= band.most_symbols + SHORT_SYMBOLS * short
            and m.token_entropy >= band.least_entropy - SHORT_ENTROPY * short)


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
          "script string, chars_per_token double, byte_fallback_share double, symbol_token_share double, token_entropy double")

_FERTILITY: dict = {}


def judge(text: str | None, fertility: Fertility, bands: dict[str, Band]) -> tuple:
    """One RESULT row."""
    words, chars, symbols, dup_lines, repeats = base_counts(text)
    n = len(words)
    failed = n < LEAST_WORDS or 100 * repeats > REPEAT_PERCENT * n
    if not n:
        return 0, 0, symbols, dup_lines, 0, True, False, None, None, None, None, None
    script = script_of(text)
    measures = fertility.measure(text, chars)
    return n, chars, symbols, dup_lines, repeats, failed, not failed and accepted(script, n, measures, bands), script, *measures


def annotate_quality(documents: DataFrame, ranks_path: str | None = None, piece_path: str | None = None,
                     bands: dict[str, Band] | None = None) -> DataFrame:
    """The rows with the RESULT columns appended."""
    bands = bands or BANDS

    def make():
        key = ranks_path, piece_path
        if key not in _FERTILITY:
            _FERTILITY[key] = Fertility(*key)
        fertility = _FERTILITY[key]
        return lambda rows: (judge(text, fertility, bands) for (text,) in rows)

    return annotate(documents, make, ["text"], RESULT)


def kept_documents(documents: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    judged = annotate_quality(documents.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("own")))
    return judged.where("kept").select("own.*")
