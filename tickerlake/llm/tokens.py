"""Exact token ids of a public byte-level BPE vocabulary.

``BpeIds`` gives the ids that ``tokenizers`` gives for the same vocabulary: with
``added`` as by default there (the string of an added token is that token),
without it as with ``encode_special_tokens`` (such a string is ordinary text).
Texts whose white space is single
spaces and line breaks, not side by side, are split by a pattern without
look-ahead, which splits such texts alike and is faster; all others by the
vocabulary's own pattern.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array

# Added tokens of byte_bpe_50k.json.
ADDED = {"<|endoftext|>": 50256}
LOOK_AHEAD = r"|\s+(?!\S)"

_ODD = re.compile(r"[^\S\n ]")


def plain(text: str) -> bool:
    """True if white space occurs as single spaces and single line breaks only, never side by side."""
    return not ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or _ODD.search(text))


class BpeIds:
    """Ids as little-endian unsigned 16-bit bytes (the vocabulary has fewer than 65,536 entries)."""

    def __init__(self, ranks_path: str | None = None, added: bool = False):
        import public_tokenizers
        import tiktoken

        path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.added = dict(ADDED) if added else {}
        self.size = max(*self.ranks.values(), *self.added.values()) + 1
        if self.size > 1 << 16:
            raise ValueError("the vocabulary does not fit 16 bits")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        pattern = public_tokenizers.PATTERN
        self.full, self.fast = (
            tiktoken.Encoding(name, pat_str=p, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary
            for name, p in (("full", pattern), ("fast", pattern.replace(LOOK_AHEAD, ""))))

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        ids = array("H")
        for part in self.cut.split(text) if self.added else (text,):
            if part in self.added:
                ids.append(self.added[part])
            else:
                ids.extend((self.fast if plain(part) else self.full)(part))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


_LOADED: dict = {}


def loaded(path: str | None = None, added: bool = False) -> BpeIds:
    """One encoder per Python worker, vocabulary and treatment of added tokens."""
    if (path, added) not in _LOADED:
        _LOADED[path, added] = BpeIds(path, added)
    return _LOADED[path, added]
