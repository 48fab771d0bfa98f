"""Cutting a text where byte-level pre-tokenization always cuts, and encoding many pieces in one call."""

from __future__ import annotations

import re
from itertools import accumulate

import numpy as np
from tokenizers import Tokenizer

#: The code points of Unicode's White_Space, as a character class.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters whose class and lower case all libraries agree on, and ASCII's punctuation.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017e"
MARKS = r"!-/:-@\[-`{-~"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

#: The pattern of byte-level BPE with its classes of visible characters joined. Its matches are whole runs of
#: pre-tokens: no pre-token reaches over the end of one, and each can be encoded without its neighbours.
chunks_of = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall

#: The pattern of byte-level BPE over plain characters only. It skips any other, so a text that its matches cover is plain,
#: and they are the pre-tokens.
_plain = re.compile(f"{CONTRACTIONS}| ?[{LETTERS}]+| ?[0-9]+| ?[{MARKS}]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+").findall


def plain_words(text: str) -> list[str] | None:
    """The pre-tokens of a plain text, None for any other."""
    words = _plain(text)
    return words if sum(map(len, words)) == len(text) else None


PIECES_AT_ONCE = 20_000


def encode_joined(tokenizer: Tokenizer, pieces: list[str], separator: str, step: int) -> list[list[int]]:
    """The ids of each piece. The pieces are encoded as one text; the tokenizer must take each for one word and the separator
    for ``step`` - 1 words."""
    out: list[list[int]] = []
    for k in range(0, len(pieces), PIECES_AT_ONCE):
        some = pieces[k : k + PIECES_AT_ONCE]
        found = tokenizer.encode(separator.join(some), add_special_tokens=False)
        ids, counts = found.ids, np.bincount(np.array(found.word_ids, np.int64), minlength=1)
        if len(counts) != step * (len(some) - 1) + 1 or not counts.all():
            raise ValueError("a piece is not one word")
        ends = list(accumulate(counts.tolist(), initial=0))
        out += [ids[ends[i] : ends[i + 1]] for i in range(0, len(counts), step)]
    return out
