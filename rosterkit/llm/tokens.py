"""Byte-level BPE ids, fast enough for whole corpora.

The ids are those of the ``tokenizers`` file ``byte_bpe_50k.json``; they
are computed from the same vocabulary as ranks (tests compare the two).
Most of the time goes into the pre-tokenizer's look-ahead for runs of
white space. A text whose white space is only lone spaces and line feeds
between other characters has no such run: there the pattern without the
look-ahead finds the same pieces in half the time.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

#: White space other than the space and the line feed.
_ODD = re.compile("[%s]" % "".join(re.escape(chr(c)) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"))


def plain(t: str) -> bool:
    """All white space is lone spaces and line feeds between other characters."""
    return not ("  " in t or "\n\n" in t or " \n" in t or "\n " in t or t[0] in " \n" or t[-1] in " \n" or _ODD.search(t))


#: A run of white space that is long for the pattern's look-ahead, which goes
#: back and forth over it: a stack's frame for each character.
_LONG_RUN = re.compile("[%s]{256,}" % "".join(re.escape(chr(c)) for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F))


class Coder:
    """Texts to ids. ``ranks``: path of a rank file; None is the public 50k vocabulary."""

    def __init__(self, ranks: str | None = None):
        import public_tokenizers
        import tiktoken
        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        whole = public_tokenizers.PATTERN
        make = lambda pat: tiktoken.Encoding("ranks", pat_str=pat, mergeable_ranks=table, special_tokens={})
        self._whole, self._plain = make(whole), make(whole.replace(r"\s+(?!\S)|", ""))

    def ids(self, text: str | None) -> array:
        """Unsigned 32-bit ids; special tokens' strings are ordinary text."""
        if not isinstance(text, str) or not text:
            return array("I")
        if plain(text):
            return array("I", self._plain.encode_ordinary(text))
        # Of a run before a word the last character belongs to the word or is a
        # piece alone, and the rest is one piece; at the end the run is one piece.
        out, at = array("I"), 0
        for m in _LONG_RUN.finditer(text):
            end = m.end() - (m.end() < len(text))
            out.extend(self._whole.encode_ordinary(text[at:m.start()]))
            out.extend(self._plain.encode_ordinary(text[m.start():end]))
            at = end
        out.extend(self._whole.encode_ordinary(text[at:]))
        return out


@lru_cache(maxsize=2)
def coder(ranks: str | None = None) -> Coder:
    """One per Python worker."""
    return Coder(ranks)


def cut_pieces(n_ids: int, limit: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else
    pieces of ``limit`` ids of which only the first may be shorter."""
    first = n_ids if n_ids <= limit else n_ids % limit or limit
    yield 0, first
    for start in range(first, n_ids, limit):
        yield start, limit
