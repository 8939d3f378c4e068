"""Token counts by count-only Viterbi over a unigram vocabulary (operator 2).

An Aho-Corasick automaton finds every vocabulary piece in a word; going
through its matches by end position, dynamic programming keeps for each
position the best score and the pieces on the path there - no path is
stored. The tie rules are those of the ``tokenizers`` library's unigram
model: a later candidate replaces an earlier one only if its score is
strictly higher, candidates come by rising start and length, a character
that no single piece covers costs ``min_score - 10``, runs of such
characters count as one unknown piece or, with byte fallback, as one
piece for each of their bytes.

Words are made as the library's Metaspace step makes them (every space
becomes the mark, which starts a word), so they are independent and a
bounded memo holds the counts of words met before.

Defined results: null and empty texts have no pieces and score 0; texts
are read whole; repeated rows are counted each for itself; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

from .common import exact_ids, keep, with_text_ids

MARK = "▁"


@dataclass(frozen=True)
class UnigramParams:
    model: str | None = None      # sentencepiece file whose pieces and scores are the vocabulary
    memo: int = 400_000           # words whose counts are kept


@lru_cache(maxsize=2)
def vocabulary(model: str | None = None) -> tuple[list[tuple[str, float]], int]:
    """((piece, score) by id, id of the unknown piece) of a sentencepiece file."""
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model or public_tokenizers.path("piece_bpe_32k.model"))
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())], sp.unk_id()


class Counter:
    """Counts pieces of words. ``vocab``: (piece, score) by id."""

    def __init__(self, vocab: list[tuple[str, float]], memo: int = 400_000):
        import ahocorasick
        auto, singles = ahocorasick.Automaton(), set()
        for piece, score in dict(vocab).items():
            if piece:
                auto.add_word(piece, (len(piece), score))
                if len(piece) == 1:
                    singles.add(piece)
        auto.make_automaton()
        known = {p for p, _ in vocab}
        self._auto, self._singles, self._memo_size = auto, singles, memo
        self._unknown = min(s for _, s in vocab) - 10.0
        self._bytes = all(f"<0x{b:02X}>" in known for b in range(256))
        self._memo: dict[str, tuple[int, float]] = {}

    def word(self, w: str) -> tuple[int, float]:
        """(pieces, score) of one word."""
        n = len(w)
        by_start: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, (length, score) in self._auto.iter(w):
            by_start[end + 1 - length].append((end + 1, score))
        best: list[float | None] = [None] * (n + 1)
        pieces, open_ = [0] * (n + 1), [False] * (n + 1)     # open_: the path ends in a run of unknown characters
        best[0] = 0.0
        for at in range(n):
            here = best[at]
            if here is None:
                continue
            for end, score in by_start[at]:
                if best[end] is None or here + score > best[end]:
                    best[end], pieces[end], open_[end] = here + score, pieces[at] + 1, False
            if w[at] not in self._singles:
                score = here + self._unknown
                if best[at + 1] is None or score > best[at + 1]:
                    more = len(w[at].encode("utf-8", "surrogatepass")) if self._bytes else 0 if open_[at] else 1
                    best[at + 1], pieces[at + 1], open_[at + 1] = score, pieces[at] + more, True
        return pieces[n], best[n]

    def count(self, text: str | None) -> tuple[int, float]:
        if not isinstance(text, str) or not text:
            return 0, 0.0
        words = text.replace(MARK, " ").split(" ")
        if words[0] == "":
            words = words[1:]           # the text starts with its own mark
        memo, total, score = self._memo, 0, 0.0
        for w in words:
            got = memo.get(w)
            if got is None:
                if len(memo) >= self._memo_size:
                    memo.clear()
                got = self.word(MARK + w)
                if len(w) <= 64:
                    memo[w] = got
            total += got[0]
            score += got[1]
        return total, score


@lru_cache(maxsize=2)
def counter(params: UnigramParams) -> Counter:
    """One per Python worker."""
    return Counter(vocabulary(params.model)[0], params.memo)


def count_tokens(docs: DataFrame, params: UnigramParams = UnigramParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the best path's score for every row; no shuffle."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(params)
        for pdf in batches:
            got = [c.count(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": exact_ids(pdf["doc_id"]), "n_tokens": [g[0] for g in got], "score": [g[1] for g in got]},
                               columns=["doc_id", "n_tokens", "score"])

    return with_text_ids(keep(docs, doc_id=id_col, text=text_col)).mapInPandas(run, "doc_id long, n_tokens long, score double")
