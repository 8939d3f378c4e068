"""Byte-level BPE, both ways, by forced boundaries (operator 13).

A merge always yields a token of the vocabulary. Two neighbouring bytes
that stand side by side inside no token can therefore never end up in
one: between them every text may be cut, and the pieces' ids, found one
by one and put together again, are the ids of the whole. The 256 x 256
table of such pairs is read off the vocabulary. Where a pair is cut must
also leave the pre-tokenizer's matches as they are, so these are kept
together even when no token holds the pair:

* bytes of one character, and the characters of a contraction;
* white space and what follows it (the pattern looks ahead there);
* an apostrophe and what stands before it, unless that is an ASCII letter
  or digit (``$'s`` is one run of signs and a letter, ``'s`` alone is not);
* everything but ASCII white space, in texts with other white space.

Fragments are words, mostly; a worker remembers the ids of short ones, up
to ``remembered`` of them. Nothing is shuffled: a document is coded
where it is read.

Defined results: a null or empty text has no ids and decodes to an empty
text; strings of special tokens in a text are those tokens, as the
tokenizer library has it; texts of any length are coded whole; repeated
rows come out as often as they go in, each row for itself, whatever its
id (null, of any type); extra columns are ignored, unless named in
``also``; an empty table gives an empty result. A tokenizer that is not
plain byte-level BPE raises ValueError.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep

_CONTRACTIONS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_ODD_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WINDOW = 1 << 20        # bytes looked at together


@dataclass(frozen=True)
class CodecParams:
    tokenizer: str | None = None          # path of a tokenizer file; None: the public 50k vocabulary
    remembered: int = 1 << 18             # fragments a worker remembers
    remembered_bytes: int = 48            # the longest of them
    batch_bytes: int = 16 << 20           # output rows are handed on in batches of about this size


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: the
    visible Latin-1 characters stand for themselves, the rest for 256, 257, ..."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def cut_tables(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Flat tables over (left byte, right byte): where to cut, and where to
    cut texts that hold white space other than ASCII's."""
    seen = np.zeros((256, 256), bool)
    for t in {t[i:i + 2] for t in tokens for i in range(len(t) - 1)}:
        seen[t[0], t[1]] = True
    before_space = ~seen & _SPACE[None, :]
    cut = ~seen
    cut[:, 0x80:0xC0] = False                                        # never inside a character
    cut[_SPACE, :] = False
    sign = np.array([not (b < 128 and chr(b).isalnum()) for b in range(256)])
    cut[sign, ord("'")] = False
    for c in _CONTRACTIONS:
        for a, b in zip(c, c[1:]):
            cut[a, b] = False
    return (cut | before_space).ravel(), before_space.ravel()


class Codec(dict):
    """Texts to little-endian unsigned 32-bit ids and back. As a dict it
    maps remembered fragments to their ids."""

    def __init__(self, params: CodecParams):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # Spark's tasks are the parallelism
        import public_tokenizers
        from tokenizers import Tokenizer
        path = params.tokenizer or public_tokenizers.path("byte_bpe_50k.json")
        with open(path, encoding="utf-8") as f:
            plan = json.load(f)
        self.params, self.whole = params, Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        pre, special = plan["pre_tokenizer"] or {}, plan["added_tokens"]
        if (plan["model"]["type"], pre.get("type"), pre.get("use_regex", True), pre.get("add_prefix_space")) != ("BPE", "ByteLevel", True, False) \
                or plan["normalizer"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in special):
            raise ValueError(f"{path} is not plain byte-level BPE")
        letters = byte_letters()
        own = {t["content"]: t["id"] for t in special}
        plain = {i: bytes(letters[c] for c in t) for t, i in plan["model"]["vocab"].items()}
        self.cut, self.cut_odd = cut_tables(list(plain.values()))
        self.bytes_of = plain | {i: t.encode() for t, i in own.items()}
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in own.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(own, key=len, reverse=True))) + ")") if own else None

    def __missing__(self, fragment: bytes) -> bytes:
        ids = array("I", self.whole.encode(fragment.decode(), add_special_tokens=False).ids).tobytes()
        if len(fragment) <= self.params.remembered_bytes:
            if len(self) >= self.params.remembered:
                self.clear()
            self[fragment] = ids
        return ids

    def fragments(self, text: str) -> list[bytes]:
        raw = text.encode()
        table = self.cut_odd if not text.isascii() and _ODD_SPACE.search(text) else self.cut
        b, at = np.frombuffer(raw, np.uint8), [0]
        for lo in range(0, len(b) - 1, _WINDOW):
            pair = (b[lo:lo + _WINDOW + 1].astype(np.uint16) << 8)[:-1] | b[lo + 1:lo + _WINDOW + 1]
            at += (np.flatnonzero(table[pair]) + (lo + 1)).tolist()
        return [raw[i:j] for i, j in zip(at, at[1:] + [len(raw)])]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        parts = self.split.split(text) if self.split else [text]
        return b"".join([self.special[p] if k % 2 else b"".join([self[f] for f in self.fragments(p)]) for k, p in enumerate(parts) if p])

    def decode(self, ids: bytes | None) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids or b"", "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(params: CodecParams) -> Codec:
    """One per Python worker."""
    return Codec(params)


def _mapped(df: DataFrame, source: str, name: str, kind: pa.DataType, params: CodecParams, one: Callable[[Codec], Callable]) -> DataFrame:
    """``df`` with one more column, computed row by row from ``source``."""
    out = T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType() if pa.types.is_binary(kind) else T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = one(codec(params))
        for batch in batches:
            column, done, first, held = batch.column(batch.schema.get_field_index(source)), [], 0, 0
            for k in range(batch.num_rows):
                done.append(work(column[k].as_py()))
                held += len(done[-1])
                if held >= params.batch_bytes or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([*batch.slice(first, len(done)).columns, pa.array(done, kind)], names=[*batch.schema.names, name])
                    done, first, held = [], k + 1, 0

    return df.mapInArrow(run, out)


def encode_documents(docs: DataFrame, params: CodecParams = CodecParams(), id_col: str = "doc_id", text_col: str = "text",
                     also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit ids), n_tokens, and the columns of ``also``."""
    source = keep(docs, doc_id=id_col, text=text_col).select("doc_id", "text") if not also else \
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`") for c in also])
    coded = _mapped(source, "text", "ids", pa.binary(), params, lambda c: c.encode)
    return coded.select("doc_id", "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"), *[F.col(f"`{c}`") for c in also])


def decode_documents(coded: DataFrame, params: CodecParams = CodecParams(), ids_col: str = "ids") -> DataFrame:
    """``coded`` with ``decoded``, the text that its ids stand for (special tokens included)."""
    return _mapped(coded, ids_col, "decoded", pa.string(), params, lambda c: c.decode)
