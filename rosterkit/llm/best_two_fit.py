"""Best-two-fit sequence packing (operator 3).

A bin is filled greedily with the longest pieces that fit. Then the
smallest piece in it is taken out when two unpacked pieces fill the gap
so widened more tightly. Pieces are dealt over shards of bounded size by
a hash of their identity, so that no task sees the whole corpus and a
hot source spreads like any other; each shard is packed alone.

Defined results: a null or empty text is the closing id alone; longer
documents than ``limit`` are cut without loss; repeated rows are packed
each for itself; ties between equal lengths fall to the smaller id;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exact_ids, keep, shard_count, with_text_ids
from .tokens import coder, cut_pieces

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


@dataclass(frozen=True)
class PackParams:
    limit: int = 2048
    closing_id: int = 0
    ranks: str | None = None              # path of a rank file; None: the public 50k vocabulary
    pieces_per_shard: int = 8192


def tokenized_pieces(docs: DataFrame, params: PackParams = PackParams(),
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's pieces with their checksum; the ids stay in the task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = coder(params.ranks)
        for pdf in batches:
            rows = []
            for doc, text in zip(exact_ids(pdf["doc_id"]), pdf["text"]):
                ids = enc.ids(text)
                ids.append(params.closing_id)
                raw = ids.tobytes()
                for k, (start, n) in enumerate(cut_pieces(len(ids), params.limit)):
                    rows.append((doc, k, start, n, zlib.crc32(raw[4 * start:4 * (start + n)])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return with_text_ids(keep(docs, doc_id=id_col, text=text_col)).mapInPandas(run, PIECES)


def pack_lengths(lengths: list[int], limit: int) -> list[list[int]]:
    """Best-two-fit over one shard: bins of positions in ``lengths``."""
    stock: list[list[int]] = [[] for _ in range(limit + 1)]
    for i in range(len(lengths) - 1, -1, -1):
        stock[lengths[i]].append(i)
    open_ = sum(1 << n for n in range(1, limit + 1) if stock[n])     # bit n: pieces of length n are left

    def take(n: int) -> int:
        nonlocal open_
        i = stock[n].pop()
        if not stock[n]:
            open_ ^= 1 << n
        return i

    def longest(room: int) -> int:
        return (open_ & ((1 << (room + 1)) - 1)).bit_length() - 1

    bins = []
    while open_:
        held, gap = [], limit
        while gap and (n := longest(gap)) > 0:
            held.append(take(n))
            gap -= n
        if gap and len(held) > 1 and open_:
            out = lengths[held[-1]]                                  # filled longest first: the last is the smallest
            wide, best, pair = gap + out, out, None
            a = longest(wide - 1)
            while a > 0 and 2 * a > best:
                b = longest(min(a, wide - a))
                if b == a and len(stock[a]) < 2:
                    b = longest(a - 1)
                if b > 0 and a + b > best:
                    best, pair = a + b, (a, b)
                    if best == wide:
                        break
                a = longest(a - 1)
            if pair:
                back = held.pop()
                held += [take(pair[0]), take(pair[1])]
                if not stock[out]:
                    open_ |= 1 << out
                stock[out].append(back)
                gap = wide - best
        bins.append(held)
    return bins


def shards_for(docs: DataFrame, text_col: str, params: PackParams) -> int:
    """From the table's rows and bytes (a byte-level id covers at least one byte)."""
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(f"`{text_col}`"))), F.lit(0))).first()
    return shard_count(n + size // params.limit, params.pieces_per_shard)


def pack_pieces(pieces: DataFrame, n_shards: int, limit: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows of PIECES."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(doc_id=exact_ids(pdf["doc_id"])).sort_values(["doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].tolist()
        order, seq, offset = [], [], []
        for b, held in enumerate(pack_lengths(lengths, limit)):
            at = 0
            for i in held:
                order.append(i)
                seq.append((int(key[0]) << 32) | b)
                offset.append(at)
                at += lengths[i]
        out = pdf.iloc[order].drop(columns="shard")
        return out.assign(sequence_id=seq, offset=offset)

    return (with_text_ids(pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_shards)).cast("int")))
            .groupBy("shard").applyInPandas(run, PACKED))


def best_two_fit(docs: DataFrame, params: PackParams = PackParams(),
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pack_pieces(tokenized_pieces(docs, params, id_col, text_col),
                       shards_for(docs, text_col, params), params.limit)
