"""Token ids packed for training and written as binary rows (operator 1).

Best-fit-decreasing: pieces go, longest first, into the open sequence
with the least room that still holds them; a segment tree over room
sizes finds it. Documents longer than a sequence are cut without loss.
Every output row is one sequence of the id matrix, padded to ``limit``,
with the cumulative segment lengths and the positions that start again
at each segment.

Defined results: a null or empty text is the closing id alone; repeated
rows are packed each for itself; ties go to the smaller doc_id and
piece; extra columns are ignored; an empty table gives no sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .best_two_fit import PackParams, shards_for
from .common import exact_ids, keep, with_text_ids
from .tokens import coder, cut_pieces

SEQUENCES = ("sequence_id long, n_ids int, ids binary, cu_lengths array<int>, positions binary, "
             "doc_ids array<long>, pieces array<int>")


@dataclass(frozen=True)
class OutputParams(PackParams):
    pad_id: int = 0
    id_type: str = "<u2"          # little-endian; wide enough for the vocabulary
    pieces_per_shard: int = 4096


class RoomTree:
    """How many open sequences have each room size; a tree of counts
    answers "smallest room of at least n" in log(limit) steps."""

    def __init__(self, limit: int):
        self.size = 1 << limit.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, by: int) -> None:
        k = self.size + room
        while k:
            self.count[k] += by
            k >>= 1

    def smallest(self, room: int) -> int | None:
        k = self.size + room
        if self.count[k]:
            return room
        while k > 1 and not (k & 1 == 0 and self.count[k + 1]):
            k >>= 1
        if k <= 1:
            return None
        k += 1
        while k < self.size:
            k = 2 * k if self.count[2 * k] else 2 * k + 1
        return k - self.size


def best_fit_decreasing(lengths: list[int], limit: int) -> list[list[int]]:
    """Bins of positions in ``lengths`` (each 1..limit), longest first."""
    tree, by_room, bins = RoomTree(limit), [[] for _ in range(limit + 1)], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        room = tree.smallest(n)
        if room is None:
            b, room = len(bins), limit
            bins.append([])
        else:
            b = by_room[room].pop()
            tree.add(room, -1)
        bins[b].append(i)
        if room > n:
            by_room[room - n].append(b)
            tree.add(room - n, 1)
    return bins


def id_pieces(docs: DataFrame, params: OutputParams, id_col: str, text_col: str) -> DataFrame:
    kind, columns = np.dtype(params.id_type), ["doc_id", "piece", "length", "ids"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = coder(params.ranks)
        for pdf in batches:
            rows, held = [], 0
            for doc, text in zip(exact_ids(pdf["doc_id"]), pdf["text"]):
                ids = enc.ids(text)
                ids.append(params.closing_id)
                ids = np.frombuffer(ids, dtype="<u4")
                if int(ids.max()) > np.iinfo(kind).max:
                    raise ValueError(f"an id does not fit {kind}")
                ids = ids.astype(kind)
                for k, (start, n) in enumerate(cut_pieces(len(ids), params.limit)):
                    rows.append((doc, k, n, ids[start:start + n].tobytes()))
                held += len(ids)
                if held > 4_000_000:
                    yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    return with_text_ids(keep(docs, doc_id=id_col, text=text_col)).mapInPandas(run, "doc_id long, piece int, length int, ids binary")


def packed_sequences(docs: DataFrame, params: OutputParams = OutputParams(),
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sequence; see SEQUENCES."""
    limit, kind = params.limit, np.dtype(params.id_type)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(doc_id=exact_ids(pdf["doc_id"])).sort_values(["doc_id", "piece", "ids"], kind="stable").reset_index(drop=True)
        lengths, ids = pdf["length"].tolist(), pdf["ids"].tolist()
        docs_, pieces = pdf["doc_id"].astype(object).where(pdf["doc_id"].notna(), None).tolist(), pdf["piece"].tolist()
        rows = []
        for b, held in enumerate(best_fit_decreasing(lengths, limit)):
            sizes = [lengths[i] for i in held]
            n = sum(sizes)
            row = np.full(limit, params.pad_id, dtype=kind)
            row[:n] = np.frombuffer(b"".join([ids[i] for i in held]), dtype=kind)
            place = np.concatenate([np.arange(s, dtype="<u4") for s in (*sizes, limit - n)])
            rows.append(((int(key[0]) << 32) | b, n, row.tobytes(), np.cumsum([0, *sizes], dtype=np.int32),
                         place.tobytes(), [None if docs_[i] is None else int(docs_[i]) for i in held],
                         [pieces[i] for i in held]))
        return pd.DataFrame(rows, columns=["sequence_id", "n_ids", "ids", "cu_lengths", "positions", "doc_ids", "pieces"])

    shards = shards_for(docs, text_col, params)
    return (with_text_ids(id_pieces(docs, params, id_col, text_col)
                          .withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids"), F.lit(shards)).cast("int")))
            .groupBy("shard").applyInPandas(run, SEQUENCES))


def write_sequences(sequences: DataFrame, path: str) -> None:
    """The id matrices as Parquet, one row per sequence."""
    sequences.write.mode("overwrite").parquet(path)
