"""Vectors with exact integer scores, for the searches (operators 6, 11)."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns that hold the rows of a group, as bytes.
ROWS = "keys binary, ids binary, has_id binary, labels array<string>, x binary"


@dataclass
class Rows:
    """Rows in tree order (or a block of anchors): keys tell them apart."""
    keys: np.ndarray
    ids: np.ndarray
    has_id: np.ndarray
    labels: list
    x: np.ndarray


def exact_integers(x: np.ndarray, factor: int, bound: int) -> np.ndarray:
    """floor(factor * x): doubles holding integers while products of them
    stay below 2**53 (``bound``), Python's integers beyond."""
    if bound < 2 ** 53:
        return np.floor(x * factor)
    return np.array([[int(c) * factor if abs(c) >= 2 ** 53 else math.floor(c * factor) for c in row] for row in x.tolist()], object).reshape(x.shape)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, as 64-bit or Python integers."""
    if q.dtype != object:
        return (q @ x.T).astype(np.int64)
    return q @ x.T if q.shape[1] else np.zeros((len(q), len(x)), object)


class Best:
    """The k best rows of each anchor and window so far, best first."""

    def __init__(self, shape: tuple[int, int], k: int, none: int, kind: type):
        self.none, self.k = none, k
        self.score = np.full((*shape, k), none, kind)
        self.row = np.full((*shape, k), -1)

    def offer(self, who: np.ndarray, j: int, score: np.ndarray, rows: np.ndarray, tie: np.ndarray) -> None:
        """score: (len(who), len(rows)), ``none`` where a row does not count;
        tie: place of every row among equal scores."""
        s = np.concatenate([self.score[who, j], score], axis=1)
        r = np.concatenate([self.row[who, j], np.broadcast_to(rows, score.shape)], axis=1)
        for by in (np.where(r < 0, len(tie), tie[r]), None):
            order = np.argsort(-s if by is None else by, axis=1, kind="stable")
            s, r = np.take_along_axis(s, order, 1), np.take_along_axis(r, order, 1)
        self.score[who, j], self.row[who, j] = s[:, :self.k], np.where(s == self.none, -1, r)[:, :self.k]


def gathered(t: pa.Table, order: np.ndarray | None = None) -> dict:
    """A group's rows as the binary columns of ROWS."""
    t = t.sort_by("key")
    t = t if order is None else t.take(pa.array(order))
    ids = t.column("vec_id")
    x = np.array(t.column("v").to_pylist(), "<f8").reshape(t.num_rows, -1)
    return {"keys": [t.column("key").to_numpy().astype("<i8").tobytes()], "ids": [ids.fill_null(0).to_numpy().astype("<i8").tobytes()],
            "has_id": [ids.is_valid().to_numpy().astype("u1").tobytes()], "labels": pa.array([t.column("label").to_pylist()], pa.list_(pa.string())), "x": [x.tobytes()]}


def rows_of(r: dict, end: str = "") -> Rows:
    keys = np.frombuffer(r["keys" + end], "<i8")
    return Rows(keys, np.frombuffer(r["ids" + end], "<i8"), np.frombuffer(r["has_id" + end], "u1").astype(bool),
                r["labels" + end], np.frombuffer(r["x" + end], "<f8").reshape(len(keys), -1))


def sound(rows: DataFrame) -> DataFrame:
    """Rows whose vector ``v`` is neither null nor holds a null or
    non-finite component, as doubles; ids as 64-bit numbers."""
    rows = rows.withColumns({"vec_id": F.col("vec_id").cast("long"), "v": F.col("v").cast("array<double>")})
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.where(F.col("v").isNotNull()).where(F.coalesce(finite, F.lit(False)))


class ScoreTexts:
    """Scores of any size as texts that sort like them: ``shift`` makes
    them positive and of one width. ``bound``: the largest there can be."""

    def __init__(self, bound: int):
        self.shift = 10 ** len(str(bound))
        self.wide = len(str(self.shift)) + 1

    def text(self, score: int) -> str:
        return f"{int(score) + self.shift:0{self.wide}d}"

    def number(self, text: str) -> int:
        return int(text) - self.shift


def as_long(score: int) -> int:
    """Cut to 64 bits."""
    return max(-2 ** 63, min(2 ** 63 - 1, int(score)))


def score_bound(dim: int | None, peak: float | None, factor: int) -> int:
    """No score of integer vectors of ``dim`` components up to ``peak`` is above."""
    top = int(peak or 0) * factor + factor
    return max(1, dim or 0) * top * top
