"""Exact top-k inner-product search by ball trees (operator 6).

Vectors become integers, floor(factor * x), so scores are exact and ties
are real. Rows are dealt by a hash over shards of bounded size; each
shard becomes a ball tree (one binary row): every node has a centre and
the distance of its farthest row, and is split at the median along the
direction between two far rows until a leaf is small enough. Queries are
gathered into blocks of bounded size, and every block meets every shard.

Branch and bound: of the nodes not yet entered the one with the highest
bound is next. q . centre + |q| radius bounds all scores below a node, so
it is left out for each query whose k-th best score so far it can't reach,
and entered for the others together. The k-th score is shared: a block
goes through ``chain`` shards one after the other and takes it along.

Defined results: vectors that are null or hold null or non-finite
components take no part; every other row is a candidate, whatever its id
(a null id comes last among equal scores, and asks nothing) and however
often its id is repeated, but a query never meets its own row; queries
only meet vectors of their own length; fewer candidates than k give all;
ties go to the smaller id; vectors of any size are scored with exact
integers, and only the returned score is cut to 64 bits; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, materialize, shard_count
from .vectors import ROWS, Best, Rows, ScoreTexts, as_long, exact_integers, gathered, rows_of, score_bound, scores, sound


@dataclass(frozen=True)
class SearchParams:
    k: int = 20
    factor: int = 64
    query_every: int = 20         # queries: ids divisible by this
    shard_values: int = 1 << 19   # numbers in a tree
    block_values: int = 1 << 16   # numbers in a block of queries
    leaf_rows: int = 128
    chain: int = 8                # shards that a block goes through in one task


# ------------------------------------------------------------------ the tree

@dataclass
class BallTree:
    """Nodes by level. Node i covers rows lo[i]:hi[i]; its two children, if
    any, are nodes kids[i] and kids[i] + 1 (0: a leaf)."""
    centre: np.ndarray
    radius: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    kids: np.ndarray

    @classmethod
    def build(cls, x: np.ndarray, leaf: int) -> tuple[BallTree, np.ndarray]:
        """The tree, and the order of rows that it is over."""
        order, nodes, todo = np.empty(len(x), np.int64), [], [(0, np.arange(len(x)))]
        while todo:
            below, nth = [], len(nodes) + len(todo)
            for lo, rows in todo:
                part = x[rows]
                centre = part.mean(axis=0)
                apart = np.sqrt(((part - centre) ** 2).sum(axis=1))
                radius, kids = apart.max(), 0
                if len(rows) <= leaf or not np.isfinite(radius) or radius == 0:
                    order[lo:lo + len(rows)] = rows
                else:
                    kids, half, far = nth + len(below), len(rows) // 2, part[np.argmax(apart)]
                    other = part[np.argmax(((part - far) ** 2).sum(axis=1))]
                    along = np.argsort((part - far) @ (other - far), kind="stable")
                    below += [(lo, rows[along[:half]]), (lo + half, rows[along[half:]])]
                nodes.append((centre, radius, lo, lo + len(rows), kids))
            todo = below
        return cls(*(np.array(c) for c in zip(*nodes))), order

    def bounds(self, q: np.ndarray, length: np.ndarray, nodes: slice) -> np.ndarray:
        """No q . x below a node is above; a little slack for rounding."""
        top = q @ self.centre[nodes].T
        off = length[:, None] * self.radius[nodes][None, :]
        return top + off + 0.5 + 1e-9 * (np.abs(top) + off)


def search(tree: BallTree, rows: Rows, queries: Rows, floor: np.ndarray, k: int, factor: int, bound: int) -> Best:
    """The k best rows of the tree for each query, among those that reach ``floor``."""
    x, q = exact_integers(rows.x, factor, bound), exact_integers(queries.x, factor, bound)
    tie = np.empty(len(x), np.int64)
    tie[np.lexsort((rows.keys, rows.ids, ~rows.has_id))] = np.arange(len(x))
    none = -(2 * bound + 2) if q.dtype == object else -(2 ** 62)
    best = Best((len(q), 1), k, none, object if q.dtype == object else np.int64)
    blind = bound >= 10 ** 200                                       # bounds would leave the range of doubles
    qf = None if blind else q.astype(float)
    length = None if blind else np.sqrt((qf ** 2).sum(axis=1))
    sure = lambda who: np.maximum(best.score[who, 0, -1], floor[who])
    everyone = np.arange(len(q))
    bounds = lambda nodes, who: np.zeros((len(who), nodes.stop - nodes.start)) if blind else tree.bounds(qf[who], length[who], nodes)
    heap = [(0.0, 0, everyone, bounds(slice(0, 1), everyone)[:, 0])]
    while heap:
        _, node, who, top = heapq.heappop(heap)
        if not blind:
            who = who[top >= sure(who).astype(float)]
        if len(who) == 0:
            continue
        if kids := tree.kids[node]:
            tops = bounds(slice(kids, kids + 2), who)
            for c in (0, 1):
                heapq.heappush(heap, (-float(tops[:, c].max()), int(kids) + c, who, tops[:, c]))
            continue
        lo, hi = tree.lo[node], tree.hi[node]
        s = scores(q[who], x[lo:hi])
        ok = (s >= sure(who)[:, None]) & (rows.keys[None, lo:hi] != queries.keys[who][:, None])
        hit = np.flatnonzero(ok.any(axis=1))
        if len(hit):
            best.offer(who[hit], 0, np.where(ok[hit], s[hit], none), np.arange(lo, hi), tie)
    return best


# ------------------------------------------------------------------ on Spark

_TREE = "centre binary, radius binary, lo binary, hi binary, kids binary"


def _tree(r: dict, dim: int) -> BallTree:
    ints = lambda c: np.frombuffer(r[c], "<i4")
    radius = np.frombuffer(r["radius"], "<f8")
    return BallTree(np.frombuffer(r["centre"], "<f8").reshape(len(radius), dim), radius, ints("lo"), ints("hi"), ints("kids"))


def top_k(vectors: DataFrame, params: SearchParams = SearchParams(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for every query row."""
    k = params.k
    rows = sound(keep(vectors, vec_id=id_col, v=vector_col)).withColumn("label", F.lit(None).cast("string"))
    rows = materialize(rows.withColumns({"key": F.monotonically_increasing_id(), "dim": F.size("v")}), "topk-rows")
    asks = (F.col("vec_id") % params.query_every) == 0
    values, asked, dim, peak = rows.agg(F.sum(F.col("dim") + 1), F.sum(F.when(asks, F.col("dim") + 1)), F.max("dim"),
                                        F.max(F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)))).first()
    shards, blocks = shard_count(values or 0, params.shard_values), shard_count(asked or 0, params.block_values)
    bound = score_bound(dim, peak, params.factor)
    texts = ScoreTexts(bound)
    dealt = lambda name, parts: F.pmod(F.xxhash64("key", F.lit(name)), F.lit(parts)).cast("int").alias(name)

    def grow(t: pa.Table) -> pa.Table:
        x = np.array(t.sort_by("key").column("v").to_pylist(), float).reshape(t.num_rows, -1)
        with np.errstate(over="ignore", invalid="ignore"):
            tree, order = BallTree.build(np.floor(x * params.factor), params.leaf_rows)
        ints = {c: [getattr(tree, c).astype("<i4").tobytes()] for c in ("lo", "hi", "kids")}
        return pa.table({"dim": t.column("dim").slice(0, 1), "shard": t.column("shard").slice(0, 1), **gathered(t, order),
                         "centre": [tree.centre.astype("<f8").tobytes()], "radius": [tree.radius.astype("<f8").tobytes()], **ints})

    def gather(t: pa.Table) -> pa.Table:
        return pa.table({"dim": t.column("dim").slice(0, 1), "block": t.column("block").slice(0, 1), **gathered(t)})

    trees = materialize(rows.select("*", dealt("shard", shards)).groupBy("dim", "shard").applyInArrow(grow, f"dim int, shard int, {ROWS}, {_TREE}"), "topk-trees")
    queries = materialize(rows.where(asks).select("*", dealt("block", blocks)).groupBy("dim", "block").applyInArrow(gather, f"dim int, block int, {ROWS}"), "topk-queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = object if bound >= 2 ** 53 else np.int64
        at, known = None, None                                       # the block at hand, its k best scores so far
        for batch in batches:
            for i in range(batch.num_rows):
                [r] = batch.slice(i, 1).to_pylist()
                asking, found = rows_of(r, "_q"), rows_of(r)
                if at != (r["dim"], r["block"], r["link"]):
                    at, known = (r["dim"], r["block"], r["link"]), np.full((len(asking.keys), k), -(2 * bound + 2) if kind is object else -(2 ** 62), kind)
                best = search(_tree(r, asking.x.shape[1]), found, asking, known[:, -1], k, params.factor, bound)
                known = -np.sort(-np.concatenate([known, best.score[:, 0]], axis=1), axis=1)[:, :k]
                q, _, m = np.nonzero(best.row >= 0)
                hit, s = best.row[q, 0, m], best.score[q, 0, m].tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(asking.keys[q]), pa.array(asking.ids[q]), pa.array(found.keys[hit]), pa.array(found.ids[hit], mask=~found.has_id[hit]),
                    pa.array([texts.text(v) for v in s], pa.string()), pa.array([as_long(v) for v in s], pa.int64())],
                    names=["query", "query_id", "other", "vec_id", "place", "score"])

    named = [F.col(c).alias(f"{c}_q") for c in ("keys", "ids", "has_id", "labels", "x")]
    each = queries.select("dim", "block", *named, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    link = (F.col("shard") / params.chain).cast("int")
    pairs = each.join(trees, ["dim", "shard"]).withColumn("link", link)
    pairs = pairs.repartition(blocks * shard_count(shards, params.chain), "dim", "block", "link").sortWithinPartitions("dim", "block", "link", "shard")
    found = pairs.mapInArrow(run, "query long, query_id long, other long, vec_id long, place string, score long")
    order = Window.partitionBy("query").orderBy(F.desc("place"), F.asc_nulls_last("vec_id"), "other")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
