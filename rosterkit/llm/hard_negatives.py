"""Hard-negative mining by cover trees (operator 11).

Vectors become integers, floor(factor * x), so scores are exact. An
anchor's positives are the rows of its own label with the highest inner
products; a positive's negatives are the best rows of other labels whose
score lies in the positive's window, ``low_percent`` to ``high_percent`` of
its score. Both are searches of one kind: the k best rows within a window,
of the same or of another label.

Rows are dealt by a hash over shards of bounded size, and each shard
becomes a cover tree over norm-augmented rows: one more coordinate,
sqrt(M^2 - |x|^2), puts all rows at the largest norm M, where a greater
inner product means a smaller distance. A node's children are centres
more than ``shrink`` times its radius apart that cover all its rows within
that distance; a node's radius is the true distance to its farthest row.
In many dimensions most centres cover next to nothing but themselves:
those with few rows share leaves of up to ``leaf_rows`` rows.
Anchors are gathered into blocks of bounded size, every block meets every
shard. The descent takes the node with the highest bound first; q . p plus
and minus |q| times the radius bound the products of all rows below p, so a
node is left out for each anchor whose windows it misses, whose k-th best
it can't reach, or whose label it has (lacks) throughout. What is left is
scored exactly at the leaves.

Defined results: rows with a null label or vector, or a null or non-finite
component take no part; a null id does, behind all others among equal
scores, but is no anchor; repeated ids are rows of their own (an anchor
never meets its own row); rows only meet rows of their own length; fewer
rows than asked for give all; vectors of any size are scored with exact
integers, and only the returned score is cut to 64 bits; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, materialize, shard_count
from .vectors import ROWS, Best, Rows, ScoreTexts, as_long, exact_integers, gathered, rows_of, score_bound, scores, sound


@dataclass(frozen=True)
class NegativeParams:
    factor: int = 256
    anchor_every: int = 100               # anchors: ids divisible by this
    positives: int = 5
    negatives: int = 5
    low_percent: int = 80
    high_percent: int = 100
    shard_values: int = 1 << 18           # numbers in a tree
    block_values: int = 1 << 17           # numbers in a block of anchors
    leaf_rows: int = 64
    shrink: float = 0.8


# ------------------------------------------------------------------ the tree

@dataclass
class CoverTree:
    """Nodes by level. Node i covers rows lo[i]:hi[i]; its children, if any,
    are nodes first[i] to first[i] + count[i]."""
    pivot: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    first: np.ndarray
    count: np.ndarray
    radius: np.ndarray

    @classmethod
    def build(cls, x: np.ndarray, leaf: int, shrink: float) -> tuple[CoverTree, np.ndarray]:
        """The tree, and the order of rows that it is over."""
        norm2 = (x ** 2).sum(axis=1)
        top2 = norm2.max(initial=0.0)
        y = np.column_stack([x, np.sqrt(top2 - norm2)])
        if not np.isfinite(top2):                                    # beyond doubles: one leaf, bounded by nothing
            return cls(*(np.array([v]) for v in (0, 0, len(x), 0, 0, np.inf))), np.arange(len(x))
        apart = lambda rows, c: np.sqrt(np.maximum(0.0, 2 * (top2 - y[rows] @ y[c])))
        every = np.arange(len(x))
        level, at = [(0, 0, every, apart(every, 0))], 0              # pivot, first place, rows, distances
        nodes, order = [], np.empty(len(x), np.int64)
        while level:
            below, nth = [], at + len(level)
            for own, lo, rows, dist in level:
                pivot, radius = own, float(dist.max())
                if len(rows) <= leaf or radius <= 1e-7 * math.sqrt(top2):
                    order[lo:lo + len(rows)] = rows
                    nodes.append((own, lo, lo + len(rows), 0, 0, radius))
                    continue
                near, kids, few = shrink * radius, [], []
                while len(rows):
                    inside = dist <= near
                    inside[rows == pivot] = True
                    one = (pivot, rows[inside], dist[inside])
                    (kids if len(one[1]) > leaf // 2 else few).append(one)
                    rows, dist = rows[~inside], dist[~inside]
                    if len(rows):
                        pivot = rows[0]
                        dist = apart(rows, pivot)
                starts = itertools.accumulate((len(k[1]) for k in few), initial=0)
                for _, group in itertools.groupby(zip(few, starts), lambda k: k[1] // max(1, leaf // 2)):       # at most a leaf's rows
                    group = [k for k, _ in group]
                    held = np.concatenate([k[1] for k in group])
                    kids.append(group[0] if len(group) == 1 else (group[0][0], held, apart(held, group[0][0])))
                first, to = nth + len(below), lo
                for p, r, d in kids:
                    below.append((p, to, r, d))
                    to += len(r)
                nodes.append((own, lo, to, first, len(kids), radius))
            level, at = below, nth
        pivot, lo, hi, first, count, radius = map(np.array, zip(*nodes))
        place = np.empty(len(x), np.int64)
        place[order] = every
        return cls(place[pivot], lo, hi, first, count, radius + 1e-7 * math.sqrt(top2)), order


def search(tree: CoverTree, rows: Rows, anchors: Rows, low: np.ndarray, high: np.ndarray, same: bool, k: int,
           factor: int, bound: int) -> Best:
    """The k best rows for every anchor and window (low to high, both
    included, in the integers of ``scores``), of its own label or others."""
    x, q = exact_integers(rows.x, factor, bound), exact_integers(anchors.x, factor, bound)
    codes = {label: i for i, label in enumerate(dict.fromkeys([*rows.labels, *anchors.labels]))}
    label, own = np.array([codes[v] for v in rows.labels]), np.array([codes[v] for v in anchors.labels])
    tie = np.empty(len(label), np.int64)
    tie[np.lexsort((rows.keys, rows.ids, ~rows.has_id))] = np.arange(len(label))
    none = -(2 * bound + 2) if q.dtype == object else -(2 ** 62)
    best = Best(low.shape, k, none, object if q.dtype == object else np.int64)
    pure = np.array([label[lo] if (label[lo:hi] == label[lo]).all() else -1 for lo, hi in zip(tree.lo, tree.hi)])
    blind = bound >= 10 ** 200                                       # bounds would leave the range of doubles
    qf, xf = (None, None) if blind else (q.astype(float), x[tree.pivot].astype(float))
    length = None if blind else np.sqrt((qf ** 2).sum(axis=1))

    def reach(node: int, who: np.ndarray, top: np.ndarray, low_: np.ndarray) -> np.ndarray:
        """Which of the anchors the node can still give a row."""
        alive = (pure[node] < 0) | ((pure[node] == own[who]) == same)
        if not blind:
            floor = np.maximum(best.score[who, :, -1], low[who]).astype(float)
            alive &= ((top[:, None] >= floor) & (low_[:, None] <= high[who].astype(float))).any(axis=1)
        return np.flatnonzero(alive)

    def bounds(nodes: slice, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if blind:
            return np.zeros((len(who), nodes.stop - nodes.start)), np.zeros((len(who), nodes.stop - nodes.start))
        mid, off = qf[who] @ xf[nodes].T, length[who][:, None] * tree.radius[nodes][None, :]
        off = off + 0.5 + 1e-9 * (np.abs(mid) + off)
        return mid + off, mid - off

    everyone = np.arange(len(own))
    top, low_ = bounds(slice(0, 1), everyone)
    heap = [(0.0, 0, everyone, top[:, 0], low_[:, 0])]
    while heap:
        _, node, who, top, low_ = heapq.heappop(heap)
        left = reach(node, who, top, low_)
        who = who[left]
        if len(who) == 0:
            continue
        if tree.count[node]:
            kids = slice(tree.first[node], tree.first[node] + tree.count[node])
            tops, lows = bounds(kids, who)
            for c, lead in enumerate((-tops.max(axis=0)).tolist()):
                heapq.heappush(heap, (lead, kids.start + c, who, tops[:, c], lows[:, c]))
            continue
        lo, hi = tree.lo[node], tree.hi[node]
        s = scores(q[who], x[lo:hi])
        fit = ((label[None, lo:hi] == own[who][:, None]) == same) & (rows.keys[None, lo:hi] != anchors.keys[who][:, None])
        for j in range(low.shape[1]):
            ok = fit & (s >= low[who, j][:, None]) & (s <= high[who, j][:, None]) & (s >= best.score[who, j, -1][:, None])
            hit = np.flatnonzero(ok.any(axis=1))
            if len(hit):
                best.offer(who[hit], j, np.where(ok[hit], s[hit], none), np.arange(lo, hi), tie)
    return best


# ------------------------------------------------------------------ on Spark

_TREE = ("pivot", "lo", "hi", "first", "count")


def sound_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    v = keep(vectors, vec_id=id_col, label=label_col, v=vector_col).withColumn("label", F.col("label").cast("string"))
    return sound(v.where(F.col("label").isNotNull()))


def hard_negatives(vectors: DataFrame, params: NegativeParams = NegativeParams(), id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = materialize(sound_rows(vectors, id_col, vector_col, label_col).withColumns({"key": F.monotonically_increasing_id(), "dim": F.size("v")}), "negatives-rows")
    asked = (F.col("vec_id") % params.anchor_every) == 0
    n, values, anchor_values, dim, peak = rows.agg(
        F.count("*"), F.sum(F.col("dim") + 1), F.sum(F.when(asked, F.col("dim") + 1)), F.max("dim"),
        F.max(F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)))).first()
    shards, blocks = shard_count(values or 0, params.shard_values), shard_count(anchor_values or 0, params.block_values)
    bound = score_bound(dim, peak, params.factor)
    texts = ScoreTexts(bound)
    dealt = lambda name, parts: F.pmod(F.xxhash64("key", F.lit(name)), F.lit(parts)).cast("int").alias(name)

    def grow(t: pa.Table) -> pa.Table:
        x = np.array(t.sort_by("key").column("v").to_pylist(), float).reshape(t.num_rows, -1)
        with np.errstate(over="ignore", invalid="ignore"):
            tree, order = CoverTree.build(np.floor(x * params.factor), params.leaf_rows, params.shrink)
        return pa.table({"dim": t.column("dim").slice(0, 1), "shard": t.column("shard").slice(0, 1), **gathered(t, order),
                         **{c: [getattr(tree, c).astype("<i4").tobytes()] for c in _TREE}, "radius": [tree.radius.astype("<f8").tobytes()]})

    def gather(t: pa.Table) -> pa.Table:
        return pa.table({"dim": t.column("dim").slice(0, 1), "block": t.column("block").slice(0, 1), **gathered(t)})

    # As many tasks as trees: adaptive execution would merge them by their bytes.
    trees = materialize(rows.select("*", dealt("shard", shards)).repartition(shards, "dim", "shard").groupBy("dim", "shard").applyInArrow(
        grow, f"dim int, shard int, {ROWS}, " + "".join(f"{c} binary, " for c in _TREE) + "radius binary"), "negatives-trees")
    anchors = materialize(rows.where(asked).select("*", dealt("block", blocks)).groupBy("dim", "block").applyInArrow(
        gather, f"dim int, block int, {ROWS}"), "negatives-anchors")

    def visit(asking: DataFrame, same: bool, k: int) -> DataFrame:
        """Every block of anchors against every tree. ``asking`` has the
        blocks' windows: rows (anchor's key, number, positive's score)."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    who, found = rows_of(r, "_a"), rows_of(r)
                    tree = CoverTree(*(np.frombuffer(r[c], "<i4") for c in _TREE), np.frombuffer(r["radius"], "<f8"))
                    kind = object if bound >= 2 ** 53 else np.int64
                    if same:
                        low, high = np.full((len(who.keys), 1), -bound, kind), np.full((len(who.keys), 1), bound, kind)
                    else:                                            # low > high: no such positive, an empty window
                        low, high = np.full((len(who.keys), params.positives), 1, kind), np.full((len(who.keys), params.positives), 0, kind)
                        at = {key: i for i, key in enumerate(who.keys.tolist())}
                        for w in r["windows"]:
                            s = texts.number(w["place"])
                            low[at[w["anchor"]], w["number"] - 1] = -(-params.low_percent * s // 100)
                            high[at[w["anchor"]], w["number"] - 1] = params.high_percent * s // 100
                    best = search(tree, found, who, low, high, same, k, params.factor, bound)
                    i, j, m = np.nonzero(best.row >= 0)
                    hit, s = best.row[i, j, m], best.score[i, j, m].tolist()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([r["dim"]] * len(i), pa.int32()), pa.array([r["block"]] * len(i), pa.int32()), pa.array(who.keys[i]), pa.array(who.ids[i]),
                        pa.array((j + 1).astype(np.int32)), pa.array(found.keys[hit]), pa.array(found.ids[hit], mask=~found.has_id[hit]),
                        pa.array([texts.text(v) for v in s], pa.string()), pa.array([as_long(v) for v in s], pa.int64())],
                        names=["dim", "block", "anchor", "anchor_id", "number", "other", "other_id", "place", "score"])

        named = [F.col(c).alias(f"{c}_a") for c in ("keys", "ids", "has_id", "labels", "x")]
        left = asking.select("dim", "block", *named, *(["windows"] if not same else []), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
        # Both sides are dealt by shard: the blocks times the shards are far more than
        # Spark's estimate of them and would be broadcast, then shuffled with the trees.
        pairs = left.repartition(shards, "dim", "shard").hint("merge").join(trees.repartition(shards, "dim", "shard"), ["dim", "shard"])
        found = (pairs.mapInArrow(run, "dim int, block int, anchor long, anchor_id long, number int, other long, other_id long, place string, score long"))
        order = Window.partitionBy("anchor", "number").orderBy(F.desc("place"), F.asc_nulls_last("other_id"), "other")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    positives = materialize(visit(anchors, True, params.positives).withColumn("number", F.col("rank")), "negatives-positives")
    windows = positives.groupBy("dim", "block").agg(F.collect_list(F.struct("anchor", "number", "place")).alias("windows"))
    negatives = visit(anchors.join(windows, ["dim", "block"]), False, params.negatives)
    named = positives.select("anchor", "number", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return negatives.join(named, ["anchor", "number"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
                                                              "positive_score", F.col("score").alias("negative_score"))
