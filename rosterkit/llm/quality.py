"""Quality rules with an isolation forest (operator 10).

``rule_statistics`` computes per document the statistics that the usual
hand-written quality rules look at. ``fit_forest`` grows an isolation
forest on them from a bounded sample of labelled rows and calibrates one
threshold; ``apply_forest`` scores every document.

Defined results: null and empty texts have no words and fail the base
rules; texts are read whole, however long; repeated rows are judged each
for itself and alike; extra columns are ignored; an empty table gives an
empty result. Without labelled rows of both kinds there is nothing to
calibrate on: the forest then rejects nothing and the base rules decide;
under four labelled rows there is no forest (``anomaly`` is null). A
labelled id counts once, however often its document is repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import exact_ids, keep, with_text_ids

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_digits", "n_punct", "n_bars", "n_distinct")
STATS_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in BASE + EXTRA)

_SYMBOLS, _UPPER, _DIGITS = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58))
_PUNCT = b".,;:!?\"'()-"
_BLANK = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50              # base rule: fewer words fail
    max_repeat_percent: int = 50     # base rule: more words in repeated windows fail
    fit_rows: int = 10_000           # bound of the labelled sample that reaches the driver
    trees: int = 200
    tree_rows: int = 64              # rows each tree is grown on
    seed: int = 7


# ------------------------------------------------------------------ statistics

def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """(words inside 3-word windows that occur at least twice, distinct words)."""
    ids: dict[bytes, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    v = len(ids)
    if len(a) < 4 or v == len(a):
        return 0, v
    key = (a[:-2] * v + a[1:-1]) * v + a[2:]     # v < 2**21 words: no overflow
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(a), bool)
    for k in range(3):
        covered[k:len(key) + k] |= again
    return int(covered.sum()), v


def text_statistics(text: str | None) -> tuple[int, ...]:
    """BASE then EXTRA of one text."""
    if not text:
        return (0,) * (len(BASE) + len(EXTRA))
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if len(words) >= 1 << 21:            # keys of three ids would pass 63 bits
        repeat, distinct = _repeated_words_long(words)
    else:
        repeat, distinct = repeated_words(words)
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    return (len(words), len(text) - sum(text.count(c) for c in _BLANK), count(_SYMBOLS),
            len(lines) - len(set(lines)), repeat,
            len(lines), count(_UPPER), count(_DIGITS), count(_PUNCT), raw.count(b"|"), distinct)


def _repeated_words_long(words: list[bytes]) -> tuple[int, int]:
    ids: dict[bytes, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    _, pair = np.unique(a[:-2] * len(ids) + a[1:-1], return_inverse=True)
    _, inv, n = np.unique(pair.astype(np.int64) * len(ids) + a[2:], return_inverse=True, return_counts=True)
    again = n[inv] > 1
    covered = np.zeros(len(a), bool)
    for k in range(3):
        covered[k:len(again) + k] |= again
    return int(covered.sum()), len(ids)


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of statistics per row of ``docs``; no shuffle."""
    columns = [*BASE, *EXTRA]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame([text_statistics(t if isinstance(t, str) else None) for t in pdf["text"]],
                               columns=columns, dtype="int64")
            out.insert(0, "doc_id", exact_ids(pdf["doc_id"]))
            yield out

    return with_text_ids(keep(docs, doc_id=id_col, text=text_col)).mapInPandas(run, STATS_SCHEMA)


# ------------------------------------------------------------------ the forest

def features(stats: pd.DataFrame) -> np.ndarray:
    """Rule statistics as ratios, so that a document's length alone says little."""
    s = {c: stats[c].to_numpy(dtype=np.float64) for c in (*BASE, *EXTRA)}
    words, chars, lines = (np.maximum(s[c], 1) for c in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([
        np.log1p(s["n_symbols"] / words * 100), np.log1p(s["n_bars"] / words * 100),
        s["n_upper"] / chars, s["n_punct"] / chars, chars / words, s["n_distinct"] / words ** 0.8,
        # what a page's footer or refrain repeats is no sign of junk
        np.maximum(s["n_dup_lines"] / lines - 0.3, 0), np.maximum(s["n_repeat_words"] / words - 0.2, 0),
    ])


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=np.float64)
    big = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(big - 1) + 0.5772156649015329) - 2 * (big - 1) / big, np.where(n > 1, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: node k has children 2k+1 and 2k+2; a leaf has feature -1."""
    feature: np.ndarray
    split: np.ndarray
    length: np.ndarray
    depth: int
    rows: int
    threshold: float = float("inf")

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1]: short paths score high."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for f, s, length in zip(self.feature, self.split, self.length):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = f[node]
                child = 2 * node + 1 + (x[rows, np.maximum(at, 0)] >= s[node])
                node = np.where(at < 0, node, child)
            total += length[node]
        return np.power(2.0, -total / len(self.feature) / max(float(_average_path(self.rows)), 1e-9))


def grow_forest(x: np.ndarray, trees: int, tree_rows: int, seed: int) -> Forest:
    rng = np.random.default_rng(seed)
    take = min(tree_rows, len(x))
    depth = max(1, int(np.ceil(np.log2(max(take, 2)))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, dtype=np.int64)
    split, length = np.zeros((trees, nodes)), np.zeros((trees, nodes))

    def grow(t: int, k: int, rows: np.ndarray, level: int) -> None:
        low, high = rows.min(axis=0), rows.max(axis=0)
        free = np.flatnonzero(high > low)
        if level == depth or len(free) == 0:
            length[t, k] = level + _average_path(len(rows))
            return
        f = int(rng.choice(free))
        s = rng.uniform(low[f], high[f])
        right = rows[:, f] >= s
        if right.all():                       # uniform() may return the low end itself
            s = np.nextafter(low[f], high[f])
            right = rows[:, f] >= s
        feature[t, k], split[t, k] = f, s
        grow(t, 2 * k + 1, rows[~right], level + 1)
        grow(t, 2 * k + 2, rows[right], level + 1)

    for t in range(trees):
        grow(t, 0, x[rng.choice(len(x), take, replace=False)], 0)
    return Forest(feature, split, length, depth, take)


def calibrate(scores: np.ndarray, good: np.ndarray) -> float:
    """The score from which rejecting separates labelled good from bad
    rows best (largest sum of the two rates; ties: the higher score)."""
    if good.all() or not good.any():
        return float("inf")
    order = np.argsort(-scores, kind="stable")
    s, g = scores[order], good[order]
    gain = np.cumsum(~g) / (~g).sum() - np.cumsum(g) / g.sum()
    gain[:-1][s[:-1] == s[1:]] = -np.inf      # cut between different scores only
    k = int(np.argmax(gain))
    if gain[k] <= 0:
        return float("inf")
    return float(s[k]) if k + 1 == len(s) else float((s[k] + s[k + 1]) / 2)


def fit_forest(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), id_col: str = "doc_id",
               text_col: str = "text", label_col: str = "quality") -> Forest | None:
    """Grow and calibrate on about ``fit_rows`` labelled ids (those whose
    hash falls into that share of all), and no others' texts: one half
    grows the trees, the other half sets the threshold. None without
    usable rows. An id labelled twice is bad if one label says so."""
    lab = (keep(labels, doc_id=id_col, good=label_col).where("doc_id IS NOT NULL AND good IS NOT NULL")
           .groupBy("doc_id").agg(F.min("good").alias("good")))
    share = F.pmod(F.xxhash64("doc_id", F.lit(params.seed)), F.lit(max(1, lab.count()))) < params.fit_rows
    lab = lab.where(share)                                     # bounded, so it may be broadcast
    texts = keep(docs, doc_id=id_col, text=text_col).join(F.broadcast(lab.select("doc_id")), "doc_id", "left_semi")
    # One row of an id that is labelled, however often it is repeated.
    stats = [F.min(F.struct(*BASE, *EXTRA)).alias("s")]
    rows = (rule_statistics(texts).where(f"n_words >= {params.min_words}").groupBy("doc_id").agg(*stats).select("doc_id", "s.*")
            .join(F.broadcast(lab), "doc_id").toPandas())
    if len(rows) < 4:
        return None
    rows = rows.sort_values([*BASE, *EXTRA, "doc_id"]).sample(frac=1, random_state=params.seed)
    x, good = features(rows), rows["good"].to_numpy() > 0
    half = np.arange(len(rows)) % 2 == 0
    forest = grow_forest(x[half], params.trees, params.tree_rows, params.seed)
    limit = calibrate(forest.scores(x[~half]), good[~half])
    return Forest(forest.feature, forest.split, forest.length, forest.depth, forest.rows, limit)


def apply_forest(stats: DataFrame, forest: Forest | None, params: QualityParams = QualityParams()) -> DataFrame:
    """Adds ``base_failed``, ``anomaly`` and ``kept`` to the statistics."""
    base = ((F.col("n_words") < params.min_words)
            | (100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words")))
    if forest is None:
        scored = stats.withColumn("anomaly", F.lit(None).cast("double"))
        return scored.withColumn("base_failed", base).withColumn("kept", ~base)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(doc_id=exact_ids(pdf["doc_id"]), anomaly=forest.scores(features(pdf)) if len(pdf) else 0.0)

    scored = with_text_ids(stats).mapInPandas(run, STATS_SCHEMA + ", anomaly double")
    return scored.withColumn("base_failed", base).withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(forest.threshold)))


def judge_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(),
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, base rules and the forest's verdict for every row; one
    pass for the labelled rows, one for all, no shuffle of texts."""
    return apply_forest(rule_statistics(docs, id_col, text_col), fit_forest(docs, labels, params, id_col, text_col), params)


def kept_documents(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(),
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    forest = fit_forest(docs, labels, params, id_col, text_col)

    @F.pandas_udf("boolean")
    def verdict(texts: pd.Series) -> pd.Series:
        s = pd.DataFrame([text_statistics(t if isinstance(t, str) else None) for t in texts], columns=[*BASE, *EXTRA], dtype="int64")
        good = (s["n_words"] >= params.min_words) & (100 * s["n_repeat_words"] <= params.max_repeat_percent * s["n_words"])
        if forest is not None and len(s):
            good &= forest.scores(features(s)) < forest.threshold
        return good

    return docs.where(verdict(F.col(f"`{text_col}`")))
