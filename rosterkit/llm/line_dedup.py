"""Line dedup by an exact set-similarity join (operator 9), DataFrame
functions only.

A line's tokens are its word 5-grams (a shorter line is one token of all
its words), lower-cased. A line goes when an earlier line of the table,
in order of doc_id, text and place, is alike by 80 % or more; so the
first of each kind stays.

Tokens are ordered by rarity (counts over a fixed number of hash buckets,
then the hash). Two alike sets share a token among their rarest 20 %
(prefix filter) at places that leave room for the overlap (positional
filter) and have sizes within 80 % (length filter). What passes is
verified on whole sets. Lines with equal sets are one class first, so a
line that stands in a third of all documents is one row in the join.
Classes are compared with the earliest documents of their lists; those
that find no match there are compared with the rest of each list.

Defined results: null and wordless texts keep their (blank) lines; blank
lines never match and stay; rows equal in id and text are one document
and are all cleaned alike; a null id comes first; texts are read whole;
extra columns are carried through; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize


@dataclass(frozen=True)
class LineParams:
    words: int = 5
    percent: int = 80
    buckets: int = 1 << 16         # of the rarity table, whatever the input
    classes: int = 64              # steps of rarity


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, text_hash, place and words of every line that has a word."""
    d = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    d = d.select("doc", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split(F.lower("text"), "\n", -1)).alias("place", "line"))
    return _with_words(d)


def _with_words(lines: DataFrame) -> DataFrame:
    """Splits at single spaces; other white space and runs are cleaned up
    first, in the few lines that have them."""
    line = F.col("line")
    odd = F.lit(False)
    for c in "\t\x0b\x0c\r":
        odd = odd | line.contains(c)
    line = F.when(odd, F.translate(line, "\t\x0b\x0c\r", "    ")).otherwise(line)
    # Blank lines go before the clean-up, which a filter after it would repeat.
    lines = lines.where(F.ltrim("line", F.lit(" \t\x0b\x0c\r")) != "").withColumn("line", line)
    words = F.split("line", " ")
    runs = F.col("line").contains("  ") | F.col("line").startswith(" ") | F.col("line").endswith(" ")
    return lines.withColumn("w", F.when(runs, F.array_remove(words, "")).otherwise(words)).drop("line")


def _word_hashes(lines: DataFrame) -> DataFrame:
    return lines.withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).drop("w")


def _places(k: int) -> Column:
    """Where in ``h`` a k-gram begins; a shorter line has one, all of it."""
    return F.sequence(F.lit(0), F.greatest(F.size("h") - k, F.lit(0)))


def _gram(i: Column, k: int) -> Column:
    """Hash of the k words from place i; words beyond a short line's end are NULL, which the hash passes over."""
    return F.xxhash64(*[F.get("h", i + j) for j in range(k)])


def _tokens(lines: DataFrame, k: int) -> DataFrame:
    """Adds ``t``: distinct 64-bit hashes of the line's k-grams."""
    return _word_hashes(lines).withColumn("t", F.array_distinct(F.transform(_places(k), lambda i: _gram(i, k)))).drop("h")


def _bucket_counts(lines: DataFrame, params: LineParams) -> DataFrame:
    """(b, n): the tokens of all lines by bucket. A row for each place
    instead of an array for the line: counting needs no arrays, and rows
    are hashed in compiled code, lambdas are not. A line's repeats count
    too; they only move a bucket in the order of rarity."""
    # Not explode(): the filter that Spark infers for it is pushed below the
    # projections and would split and hash the words anew.
    places = _word_hashes(lines).select("h", F.explode_outer(_places(params.words)).alias("i"))
    return places.groupBy(F.pmod(_gram(F.col("i"), params.words), F.lit(params.buckets)).cast("int").alias("b")).agg(F.count("*").alias("n"))


def _rarity(lines: DataFrame, params: LineParams) -> Column:
    """Bucket -> step of rarity, an array of fixed length made from counts
    over all lines: steps of equal numbers of buckets, the fullest last."""
    rows = _bucket_counts(lines, params).collect()
    order = [0] * params.buckets
    for place, row in enumerate(sorted(rows, key=lambda r: (r["n"], r["b"]))):
        order[row["b"]] = place * params.classes // params.buckets
    return F.split(F.lit(",".join(map(str, order))), ",").cast("array<int>")


def _keys(tokens: DataFrame, rarity: Column, params: LineParams) -> DataFrame:
    """``t`` becomes ``key``: sorted numbers, rare tokens before frequent
    ones (step of rarity above 57 bits of the hash)."""
    step = lambda t: F.coalesce(F.get(rarity, F.pmod(t, F.lit(params.buckets)).cast("int")), F.lit(0)).cast("long")
    key = lambda t: F.shiftleft(step(t), 57).bitwiseOR(t.bitwiseAND(F.lit((1 << 57) - 1)))
    return tokens.withColumn("key", F.sort_array(F.transform("t", key))).drop("t")


def later_matches(docs: DataFrame, params: LineParams = LineParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The lines that go: doc, text_hash, places (array of line numbers from 0)."""
    p = params.percent
    split = _lines(docs, id_col, text_col)
    rarity, tokens = _rarity(split, params), _tokens(split, params.words)
    n = F.size("key")
    prefix = F.slice("key", 1, n - F.ceil(n * p / 100).cast("int") + 1)
    lines = materialize(_keys(tokens, rarity, params).select(
        "doc", "text_hash", "place", n.alias("n"), F.xxhash64("key").alias("f1"), F.xxhash64("key", F.lit(1)).alias("f2"), prefix.alias("prefix")), "line-sets")
    own = ["n", "f1", "f2"]
    first = F.min(F.struct("doc", "text_hash", "place"))
    # All lines of a class have one prefix.
    classes = materialize(lines.groupBy(*own).agg(first.alias("at"), F.first("prefix").alias("prefix"))
                          .select(*own, F.xxhash64(*own).alias("c"), "at.*", "prefix"), "line-classes")

    fat, lines = lines, materialize(lines.drop("prefix"), "line-sets")
    discard(fat)

    # One posting per class and prefix token; only tokens that another class has too matter.
    posting = classes.select("c", F.posexplode("prefix").alias("pos", "token"), "n").select(
        "token", "c", F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("pos").cast("long")).alias("np"))
    lists = materialize(posting.withColumn("k", F.count("*").over(Window.partitionBy("token"))).where("k > 1").select(
        "token", "c", F.shiftright("np", 32).cast("int").alias("n"), F.col("np").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos")), "line-lists")
    fat, classes = classes, materialize(classes.drop("prefix"), "line-classes")
    discard(fat)
    order = classes.select("c", F.struct("doc", "text_hash", "place").alias("o"))
    fat, lists = lists, materialize(lists.join(order, "c"), "line-placed")
    discard(fat)

    def pairs(late: DataFrame, early: DataFrame) -> DataFrame:
        """Distinct (c, e): e earlier, within length and positional filter."""
        e = early.select("token", F.col("c").alias("e"), F.col("n").alias("en"), F.col("pos").alias("epos"), F.col("o").alias("eo"))
        return late.join(e, "token").where(
            (F.col("eo") < F.col("o")) & (F.col("n") * 100 >= F.col("en") * p) & (F.col("en") * 100 >= F.col("n") * p)
            & (F.least(F.col("n") - F.col("pos"), F.col("en") - F.col("epos")) * (100 + p) >= (F.col("n") + F.col("en")) * p)
        ).select("c", "e").distinct()

    # First the earliest line of each list, then, for classes without a match, all others.
    low = lists.groupBy("token").agg(F.min("o").alias("low"))
    pivots = lists.join(low, "token").where(F.col("o") == F.col("low")).drop("low")
    near = materialize(pairs(lists, pivots), "line-near")
    ends = lambda df: df.select("c").union(df.select(F.col("e").alias("c"))).distinct()
    sets = materialize(_full_sets(docs, ends(near).join(order, "c"), rarity, params, id_col, text_col), "line-full")
    matched = materialize(_verify(near, sets, p), "line-matched")
    open_ = lists.join(matched.select("c").distinct(), "c", "left_anti")
    wanted = open_.select("token").distinct()
    rest = pairs(open_, lists.join(wanted, "token", "left_semi")).join(near, ["c", "e"], "left_anti")
    rest = materialize(rest, "line-rest")
    discard(lists)
    missing = ends(rest).join(sets.select("c"), "c", "left_anti")
    if not missing.isEmpty():
        sets = sets.unionByName(materialize(_full_sets(docs, missing.join(order, "c"), rarity, params, id_col, text_col), "line-full"))
    gone = matched.select("c").union(_verify(rest, sets, p).select("c")).distinct()

    # Gone: every line but the first of its class, and the first of a class that matches an earlier one.
    fate = classes.join(gone.withColumn("gone", F.lit(True)), "c", "left").select(
        *own, F.struct("doc", "text_hash", "place").alias("at"), F.coalesce("gone", F.lit(False)).alias("gone"))
    out = lines.drop("prefix").join(fate, own).where(F.col("gone") | ~F.col("at").eqNullSafe(F.struct("doc", "text_hash", "place")))
    out = materialize(out.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("place")).alias("places")), "line-gone")
    for done in (lines, classes, near, sets, matched, rest):
        discard(done)
    return out


def _full_sets(docs: DataFrame, wanted: DataFrame, rarity: Column, params: LineParams, id_col: str, text_col: str) -> DataFrame:
    """(c, key) for the classes in ``wanted`` (c, o), from their first lines."""
    per_doc = wanted.groupBy("o.doc", "o.text_hash").agg(F.collect_list(F.struct(F.col("o.place").alias("place"), "c")).alias("want"))
    d = docs.select(F.col(f"`{id_col}`").alias("doc_"), F.col(f"`{text_col}`").alias("text")).withColumn("hash_", F.xxhash64("text"))
    d = d.join(per_doc, F.col("doc_").eqNullSafe(F.col("doc")) & (F.col("hash_") == F.col("text_hash"))).dropDuplicates(["doc", "text_hash"])
    d = d.withColumn("all", F.split(F.lower("text"), "\n", -1)).select(F.explode("want").alias("x"), "all").select("x.c", F.get("all", F.col("x.place")).alias("line"))
    return _keys(_tokens(_with_words(d), params.words), rarity, params).select("c", "key")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a, b = sets.withColumnRenamed("key", "ka"), sets.select(F.col("c").alias("e"), F.col("key").alias("kb"))
    both = F.size(F.array_intersect("ka", "kb"))
    return (pairs.join(b, "e").join(a, "c").withColumn("both", both)
            .where(F.col("both") * 100 >= (F.size("ka") + F.size("kb") - F.col("both")) * percent).select("c", "e"))


def dedup_lines(docs: DataFrame, params: LineParams = LineParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later matches cut out of the text, and ``removed_lines``
    (their numbers in the old text, from 0; empty if none)."""
    gone = later_matches(docs, params, id_col, text_col).select(
        F.col("doc").alias("_line_doc"), F.col("text_hash").alias("_line_hash"), F.col("places").alias("removed_lines"))
    text = F.col(f"`{text_col}`")
    joined = docs.drop("removed_lines").join(
        gone, docs[id_col].eqNullSafe(F.col("_line_doc")) & (F.xxhash64(docs[text_col]) == F.col("_line_hash")), "left")
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("removed_lines", i)), "\n")
    cleaned = F.when(F.col("removed_lines").isNull(), text).otherwise(left)
    return joined.withColumn(text_col, cleaned).select(
        *[F.col(f"`{c}`") for c in docs.columns if c != "removed_lines"], F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"))
