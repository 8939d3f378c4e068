"""Phrase collocation mining by stripes (operator 12).

A stripe belongs to a prefix (zero to four words of one language) and
counts the words that follow it. Level m of the search makes the stripes
of (m-1)-word prefixes: each task counts a bounded chunk of words into
stripes of its own, stripes of one prefix meet in one place and are
merged elementwise there. From the merged stripes come

* the counts of all m-word phrases that occur ``least`` times,
* the total of a prefix: rare next words are summed in one entry (next is
  null), so that the empty prefix' total is the language's word count,
* the best extension of each phrase, to the right (largest entry of its
  stripe) and to the left (largest entry whose phrase ends in it), by which
  phrases inside equally frequent longer ones are dropped.

A frequent phrase has frequent parts. So a level only counts phrases whose
first and last m-1 words passed the level below, by a bit filter over the
frequent phrases; from the third level on it reads no more than the runs
of frequent pairs, which are written once. The filter's size follows their number up to ``filter_bits``; a
full filter lets more phrases through to the merge, never fewer, and the
counts stay exact. It and the hashes of hot prefixes (at most
``hot_share``) are all that is broadcast.

Hot keys: a hot prefix' stripe is split into ``salts`` parts by the next
word (the empty prefix' into as many as there are partitions), and all
stripes arrive summed by chunk. Merging is Spark's hash aggregate, which spills.

Arithmetic is that of decimal(38,0): scores are exact while 1000 * a * n
stays below 10**38 (a Spark error is raised beyond, where ANSI mode is on).

Defined results: a null text is empty, a null language is ``und``; words
and pieces are cut as the contract says, only A-Z are lowered; repeated
rows count each; ids take no part, so they may be null or repeated; ties
in score go to larger a, then to the phrase that is smaller in UTF-8
bytes; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, keep, materialize, shard_count

STRIPES = "lang string, prefix string, salt int, next string, count array<int>"      # next: words, one space between
_PIECE_END = b"\xff"                      # in no UTF-8 text
_LOWER = bytes(ord(chr(b).lower()) if 65 <= b <= 90 else 0xFF if b in b".,;:!?\n\v\f\r" else 32 if b in b" \t" else b for b in range(256))


@dataclass(frozen=True)
class CollocationParams:
    least: int = 100                      # occurrences of a candidate
    longest: int = 5                      # words of a candidate
    subsumed_percent: int = 100           # dropped if a longer candidate has this share of its count
    top: int = 2000                       # per language
    hot_share: int = 4096                 # a prefix with more than one in so many words is hot (so many are, at most)
    salts: int = 32                       # parts of a hot prefix' stripe
    chunk_bytes: int = 8 << 20            # of text that a task counts together
    bytes_per_partition: int = 8 << 20    # of text, behind one partition of a merge
    filter_bits: int = 1 << 25            # 4 MB, the most that is broadcast


# ------------------------------------------------------------------ inside a task

@dataclass
class Chunk:
    """Texts as word numbers by place; ``lang`` is the language's number."""
    word: np.ndarray
    lang: np.ndarray
    words: pa.Array                       # the word of each number
    langs: list
    end: int                              # the number that ends a piece

    @classmethod
    def of(cls, raws: list[bytes], langs: list[str]) -> Chunk:
        lists = pc.split_pattern(pa.array([r + b" \xff" for r in raws], pa.large_binary()), pattern=b" ")
        coded = lists.flatten().dictionary_encode()
        names = list(dict.fromkeys(langs))
        at = {name: i for i, name in enumerate(names)}
        lang = np.repeat(np.array([at[x] for x in langs], np.int32), np.diff(lists.offsets.to_numpy()))
        word = coded.indices.to_numpy()
        told = word != pc.index(coded.dictionary, pa.scalar(b"", pa.large_binary())).as_py()
        return cls(word[told], lang[told], coded.dictionary, names, pc.index(coded.dictionary, pa.scalar(_PIECE_END, pa.large_binary())).as_py())

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of words and of languages."""
        return _hashed(self.words.to_pylist()), _hashed([x.encode() for x in self.langs])

    def text(self) -> pa.Array:
        return pc.if_else(pc.equal(self.words, pa.scalar(_PIECE_END, pa.large_binary())), pa.scalar(b"", pa.large_binary()), self.words).cast(pa.string())


def _raw(text: str) -> bytes:
    """Lowered, every piece's end a word of its own."""
    return text.encode().translate(_LOWER).replace(_PIECE_END, b" \xff ")


def _windows(raw: bytes, size: int, overlap: int) -> Iterator[bytes]:
    """A long text in windows; each begins with the last ``overlap`` words
    of the one before, so that every phrase of one word more lies in
    exactly one of them."""
    at, tail = 0, []
    while True:
        end = raw.find(b" ", at + size) if at + size < len(raw) else -1
        part = b" ".join([*tail, raw[at:] if end < 0 else raw[at:end]])
        yield part
        if end < 0:
            return
        tail, at = part.rsplit(None, overlap)[-overlap:] if overlap else [], end


def _hashed(words: list[bytes]) -> np.ndarray:
    import xxhash
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return h ^ (h >> np.uint64(29))


def _hash_phrases(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Of hashes of the language and of the words by place, one per phrase."""
    h = lang
    with np.errstate(over="ignore"):
        for w in words:
            h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + w)
    return h


def _bits(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each hash in a filter of ``size`` (a power of two) bits."""
    mask = np.uint64(size - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def _passes(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    a, b = _bits(h, 8 * len(bitmap))
    return ((bitmap[a >> 3] >> (a & 7)) & (bitmap[b >> 3] >> (b & 7)) & 1).astype(bool)


def _phrase_starts(c: Chunk, m: int, bitmap: np.ndarray | None, of_word: np.ndarray, of_lang: np.ndarray) -> np.ndarray:
    """Whether an m-word phrase whose first and last m-1 words pass begins at each place."""
    n = max(0, len(c.word) - m + 1)
    good, inside = np.ones(n, bool), c.word != c.end
    for j in range(m):
        good &= inside[j:n + j]
    if m > 1 and n:
        part = _passes(_hash_phrases(of_lang[c.lang[:n + 1]], [of_word[c.word[j:n + j + 1]] for j in range(m - 1)]), bitmap)
        good &= part[:n] & part[1:n + 1]
    return good


def _chunk_stripes(c: Chunk, m: int, bitmap: np.ndarray | None, hot: np.ndarray, salts: int) -> pa.RecordBatch | None:
    """The stripes of one chunk's m-word phrases."""
    of_word, of_lang = c.hashes()
    at, size = np.flatnonzero(_phrase_starts(c, m, bitmap, of_word, of_lang)), len(c.words)
    if len(at) == 0:
        return None
    prefix = c.lang[at].astype(np.int64)              # numbers of prefixes, the empty one being the language's
    for j in range(m - 1):
        prefix, _ = pd.factorize(prefix * size + c.word[at + j])
    gram, grams = pd.factorize(prefix * size + c.word[at + m - 1])
    count, first = np.bincount(gram, minlength=len(grams)), np.empty(len(grams), np.int64)
    first[gram[::-1]] = at[::-1]
    at, prefix = first, grams // size
    last = c.word[at + m - 1]
    salt = (of_word[last] >> np.uint64(40)).astype(np.int64) % salts
    if m > 1:
        salt *= np.isin(_hash_phrases(of_lang[c.lang[at]], [of_word[c.word[at + j]] for j in range(m - 1)]), hot)
    order = np.argsort(prefix * salts + salt)
    at, last, salt, count, prefix = at[order], last[order], salt[order], count[order], prefix[order]
    starts = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]) | (salt[1:] != salt[:-1])])
    text, ends = c.text(), np.r_[starts, len(at)]
    heads = [text.take(pa.array(c.word[at[starts] + j])) for j in range(m - 1)]
    return pa.RecordBatch.from_arrays([
        pa.array(c.langs).take(pa.array(c.lang[at[starts]])),
        pc.binary_join_element_wise(*heads, " ") if heads else pa.array([""] * len(starts)),
        pa.array(salt[starts].astype(np.int32)),
        pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), text.take(pa.array(last))), " "),
        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(count.astype(np.int32)))], names=["lang", "prefix", "salt", "next", "count"])


def _chunk_runs(c: Chunk, bitmap: np.ndarray, least: int) -> Iterator[tuple[str, str]]:
    """(lang, runs of at least ``least`` words whose neighbours all pass as pairs)."""
    of_word, of_lang = c.hashes()
    inside = c.word != c.end
    pair = inside[:-1] & inside[1:] & _passes(_hash_phrases(of_lang[c.lang[:-1]], [of_word[c.word[:-1]], of_word[c.word[1:]]]), bitmap)
    edge = np.flatnonzero(np.diff(np.r_[False, pair, False].astype(np.int8)))       # first and last word of each run
    lo, hi = edge[::2], edge[1::2]
    long = hi - lo + 1 >= least
    lo, hi = lo[long], hi[long]
    if len(lo) == 0:
        return
    text, size = c.text(), hi - lo + 1
    at = np.repeat(lo - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), text.take(pa.array(c.word[at]))), " ").to_pylist()
    of, some = c.lang[lo].tolist(), 1 << 14
    for lang in set(of):
        own = [r for r, k in zip(runs, of) if k == lang]
        for at in range(0, len(own), some):
            yield c.langs[lang], "\n".join(own[at:at + some])


def _chunks(batches: Iterator[pa.RecordBatch], size: int, overlap: int | None) -> Iterator[Chunk]:
    """The texts of a task in chunks of about ``size`` bytes; longer texts
    are cut into overlapping windows, or stay whole (``overlap`` None)."""
    raws, langs, held = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            raw = _raw(text.as_py())
            for part in [raw] if overlap is None else _windows(raw, size, overlap):
                raws.append(part)
                langs.append(lang.as_py())
                held += len(part)
                if held >= size:
                    yield Chunk.of(raws, langs)
                    raws, langs, held = [], [], 0
                    pa.default_memory_pool().release_unused()
    if raws:
        yield Chunk.of(raws, langs)


# ------------------------------------------------------------------ on Spark

def stripes(docs: DataFrame, level: int, params: CollocationParams, salts: int, bitmap: bytes | None, hot: np.ndarray) -> DataFrame:
    """STRIPES of each chunk; ``docs``: lang, text without nulls."""
    shared = docs.sparkSession.sparkContext.broadcast((bitmap, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, often = shared.value
        held = held and np.frombuffer(held, np.uint8)
        for chunk in _chunks(batches, params.chunk_bytes, level - 1):
            if (out := _chunk_stripes(chunk, level, held, often, salts)) is not None:
                yield out

    return docs.mapInArrow(run, STRIPES)


def frequent_runs(docs: DataFrame, params: CollocationParams, bitmap: bytes) -> DataFrame:
    """(lang, text): what is left of the texts for phrases of three words and
    more, the runs in which all pairs of neighbours are frequent."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shared.value, np.uint8)
        for chunk in _chunks(batches, params.chunk_bytes, None):
            for lang, text in _chunk_runs(chunk, held, 3):
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([text])], names=["lang", "text"])

    return docs.mapInArrow(run, "lang string, text string")


def merged(parts: DataFrame, partitions: int, least: int) -> DataFrame:
    """Stripes merged elementwise: lang, prefix, next, a; what occurs less
    than ``least`` times is summed in entries whose next is null."""
    entry = F.explode(F.arrays_zip(F.split("next", " ", -1).alias("next"), "count")).alias("e")
    once = (parts.repartition(partitions, "lang", "prefix", "salt").select("lang", "prefix", "salt", entry)
            .groupBy("lang", "prefix", "salt", F.col("e.next").alias("next")).agg(F.sum("e.count").alias("a")))
    return (once.groupBy("lang", "prefix", "salt", F.when(F.col("a") >= least, F.col("next")).alias("next")).agg(F.sum("a").alias("a"))
            .drop("salt"))


def _phrase_hashes(batch: pa.RecordBatch, level: int) -> np.ndarray:
    words = _hashed([w.encode() for phrase in batch.column("phrase").to_pylist() for w in phrase.split(" ")]).reshape(-1, level)
    return _hash_phrases(_hashed([lang.encode() for lang in batch.column("lang").to_pylist()]), list(words.T))


def hot_prefixes(phrases: DataFrame, level: int, least: int) -> np.ndarray:
    """Hashes of the phrases that occur more than ``least`` times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_phrase_hashes(batch, level).view(np.int64))], names=["h"])

    return phrases.where(F.col("a") > least).select("lang", "phrase").mapInArrow(run, "h long").toArrow().column("h").to_numpy().view(np.uint64)


def frequent_filter(phrases: DataFrame, level: int, most: int) -> bytes:
    """A bit filter over (lang, phrase), of at most ``most`` bits."""
    size = 1 << 16
    n = phrases.count()
    while size < min(most, 16 * n):
        size *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = _phrase_hashes(batch, level)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_bits(h, size)))], names=["bit"])

    rows = (phrases.select("lang", "phrase").mapInArrow(run, "bit long").groupBy(F.shiftright("bit", 3).alias("slot"))
            .agg(F.expr("bit_or(shiftleft(1, cast(bit & 7 AS int)))").alias("held")).toArrow())
    out = np.zeros(size // 8, np.uint8)
    out[rows.column("slot").to_numpy()] = rows.column("held").to_numpy()
    return out.tobytes()


def frequent_phrases(docs: DataFrame, params: CollocationParams = CollocationParams(), text_col: str = "text",
                     lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, prefix, next, m, a) of all frequent phrases of one to
    ``longest`` words, and (lang, n)."""
    docs = keep(docs, lang=lang_col, text=text_col).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = shard_count(size, params.bytes_per_partition)
    phrase = F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))
    bitmap, hot, levels, n, words = None, np.zeros(0, np.uint64), [], None, 0
    for m in range(1, params.longest + 1):
        found = merged(stripes(docs, m, params, parts if m == 1 else params.salts, bitmap, hot), parts, params.least)
        if m > 1:
            found = found.where(F.col("next").isNotNull())
        found = materialize(found.select("lang", "prefix", "next", phrase.alias("phrase"), F.lit(m).alias("m"), "a"), f"phrases-{m}")
        if m == 1:
            n = found.groupBy("lang").agg(F.sum("a").alias("n"))
            words = found.agg(F.coalesce(F.sum("a"), F.lit(0))).first()[0]
        levels.append(found.where(F.col("next").isNotNull()))
        if m < params.longest:
            if levels[-1].isEmpty():
                break
            bitmap = frequent_filter(levels[-1], m, params.filter_bits)
            hot = hot_prefixes(levels[-1], m, words // params.hot_share)
            if m == 2:
                docs = materialize(frequent_runs(docs, params, bitmap), "phrases-runs")
    out = levels[0]
    for df in levels[1:]:
        out = out.unionByName(df)
    return out, n


def collocations(docs: DataFrame, params: CollocationParams = CollocationParams(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score; and k, the words before the cut."""
    phrases, n = frequent_phrases(docs, params, text_col, lang_col)
    words = F.split("phrase", " ", -1)
    piece = lambda first, count: F.array_join(F.slice(words, first, count), " ")
    long = lambda c: F.col(c).cast("decimal(19,0)")

    longer = phrases.where("m > 2")
    best = (longer.select("lang", F.col("prefix").alias("phrase"), "a")
            .unionByName(longer.select("lang", piece(F.lit(2), F.col("m") - 1).alias("phrase"), "a"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("extended")))
    counts = phrases.select("lang", "phrase", "a")
    cuts = (phrases.where("m > 1").select("lang", "phrase", "m", "a", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", piece(F.lit(1), F.col("k")).alias("left"), piece(F.col("k") + 1, F.col("m") - F.col("k")).alias("right"))
            .join(counts.toDF("lang", "left", "l"), ["lang", "left"]).join(counts.toDF("lang", "right", "r"), ["lang", "right"]).join(n, "lang"))
    cuts = cuts.withColumns({"above": long("a") * long("n") * F.lit(1000).cast("decimal(19,0)"), "below": long("l") * long("r")})
    scored = (cuts.withColumn("score", F.expr("above div below"))
              .groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut")).select("lang", "phrase", "cut.*"))
    left = (scored.join(best, ["lang", "phrase"], "left")
            .where(100 * F.coalesce("extended", F.lit(0)) < params.subsumed_percent * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", F.col("k").cast("long").alias("k")))
