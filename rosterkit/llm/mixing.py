"""Mixing sources to target weights (operator 7), DataFrame functions only.

Each source's documents, in a fixed order, are one long run of words
that is cut into blocks of ``block_words``. The mix is a list of block
slots, ``shard_slots`` to an output shard. A multinomial draw over the
target weights gives each shard's slots their sources; the j-th slot of
a source takes the block that a pseudorandom permutation of the source's
block numbers puts at place j (a new pass begins when all are used), and
blocks are joined to documents by number.

Independent draws alone would miss a target by the root of its slots and
could use a document a third time where the target is the cap. So each
source's slots are counted through the shards, and slots drawn beyond a
source's quota are handed, in order, to the sources that were drawn too
seldom. The totals then meet the targets to the word; the last slot of a
source takes only as many words of its block as are still due.

Defined results: a null or empty text has size 0 and nothing taken; a
null source is a source of its own, last in order; equal ids and
repeated rows are separate documents; extra columns are ignored; an
empty table (or one without words) takes nothing. A rerun draws the same.

Large inputs: texts are read once, for their sizes. Offsets inside a source are
counted over hash buckets of bounded size, then over the buckets, so a
source with a third of all rows is never one task's; slots are ranked
inside shards, then over shards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, keep, materialize, shard_count


@dataclass(frozen=True)
class MixParams:
    weights: tuple[float, ...] = (3, 1, 2)   # sources in order, repeating
    share: float = 1.5                       # words of the mix, as a share of all words
    cap: float = 2.0                         # most passes over a source
    block_words: int = 256
    group_rows: int = 512                    # rows that are ranked together
    seed: int = 11


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size (words) and a hash of the text; reads the texts once."""
    return keep(docs, doc_id=id_col, text=text_col, source=source_col).select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def running_total(df: DataFrame, value: str, group: str, order: list[str], per: int) -> DataFrame:
    """Adds ``before``: the total of ``value`` over the earlier rows of the
    same ``number``. Rows are summed inside groups ``group`` of bounded
    size, the groups inside ``per`` groups, and those over the rest: a
    number with most of the rows still spreads over many tasks."""
    df = df.withColumn("g2", F.expr(f"{group} div {per}"))
    inside = F.sum(value).over(Window.partitionBy("number", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    past = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    low = df.groupBy("number", "g2", group).agg(F.sum(value).alias("v"))
    high = (low.groupBy("number", "g2").agg(F.sum("v").alias("v2"))
            .select("number", "g2", F.coalesce(F.sum("v2").over(past("number", "g2")), F.lit(0)).alias("before2")))
    low = (low.withColumn("before1", F.coalesce(F.sum("v").over(past("number", "g2", group)), F.lit(0)))
           .join(high, ["number", "g2"]).select("number", group, (F.col("before1") + F.col("before2")).alias("base")))
    return (df.withColumn("before", inside - F.col(value)).join(low, ["number", group])
            .withColumn("before", F.col("before") + F.col("base")).drop("base", "g2"))


def source_targets(sizes: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """One row per source: number (place in order), words, weight, target.
    Targets above ``cap`` times the source are set to it and the excess is
    shared again by weight, round by round, until none is above. The one
    ranking over everything is over distinct sources, already summed."""
    n = len(params.weights)
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in params.weights]), (F.col("number") % n + 1).cast("int"))
    table = materialize(sizes.groupBy("source").agg(F.sum("size").alias("words"))
                        .withColumn("number", number).withColumn("weight", weight), "mix-sources")
    goal = params.share * (table.agg(F.sum("words")).first()[0] or 0)
    full = params.cap * F.col("words")
    rate, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(rate) > full
        row = table.agg(F.count_if(above), F.sum(F.when(above, full)), F.sum(F.when(~above, F.col("weight")))).first()
        if row[0] == capped or not row[2]:
            break
        capped, rate = row[0], (goal - (row[1] or 0.0)) / row[2]
    return table.withColumn("target", F.when(F.col("weight") * F.lit(rate) > full, full).otherwise(F.col("weight") * F.lit(rate)))


def _gcd(a: Column, b: Column) -> Column:
    """Euclid; 96 rounds are enough for 64-bit numbers."""
    start = F.struct(b.cast("long").alias("x"), a.cast("long").alias("y"))
    step = lambda p, _: F.when(p["y"] == 0, p).otherwise(
        F.struct(p["y"].alias("x"), F.pmod(p["x"], F.greatest(p["y"], F.lit(1).cast("long"))).alias("y")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(96)), start, step)["x"]


def slot_quotas(targets: DataFrame, params: MixParams) -> DataFrame:
    """Per source with words: slots due, and its permutation of full
    blocks (place p holds block (step * p + shift) mod full). A short last
    block keeps the last place of a pass, so p places hold p full blocks."""
    size = params.block_words
    q = (targets.where("words > 0").select("number", "words", F.round("target").cast("long").alias("due"))
         .withColumn("full", F.expr(f"words div {size}")).withColumn("blocks", F.expr(f"(words + {size - 1}) div {size}"))
         .withColumn("slots", F.expr(f"(due div words) * blocks + ((due % words) + {size - 1}) div {size}")))
    seed = F.xxhash64("number", F.lit(params.seed))
    modulus = F.greatest("full", F.lit(1).cast("long"))
    tries = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.pmod(seed + k, modulus) )
    step = F.coalesce(F.element_at(F.filter(tries, lambda t: _gcd(t, modulus) == 1), 1), F.lit(1).cast("long"))
    return q.withColumn("step", step).withColumn("shift", F.pmod(F.xxhash64(seed), modulus))


def draw_slots(targets: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The mix, one row per slot: ``slot`` (output order), ``number`` of the
    source, ``block`` and ``take``, the words taken from the block's front."""
    size, group = params.block_words, params.group_rows
    spark = targets.sparkSession
    quota = slot_quotas(targets, params).withColumn("low", F.coalesce(
        F.sum("slots").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    quota = materialize(quota, "mix-quota")
    n_slots = int(quota.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0])
    # The draw: a slot's hash falls on a point of [0, n_slots); sources hold ranges as long as their quotas.
    points = quota.where("slots > 0").select("number", "low", "slots", F.explode(F.expr("sequence(low div 1024, (low + slots - 1) div 1024)")).alias("cell"))
    slots = (spark.range(n_slots).withColumnRenamed("id", "slot")
             .withColumn("point", F.pmod(F.xxhash64("slot", F.lit(params.seed)), F.lit(max(n_slots, 1))))
             .withColumn("cell", F.expr("point div 1024"))
             .join(points, "cell").where("point >= low AND point < low + slots")
             .select("slot", "number", F.lit(1).cast("long").alias("one"), F.expr(f"slot div {group}").alias("g")))
    drawn = running_total(slots, "one", "g", ["slot"], group).withColumnRenamed("before", "j").drop("one", "g")
    drawn = materialize(drawn.join(quota.select("number", "slots"), "number"), "mix-drawn")
    # Slots beyond a quota go, in order, to the places that sources drawn too seldom have left.
    left = (quota.select("number", "slots").join(drawn.groupBy("number").agg(F.count("*").alias("got")), "number", "left")
            .withColumn("got", F.coalesce("got", F.lit(0))).where("got < slots")
            .withColumn("end", F.sum(F.expr("slots - got")).over(Window.orderBy("number"))))
    places = (left.withColumn("r", F.explode(F.expr("sequence(end - (slots - got), end - 1)")))
              .select("number", "r", F.expr("slots - (end - r)").alias("j")))
    over = (drawn.where("j >= slots").select("slot", F.lit(0).alias("number"), F.lit(1).cast("long").alias("one"), F.expr(f"slot div {group}").alias("g")))
    over = running_total(over, "one", "g", ["slot"], group).select("slot", F.col("before").alias("r"))
    given = drawn.where("j < slots").select("slot", "number", "j").unionByName(over.join(places, "r").select("slot", "number", "j"))
    place = given.join(quota.select("number", "words", "due", "full", "blocks", "step", "shift"), "number").withColumn("p", F.expr("j % blocks"))
    spun = F.expr("cast((cast(step AS decimal(19,0)) * cast(p AS decimal(19,0)) + shift) % full AS bigint)")
    length = F.when(F.col("p") < F.col("full"), F.lit(size)).otherwise(F.expr(f"words - full * {size}"))
    rest = F.expr(f"(due % words) - p * {size}")
    return place.select("slot", "number", F.when(F.col("p") < F.col("full"), spun).otherwise(F.col("full")).alias("block"),
                        F.when(F.expr("j div blocks < due div words"), length).otherwise(F.least(length, rest)).cast("long").alias("take"))


def mix(docs: DataFrame, params: MixParams = MixParams(), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, slots). Documents: doc_id, source, size, source_size,
    target, taken, and number/offset, by which slots' blocks name words."""
    size = params.block_words
    sizes = materialize(document_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    targets = materialize(source_targets(sizes, params), "mix-targets")
    slots = materialize(draw_slots(targets, params), "mix-slots")
    named = targets.select("number", F.col("source").alias("s"), F.col("words").alias("source_size"), "target")
    buckets = shard_count(sizes.count(), params.group_rows)
    placed = (sizes.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
              .withColumn("g", F.pmod(F.xxhash64("doc_id", "size", F.lit(params.seed)), F.lit(buckets)).cast("long")))
    placed = materialize(running_total(placed, "size", "g", ["doc_id", "size", "text_hash"], params.group_rows)
                         .withColumnRenamed("before", "offset").drop("g"), "mix-placed")
    used = slots.groupBy("number", "block").agg(
        F.count_if(F.col("take") == size).alias("whole"),
        F.collect_list(F.when(F.col("take") < size, F.col("take"))).alias("parts"))
    front = F.greatest(F.col("offset") - F.col("block") * size, F.lit(0))
    back = F.least(F.col("offset") + F.col("size") - F.col("block") * size, F.lit(size))
    part = F.aggregate("parts", F.lit(0).cast("long"), lambda a, t: a + F.greatest(F.least(back, t) - front, F.lit(0).cast("long")))
    cut = placed.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(offset div {size}, (offset + size - 1) div {size})")))
    taken = (cut.join(used, ["number", "block"], "left")
             .withColumn("t", F.coalesce(F.col("whole") * (back - front) + part, F.lit(0)))
             .groupBy(*placed.columns).agg(F.sum("t").cast("long").alias("taken")))
    empty = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return taken.unionByName(empty), slots


def mixed_documents(docs: DataFrame, params: MixParams = MixParams(), id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix as whole documents with all columns of ``docs``: each as
    often as its words were taken, a fraction of a pass rounded up or down
    by a hash with that probability, so that sources keep their shares.
    Rows alike in id, source and text count as copies of one row."""
    placed, _ = mix(docs, params, id_col, text_col, source_col)
    chance = F.pmod(F.xxhash64("doc_id", "offset", F.lit(params.seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    copies = (placed.where("taken > 0")
              .withColumn("n", F.expr("taken div size") + F.when(chance < F.expr("(taken % size) / size"), 1).otherwise(0))
              .groupBy(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("text_hash").alias("_mix_hash"))
              .agg(F.sum("n").alias("_mix_n")).where("_mix_n > 0"))
    keyed = docs.withColumns({"_mix_k": F.xxhash64(F.col(f"`{text_col}`"))}).dropDuplicates([id_col, source_col, "_mix_k"])
    return (keyed.join(copies, keyed[id_col].eqNullSafe(F.col("_mix_id")) & keyed[source_col].eqNullSafe(F.col("_mix_source"))
                       & (F.col("_mix_k") == F.col("_mix_hash")))
            .withColumn("_mix_copy", F.explode(F.expr("sequence(1, _mix_n)"))).select(*[F.col(f"`{c}`") for c in docs.columns]))
