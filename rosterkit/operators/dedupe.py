"""Keyed dedupe and group fill.

``row_number() = 1`` over a keyed window is planned by Spark as a
``WindowGroupLimit`` that already keeps one row per key *before* the
shuffle (partial) and again after it (final), so a hot key costs one row
per map task in the exchange, not all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from .schema import qcol

_RN = "__rn"


def _keys(keys: Sequence[str | Column]) -> list[Column]:
    return [qcol(k) if isinstance(k, str) else k for k in keys]


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """one row per key, the first in ``order`` (a total order makes
    the result deterministic; ``dropDuplicates`` would keep any row)."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def keep_latest(df: DataFrame, key: Column, order_desc: Sequence[Column],
                partition: Sequence[str | Column] = (), row_id: Column | None = None) -> DataFrame:
    """one row per (``partition``, ``key``), the greatest in
    ``order_desc`` (each sorted descending, NULLs last). Rows whose key
    is NULL are all kept.

    With a unique ``row_id`` a NULL key is replaced by that row's own key
    (one pass; blank rows spread over the shuffle instead of forming one
    hot key). Without it the blank rows bypass the window in a second
    branch of the same input.
    """
    order = [c.desc_nulls_last() for c in order_desc]
    if row_id is not None:
        k = F.when(key.isNotNull(), F.concat(F.lit("k"), key.cast("string"))) \
             .otherwise(F.concat(F.lit("r"), row_id.cast("string")))
        w = Window.partitionBy(*_keys(partition), k).orderBy(*order)
        return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)
    keyed = df.where(key.isNotNull())
    blank = df.where(key.isNull())
    w = Window.partitionBy(*_keys(partition), key).orderBy(*order)
    kept = keyed.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)
    return kept.unionByName(blank)


def distinct_rows(df: DataFrame) -> DataFrame:
    """exact duplicate rows removed (partial aggregation before the
    shuffle makes duplicates cheap)."""
    return df.distinct()


def ranked(df: DataFrame, order: Sequence[Column], place: str = "place", parts: int | None = None) -> DataFrame:
    """``df`` with each row's number (from 1) in ``order``, which
    outlives a write. Rows are range-partitioned and sorted in their parts;
    a part's first number is the count of the parts before it (one row a
    part), so no task sees all rows, as a window without keys would. The
    placed table is written: its parts are the same for both reads."""
    from ..session import ensure_checkpoint_dir, materialize
    ensure_checkpoint_dir(df.sparkSession)
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    part, row = F.spark_partition_id(), F.monotonically_increasing_id()
    placed = materialize(spread.withColumns({"__part": part, "__row": row.bitwiseAND((1 << 33) - 1)}), "ranked")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return placed.join(starts, "__part").withColumn(place, F.col("__start") + F.col("__row") + 1).drop("__part", "__row", "__start")


def fill_from_first(df: DataFrame, column: str, group: Sequence[str],
                    order: Sequence[Column]) -> DataFrame:
    """blank cells of ``column`` take the first non-blank value of the
    same group in ``order``; non-blank cells are kept; a group with no
    value keeps NULLs (blank-only cells become NULL).

    One window over the group (a file's rows, so its size is a file's):
    one scan, one exchange.
    """
    val = blank_to_null(qcol(column))
    frame = (Window.partitionBy(*[qcol(g) for g in group]).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn(column, F.coalesce(val, F.first(val, ignorenulls=True).over(frame)))
