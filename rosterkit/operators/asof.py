"""As-of lookups (JN5, JN6): for each row, the latest event at or before it.

Spark has no as-of join operator; it is a union of rows and events
sorted per key with ``last(..., ignorenulls)`` over a running frame.
With ``slice_by`` the per-key sort is split into slices (e.g. days):
each slice is solved on its own and the value carried in from earlier
slices comes from a small per-(key, slice) table, so one hot key is
spread over many tasks and the answer stays exact. Where a slice itself
is hot, :func:`asof_join_ranged` splits by range instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .schema import qcol

_SIDE = "__side"
_VAL = "__asof_val"
_SALT = "__salt"


def asof_join(rows: DataFrame, events: DataFrame, by: Sequence[str], order: Sequence[str],
              values: Sequence[str], *, slice_by: str | None = None,
              prefix: str = "") -> DataFrame:
    """Left as-of join.

    ``rows`` and ``events`` both carry the ``by`` columns and the
    ``order`` columns (compared lexicographically; an event whose order
    equals the row's counts as "at or before"). Each output row is a row
    of ``rows`` plus ``prefix + v`` for every ``v`` in ``values`` taken
    from the latest matching event (NULL if there is none). Rows with a
    NULL ``by`` key match nothing and skip the shuffle.
    ``slice_by`` names a column present on both sides that is monotone
    in ``order`` (e.g. the event date).
    """
    row_cols = rows.columns
    keyed = F.lit(True)
    for b in by:
        keyed = keyed & qcol(b).isNotNull()
    # Rows without a key match nothing; a number per row spreads them over
    # the shuffle instead of sending them all to NULL's partition (and,
    # unlike a hash of the row, reads none of its columns).
    salt = F.when(keyed, F.lit(0)).otherwise(F.monotonically_increasing_id()).cast("long")
    ev = events.where(keyed)
    part = list(by) + ([slice_by] if slice_by else []) + [_SALT]
    ev_vals = F.struct(*[qcol(v).alias(v) for v in values])
    ev_side = ev.select(*[qcol(c) for c in dict.fromkeys(list(by) + ([slice_by] if slice_by else [])
                                                         + list(order))],
                        ev_vals.alias(_VAL), F.lit(0).cast("long").alias(_SALT),
                        F.lit(0).alias(_SIDE))
    row_side = rows.withColumn(_SALT, salt).withColumn(_SIDE, F.lit(1))
    u = row_side.unionByName(ev_side, allowMissingColumns=True)
    w = (Window.partitionBy(*[qcol(c) for c in part])
         .orderBy(*[qcol(c).asc_nulls_first() for c in order], F.col(_SIDE))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = u.withColumn(_VAL, F.last(F.col(_VAL), ignorenulls=True).over(w))
    got = seen.where(F.col(_SIDE) == 1)

    if slice_by:
        # The last state of each (key, slice), from the same exchange; per key
        # the latest of all earlier slices is carried into the next ones.
        kparts = [*by, slice_by]
        ends = (Window.partitionBy(*[qcol(c) for c in part])
                .orderBy(*[qcol(c).desc_nulls_last() for c in order], F.col(_SIDE).desc()))
        last = (seen.where(keyed).withColumn("__n", F.row_number().over(ends)).where(F.col("__n") == 1)
                .select(*[qcol(c) for c in part], F.col(_VAL).alias("__last")))
        ws = (Window.partitionBy(*[qcol(b) for b in by]).orderBy(qcol(slice_by))
              .rowsBetween(Window.unboundedPreceding, -1))
        carry = last.select(*[qcol(c) for c in part], F.last("__last", ignorenulls=True).over(ws).alias("__carry"))
        got = (got.join(carry, on=kparts + [_SALT], how="left")
               .withColumn(_VAL, F.coalesce(F.col(_VAL), F.col("__carry"))).drop("__carry"))

    out_vals = [F.col(f"{_VAL}.{v}").alias(prefix + v) for v in values]
    return got.select(*[qcol(c) for c in row_cols], *out_vals)


def asof_join_ranged(rows: DataFrame, events: DataFrame, by: Sequence[str], order: Sequence[str],
                     values: Sequence[str], *, parts: int, prefix: str = "") -> DataFrame:
    """:func:`asof_join` for keys too hot for one task even within a slice:
    one key may hold nearly all rows, all on one day.

    Rows and events are range-partitioned together by (key, order) into
    ``parts`` parts of about equal size, whatever the keys are (Spark
    samples the bounds; rows of one place are told apart by a number, so
    that even they can be split). The placed table is written, so that a
    part is the same part for every later read. Each part is solved on its
    own; the last event of each (part, key), a table of at most a row per
    part and key, is carried into the parts after it.

    ``parts`` should be some dozens of times the number of tasks that run
    at once: groups of (part, key) are then dealt evenly."""
    from ..session import materialize
    row_cols, by, order = rows.columns, list(by), list(order)
    keyed = F.lit(True)
    for b in by:
        keyed = keyed & qcol(b).isNotNull()
    vals = F.struct(*[qcol(v).alias(v) for v in values])
    ev = events.where(keyed).select(*[qcol(c) for c in dict.fromkeys(by + order)], vals.alias(_VAL), F.lit(0).alias(_SIDE), F.lit(0).cast("long").alias(_SALT))
    u = rows.where(keyed).withColumns({_SIDE: F.lit(1), _SALT: F.monotonically_increasing_id()}).unionByName(ev, allowMissingColumns=True)
    place = [*[qcol(c) for c in by], *[qcol(c).asc_nulls_first() for c in order], F.col(_SIDE), F.col(_SALT)]
    u = materialize(u.repartitionByRange(parts, *place).withColumn("__part", F.spark_partition_id()), "asof-placed")
    inside = [F.col("__part"), *[qcol(b) for b in by]]
    up_to = Window.partitionBy(*inside).orderBy(*place[len(by):]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = u.withColumn(_VAL, F.last(_VAL, ignorenulls=True).over(up_to))
    ends = Window.partitionBy(*inside).orderBy(*[qcol(c).desc_nulls_last() for c in order], F.col(_SIDE).desc(), F.col(_SALT).desc())
    last = (u.where(F.col(_SIDE) == 0).withColumn("__n", F.row_number().over(ends)).where(F.col("__n") == 1)
            .select(*by, "__part", F.col(_VAL).alias("__last")))
    # At most a row per part and key, so one key's are few whatever its rows.
    every = last.unionByName(u.select(*by, "__part").distinct(), allowMissingColumns=True).groupBy(*by, "__part").agg(F.first("__last", ignorenulls=True).alias("__last"))
    before = Window.partitionBy(*[qcol(b) for b in by]).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carry = every.select(*by, "__part", F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    got = seen.where(F.col(_SIDE) == 1).join(carry, [*by, "__part"], "left")
    picked = F.coalesce(F.col(_VAL), F.col("__carry"))
    out = got.select(*[qcol(c) for c in row_cols], *[picked[v].alias(prefix + v) for v in values])
    types = dict(events.dtypes)
    return out.unionByName(rows.where(~F.coalesce(keyed, F.lit(False))).select(*[qcol(c) for c in row_cols], *[F.lit(None).cast(types[v]).alias(prefix + v) for v in values]))


def last_wins_lookup(df: DataFrame, group: Sequence[str], order: Sequence[str],
                     values: Sequence[str]) -> DataFrame:
    """JN5: per group, the values of the last row in ``order`` (a
    dictionary built row by row where a later row overwrites)."""
    last = Window.partitionBy(*[qcol(g) for g in group]).orderBy(*[qcol(o).desc() for o in order])
    return (df.select(*[qcol(c) for c in dict.fromkeys([*group, *order, *values])])
            .withColumn("__n", F.row_number().over(last)).where(F.col("__n") == 1)
            .select(*[qcol(g) for g in group], *[qcol(v) for v in values if v not in group]))
