"""Membership tests on normalised keys (JN2-JN4, JN8, X3-X5).

A membership flag is a LEFT join against the *distinct* key set of the
other side, so it never fans out. Rows without a key cannot match; their
join key is replaced by a per-row salt so they spread over all shuffle
partitions instead of piling into the one that NULL hashes to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import composite_key, normalize_name
from .schema import qcol


def name_key(first: Column, last: Column, dob: Column | None = None, *,
             blank_names_match: bool = False) -> Column:
    """JN8/J16: ``first|last`` or ``first|last|dob`` over normalised names.

    A missing DOB is the text ``None`` (D4: two rows with missing DOB
    match on name alone). A row with both names blank has no key unless
    ``blank_names_match`` restores the reference behaviour.
    """
    f, s = normalize_name(first), normalize_name(last)
    parts = [f, s]
    if dob is not None:
        parts.append(F.coalesce(dob.cast("string"), F.lit("None")))
    key = composite_key(*parts)
    if blank_names_match:
        return key
    return F.when((f != "") | (s != ""), key)


def stack_columns(df: DataFrame, columns: Sequence[str], name: str = "value") -> DataFrame:
    """The values of several columns as one column (UNION ALL of the
    columns), via ``explode(array(...))`` in a single scan."""
    if not columns:
        raise ValueError("stack_columns needs at least one column")
    return df.select(F.explode(F.array(*[qcol(c).cast("string") for c in columns])).alias(name))


def flag_membership(df: DataFrame, key: Column, keys: DataFrame, flag: str) -> DataFrame:
    """JN2/JN3/X5: add boolean ``flag`` = ``key`` is in the one-column
    DataFrame ``keys``. Bag semantics: every row of ``df`` is kept once.
    """
    kcol = keys.columns[0]
    k = (keys.select(qcol(kcol).alias("__k")).where(F.col("__k").isNotNull())
         .distinct().withColumn("__hit", F.lit(True)))
    # A number per row spreads the rows without a key and reads no column.
    salt = F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))
    tagged = df.withColumn("__mk_real", key).withColumn(
        "__mk", F.coalesce(F.col("__mk_real"), salt))
    joined = tagged.join(k, (F.col("__mk") == F.col("__k")) & F.col("__mk_real").isNotNull(), "left")
    return (joined.withColumn(flag, F.coalesce(F.col("__hit"), F.lit(False)))
            .drop("__mk_real", "__mk", "__k", "__hit"))


def store_keys(keys: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """A key set kept as a table, bucketed and sorted by its key ``k``, for
    keys that are asked again and again: joins of :func:`flag_membership`
    with it deal out the other side only. ``path``: a folder that all
    executors share (default: the session's warehouse); ``buckets`` should
    follow the number of keys, some millions to a bucket."""
    kcol = keys.columns[0]
    rows = keys.select(qcol(kcol).alias("k")).where(F.col("k").isNotNull()).distinct()
    writer = rows.repartition(buckets, "k").write.mode("overwrite").format("parquet").bucketBy(buckets, "k").sortBy("k")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return keys.sparkSession.table(table)


def anti_join(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys`` (bag semantics,
    NULL keys are kept -- unlike ``NOT IN`` or ``EXCEPT``)."""
    return flag_membership(df, key, keys, "__in").where(~F.col("__in")).drop("__in")


def semi_join(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``."""
    return flag_membership(df, key, keys, "__in").where(F.col("__in")).drop("__in")


def match_reason(by_email: Column, by_name: Column) -> Column:
    """P10: why a row was suppressed."""
    return (F.when(by_email & by_name, F.lit("Email match; Name+DOB match"))
            .when(by_email, F.lit("Email match"))
            .otherwise(F.lit("Name+DOB match")))
