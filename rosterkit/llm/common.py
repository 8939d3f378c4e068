"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, shared_path
from ..session import materialize as _materialize

__all__ = ["WORD", "WHITE", "materialize", "discard", "shared_path", "table", "keep", "with_text_ids", "exact_ids", "shard_count", "ship_package"]

#: A word is a run of anything but ASCII white space (space, \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"
#: The white space itself, as bytes; ``bytes.split()`` splits on exactly these.
WHITE = b" \t\n\x0b\x0c\r"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again. The shuffle files
    of the plan that made it are of no use any more; Spark drops them once
    the JVM has collected the plan, which is asked for here."""
    out = _materialize(df, name)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, **columns: str) -> DataFrame:
    """Select ``internal=source`` columns and nothing else, so that extra
    columns of the input can never clash with an operator's own."""
    return df.select(*[F.col(f"`{src}`").alias(name) for name, src in columns.items()])


def with_text_ids(df: DataFrame, column: str = "doc_id") -> DataFrame:
    """The ids as texts, on their way into pandas: beside a null, pandas
    makes doubles of integers, and large ids would be rounded."""
    return df.withColumn(column, F.col(f"`{column}`").cast("string"))


def exact_ids(texts: pd.Series) -> pd.api.extensions.ExtensionArray:
    """The ids that :func:`with_text_ids` sent, nulls included."""
    return pd.array([None if t is None else int(t) for t in texts], dtype="Int64")


def shard_count(rows: int, rows_per_shard: int) -> int:
    """Shards of about equal size: their number grows with the input,
    what one task holds does not."""
    return max(1, -(-int(rows) // int(rows_per_shard)))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application, as
    ``--py-files`` would (Spark serves the archive from the driver)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="py-files-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
