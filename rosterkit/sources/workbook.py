"""Workbook sources.

Files come from Spark's ``binaryFile`` source (any Hadoop file system) or
from a table of the same shape (path, modificationTime, content); they
are decoded on the executors into the long cell layout or one string
column per header.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField,
                               StructType)

from ..operators.schema import resolve_name
from . import xlsx_rows

CELLS_SCHEMA = StructType([
    StructField("_file", StringType()), StructField("_sheet", StringType()),
    StructField("_ordinal", LongType()),
    StructField("cells", ArrayType(StructType([StructField("k", StringType()),
                                               StructField("pos", IntegerType()),
                                               StructField("v", StringType())]))),
    StructField("_error", StringType()),
])


def workbook_files(spark: SparkSession, source: str | DataFrame, glob: str = "*.xls*") -> DataFrame:
    """Path, modification time and content of the files that ``glob``
    names, from a path or a table of files. Nothing is read yet."""
    if isinstance(source, DataFrame):
        pattern = "^" + "".join(".*" if c == "*" else "." if c == "?" else f"\\Q{c}\\E" for c in glob) + "$"
        files = source.where(F.element_at(F.split("path", "/"), -1).rlike(pattern))
    else:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", "true").load(source))
    return files.select("path", "modificationTime", "content")


def read_workbook_cells(spark: SparkSession, source: str | DataFrame, *, sheet: str | None = None,
                        candidates: list[str] | None = None, glob: str = "*.xls*") -> DataFrame:
    """A1/A2/A5: decoded rows of one sheet of every matching workbook,
    cells as ``(header, position, value)``; ``_ordinal = -1`` is each
    file's header row; unreadable files (old binary formats too) carry
    ``_error``."""
    from . import ship
    ship(spark)
    # No repartition: binaryFile already packs whole files into splits of
    # at most spark.sql.files.maxPartitionBytes, and moving file bytes
    # through a shuffle would only cost; Arrow batches are byte-bounded
    # (spark.sql.execution.arrow.maxBytesPerBatch).
    resolve = functools.partial(resolve_name) if candidates else None
    fn = functools.partial(xlsx_rows.decode_files, sheet=sheet, candidates=candidates, resolve=resolve)
    return workbook_files(spark, source, glob).select("path", "content").mapInArrow(fn, CELLS_SCHEMA)


def unreadable_files(cells: DataFrame) -> DataFrame:
    """Every file that could not be read, with the whole error text."""
    return cells.where(F.col("_error").isNotNull()).select("_file", "_error")


def read_workbooks(spark: SparkSession, source: str | DataFrame, *, sheet: str | None = None,
                   candidates: list[str] | None = None, glob: str = "*.xls*") -> DataFrame:
    """Workbooks as a wide table: ``_file, _sheet, _ordinal`` + one string
    column per header (union by name across files, C11). Headers that
    differ only in case are one column, spelled as in the first file; a
    header named like one of the three own columns gets ``.1``. The
    headers of one export are few; mail attachments, whose headers are
    anybody's, stay in the long layout (see plans.reports)."""
    from ..session import ensure_checkpoint_dir, materialize
    ensure_checkpoint_dir(spark)
    cells = materialize(read_workbook_cells(spark, source, sheet=sheet, candidates=candidates, glob=glob),
                        "workbook_cells")
    errors = unreadable_files(cells)
    if not errors.isEmpty():
        n = errors.count()
        first = errors.orderBy("_file").first()
        raise ValueError(f"could not read {n} file(s); first {first['_file']}: {first['_error']}")
    order = (cells.where(F.col("_ordinal") == -1)
             .select("_file", F.posexplode("cells").alias("p", "c"))
             .groupBy(F.lower("c.k").alias("k")).agg(F.min(F.struct("_file", "p", "c.k")).alias("o")))
    headers = [(r["k"], r["o"]["k"]) for r in order.orderBy("o").collect()]
    own = {"_file", "_sheet", "_ordinal"}
    m = F.map_from_entries(F.transform("cells", lambda c: F.struct(F.lower(c["k"]), c["v"])))
    return cells.where(F.col("_ordinal") >= 0).select("_file", "_sheet", "_ordinal", m.alias("m")).select(
        "_file", "_sheet", "_ordinal", *[F.col("m")[k].alias(h + ".1" if k in own else h) for k, h in headers])


def read_workbook_tables(spark: SparkSession, source: str | DataFrame, names: dict[str, list[str]],
                         glob: str = "*.xls*") -> dict[str, DataFrame]:
    """A1: several sheets of the same workbook(s), each chosen by name."""
    return {k: read_workbooks(spark, source, candidates=v, glob=glob) for k, v in names.items()}


def latest_snapshot(spark: SparkSession, source: str | DataFrame, pattern: str) -> str | None:
    """A4/T4: path of the newest file (by modification time, then path)
    matching ``pattern``; file contents are pruned from the scan."""
    files = workbook_files(spark, source, pattern).select("path", "modificationTime")
    top = files.orderBy(F.col("modificationTime").desc(), F.col("path").desc()).limit(1).collect()
    return top[0]["path"] if top else None


def load_system_export(spark: SparkSession, *, file: str | None = None, folder: str | DataFrame | None = None,
                       pattern: str | None = None, sheet: str = "students") -> DataFrame:
    """A3: the system export -- an explicitly given file wins, else the
    newest file of ``folder`` (or table of files) whose name matches
    ``pattern`` (A4). Raises when neither yields a file or the sheet is
    missing."""
    if file is not None:
        return read_workbooks(spark, file, sheet=sheet, glob="*")
    if folder is None or pattern is None:
        raise ValueError("give the export file, or a folder and the pattern of its name")
    path = latest_snapshot(spark, folder, pattern)
    if path is None:
        raise ValueError(f"no file matches {pattern!r}")
    source = folder.where(F.col("path") == path) if isinstance(folder, DataFrame) else path
    return read_workbooks(spark, source, sheet=sheet, glob="*")
