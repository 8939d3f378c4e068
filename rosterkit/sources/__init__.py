"""Sources and sinks: workbook files, attachment bytes, latest snapshot,
multi-table and partitioned writes."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SHIPPED: set[int] = set()


def ship(spark: SparkSession) -> None:
    """Make the executor-side decoding code importable on every worker.

    The decoding module depends only on the standard library, so it is
    pickled *by value* with the tasks instead of requiring the package to
    be installed on the executors."""
    from pyspark import cloudpickle

    from ..operators import schema
    from . import layouts, xlsx_rows
    if id(xlsx_rows) not in _SHIPPED:
        cloudpickle.register_pickle_by_value(xlsx_rows)
        cloudpickle.register_pickle_by_value(schema)      # the sheet chooser
        cloudpickle.register_pickle_by_value(layouts)
        _SHIPPED.add(id(xlsx_rows))
