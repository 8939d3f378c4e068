"""rosterkit: record reconciliation and reporting as Spark DataFrame plans.

Sub-packages
------------
functions  Column -> Column expressions (text, dates, classification)
operators  DataFrame -> DataFrame building blocks (schema resolution,
           dedupe, membership, as-of lookups)
plans      the three user-level jobs: scorecard, reconcile (+ import
           template), employer reports
sources    workbook (.xlsx) data source, latest-snapshot finder, sinks
streaming  incremental form of the employer report over a message stream
checks     check queries on the driver tables and their SQL oracles
"""

__version__ = "0.1.0"
