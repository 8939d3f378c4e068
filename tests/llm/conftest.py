import os
import sys

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the package on its executors' path."""
    from rosterkit.llm.common import ship_package
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def make_docs(llm):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return llm.createDataFrame(full, DOCS)
    return make
