import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import DOCS, LABELS, SF, rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "x"), (2, None, None, None), (6, 0, 1, ""), (None, 1, 1, ""), (99, 1, 1, ""), (7, 5, 7, "")] , LABELS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)


@pytest.fixture(scope="session")
def texts_of():
    """doc_id to text of the small fixture."""
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF}/documents.parquet")
    return dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
