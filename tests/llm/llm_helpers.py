"""Small tables for the tests of the operators."""

import pytest


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def docs_df(spark, rows):
    """Rows (doc_id, text) with further columns whose names clash with the
    operators' own."""
    return spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows],
                                 "doc_id long, text string, n long, hash string, rank int")
