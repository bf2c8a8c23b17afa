import pytest
from pyspark.sql import Row


@pytest.fixture
def docs(spark):
    """Makes a documents table; rows are (doc_id, text) or dicts of more columns."""

    def make(*rows, extra=""):
        return spark.createDataFrame([Row(*r) for r in rows], "doc_id long, text string" + extra)

    return make
