import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import DOC, tricky_rows  # noqa: E402


@pytest.fixture(scope="session")
def tricky(spark):
    return spark.createDataFrame(tricky_rows(), DOC)


@pytest.fixture(scope="session")
def tricky_clash(spark, tricky):
    """The same rows with columns whose names the operators use inside or return."""
    from pyspark.sql import functions as F
    names = ["node", "row", "md5", "size", "target", "copies", "grp", "hash", "kept", "root", "text_hash", "id", "c_0", "trusted", "rank", "part", "first", "m", "s"]
    return tricky.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)
