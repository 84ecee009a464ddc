"""Small frames with the awkward cases that every operator must take."""

import os

import pytest

from cases import EXTRA, ROWS, SCHEMA

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="session")
def awkward(spark):
    from riskloom.session import ship

    ship(spark)
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), *["x"] * len(EXTRA)) for i, t, lang, s in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def scratch(spark):
    from riskloom.llm.common import Scratch

    s = Scratch(spark)
    yield s
    s.drop()
