"""Small frames for the corpus operators."""

import pytest
from llm_cases import CLASHES, ODD


@pytest.fixture
def odd_docs(spark):
    names = ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(i, t, *["x"] * len(CLASHES)) for i, t in ODD], f"doc_id long, text string, {names}")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
