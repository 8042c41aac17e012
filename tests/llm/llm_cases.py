"""Fixtures and odd rows for the tests of the operators for training data."""

import pytest

from forecourt.llm.shared import importable


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text, and columns whose names the operators use inside) as a table of documents."""
    importable(spark)
    schema = "doc_id long, text string, digest string, row long, bucket int, _text string"
    return lambda rows: spark.createDataFrame([(i, t, "d", 7, 1, "x") for i, t in rows], schema)


#: Nulls, empty and blank texts, ties, repeated rows, odd characters, one long text.
ODD = [
    (3, "one two three four five six seven eight nine ten eleven"),
    (1, "one  two three\tfour five six seven eight nine ten eleven"),
    (9, "one two three four five six seven eight nine ten eleven"),
    (9, "one two three four five six seven eight nine ten eleven"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (None, "a text without an id, which is as long as any other text of its kind in here"),
    (None, "a text without an id, which is as long as any other text of its kind in here"),
    (7, "naïve café — 漢字 ΑΣ   x　y"),
    (8, "word " * 3000),
    (2, "All rights reserved. CC BY 4.0; GNU General Public License, version 3."),
]


@pytest.fixture
def odd(docs):
    return docs(ODD)


@pytest.fixture
def sample(spark):
    """Some hundred documents of the smallest tables."""
    importable(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
