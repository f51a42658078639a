import pytest


@pytest.fixture
def docs(spark):
    """Rows with every awkward case, and columns that clash with names the operators use."""

    def make(texts, **more):
        rows = [(i, t, "x", "clash", 1.0, "score") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n double, score string")

    return make


AWKWARD = [None, "", " ", "\n\t ", "a", "é日😀", "same text here now", "same text here now", "\x00﻿", "word " * 30_000]


@pytest.fixture
def awkward():
    return list(AWKWARD)
