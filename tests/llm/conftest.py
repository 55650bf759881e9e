from __future__ import annotations

import pytest

SMALL_DIR = "/root/testdata/sf0.001"
MIDDLE_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def middle():
    return MIDDLE_DIR


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) pairs, with the other columns filled in."""

    def made(rows):
        full = [(i, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return made
