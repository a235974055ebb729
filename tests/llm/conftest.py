import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_SMALL = "/root/testdata/sf0.001"

# Nulls, empty and very long texts, ties, repeated rows, an id twice, columns with clashing names.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf tonight"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf tonight"),
    (5, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf tonight"),
    (6, "alpha " * 300),
    (6, "alpha " * 300),
    (7, "one two three"),
    (None, "so the quick brown fox jumps over the lazy dog and runs away from the big bad wolf again"),
    (None, None),
    (8, "é ü ñ ß " * 40 + "x" * 5000 + " " + "word " * 20000),
]


@pytest.fixture(scope="session")
def odd(spark):
    """ODD with extra columns named like the operators' own."""
    rows = [(i, t, f"k{n}", n, "r") for n, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int, row string")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
