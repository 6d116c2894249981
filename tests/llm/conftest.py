import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from prose import prose  # noqa: E402

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "shard string, slot string, kept string, group_size string, key string, word string, row_id string, "
    "size string, n string, score string, part string, bin_id string, item_id string, n_lines string, maybe string"
)


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): nulls, empty and blank texts, ties, repeated rows, a very long text."""
    base = prose(1, 60)
    long = "\n".join(prose(100 + i, 40) for i in range(400))
    return [
        (1, base),
        (2, base),
        (2, base),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (None, base),
        (None, prose(2, 30)),
        (None, None),
        (6, long),
        (7, base.upper()),
        (8, "12 345 !!"),
        (9, "two words"),
        (10, base + " " + prose(3, 3)),
        (11, "Ünïcödé 😀 text " + prose(4, 20)),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows with extra columns named like what operators add."""
    rows = [(i, t, "en", "s", None if t is None else len(t), *["x"] * 15) for i, t in edge_rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def as_docs(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    return make
