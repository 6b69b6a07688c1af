import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: Nulls, empty and long texts, copies, repeated rows and ids, a null id, odd characters.
LONG = " ".join(f"w{k % 97} v{k % 89}" for k in range(9_000))
ROWS = [
    (1, "Alpha beta gamma delta " * 8, "en", "a", 10),
    (2, "Alpha beta gamma delta " * 8, "en", "a", 10),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", "de", "b", 4),
    (6, LONG, "en", "a", len(LONG)),
    (7, "x" * 5_000, "en", None, 5_000),
    (8, "Ärger über 日本語 😀 ▁ password = abc123def456 ende", "de", "b", 9),
    (8, "Ärger über 日本語 😀 ▁ password = abc123def456 ende", "de", "b", 9),
    (9, "same id, first text", "en", "a", 3),
    (9, "same id, second text", "en", "a", 3),
    (None, "a row without an id", "en", "a", 1),
    (10, LONG + " tail", "en", "a", 1),
]
#: Columns that operators might use themselves.
EXTRA = "text_key long, runs string, kept string, score string, piece_ids string, id long, band long"


@pytest.fixture(scope="session")
def spark():
    from procrisk.session import local_session

    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, 1, "r", "k", "s", "p", 2, 3) for r in ROWS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
