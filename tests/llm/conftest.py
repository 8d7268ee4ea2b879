import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from texts import prose  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, copies, repeated rows, and columns whose names operators use themselves."""
    rows = [
        (1, prose(1)),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, prose(1)),
        (5, prose(1)),
        (6, prose(2, 30_000)),
        (7, "É <|endoftext|> x y z\x1cq İstanbul ΣΑΣ café   ﬁ"),
        (None, prose(3)),
        (8, prose(3)),
        (9, "one"),
        (10, "a" * 100_000),
        (11, prose(4) + " jo.81@mail3.example.com +1 (013) 555-9871 4111 1111 1111 1111 1.2.3.4"),
    ]
    clash = "digest string, keep_id long, n long, fp long, key string, row string, body string, first long, label int, part int, score double"
    values = [(i, t, "en" if t else None, "s", len(t or ""), *["clash", 7, 7, 7, "k", "r", "b", 7, 7, 7, 0.7]) for i, t in rows]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {clash}"
    return spark.createDataFrame(values, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
