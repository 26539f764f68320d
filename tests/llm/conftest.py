import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def words():
    """A function giving n words drawn from a small vocabulary."""

    def draw(seed, n, size=40):
        rng = random.Random(seed)
        vocabulary = [f"w{k}" for k in range(size)]
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    return draw


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, very long and repeated texts; null and repeated ids; columns with clashing names."""
    long_text = "lorem ipsum dolor " * 40_000
    rows = [
        (1, None, "en", "a", 7),
        (2, "", "en", "a", 7),
        (3, " \t\n ", None, None, None),
        (4, long_text, "en", "b", 1),
        (5, "same words here again and again", "en", "a", 1),
        (5, "same words here again and again", "en", "a", 1),
        (None, "same words here again and again", "en", "a", 1),
        (6, "Ünïcode wörds « et » ponctuation", "fr", "b", 1),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return frame.selectExpr("*", "1 AS fingerprint", "2 AS text_key", "'x' AS host_key", "3 AS hits", "4 AS id")
