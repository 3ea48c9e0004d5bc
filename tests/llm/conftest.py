import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import as_docs, prose  # noqa: E402


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows and ids."""
    long = prose(99, 30_000)
    base = prose(1, 80)
    return [(1, base), (2, base), (2, base), (3, None), (4, ""), (5, "  \n\t "), (None, base), (None, None), (6, long, None, None), (7, long + " tail", "de", None),
            (8, "a"), (9, "É" * 3000), (10, "token = \"0a1b2c3d4e5f60718293a4b5c6d7e8f9\" and Aa0Bb1Cc2Dd3Ee4Ff5Gg6 end", "en", "src2"),
            (11, "mail me at a.b@c.example.com or +1 (212) 555-0153 from 10.0.0.1 4111 1111 1111 1111 now", "en", "src2"), (12, "\U0001F600 x\x00y " + base, "fr", "src3")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return as_docs(spark, odd_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return as_docs(spark, [(1, "x")]).limit(0)
