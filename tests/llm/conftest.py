import random

import pytest
from cases import make_docs


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7))) for _ in range(300)]


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda texts, extra=True: make_docs(spark, texts, extra)
