import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


@pytest.fixture
def words():
    return WORDS


@pytest.fixture
def make_text():
    def make(seed: int, n: int) -> str:
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + str(r.randrange(300)) for _ in range(n))

    return make


@pytest.fixture
def frame(spark):
    def build(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return build
