import random

import pytest

SCHEMA = "doc_id long, text string, lang string, mark string, place int, spans string, n_words int, gone int, shared int, __mark long, __place int, __spans string, __text string, __kept int, __gone int, before int, after int"
WORDS = "ab cd ef gh ij kl mn op qr st uv wx yz é ß ü 12 x9".split()


@pytest.fixture
def frame(spark):
    """Documents with columns that have the names of the operators' own."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "m", 1, "s", 2, 3, 4, 5, 6, "p", "t", 7, 8, 9, 10) for i, t in rows], SCHEMA)
    return make


@pytest.fixture
def prose():
    def make(seed, n, vocabulary=WORDS):
        draw = random.Random(seed)
        return " ".join(draw.choice(vocabulary) + draw.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))
    return make
