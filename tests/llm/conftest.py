import random

import pytest

from voltway.llm import common

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, score double, key string, n_tokens string, held_out int, rank int"


def prose(n, seed=0, stops=7):
    rng = random.Random(seed)
    parts = ["na", "ti", "ré", "on", "er", "sch", "a", "lo", "x9"]
    words = ["".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if i % stops == stops - 1 else "") for i, w in enumerate(words))


TEXTS = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "Two words"), (5, prose(60, 1)), (6, prose(60, 1)), (7, prose(60, 1).replace("on", "ON", 1)), (8, prose(6000, 2)),
    (8, prose(6000, 2)), (None, prose(80, 3)), (9, "don't we'LL <|endoftext|> x ①２３ ΣΑΣ é é ﬁ  a b \x00\x1c.,'s 🎉🎉"), (10, "\n".join([prose(30, 4)] * 4)),
    (11, "All rights reserved. cc by cc by, CC-BY general public license"), (12, "word " * 100), (13, prose(61, 1)),
]


@pytest.fixture(scope="session")
def texts():
    return TEXTS


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns whose names operators use themselves."""
    common.importable(spark)
    return spark.createDataFrame([(i, t, "en", "s", 1, 7, 0.5, "k", "t", 1, 2) for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
