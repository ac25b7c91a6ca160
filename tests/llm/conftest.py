import random

import pytest

from hazardlake.session import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


def prose(seed: int, words: int, letters: str = "etaoinshrdlu") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(words))


def odd_rows():
    """Nulls in any column, empty, blank and very long texts, repeated rows, accents, ties."""
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a", 3),
        (2, base + " " + prose(2, 30), "en", "a", None),
        (3, None, "en", None, None),
        (4, "", None, "b", 0),
        (5, " \t\n\x0b ", "de", "b", 5),
        (6, prose(3, 20_000), "en", "b", 9),
        (7, "Füße ÉTÉ naïve — 日本語   x" + " é" * 40, "fr", "c", 1),
        (7, "Füße ÉTÉ naïve — 日本語   x" + " é" * 40, "fr", "c", 1),
        (None, base, "en", "c", 2),
        (8, base.upper(), "en", "c", 2),
        (9, "one two three", "en", "c", 2),
        (10, prose(4, 60) + "\n" + base + "\n" + prose(5, 60), "en", "d", 2),
        (11, "word " * 500, "en", "d", 2),
        (12, "word " * 500, "en", "d", 2),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


#: Names that the operators use inside.
CLASHES = ("doc", "key", "hits", "n_words", "score", "sequence_id", "fingerprint", "spans", "lines", "_key", "lang_pred")


@pytest.fixture(scope="session")
def clashing(odd):
    for name in CLASHES:
        odd = odd.withColumn(name, odd["source"])
    return odd
