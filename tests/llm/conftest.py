"""Small tables with what the operators must stand: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

import pytest

CLASH = "row kept doc body fp words bands v key keys start length rank score predicted spans lang_pred _id _y _doc _body stay lines share term n_lines _order".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def vocabulary(seed: int) -> list[str]:
    rnd = random.Random(seed)
    syllables = ["ta", "ro", "mi", "len", "sor", "ve", "ka", "dun", "pel", "ix"]
    return ["".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(400)]


def prose(n: int, seed: int, vocab: int = 1) -> str:
    rnd, words = random.Random(seed), vocabulary(vocab)
    return " ".join(rnd.choice(words) + (".\n" if i % 9 == 8 else "") for i in range(n))


EDGES = [
    (None, "a text without an id, of some words more", "en", "s", 1),
    (1, None, "en", "s", 0),
    (2, "", None, "s", 0),
    (3, " \n\t ", "en", None, None),
    (4, "one", "en", "s", 3),
    (4, "one", "en", "s", 3),
    (5, "tie tie tie\ntie tie tie", "fr", "s", 20),
    (6, "12345 !!! ???", "fr", "s", 10),
    (7, "é" * 30_000, "fr", "s", 30_000),
    (8, " " * 30_000 + "x", "en", "s", 30_001),
    (9, prose(6000, 9), "en", "hot", 9),
    (10, prose(120, 10), "en", "hot", 9),
    (11, prose(120, 10), "de", "hot", 9),
    (12, "漢字 😀 ok\r\nnext\x0bline\x00 end", "de", "s", 9),
    (None, None, None, None, None),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Every edge at once, with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGES, SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASH})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def tables(spark, tmp_path):
    """Write documents (and others) as driver tables; gives the folder."""

    def write(**frames) -> str:
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
