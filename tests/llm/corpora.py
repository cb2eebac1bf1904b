"""Texts for the tests, and the tables ``docs`` and ``nothing`` as fixtures to import."""

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, N_Words string, _text string"

PLAIN = ("the of and a house river stone walks under light over field green quiet morning evening "
         "small bird sings near water while old road turns past mill toward hill where wind moves "
         "grass slowly again").split()


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(PLAIN) + rng.choice(["", "", "", "s", "ed", "ing", "er"]) for _ in range(n)]
    lines = [" ".join(words[i:i + 15]) + "." for i in range(0, n, 15)]
    return "\n".join(lines)


def corpus() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, near and exact copies."""
    rng = random.Random(7)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(30)]
    passage = prose(rng, 60)
    texts = [*base, base[0], base[1], base[1] + " tail", "one more " + base[2],
             base[3] + "\n" + passage, base[4][:200] + "\n" + passage + "\n" + base[5],
             prose(rng, 5000), "", None, " \n\t ", "two words", "w", "é ü 漢字 ñ", "a " * 300,
             base[6].upper(), base[7].replace("the", "THE")]
    rows = [(i, t, rng.choice(["en", "de", None, "??"]), rng.choice(["a", "b", "é", None]),
             len(t or ""), "x", None) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, None, None, None, None, None, None),
             (None, base[8], "en", "a", 1, "y", "z"), (None, base[8], "en", "a", 1, "y", "z"),
             (5, "other text under an id that comes twice", "en", "b", 3, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)
