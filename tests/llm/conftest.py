from __future__ import annotations

import random

import pytest

# Columns whose names clash with those the operators make for themselves.
CLASHES = "size long, shard string, slot string, row string, n long, c string, doc string, h long, text_crc32 string, copies string, toxicity string, fingerprint string, e string, same string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
EXTRA = (1, "x", "y", "z", 2, "c", "d", 3, "t", "p", "q", "f", "e", "s")


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("bcdfglmnprst") + draw.choice("aeiou") for _ in range(draw.randint(1, 4))) for _ in range(n))


def sentences(seed: int, n: int) -> str:
    return ". ".join(words(seed * 1000 + i, 9) for i in range(n)) + "."


@pytest.fixture(scope="session", autouse=True)
def scratch(spark):
    from pagewright.llm.common import clear_scratch

    yield
    clear_scratch(spark)


@pytest.fixture(scope="session")
def make(spark):
    """make(rows) gives a documents table of (doc_id, text[, source]) with clashing columns."""

    def table(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else f"src{(r[0] or 0) % 3}", len(r[1] or ""), *EXTRA) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return table


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, long and unbroken ones, ties, repeated rows, odd characters."""
    base = sentences(1, 12)
    return [
        (1, base), (2, base), (3, base.upper()), (4, None), (5, ""), (6, " \n\t "), (None, base), (None, None), (7, sentences(2, 400)), (8, "a" * 30000), (9, "one two"), (10, "one  two"), (10, "one  two"),
        (11, "é ß ▁x <s> \x00 　 😀\n\n▁▁ tail  "), (12, sentences(3, 30) + "\n" + sentences(4, 8)), (13, sentences(5, 3) + " " + sentences(4, 8) + "\n" + sentences(6, 4), None), (14, words(9, 200)), (15, words(9, 199) + " changed"), (16, "the " * 300), (17, "x"),
    ]


@pytest.fixture(scope="session")
def odd(make, odd_rows):
    return make(odd_rows).cache()
