from __future__ import annotations

import pytest

from tillroll.llm.inputs import ship

WORDS = "river stone cloud amber field winter candle copper meadow lantern harbor violet".split()


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(llm):
    """Rows that every operator over documents must take: nulls, blanks, repeats, long texts,
    columns whose names clash with those the operators add."""
    long = " ".join(WORDS[(i * i) % len(WORDS)] + str(i % 97) for i in range(40_000))
    rows = [
        (1, "river stone cloud amber field", "en", "a"),
        (1, "river stone cloud amber field", "en", "a"),
        (2, None, "en", "a"),
        (3, "", "de", None),
        (4, " \t\n", None, "b"),
        (5, long, "en", "b"),
        (6, "x", "en", None),
        (None, "river stone cloud amber field", None, "c"),
        (None, None, None, None),
        (7, "12345 !!! \U0001f600 ß é", "de", "c"),
    ]
    extra = [(*r, "clash", -1, "own", "own") for r in rows]
    schema = "doc_id long, text string, lang string, source string, taken string, fp int, _fp string, _id string"
    return llm.createDataFrame(extra, schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
