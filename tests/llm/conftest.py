"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, extra and clashing columns."""

import pytest

LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture(scope="session")
def docs(spark):
    base = "the quick brown fox jumps over the lazy dog while seven wizards watch from the hill and drink their tea in silence"
    data = [
        (1, base, "en", "a"), (2, base + " today", "en", "a"), (3, base.upper(), "en", "b"), (4, None, "en", "b"), (5, "", None, None), (6, "  \n\t", "en", None), (7, LONG, "en", "c"),
        (8, "two words", "en", "c"), (9, "two words", "en", "c"), (9, "two words", "en", "c"), (10, "word", None, "a"), (None, base, "en", "a"), (None, "nobody links me at all here", "en", "a"),
        (11, "nul \x00 and \U0001f600 ▁ <s>[INST]</s>", "en", "é"), (12, "completely different text about nothing that was said before in this table", "en", "é"),
    ]
    rows = [(i, t, lang, s, "x", 0.5, -1) for i, t, lang, s in data]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string, n double, node long")


def collect(df):
    return [tuple(r) for r in df.collect()]
