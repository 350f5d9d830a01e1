from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, uid long, label int, n_words string, _number int, digest string, node int, first boolean, sequence_id string"


def frame(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns that operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), 5, 1, "n", 3, "d", 2, True, "q") for r in rows]
    return spark.createDataFrame(full, COLUMNS)


LONG = " ".join(f"word{k % 977}" for k in range(60_000))


@pytest.fixture
def odd_rows():
    """Nulls, empty and very long texts, repeated ids and rows, white space, wide characters."""
    return [
        (None, "lonely words without an id"),
        (1, None),
        (None, None),
        (2, ""),
        (3, LONG),
        (4, "the same row"),
        (4, "the same row"),
        (4, "the same id with another text"),
        (5, " \n\t "),
        (6, "naïve  café\n\n日本語 <|endoftext|> 😀"),
        (7, "x" * 5000),
        (8, "lang is null", None),
    ]


@pytest.fixture
def odd(spark, odd_rows):
    return frame(spark, odd_rows)


@pytest.fixture
def nothing(spark):
    return frame(spark, [])
