"""Documents with everything that the operators promise to take."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, h int, size int, node string"
WORDS = "alder birch cedar elm fir hazel larch maple oak pine rowan spruce willow yew".split()


def prose(seed: int, n: int) -> str:
    state, out = seed * 7919 + 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state % len(WORDS)] + str(state // 65536 % 50))
    return " ".join(out)


def hostile() -> list[tuple]:
    texts = [
        (1, prose(1, 120), "en", "a"), (2, prose(1, 120), "en", "a"), (3, prose(1, 119) + " changed", "en", "b"), (4, prose(4, 300), "de", "b"),
        (5, None, "en", "a"), (6, "", "en", None), (7, " \n\t ", None, "a"), (8, "one two three", "en", "a"), (9, "one two three", "en", None),
        (10, "x" * 50_000 + " " + prose(10, 4000), "en", "c"), (11, "ümläut 日本 😀 " * 30, "de", "c"), (11, "ümläut 日本 😀 " * 30, "de", "c"), (12, prose(12, 80), None, None),
        (12, prose(13, 80), None, None), (None, prose(14, 90), "fr", "a"), (None, None, None, None), (15, prose(15, 60), None, "a"),
        (16, "line one\nline two\nline one\n\nline one " * 20, "en", "\U0001f600"), (17, "mail me@host.example or +1 (415) 555-2671 from 10.0.0.1", "en", "a"),
    ]
    return [(i, t, lang, source, len(t) if t is not None else None, "clash", 1, 2, "n") for i, t, lang, source in texts]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(hostile(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
