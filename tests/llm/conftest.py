from __future__ import annotations

import pytest

#: a null text, an empty one, one without words, a very long one, repeated rows, a null id, clashing columns
LONG = "one two three four five six seven eight nine ten. " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    def make(texts: list[tuple[int | None, str | None]]):
        rows = [(i, t, "en", "s", None, 7, "x") for i, t in texts]
        schema = "doc_id long, text string, lang string, source string, n_chars long, n_removed long, id string"
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture(scope="session")
def plain_odd_rows():
    return [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (4, LONG), (None, "a b c d e f g h."), (None, None), (5, "Ünï ß 7 É.")]
