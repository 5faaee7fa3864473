import random

import pytest

WORDS = "alpha bravo Charlie delta echo foxtrot golf hotel india juliet kilo Lima mike été über niño".split()


@pytest.fixture
def pick():
    return random.Random(3)


@pytest.fixture
def prose(pick):
    """Makes texts of so many words that hardly repeat by chance."""

    def make(n, line=0):
        words = [pick.choice(WORDS) + str(pick.randrange(1000)) for _ in range(n)]
        if line:
            return "\n".join(" ".join(words[i : i + line]) for i in range(0, n, line))
        return " ".join(words)

    return make


@pytest.fixture
def documents(spark):
    """Rows of id and text, with further columns whose names clash with inner ones."""

    def make(rows):
        kind = "doc_id bigint, text string, words int, _id string, _text string, n_chars bigint, cls int"
        full = [(i, t, 7, "x", "y", None if t is None else len(t), 1) for i, t in rows]
        return spark.createDataFrame(full, kind)

    return make
