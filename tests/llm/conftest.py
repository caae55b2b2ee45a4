from __future__ import annotations

import random

import pytest

# Extra columns whose names operators might use themselves.
CLASHING = "row string, id string, part string, stat string, cut string, leaks string, gone string, n_lines string"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def tricky() -> list[tuple[int | None, str | None]]:
    """Null and empty texts, a very long one, copies, near copies, shared passages, repeated rows, null ids."""
    rng = random.Random(3)
    passage, base = words(rng, 60), words(rng, 200)
    near = base.split()
    near[100] = "changed"
    block = "\n".join(words(rng, 6) for _ in range(14))
    long = " ".join(words(rng, 40) for _ in range(500)) + " " + passage
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "one two"),
        (9, words(rng, 50) + " " + passage + " " + words(rng, 5)), (10, long), (11, passage + " " + passage),
        (12, words(rng, 3) + "\n" + block + "\n" + words(rng, 4)), (13, block), (14, block + "\n" + block),
        (15, "Ünïcode 日本語 😀 " + words(rng, 30)), (16, "A b C " * 30), (16, "A b C " * 30),
        (17, base.upper()), (None, base), (None, words(rng, 40)), (None, None),
        *[(100 + i, words(rng, rng.randint(5, 80))) for i in range(20)],
        *[(200 + i, base) for i in range(30)],
    ]


@pytest.fixture(scope="session")
def tricky_docs(spark, tricky):
    rows = [(i, t, *["x"] * 8) for i, t in tricky]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], f"doc_id long, text string, {CLASHING}")
