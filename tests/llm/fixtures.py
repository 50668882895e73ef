"""Tables that the tests of the corpus operators share."""

import random

import pytest


# Names that operators use inside; a table may have them too.
CLASHING = "key digest fp line band slot shard size ids spans items n_words score copy component kept range"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows of (doc_id, text) as a table with other columns, some of them null."""

    def make(rows, partitions=3):
        names = CLASHING.split()
        full = [(d, t, None if i % 2 else "en", *[None if i % 3 else str(i)] * len(names)) for i, (d, t) in enumerate(rows)]
        schema = "doc_id bigint, text string, lang string, " + ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, null and repeated ids, ties, repeated rows, and a very long text."""
    rng = random.Random(5)
    long = words(rng, 30_000)
    first = words(rng, 120)
    return [
        (1, first), (2, first), (2, first), (3, None), (4, ""), (None, first), (None, None), (5, " \t\n"),
        (6, long), (6, long), (7, first + " tail"), (7, "other " + first), (8, "İstanbul 中文字 naïve — É!"), (9, "x" * 5000),
    ]
