from __future__ import annotations

import pytest

#: Texts with every awkward case: null, empty, blanks, copies, other scripts, long.
BASE = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
TEXTS = [
    (1, BASE),
    (2, BASE.upper()),  # the same words
    (3, BASE + " seventeen"),
    (4, None),
    (5, ""),
    (6, " \t\n\x0b\x0c\r "),
    (7, "three words only"),
    (8, "Three  words\tonly"),
    (9, "A line that many documents have\nown line of nine\n\na line THAT many documents have  "),
    (10, "\x0bA line that many documents have\nshort\nshort\n"),
    (11, "short\nÉtrange ligne accentuée\nKK kelvin sign line"),
    (12, "étrange ligne accentuée\nÉtrange ligne accentuée\nkk kelvin sign line"),
    (13, "word " * 40_000 + "A line that many documents have"),
    (14, "x" * 300_000),
    (None, BASE),
    (None, None),
    (1, BASE),  # a repeated row
    (7, "another text under a used id, with a few more words than that"),
    (15, "12345 !!! ...\n😀😀"),
    (16, "Ünïcödé \U0001f600 text"),
]


@pytest.fixture(autouse=True, scope="session")
def few_partitions(spark):
    """The fixtures are small: fewer tasks, same results."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def awkward(spark):
    """The texts with further columns whose names the operators use themselves."""
    rows = [(i, t, "en" if n % 2 else None, n, f"k{n}", 1.5, [n]) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, n long, key string, rate double, `rejected` array<int>"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n long")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
