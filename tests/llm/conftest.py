import random

import pytest

UPPER = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LONG = "word" * 700_000      # one word far longer than a piece


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    """(id, text) of the smallest documents table."""
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").orderBy("doc_id").collect()]


def odd_rows():
    """(id, text, lang, source): missing values, empty, long and repeated texts, ties, and near copies."""
    dice = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta", "Ωmega", "iota", "kappa", "and", "the", "of"]
    body = " ".join(dice.choice(vocabulary) + str(dice.randrange(40)) for _ in range(400))
    other = "\n".join(" ".join(dice.choice(vocabulary) for _ in range(12)) for _ in range(20))
    many = " ".join(dice.choice(vocabulary) + str(dice.randrange(500)) for _ in range(30_000))
    near = body.replace("alpha1 ", "changed ", 1)
    return [
        (1, body, "en", "a"), (2, body, "en", "b"), (3, near, "en", None), (4, near.translate(UPPER), None, "a"),
        (5, None, "de", "a"), (6, "", "de", None), (7, " \t\n ", None, "b"), (8, "one two three", "de", "c"),
        (9, "one two three", "en", "c"), (9, "one two three", "en", "c"), (10, other, "de", "c"), (11, other + "\n" + other, "de", "c"),
        (12, LONG, None, "d"), (13, many, "en", "d"), (14, many, "en", "d"), (None, body, "en", "a"), (None, None, None, None),
        (15, "1234 !!", "en", "e"), (16, "Licensed under the MIT License and the Apache License, Version 2.0.", "en", "e"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows in a table with further columns whose names the operators use themselves."""
    columns = "doc_id long, text string, lang string, source string, n_chars long, version int, score string, h int, label int, row int, spans string, `key` int"
    rows = [(*r, len(r[1] or ""), 1, "s", 2, 3, 4, "x", 5) for r in odd_rows()]
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
