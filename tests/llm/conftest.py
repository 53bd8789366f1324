"""Edge rows and a small corpus for the corpus operators."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, _text_key string"


def prose(rng, words, vocabulary=4000, prefix="w"):
    return " ".join(f"{prefix}{rng.randrange(vocabulary)}" for _ in range(words))


def edge_texts():
    """(doc_id, text): nulls, empty and blank texts, ties, repeated rows, signs only, a very long text."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    body = prose(rng, 120)
    words = body.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    passage = prose(rng, 70, prefix="p")
    lines = "first line here\nsecond line here\nthird line here\nfourth line here"
    return [
        (1, body), (2, body), (2, body), (3, near), (4, None), (5, ""), (6, " \n\t "), (7, "!!! ??? ..."), (8, "one"),
        (9, "one two three four five"), (10, long), (11, long + " end"), (12, prose(rng, 90) + " " + passage + " " + prose(rng, 40)),
        (13, prose(rng, 80) + " " + passage + " " + prose(rng, 60)), (14, lines), (15, "x\n" + lines + "\ny"), (16, "a\nb"),
        (17, "naïve café 'S it's don't x   42,5 日本語 👍🏽 é <|endoftext|>"), (18, "\n\n\n\n"), (19, body.upper()),
        (None, "a row without an id"), (None, None),
    ]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "en", "s", 1, 7, "k", "x") for i, t in edge_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark, sf):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
