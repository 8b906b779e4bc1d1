import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, w string, score string, print string, shard string, gram string, "
    "root string, marks string, topic string, word string, predicted string, probability string, label string, n_words string, item string"
)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(2 + (r.randrange(vocabulary) + seed) % 7)) for _ in range(n))


def hard_texts():
    """(key, text): nulls, empty and blank texts, repeats, ties, near copies, shared passages, odd white space, one long text."""
    passage = prose(900, 60)
    base = prose(1, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    rows = [
        (1, base), (2, base), (3, near), (3, near), (4, None), (5, ""), (6, " \t\n "), (None, base), (None, None), (None, prose(5, 30)),
        (7, "one two three"), (8, "one two three"), (9, "ONE two\x0bthree\n\nfour  five "), (10, prose(10, 40) + " " + passage + " " + prose(11, 40)),
        (11, prose(12, 15) + "\n" + passage), (12, passage), (13, prose(13, 5000)), (14, "same " * 400), (-15, prose(14, 25) + " É Ü ß 漢字 \U0001f600 <|endoftext|> it's"),
        (16, base.upper()),
    ]
    return rows + [(100 + i, prose(200 + i, 10 + 7 * (i % 9))) for i in range(40)]


def documents(spark, rows):
    """A documents table whose other columns clash with names the operators use."""
    junk = ["x"] * 14
    return spark.createDataFrame([(k, t, ["en", "de", None][i % 3], ["a", "b", None, "c"][i % 4], None, *junk) for i, (k, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="session")
def hard(spark):
    return hard_texts()


@pytest.fixture(scope="session")
def frame(spark):
    return lambda rows: documents(spark, rows)


@pytest.fixture(scope="session")
def docs(frame, hard):
    return frame(hard).repartition(5)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])
