"""Fixtures of the training-data tests: a corpus with copies, near copies, junk and odd rows."""

import random

import pytest

WORDS = ["ba", "de", "ki", "lo", "mu", "na", "po", "ra", "si", "tu", "ve", "zo"]


def word(rng):
    return "".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3)))


def sentence(rng, n):
    return " ".join(word(rng) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source, n_chars) rows; every odd case that the operators must bear is in here."""
    rng = random.Random(5)
    texts = ["\n".join(sentence(rng, rng.randint(9, 30)) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    for i in range(12):  # near copies: one to four words changed
        w = texts[i].split(" ")
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = word(rng)
        texts.append(" ".join(w))
    texts += [texts[0], texts[0].upper(), texts[3]]  # copies
    texts += ["", None, " \n\t ", "one", "one two", "ONE two", "été ÉTÉ \U0001f600 x", "a\x00b c\x0bd"]
    texts += [" ".join(sentence(rng, 40) for _ in range(60))]  # long
    rows = [(i, t, ["en", "fr", None][i % 3], f"src{i % 4}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[1], rows[2]]  # repeated rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def clashing(docs):
    """Columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    names = ["u", "v", "a", "b", "key", "n", "h", "e", "i", "m", "row", "kind", "start", "size", "c", "rep", "component", "first", "words", "l", "whole", "target", "__id"]
    return docs.withColumns({x: F.lit(1) for x in names})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
