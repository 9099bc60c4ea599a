"""Line dedup against all pairs of lines."""

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrina.llm import lines

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) <= 1
    return len(y) - len(x) == 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute(rows, exact_words=lines.EXACT_WORDS, edit_words=lines.EDIT_WORDS):
    every = sorted({(i, n, tuple(re.findall(r"[^\x20\x09-\x0D]+", x.translate(LOWER)))) for i, t, *_ in rows for n, x in enumerate((t or "").split("\n"))})
    every = [x for x in every if len(x[2]) >= exact_words]
    out = set()
    for k, (i, n, w) in enumerate(every):
        before = [x[2] for x in every[:k]]
        if w in before:
            out.add((i, n, "exact"))
        elif len(w) >= edit_words and any(len(b) >= edit_words and one_edit(w, b) for b in before):
            out.add((i, n, "near"))
    return out


def corpus_of_lines():
    rng = random.Random(11)
    stock = [[f"w{rng.randrange(40)}" for _ in range(rng.randint(3, 14))] for _ in range(40)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(1, 5)):
            w = list(rng.choice(stock))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w[at : at + rng.choice([0, 1])] = rng.choice([[], ["NEW"], [f"v{rng.randrange(9)}"]])
                w = w or ["x"]
            text.append(rng.choice([" ", "  ", "\t"]).join(w))
        rows.append((i, "\n".join(text)))
    # a form of which thousands of copies would differ in one place
    rows += [(100 + i, f"this is page {i} of the report on the year") for i in range(40)]
    return rows


def test_matches_all_pairs(spark):
    rows = corpus_of_lines()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {tuple(r) for r in lines.repeated_lines(df).collect()} == brute(rows)


def test_shuffled_path_is_the_same(spark, monkeypatch):
    rows = corpus_of_lines()
    monkeypatch.setattr(lines, "MAX_BROADCAST_LINES", -1)
    monkeypatch.setattr(lines, "MANY", 1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert {tuple(r) for r in lines.repeated_lines(df).collect()} == brute(rows)


def test_odd_rows(docs, clashing, no_docs, corpus):
    want = brute(corpus)
    assert {tuple(r) for r in lines.repeated_lines(docs).collect()} == want
    assert lines.repeated_lines(no_docs).count() == 0
    out = lines.dedup_lines(clashing)
    assert out.columns == clashing.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    for i, t, *_ in corpus:
        kept = [x for n, x in enumerate((t or "").split("\n")) if (i, n, "exact") not in want and (i, n, "near") not in want]
        touched = any(x[0] == i for x in want)
        if not touched:
            assert rows[i]["text"] == t
        elif any(x.strip(" \t\n\x0b\x0c\r") for x in kept):
            assert rows[i]["text"] == "\n".join(kept) and rows[i]["n_chars"] == len("\n".join(kept))
        else:
            assert i not in rows


def test_null_ids_stay(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e"), (2, "a b c d e")], "doc_id long, text string")
    assert [tuple(r) for r in lines.repeated_lines(df).collect()] == [(2, 0, "exact")]
    assert lines.dedup_lines(df.withColumn("n_chars", F.length("text"))).count() == 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=7), st.lists(st.integers(0, 2), max_size=7))
def test_one_edit(x, y):
    assert lines.within_one_edit(np.array(x, np.uint64), np.array(y, np.uint64)) == one_edit(tuple(x), tuple(y))
