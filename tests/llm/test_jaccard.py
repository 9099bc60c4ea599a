"""The Jaccard join against all pairs."""

import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrina.llm import jaccard
from vitrina.llm.components import components


def shingle_set(text, k):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, k, num, den):
    sets = {}
    for i, t, *_ in rows:
        sets[i] = shingle_set(t, k)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((i, len(sets[i]), find(i)) for i, *_ in rows)


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 80, 100), (2, 60, 100)])
def test_groups_match_all_pairs(docs, corpus, k, num, den):
    assert got(jaccard.jaccard_groups(docs, k, num, den)) == brute(corpus, k, num, den)


def test_many_near_copies_and_chains(spark, monkeypatch):
    """Long lists, pivots that do not link, and chains; with lists cut short so that the second round runs."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    rows = []
    for i in range(40):  # drifting away word by word
        base[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(base)))
    for i in range(40, 80):  # a shared passage, unlike otherwise
        rows.append((i, " ".join([f"p{j}" for j in range(30)] + [f"y{rng.randrange(10**6)}" for _ in range(rng.choice([6, 7, 8]))])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "SHORT", 2)
    for num in (70, 80, 90):
        assert got(jaccard.jaccard_groups(df, 3, num, 100)) == brute(rows, 3, num, 100)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(0, 14), st.integers(0, 14), st.sampled_from([(9, 10), (8, 10), (7, 10)]), st.integers(0, 30), st.randoms(use_true_random=False))
def test_linked_sets_share_a_key(both, more_x, more_y, share, small, rng):
    """Whatever the boundary, sets that link share a key."""
    num, den = share
    # the boundary that cost chooses never asks for so many subsets of one set
    subsets = lambda s: sum(math.comb(n, c) for n in (both + more_x, both + more_y) for c in jaccard.overlaps(n, s, num, den))
    while small and subsets(small) > 20_000:
        small -= 1
    pool = np.array([rng.getrandbits(64) for _ in range(both + more_x + more_y)], np.uint64)
    x, y = np.unique(pool[: both + more_x]), np.unique(np.r_[pool[:both], pool[both + more_x :]])
    keys = [set(jaccard.keys_of(np.array([1]), np.array([0, len(s)]), s, small, num, den)[1].tolist()) for s in (x, y)]
    if den * len(np.intersect1d(x, y)) >= num * len(np.union1d(x, y)):
        assert keys[0] & keys[1]


def test_one_per_group_and_odd_tables(docs, clashing, no_docs, corpus):
    kept = sorted(r[0] for r in jaccard.one_per_group(clashing).select("doc_id").collect())
    gone = {i for i, _, c in brute(corpus, 5, 80, 100) if c != i}
    assert kept == sorted(r[0] for r in corpus if r[0] not in gone)
    assert jaccard.one_per_group(clashing).columns == clashing.columns
    assert jaccard.jaccard_groups(no_docs).count() == 0


def test_null_id(spark):
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (2, "a b c")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.jaccard_groups(df, 3).collect()), key=str) == [(1, 1, 1), (2, 1, 1), (None, 1, None)]


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(50, 40), (40, 60), (70, 70)]
    got_ = {r[0]: r[1] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got_ == {**{i: 0 for i in range(31)}, 40: 40, 50: 40, 60: 40}
