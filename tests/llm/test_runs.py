"""Lyndon arrays and periodic runs against their definitions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrina.llm import queries, runs

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
SMALL = st.lists(st.integers(0, 3), max_size=40)


def brute_lyndon(s):
    out = []
    for i in range(len(s)):
        best = 1
        for j in range(i + 1, len(s) + 1):
            w = s[i:j]
            if all(w < w[k:] for k in range(1, len(w))):
                best = j - i
        out.append(best)
    return out


def brute_runs(w, least=24, exponent=3):
    n, found = len(w), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic(rng, n, letters):
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(3):
        a, q, m = rng.randrange(n), rng.randint(1, 12), rng.randint(5, 70)
        w[a : a + m] = [w[min(a + k % q, n - 1)] for k in range(len(w[a : a + m]))]
        if rng.random() < 0.3:
            w[rng.randrange(n)] = rng.randrange(letters)
    return w


@settings(max_examples=400, deadline=None)
@given(SMALL)
def test_lyndon_arrays_of_both_orders(s):
    assert runs.lyndon_array(s) == brute_lyndon(s)
    assert runs.lyndon_array([-x for x in s]) == brute_lyndon([-x for x in s])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=60), st.integers(2, 12), st.integers(2, 4))
def test_runs_of_short_sequences(s, least, exponent):
    assert sorted(runs.runs_of(np.array(s, np.int64), least, exponent), key=lambda r: (r[0], r[2])) == brute_runs(s, least, exponent)
    text = " ".join(map(str, s)).encode()
    assert runs._piece([text], least, exponent)[0][1] == brute_runs(s, least, exponent)


@pytest.mark.parametrize("seed", range(60))
def test_sieve_and_runs_of_long_texts(seed):
    rng = random.Random(seed)
    many = [periodic(rng, rng.randint(1, 400), rng.choice([2, 3, 50])) for _ in range(5)]
    got = runs._piece([" ".join(f"w{x}" for x in w).encode() for w in many], 24, 3)
    for w, (n, found, _) in zip(many, got, strict=True):
        assert n == len(w) and found == brute_runs(w)


def test_texts_side_by_side_do_not_meet():
    one = " ".join(["a b c"] * 6).encode()  # 18 words each: no run alone
    assert [r for _, r, _ in runs._piece([one, one, b"", one], 24, 3)] == [[], [], [], []]


def test_wrong_hashes_do_not_change_runs(monkeypatch):
    rng = random.Random(1)
    w = periodic(rng, 300, 2)
    monkeypatch.setattr(runs._Extensions, "hashes", lambda self, a, b: np.zeros(len(a), np.uint64))  # every comparison claims equality
    assert sorted(runs.runs_of(np.array(w, np.int64)), key=lambda r: (r[0], r[2])) == brute_runs(w)


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def brute_row(doc_id, text):
    w = planted(doc_id, text)
    found = brute_runs(w) if len(set(w)) < len(w) else []
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = None
    for s, n, q in found:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def digests(docs):
    return rows_of(runs.run_digests(runs.periodic_runs(runs.with_planted_runs(docs))))


def test_whole_table(spark, docs, corpus):
    rng = random.Random(9)
    odd = [(1000 + i, " ".join(map(str, periodic(rng, rng.randint(20, 700), 3))), "en", "s", 1) for i in range(60)]
    odd += [(None, "a b", None, None, None), (2000, "x " * 5000, None, None, None), (2001, "x" * 200_000, None, None, None)]
    got = digests(docs.unionByName(spark.createDataFrame(odd, docs.schema)))
    assert got == sorted((brute_row(i, t) for i, t, *_ in corpus + odd), key=repr)
    assert any(r[1] > 1 for r in got)


def test_clashing_columns_and_no_rows(docs, clashing, no_docs):
    assert digests(clashing) == digests(docs) and digests(no_docs) == []


def test_operator_gives_runs_and_texts(spark):
    docs = spark.createDataFrame([(1, "so " + "on and on, " * 10 + "end"), (2, "a b")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(docs).collect()}
    assert got == {1: (32, [(1, 30, 3)], "so on and on, end"), 2: (2, [], "a b")}
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, min_exponent=1)


def test_query_on_given_rows(spark):
    folder = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: r for r in rows_of(queries.op13_periodic_runs(spark, folder))}
    short = [t for t in texts if len(t[1] or "") < 6000]
    assert len(got) == len(texts) and len(short) > 100
    assert all(got[i] == brute_row(i, t) for i, t in short)
