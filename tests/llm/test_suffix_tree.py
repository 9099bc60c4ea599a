"""Suffix-tree scoring against a plain version, and as a probability distribution."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from vitrina.llm import suffix_tree as pst

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = object()


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), END]


def plain(rows, max_depth, min_word, min_context, min_entry):
    """The same model, written with dictionaries."""
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    train = [tokens(r[1]) for r, h in zip(rows, held, strict=True) if not h]
    c = Counter(w for t in train for w in t)
    total, distinct = sum(c.values()), len(c)
    often = {w for w, x in c.items() if x >= max(1, min_word * total)}
    seen = defaultdict(Counter)  # context -> next word
    for d in range(1, max_depth + 1):
        for t in train:
            for i in range(d, len(t)):
                seen[tuple(t[i - d : i])][t[i]] += 1
    level, size = [(w,) for w in often if w is not END and c[w] >= min_context * total], {(w,): c[w] for w in often}
    states = {}

    def p(context, w):
        if not context:
            return (c[w] + 1) / (total + distinct + 1)
        if context not in states or not states[context]["on"]:
            return p(context[1:], w)
        s = states[context]
        return s["p"][w] if w in s["p"] else s["rest"] * p(context[1:], w)

    for _ in range(max_depth):
        longer = []
        for s in level:
            m = size[s]
            kept = {w: x for w, x in seen[s].items() if w in often and x >= max(2, min_entry * total)}
            own = {w: (x - pst.DISCOUNT) / m for w, x in kept.items()}
            below = {w: p(s[1:], w) for w in kept}
            rest, rest_below = 1 - sum(own.values()), 1 - sum(below.values())
            gain = m * (sum(x * math.log(x / below[w]) for w, x in own.items()) + rest * math.log(rest / rest_below))
            states[s] = {"p": own, "rest": rest / rest_below, "on": gain > 0.5 * len(own) * math.log(max(m, 2)) + 3}
            for w, x in kept.items():
                if w is not END and x >= min_context * total:
                    longer.append((*s, w))
                    size[(*s, w)] = x
        level = longer
    out = []
    for r, h in zip(rows, held, strict=True):
        t, score = tokens(r[1]), 0.0
        for i, w in enumerate(t):
            context = ()
            for d in range(min(max_depth, i), 0, -1):
                if tuple(t[i - d : i]) in states:
                    context = tuple(t[i - d : i])
                    break
            score += math.log10(p(context, w))
        out.append((r[0], h, len(t), sum(c[w] > 0 for w in t), total, sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in t), score))
    return out, sum(s["on"] for s in states.values())


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(sorted(a, key=str), sorted(b, key=str), strict=True):
        assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], rel=1e-9, abs=1e-9)


@pytest.fixture(scope="module")
def talk():
    """Texts in which what follows depends on one or two words before."""
    rng = random.Random(2)
    out = []
    for i in range(300):
        t = []
        for _ in range(rng.randint(0, 60)):
            if len(t) > 1 and t[-2:] == ["a", "b"]:
                t.append(rng.choice(["c", "c", "c", "d"]))
            elif t and t[-1] == "a":
                t.append(rng.choice(["b", "b", "x"]))
            else:
                t.append(rng.choice(["a", "A", "b", "x", f"rare{rng.randrange(200)}"]))
        out.append((i, " ".join(t)))
    return out + [(None, "a b c"), (301, None), (302, "a b c"), (302, "a b c")]


@pytest.mark.parametrize(("max_depth", "min_word"), [(1, 0.0), (2, 0.002), (3, 0.01)])
def test_matches_the_plain_version(spark, talk, max_depth, min_word):
    df = spark.createDataFrame(talk, "doc_id long, text string").repartition(3)
    params = dict(max_depth=max_depth, min_word=min_word, min_context=0.001, min_entry=0.0005)
    want, states = plain(talk, **params)
    assert states >= max_depth
    got = [tuple(r) for r in pst.score_documents(df, **params).collect()]
    close(got, want)
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held) + 50  # contexts help on texts that were not learned from


@pytest.mark.parametrize("params", [{}, {"hot": 0.004}, {"hot": 1.0}])
def test_rare_contexts_and_next_words_take_part(spark, params):
    """A corpus so large that 2^-16 of its tokens is more than what follows most words; sequences joined, broadcast, or some of either."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefgh", k=40)) for _ in range(60)] + [f"q{i} r{i} s{i} t{i}" for i in range(40) for _ in range(20)]
    texts += [" ".join(f"z{rng.randrange(10**9)}" for _ in range(2000)) for _ in range(45)]
    texts += [f"u{i} v{i}" for i in range(50)]  # seen once
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want, states = plain(rows, 2, 0.0, 0.0, 0.0)
    assert want[0][4] * 2.0**-16 > 1 and states > 80
    close([tuple(r) for r in pst.score_documents(df, **params).collect()], want)


def test_many_buckets_and_only_what_is_read_stays_on_disk(spark, talk, monkeypatch, tmp_path):
    """Tables that no later step reads, and shuffle files of tables already stored, made up half of the disk."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffles = lambda: {f for d in folders for f in Path(d).glob("*/shuffle_*_0.data")}
    before = shuffles()
    monkeypatch.setattr(pst, "BUCKET_TOKENS", 100)
    monkeypatch.setattr(pst, "scratch_path", lambda spark, name: str(tmp_path / "tree"))
    df = spark.createDataFrame(talk, "doc_id long, text string").repartition(3)
    want, states = plain(talk, 2, 0.0, 0.0, 0.0)
    done = pst.score_documents(df)
    assert pst._buckets(want[0][4]) > 64 and states > 5
    assert sorted(f.name for f in (tmp_path / "tree").iterdir()) == ["level1", "level2", "states1", "states2"]
    assert len(shuffles() - before) < 3
    close([tuple(r) for r in done.collect()], want)


def test_probabilities_sum_to_one(spark, talk):
    df = spark.createDataFrame(talk, "doc_id long, text string").selectExpr("cast(text as binary) as text")
    tree, _, total, distinct = pst.train(df, max_depth=3, min_word=0.0, min_context=0.001, min_entry=0.0005)
    words = np.arange(len(tree.words))
    unseen = 1 / (total + distinct + 1)
    assert any(s.any() for s in tree.state)
    for depth in range(1, len(tree.contexts) + 1):
        for s in range(len(tree.contexts[depth - 1])):
            at, left = np.array([s]), unseen
            for d in range(depth, 0, -1):
                left *= 10 ** tree.rest_log[d - 1][at[0]] if tree.state[d - 1][at[0]] else 1.0
                at = tree._suffix(d, at)
            assert tree.prob(depth, np.full(len(words), s), words).sum() + left == pytest.approx(1, abs=1e-9)


def test_odd_tables(spark, docs, clashing, no_docs, corpus):
    want, _ = plain(corpus, 2, pst.MIN_WORD, pst.MIN_CONTEXT, pst.MIN_ENTRY)
    close([tuple(r) for r in pst.score_documents(docs).collect()], want)
    assert pst.score_documents(clashing).count() == len(corpus)
    assert pst.score_documents(no_docs).count() == 0
    # nothing to learn from: crc32 of "6" leaves the remainder of held-out texts
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = pst.score_documents(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).collect()
    assert [tuple(x) for x in r] == [(only, True, 3, 0, 0, 0.0, 0.0)]
