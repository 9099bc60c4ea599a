"""Personal data: strict spans against Python's own matching, loose ones by planted cases."""

import hashlib
import re
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrina.llm import pii

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def base(text):
    out = []
    for no, (kind, pattern) in enumerate(CONTRACT.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), no, m.end()))
    return sorted(out)


def got(df):
    return {r["doc_id"]: ([tuple(x) for x in r["base"]], [tuple(x) for x in r["spans"]]) for r in pii.find_pii(df).collect()}


def noisy(rng):
    bits = ["a@b.c%d@e.f", "x.y+z@mail.example.com", "10.0.0.1", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "0001.2.3.4", "4111 1111 1111 1111", "4111111111111112", "5500-0000-0000-0004",
            "+34 600 123 456", "+1 (212) 555-0100.", "+123", "+49 30 1234567 x", "1 2 3 4", "é", "\U0001f600", "@", "a@b", "12345678901234567890123", "...", "--", " ", "\n", "call", "v1.2.3.4"]
    return rng.choice(["", " "]).join(rng.choice(bits) for _ in range(rng.randint(0, 12)))


def test_strict_spans(spark):
    rng = random.Random(1)
    rows = [(i, noisy(rng)) for i in range(400)] + [(400, None), (401, ""), (402, "\U0001f600 é a@b.co 10.1.1.1 " * 700), (403, "9" * 50_000 + " " + "a" * 50_000 + " @" * 10)]
    found = got(spark.createDataFrame(rows, "doc_id long, text string"))
    for i, t in rows:
        assert found[i][0] == base(t), t
        assert set(found[i][0]) <= set(found[i][1])


@settings(max_examples=300, deadline=None)
@given(st.text("ab@.+-%_ 1234567890()", max_size=40))
def test_rewritten_patterns_match_alike(text):
    for kind in ("card", "phone"):
        want = [m.span() for m in re.finditer(CONTRACT[kind], text)]
        mine = [m.span() for m in re.finditer(pii.STRICT[kind], text) if kind != "card" or m.end() - m.start() > 1]
        assert mine == want


def test_query_digest_and_odd_tables(spark, docs, clashing, no_docs, corpus):
    found = got(docs)
    assert set(found) == {r[0] for r in corpus}
    assert pii.find_pii(clashing).count() == len(corpus) and pii.find_pii(no_docs).count() == 0
    r = pii.find_pii(spark.createDataFrame([(1, "to a@b.co from 10.0.0.1")], "doc_id long, text string")).select(pii.joined("base").alias("s")).first()
    assert r["s"] == "email:3:9,ip:15:23"
    assert hashlib.sha256(r["s"].encode()).hexdigest()


def test_loose_spans_need_support(spark):
    """A national number after a word for phones counts; the same digits after a word for orders do not."""
    rng = random.Random(4)
    rows = []
    for i in range(200):
        n = "".join(rng.choice("0123456789") for _ in range(9))
        rows.append((i, f"phone +34 {n[:3]} {n[3:6]} {n[6:]} thanks"))
        rows.append((1000 + i, f"telephone 600 {n[3:6]} {n[6:]}0 thanks"))
        rows.append((2000 + i, f"order nr 017{n[3:5]}-{n[3:6]}-{n[6:]} sent"))
    found = got(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(len(found[i][1]) == 1 for i in range(200))
    assert sum(bool(found[1000 + i][1]) for i in range(200)) > 190
    assert not any(found[2000 + i][1] for i in range(200))


def test_secrets_need_support(spark):
    """Tokens after a word for them count; digests of commits and files of the same form do not."""
    rng = random.Random(6)
    hexes = lambda n, chars="0123456789abcdef": "".join(rng.choice(chars) for _ in range(n))
    rows = []
    for i in range(120):
        rows.append((i, f'and token = "{hexes(40)}" for it'))
        rows.append((1000 + i, f"api_key: ghp_{hexes(36)} thanks"))
        rows.append((2000 + i, f"fixed in commit {hexes(40)} of the branch"))
        rows.append((3000 + i, f"file sha256: {hexes(64)} and so on"))
        rows.append((4000 + i, f"x{hexes(40)}y and {hexes(31)}"))
    found = got(spark.createDataFrame(rows, "doc_id long, text string"))
    # a run of digits within a token may be a card by the strict format, which then stands for that place
    added = lambda i: [x for x in found[i][1] if x not in found[i][0]]
    assert all(len(added(k + i)) == 1 or found[k + i][0] for k in (0, 1000) for i in range(120))
    assert added(1) == [(13, 4, 53)] or found[1][0]
    assert not any(added(k + i) for k in (2000, 3000, 4000) for i in range(120))


def test_the_method_adds_spans_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = got(docs)
    want = set()
    for r in docs.collect():
        for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', r["text"] or ""):
            if not any(s < m.end(1) and m.start(1) < e for s, _, e in base(r["text"])):
                want.add((r["doc_id"], m.start(1), 4, m.end(1)))
    assert {(i, *x) for i, (b, a) in found.items() for x in a if x not in b} == want and len(want) > 5


def test_em_finds_the_reliable_labeler():
    rng = random.Random(9)
    counts = {}
    for _ in range(5000):
        y = rng.random() < 0.4
        v = {k: (1 if y == (rng.random() < right) else -1) for k, right in zip(pii.LABELERS, (0.95, 0.8, 0.9, 0.55), strict=True)}
        counts[tuple(v.values())] = counts.get(tuple(v.values()), 0) + 1
    share, prob, _ = pii.reliabilities([(dict(zip(pii.LABELERS, k, strict=True)), c) for k, c in counts.items()])
    assert share == pytest.approx(0.4, abs=0.05)
    assert [prob[1][k][1] for k in pii.LABELERS] == pytest.approx([0.95, 0.8, 0.9, 0.55], abs=0.06)
