"""Seekable frames and the fill-in-the-middle transform."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrina.llm import frames, queries

UNIT = re.compile("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+")
TEXT = st.text(alphabet=st.sampled_from("ab é\U0001f600 \n\t\x0b\x85\xa0<P>SM\x00"), max_size=60)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, h = len(units), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(pre), len(mid), sha(f"<S>{suf}<P>{pre}<M>{mid}"), sha(text)
    return doc_id, n, "psm", len(pre), len(mid), sha(f"<P>{pre}<S>{suf}<M>{mid}"), sha(text)


def form(doc_id, text, size):
    data = (text or "").encode()
    made, units, chars = frames.cut_frames(data, size)
    assert chars == len(text or "") and units == len(UNIT.findall(text or ""))
    assert all(len(frames.zstandard.decompress(f["data"])) <= size + 3 for f in made)
    row = {"doc_id": doc_id, "units": units, "bytes": len(data), "marked": any(m in data for m in (b"<P>", b"<S>", b"<M>")), "frames": made}
    return (doc_id, *frames._form(row, 42, 50, 80, size))


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(0, 500), st.integers(1, 9))
def test_frames_of_any_size(text, doc_id, size):
    assert form(doc_id, text, size)[:7] == brute(doc_id, text)


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(1, 9))
def test_places_and_streams(text, size):
    data = text.encode()
    made, units, _ = frames.cut_frames(data, size)
    f = frames.Frames(made, units, len(data))
    ends = [0] + [m.end() for m in UNIT.finditer(text)]
    for n, end in enumerate(ends):
        assert f.place(n) == (len(text[:end].encode()), end)
    for a in range(0, len(data) + 1, 3):
        for b in range(a, len(data) + 1, 5):
            assert b"".join(f.stream(a, b)) == data[a:b]


def test_a_cut_reads_one_frame(monkeypatch):
    data = " ".join(f"w{i}" for i in range(5000)).encode()
    made, units, _ = frames.cut_frames(data, 512)
    f, read = frames.Frames(made, units, len(data)), []
    plain = f._unpack.decompress
    f._unpack = type("Counted", (), {"decompress": staticmethod(lambda x: read.append(len(x)) or plain(x))})
    f.place(2500)
    assert len(made) > 40 and len(read) == 1


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [7, 64, 1 << 16])
def test_whole_table(spark, docs, corpus, size):
    rng = random.Random(3)
    odd = [(1000, "x" * 300_000), (1001, "".join(rng.choice("ab \n é") for _ in range(50_000))), (1002, "a <P> b"), (None, "a b c d"), (1003, " \t ")]
    more = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in odd], docs.schema)
    made = frames.fill_in_middle(frames.stored_frames(docs.unionByName(more), frame_bytes=size), frame_bytes=size)
    got = [tuple(r)[:7] for r in made.collect()]
    assert sorted(got, key=repr) == sorted((brute(i, t) for i, t, *_ in corpus + odd), key=repr)


def test_output_frames(spark, docs, corpus):
    texts = {i: t or "" for i, t, *_ in corpus}
    for r in frames.fill_in_middle(frames.stored_frames(docs, frame_bytes=50), frame_bytes=50).collect():
        out = b"".join(frames.zstandard.decompress(f) for f in r["output"])
        assert hashlib.sha256(out).hexdigest() == r["output_sha256"] and sha(texts[r["doc_id"]]) == r["restored_sha256"]
        assert (out.decode() == texts[r["doc_id"]]) == (r["form"] == "plain")


def test_clashing_columns_and_no_rows(spark, docs, clashing, no_docs):
    run = lambda d: rows_of(frames.fill_in_middle(frames.stored_frames(d), keep_output=False))
    assert run(clashing.withColumn("units", clashing["doc_id"]).withColumn("frames", clashing["doc_id"])) == run(docs)
    assert run(no_docs) == []


def test_query_on_given_rows(spark):
    folder = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op12_fill_in_middle(spark, folder)) == sorted((brute(*t) for t in texts), key=repr)
