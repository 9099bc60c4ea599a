"""WARC archives: exact round trip, revisits, and the merge."""

import gzip
import hashlib
import random
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrina.llm import warc

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "page_id long, url string, captured timestamp, payload string"


def rows():
    rng = random.Random(1)
    big = "x é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 40
    out = [(i, f"http://H{i % 7}.Example.com/p?{i % 3}", T0 + timedelta(seconds=rng.randrange(1000), microseconds=i), rng.choice([big, big + "y", f"small {i}", "", None, "é" * 499, "é" * 500])) for i in range(200)]
    return out + [(None, None, None, big), (300, "no scheme", T0, "a\n\x00b"), (301, "http://x/\r\nWARC-Type: bad", T0, "z" * 300_000), (199, "http://again/", T0, big)]


def expected(rs):
    best = {}
    for i, _, _, p in rs:
        b = (p or "").encode()
        if len(b) >= 1000 and i is not None:
            best[b] = max(best.get(b, -1), i)
    out = []
    for i, _, _, p in rs:
        b = (p or "").encode()
        to = best.get(b)
        to = None if to == i else to
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip(spark):
    got = warc.archive_round_trip(spark.createDataFrame(rows(), SCHEMA).repartition(4)).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == expected(rows())


def test_global_order_and_files(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    warc.write_archives(df, str(tmp_path / "w"))
    index = warc.read_index(spark, str(tmp_path / "w")).withColumn("part", F.spark_partition_id()).collect()
    keys = [(r["url_key"], r["captured"], -1 if r["page_id"] is None else r["page_id"]) for r in sorted(index, key=lambda r: r["part"])]
    assert keys == sorted(keys)
    assert "com,example,h1)/p?0" in {k[0] for k in keys}
    # each entry points at its record
    r = next(r for r in index if r["page_id"] == 7)
    data = gzip.decompress(open(r["file"].removeprefix("file:"), "rb").read())[r["offset"] :]
    assert data.startswith(b"WARC/1.1\r\n") and b"<urn:capture:7>" in data[:200]
    at = {x["page_id"]: x["captured"] for x in index}
    assert at[7] == next(x[2] for x in rows() if x[0] == 7).replace(tzinfo=None) or at[7].timestamp() == next(x[2] for x in rows() if x[0] == 7).timestamp()


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.archive_round_trip(empty).count() == 0
    twice = spark.createDataFrame([(None, "u", T0, "x" * 2000)] * 2, SCHEMA).withColumn("key", F.lit(1)).withColumn("part", F.lit("p"))
    assert [(r["page_id"], r["record_type"]) for r in warc.archive_round_trip(twice).collect()] == [(None, "response")] * 2


@given(st.lists(st.lists(st.integers(0, 9)).map(sorted)))
def test_loser_tree(runs):
    assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_size_classes_bound_files():
    assert all(n * (top or 0) <= 64 << 20 for top, n in warc.CLASSES)
    assert warc.CLASSES[-1] == (None, 1)


@pytest.mark.parametrize("bad", [b"WARC/1.1\r\nContent-Length: 3"])
def test_cut_off_file(bad):
    with pytest.raises(ValueError, match="no end of header"):
        warc._find(memoryview(bad), 0)
