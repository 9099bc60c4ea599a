"""Fan-out review (the reference's three skipped tests plus the untested branches),
HMAC and file hashes against Python, contract, drift and sizing."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.operators import quality as Q


def frames(spark, a_rows, b_rows, a_schema="id bigint, x string", b_schema="id bigint, y bigint"):
    return spark.createDataFrame(a_rows, a_schema), spark.createDataFrame(b_rows, b_schema)


def test_one_to_one_passes(spark):
    a, b = frames(spark, [(1, "a"), (2, "b"), (3, "c")], [(1, 10), (2, 20), (3, 30)])
    out = Q.checked_join(a, b, ["id"], "inner", "1:1")
    assert out.count() == 3


def test_empty_join_raises(spark):
    a, b = frames(spark, [(1, "a"), (2, "b"), (3, "c")], [(4, 1), (5, 2), (6, 3)])
    with pytest.raises(Q.FanoutError, match="empty result"):
        Q.checked_join(a, b, ["id"], "inner", "1:1")


def test_no_keys_raises(spark):
    a = spark.createDataFrame([(1,), (2,)], "x bigint")
    b = spark.createDataFrame([(3,), (4,)], "y bigint")
    with pytest.raises(ValueError, match="cartesian"):
        Q.checked_join(a, b, [], "inner")
    r = Q.fanout_report(a, b, a.crossJoin(b), []).first()
    assert not r["passed"] and "cartesian" in r["reason"]


def test_duplicate_key_in_one_to_one(spark):
    a, b = frames(spark, [(1, "a"), (2, "b")], [(1, 10), (1, 11), (2, 20)])
    r = Q.fanout_report(a, b, a.join(b, "id"), ["id"], "inner", "1:1").first()
    assert r["dup_keys"] and not r["passed"] and "duplicate" in r["reason"]


def test_inner_larger_than_smaller_input(spark):
    a, b = frames(spark, [(1, "a"), (2, "b")], [(1, 10), (2, 20), (3, 30)])
    res = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "id bigint, x string, y bigint")
    r = Q.fanout_report(a, b, res, ["id"], "inner", "1:1").first()
    assert "explosion" in r["reason"]


def test_left_size_differs(spark):
    a, b = frames(spark, [(1, "a"), (2, "b")], [(1, 10)])
    res = a.join(b, "id", "inner")
    r = Q.fanout_report(a, b, res, ["id"], "left", "1:1").first()
    assert "left join leak" in r["reason"]


def test_one_to_n_limit(spark):
    a = spark.createDataFrame([(i,) for i in range(20)], "id bigint")
    b = spark.createDataFrame([(i % 20, i) for i in range(20)], "id bigint, v bigint")
    exact = spark.createDataFrame([(i % 20,) for i in range(21)], "id bigint")  # int(20 * 1.05) = 21
    over = spark.createDataFrame([(i % 20,) for i in range(22)], "id bigint")
    assert Q.fanout_report(a, b, exact, ["id"], "inner", "1:N").first()["passed"]
    assert not Q.fanout_report(a, b, over, ["id"], "inner", "1:N").first()["passed"]


def test_key_missing_and_nm(spark):
    a, b = frames(spark, [(1, "a")], [(1, 10)])
    r = Q.fanout_report(a, b, a.select("x"), ["id"]).first()
    assert "not found" in r["reason"]
    big = spark.createDataFrame([(1,)] * 50, "id bigint")
    assert Q.fanout_report(a, b, big, ["id"], "inner", "N:M").first()["passed"]  # N:M checks leakage only


def test_null_keys_group_together(spark):
    a = spark.createDataFrame([(None, "a"), (None, "b")], "id bigint, x string")
    r = Q.fanout_report(a, a, a, ["id"], "inner", "1:1").first()
    assert r["dup_keys"]


@pytest.mark.parametrize("secret,pepper", [("s", "p"), ("k" * 80, "pepper-long")])
def test_hmac_equals_python(spark, secret, pepper):
    vals = ["12345", "María José", "", "x" * 200]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r["h"] for r in df.select(Q.hmac_sha256("v", secret, pepper).alias("h")).collect()]
    key = f"{secret}_{pepper}".encode()
    assert got == [hmac.new(key, v.encode(), hashlib.sha256).hexdigest() for v in vals]


def test_file_hashes(spark, tmp_dir):
    data = {"a.txt": b"hola", "b.bin": bytes(range(256)) * 10}
    for name, content in data.items():
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(content)
    rows = {r["path"].rsplit("/", 1)[-1]: (r["size"], r["sha256"])
            for r in Q.file_hashes(spark, f"{tmp_dir}/*").collect()}
    for name, content in data.items():
        assert rows[name] == (len(content), hashlib.sha256(content).hexdigest())


def test_validate_catalog(spark):
    df = spark.createDataFrame([("a", "t", "Funcas"), ("", "t", "INE"), ("c", "t", "Otro")],
                               "id string, title string, source string")
    rules = sorted((r["rule"], r["detail"]) for r in
                   Q.validate_catalog(df, min_items=4, required_sources=["Funcas", "ECB"]).collect())
    assert rules == [("missing_id", "INE"), ("missing_source_family", "ECB"), ("source_not_allowed", "Otro"),
                     ("too_few_items", "3")]


def test_schema_drift(spark):
    exp = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    act = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("c", T.StringType())])
    got = sorted((r["column"], r["kind"]) for r in Q.schema_drift(spark, act, exp).collect())
    assert got == [("a", "type_changed"), ("b", "missing"), ("c", "extra")]


def test_size_class(spark):
    df = spark.createDataFrame([("ON id=id", 10, False), ("ON id=id", 10, True), ("semantic match", 10, False),
                                ("ON id=id", 200_000, False), ("fuzzy", 5, True)],
                               "d string, n bigint, p boolean")
    got = [r["s"] for r in df.select(Q.size_class("d", "n", "p").alias("s")).collect()]
    assert got == ["S", "M", "L", "M", "L"]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_crossing_report_equals_the_run_crossing(spark, how):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "z"), (None, "z"), (5, None)], "k int, g string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (2, "n"), (None, "z"), (7, "q")], "k int, g string")
    for keys in (["k"], ["k", "g"]):
        for expected in ("1:1", "1:N"):
            ran = Q.fanout_report(a, b, a.join(b, keys, how), keys, how, expected).first()
            assert Q.crossing_report(a, b, keys, how, expected).first()[:6] == ran[:6], (keys, expected)
    empty = a.limit(0)
    assert Q.crossing_report(empty, empty, ["k"]).first()["passed"]


def test_exploding_join_is_refused_before_it_runs(spark):
    a = spark.range(2000).selectExpr("id % 2 AS k")
    with pytest.raises(Q.FanoutError):
        Q.checked_join(a, a, ["k"], "inner", "1:N")


def test_all_violations_of_a_row_and_record_drift(spark):
    df = spark.createDataFrame([("", None, "nowhere"), ("i", "t", "INE"), ("j", "", "")], "id string, title string, source string")
    got = sorted((r["rule"], r["id"]) for r in Q.validate_catalog(df).collect())
    assert got == [("missing_id", ""), ("missing_source", "j"), ("missing_title", ""), ("missing_title", "j"), ("source_not_allowed", "")]
    rec = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "1"}',), ("[1]",), (None,)], "j string")
    got = sorted(map(tuple, Q.record_drift(rec, "j", {"a": "BIGINT"}).collect()))
    assert got == [("a", "missing", "BIGINT", None, 2), ("a", "type_changed", "BIGINT", "STRING", 1), ("b", "extra", None, "STRING", 1)]


def test_file_hashes_of_any_size(spark, tmp_dir):
    import hashlib
    import os
    sizes = {"small": 100, "a b%2Fc": 70_000, "block": 8 << 20, "more": (8 << 20) + 1}
    want = {}
    for name, n in sizes.items():
        data = os.urandom(n)
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(data)
        want[name] = (n, hashlib.sha256(data).hexdigest())
    huge = (2 << 30) + 4097  # more than one value can hold; sparse, so it takes no disk
    with open(f"{tmp_dir}/huge", "wb") as f:
        f.truncate(huge)
    h, left = hashlib.sha256(), huge
    while left:
        h.update(bytes(min(left, 1 << 24)))
        left -= min(left, 1 << 24)
    want["huge"] = (huge, h.hexdigest())
    got = {r["path"].rsplit("/", 1)[1]: (r["size"], r["sha256"]) for r in Q.file_hashes(spark, tmp_dir, whole_file=1000).collect()}
    assert got == want
