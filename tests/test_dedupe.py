"""Positions, first-wins and set operations (W1, W2, W6, U2, U3) on skewed input."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitrina.operators import dedupe as W


def test_ordinal_within_matches_row_number_on_hot_group(spark):
    # one group holds ~2/3 of the rows and spans several range partitions
    rows = [("hot", f"n{i:05d}") for i in range(3000)] + [(f"g{i % 7}", f"n{i:05d}") for i in range(1500)]
    df = spark.createDataFrame(rows, "flow string, name string")
    got = W.ordinal_within(df, ["flow"], ["name"], n_parts=6)
    w = Window.partitionBy("flow").orderBy("name")
    ref = df.withColumn("ref", (F.row_number().over(w) - 1).cast("bigint"))
    j = got.join(ref, ["flow", "name"])
    assert j.count() == len(rows)
    assert j.filter(F.col("position") != F.col("ref")).count() == 0


def test_dedupe_by_title_first_wins(spark):
    df = spark.createDataFrame([(3, " Hola "), (1, "hola"), (2, "HOLA\n"), (4, "  "), (5, "otro")],
                               "ord int, title string")
    got = sorted((r["ord"], r["title"]) for r in W.dedupe_by_title(df, "ord").collect())
    assert got == [(1, "hola"), (5, "otro")]


def test_first_k_per_group(spark):
    df = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 5)], "g int, v int")
    got = sorted((r["g"], r["v"]) for r in W.first_k_per_group(df, ["g"], ["v"], 3).collect())
    assert got == [(1, 0), (1, 1), (1, 2), (2, 5)]


def test_concat_and_prefer_first(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    u = W.concat_listings({"http://a": a, "http://b": b})
    assert sorted((r["v"], r["source_url"]) for r in u.collect()) == [("x", "http://a"), ("y", "http://b"),
                                                                     ("z", "http://b")]
    got = sorted((r["k"], r["v"]) for r in W.prefer_first([a, b], ["k"]).collect())
    assert got == [(1, "x"), (2, "z")]


def test_null_keys_and_maps(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 1)], "g string, o int")
    got = sorted((r["g"] or "", r["o"], r["position"]) for r in W.ordinal_within(df, ["g"], ["o"]).collect())
    assert got == [("", 1, 0), ("", 2, 1), ("a", 1, 0)]
    second = spark.createDataFrame([(None, 9), ("b", 9)], "g string, o int")
    assert sorted((r["g"] or "", r["o"]) for r in W.prefer_first([df, second], ["g"]).collect()) == [("", 1), ("", 2), ("a", 1), ("b", 9)]
    m = spark.createDataFrame([("T ", {"x": "1"}, 2), ("t", {"x": "2"}, 1), ("\t", {}, 0)], "title string, dims map<string,string>, o int")
    assert [tuple(r) for r in W.dedupe_by_title(m, "o").collect()] == [("t", {"x": "2"}, 1)]
