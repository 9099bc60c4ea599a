"""Accent folding equals NFKD + drop combining marks (Python's rule), not DuckDB's."""

import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrina.functions.fold import fold, fold_exact, fold_py, fold_tables

SAMPLES = ["Inflación", "INFLACIÓN", "naïve café", "Ĳssel ﬁnal ½", "straße", "ª º", "Ångström", "ǅ",
           "évolution économique", "São Paulo", "Łódź", "ﬀ ﬃ ﬆ", ""]


def test_fold_matches_python(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    got = [r["f"] for r in df.select(fold("s").alias("f")).collect()]
    assert got == [fold_py(s) for s in SAMPLES]


def test_fold_exact_udf(spark):
    df = spark.createDataFrame([("한국어 café",)], "s string")
    assert df.select(fold_exact("s").alias("f")).first()["f"] == fold_py("한국어 café")


def test_fold_beyond_the_first_plane(spark):
    texts = ["\U0001d400\U0001d4b7 caf\u00e9 \U0001d552", "\U0002f800x", "a\U0001e8d0b", "\U0001f600 ok"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r["f"] for r in df.select(fold("s").alias("f")).collect()] == [fold_py(t) for t in texts]


def test_table_covers_all_planes_one_to_one():
    matching, replace, expansions = fold_tables()
    every = [chr(cp) for cp in range(0x110000) if not 0xD800 <= cp <= 0xDFFF]
    one = {c for c in every if not unicodedata.combining(c) and len(fold_py(c)) == 1 and fold_py(c) != c}
    assert set(matching[:len(replace)]) == one and len(matching) > len(replace)
    for a, b in zip(matching, replace):
        assert fold_py(a) == b
    for a in matching[len(replace):]:
        assert fold_py(a) == "" or unicodedata.combining(a)
    assert all(len(dst) > 1 for _, dst in expansions)


latin = st.text(alphabet=st.characters(min_codepoint=0x20, max_codepoint=0x24F), max_size=40)


@settings(max_examples=40, deadline=None)
@given(st.lists(latin, min_size=1, max_size=8))
def test_fold_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select(fold("s").alias("f"), fold(fold("s")).alias("ff")).collect()
    for t, r in zip(texts, rows):
        assert r["f"] == fold_py(t)
        assert r["ff"] == r["f"]  # idempotent
