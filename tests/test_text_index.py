"""The trigram block index: same rows as a scan, few blocks read."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrina.functions.fold import fold_py
from vitrina.operators import search as S
from vitrina.operators import text_index as X
from vitrina.operators.normalize import build_catalog

SYLLABLES = ["ba", "cé", "di", "fó", "gu", "Ha", "ñi", "ka", "lü", "mo"]


@pytest.fixture(scope="module")
def catalog(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
    rows = [(f"id-{i:05d}", f"src{i % 3}", f"20{i % 20:02d}-01-{i % 28 + 1:02d}", " ".join(word() for _ in range(4)),
             " ".join(word() for _ in range(30)) + (" Zürich ½ 한국 xyzzy" if i in (77, 2101) else ""), "paper" if i % 2 else "report") for i in range(4000)]
    rows += [("id-null", None, None, None, None, None), ("id-null", None, None, None, None, None), ("id-empty", "", "", "", "", "")]
    df = spark.createDataFrame(rows, "id string, source string, date_iso string, title string, description string, type string").repartition(4)
    return build_catalog(df.withColumn("tags", F.array(F.lit("t"))).withColumn("url", F.lit("")))


@pytest.fixture(scope="module")
def stored(catalog, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("indexed"))
    X.write_indexed_catalog(catalog, path, block_rows=16, partitions=3)
    return path


@pytest.fixture(scope="module")
def kept(catalog, tmp_path_factory):
    """The catalogue as rows that a scan reads quickly."""
    path = str(tmp_path_factory.mktemp("kept"))
    catalog.write.parquet(path, mode="overwrite")
    return catalog.sparkSession.read.parquet(path)


def rows_of(df):
    return sorted(map(str, df.collect()))


def scanned(df):
    """Rows that the scans of a query have handed on."""
    df.collect()
    plan, out, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(p.plan())
            continue
        if name.startswith("Scan") and p.metrics().contains("numOutputRows"):
            out += p.metrics().apply("numOutputRows").value()
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


NEEDLES = ["xyzzy", "ZÜRICH", "zurich", "1⁄2", "½", "한국", "한", "x", "zü", "bacedi", "BACÉDI", "ba", "", "no such text", "́", "xyzzy 1", " ", "guguguguguha"]


@pytest.mark.parametrize("needle", NEEDLES)
def test_same_rows_as_the_scan(spark, kept, stored, needle):
    assert rows_of(X.search_indexed(spark, stored, needle, limit=None)) == rows_of(S.search(kept, limit=None, texto=needle))


@pytest.mark.parametrize("needle", ["xyzzy", "bacedi"])
def test_blocks_met_by_a_join(spark, catalog, stored, needle):
    met = X.narrowed(spark, stored, needle, max_blocks=0)
    assert rows_of(met.where(S.text_matches(needle)).select("id")) == rows_of(catalog.where(S.text_matches(needle)).select("id"))


def test_other_criteria_and_limit(spark, catalog, stored):
    criteria = {"source": "src1", "type": "Paper", "desde": "2005", "hasta": "2018"}
    assert [r["id"] for r in X.search_indexed(spark, stored, "gugu", limit=7, **criteria).collect()] == [
        r["id"] for r in S.search(catalog, limit=7, texto="gugu", **criteria).collect()]


def test_a_rare_term_reads_few_texts(spark, stored):
    total = spark.read.parquet(f"{stored}/items").count()
    found = lambda needle: X.narrowed(spark, stored, needle).where(S.text_matches(needle, folded="text_folded")).select("id", "title")
    assert scanned(found("Xyzzy")) < total / 10 and scanned(found("한")) < total / 10
    assert scanned(found("no such")) == 0 and scanned(found("")) == total


def test_as_many_ranges_as_are_read(spark, catalog, tmp_path):
    # every second item has the needle and every item is a block: the blocks lie in hundreds of ranges
    even = F.col("n") % 2 == 0
    items = spark.range(2 * X.MAX_RANGES + 200).withColumnRenamed("id", "n").select(
        F.format_string("id-%05d", "n").alias("id"), F.when(even, "an even xyzzy").otherwise("odd").alias("title"),
        *[F.lit("").alias(c) for c in ("source", "date_iso", "description", "type", "url")], F.array(F.lit("t")).alias("tags"))
    X.write_indexed_catalog(build_catalog(items), str(tmp_path), block_rows=1, partitions=2)
    found = X.search_indexed(spark, str(tmp_path), "xyzzy", limit=None)
    assert [r["id"] for r in found.collect()] == [f"id-{i:05d}" for i in range(0, 2 * X.MAX_RANGES + 200, 2)]
    assert X.search_indexed(spark, str(tmp_path), "".join(chr(0x4E00 + i) for i in range(2000))).count() == 0


def test_ranges():
    assert X.block_ranges([]) == [] and X.block_ranges([5]) == [(5, 5)]
    assert X.block_ranges([3, 1, 2, 9, 8, 20]) == [(1, 3), (8, 9), (20, 20)]
    assert X.block_ranges([1, 3, 10, 12, 30], most=2) == [(1, 12), (30, 30)]


@given(st.text(max_size=30), st.text(max_size=6))
def test_a_text_has_the_codes_of_what_it_contains(text, part):
    whole = set(X.gram_codes(text + part).tolist())
    assert set(X.needle_codes(part)) <= whole
    assert fold_py(part) in fold_py(text + part)


def test_empty_catalogue_and_bad_blocks(spark, catalog, tmp_path):
    X.write_indexed_catalog(catalog.where("false"), str(tmp_path))
    assert X.search_indexed(spark, str(tmp_path), "ba").count() == 0
    with pytest.raises(ValueError):
        X.write_indexed_catalog(catalog, str(tmp_path), block_rows=100)
