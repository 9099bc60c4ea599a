"""The stored catalogue: counts that add up, criteria resolved before the scan, clustered layout."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_text_index import rows_of, scanned
from vitrina.operators import search as S
from vitrina.operators import stored as ST
from vitrina.operators import summary as A
from vitrina.operators.normalize import build_catalog

COLS = "id string, source string, title string, date_iso string, description string, tags array<string>, url string, type string"


def batch(spark, n, start, seed):
    rng = random.Random(seed)
    rows = [(f"i{start + i}", rng.choice(["Funcas", "INE", "BBVA Research", "ecb", None, ""]), f"t {i}", f"20{rng.randrange(30):02d}-{rng.randint(1, 12):02d}" if i % 7 else rng.choice(["", None]),
             "x" * 200, rng.choice([["a", "b"], ["b"], [], None, ["c", None]]), "", rng.choice(["report", "Dataset", None, "", "time_series"])) for i in range(n)]
    return build_catalog(spark.createDataFrame(rows, COLS).repartition(2))


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("kept"))
    batch(spark, 3000, 0, 1).unionByName(batch(spark, 500, 3000, 2)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module", params=[False, True], ids=["by date", "clustered"])
def path(request, spark, whole, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("stored"))
    old = whole.where(F.substring("id", 2, 9).cast("int") < 3000)
    ST.write_stored(old, p, "overwrite", cluster=request.param, row_group_bytes=20_000)
    ST.write_stored(whole.join(old.select("id"), "id", "left_anti").select(*whole.columns), p, cluster=request.param, row_group_bytes=20_000)
    return p


def test_summary_equals_the_recount(spark, whole, path):
    assert rows_of(ST.stored_summary(spark, path)) == rows_of(A.summary_table(whole))
    read = scanned(ST.stored_summary(spark, path))
    assert read < whole.count() / 10  # counts only


def test_counts_that_are_missing_are_taken_again(spark, whole, tmp_path):
    p = str(tmp_path)
    ST.write_stored(whole.limit(50), p, "overwrite")
    extra = whole.limit(20).withColumn("text_folded", F.lit("")).withColumn("batch", F.lit("stopped"))
    extra.write.mode("append").partitionBy("batch").parquet(f"{p}/items")
    assert rows_of(ST.stored_summary(spark, p)) == rows_of(A.summary_table(ST.load_stored(spark, p)))
    assert ST.stored_summary(spark, p).where("piece = 'total_items'").first()["n"] == 70


@pytest.mark.parametrize("criteria", [
    {"source": "bbva"}, {"source": "the INE of Spain"}, {"type": "DATASET"}, {"source": "ecb", "tipo": "report", "desde": "2010", "hasta": "2015-06"},
    {"source": "nobody"}, {"type": "none"}, {"texto": "T 17"}, {}])
def test_same_rows_as_the_search(spark, whole, path, criteria):
    assert rows_of(ST.search_stored(spark, path, limit=None, **criteria)) == rows_of(S.search(whole, limit=None, **criteria))


def test_more_names_than_are_pushed(spark, whole, path, monkeypatch):
    monkeypatch.setattr(ST, "MAX_NAMES", 1)
    assert rows_of(ST.search_stored(spark, path, limit=None, source="INE")) == rows_of(S.search(whole, limit=None, source="INE"))


def test_each_criterion_narrows_the_scan(spark, whole, tmp_path):
    p = str(tmp_path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ST.write_stored(whole.repartition(4), p, "overwrite", cluster=True, row_group_bytes=10_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total = whole.count()
    narrow = lambda **c: scanned(ST.narrowed(spark, p, **c).select("id", "title"))
    plan = ST.narrowed(spark, p, source="ecb", type="report")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" not in plan or "EqualTo" in plan or "Or(" in plan
    assert narrow(type="none") == 0
    assert narrow(type="report") < 0.8 * total and narrow(source="ecb", type="report") < 0.6 * total
    dated = ST.load_stored(spark, p).where(S.date_between("date_iso", "2028")).select("id", "title")
    assert scanned(dated) < 0.6 * total
