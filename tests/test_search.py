"""Search semantics (F1-F8, W7, W8, A12) on literal catalogue rows."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrina.operators import search as S
from vitrina.operators import summary as A

ROWS = [
    ("funcas-a", "Funcas", "Inflación y precios", "2024-05-17", "Sobre la INFLACIÓN", ["economía", "España"], "working_paper", "", "u1"),
    ("bbva-b", "BBVA Research", "España | empleo", "2024", "", ["economía", "España"], "report", "España", "u2"),
    ("ine-c", "INE", "IPC", "", "índice", ["INE"], "dataset", None, ""),
    ("x-d", "", "Sin fuente", "2023-01-01", "texto", [], "report", "Global", None),
    ("ecb-e", "ECB", "[ECB] HICP", "2024-05", "serie", ["ECB", "ICP"], "time_series", None, "u5"),
]
SCHEMA = "id string, source string, title string, date_iso string, description string, tags array<string>, " \
         "type string, geography string, url string"


def cat(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_date_filter_text_semantics(spark):
    c = cat(spark)
    # '' fails desde and passes hasta; '2024' fails desde=2024-01-01
    assert ids(S.search(c, None, desde="2024-01-01")) == ["ecb-e", "funcas-a"]
    assert ids(S.search(c, None, hasta="2023-12-31")) == ["ine-c", "x-d"]
    # Hasta alone is applied
    assert "funcas-a" not in ids(S.search(c, None, hasta="2024-01-01"))


def test_source_match(spark):
    c = cat(spark)
    assert ids(S.search(c, None, source="bbva")) == ["bbva-b", "x-d"]  # '' source matches all
    assert ids(S.search(c, None, source="ine")) == ["ine-c", "x-d"]


def test_text_plain_or_folded(spark):
    c = cat(spark)
    assert ids(S.search(c, None, texto="inflacion")) == ["funcas-a"]
    assert ids(S.search(c, None, texto="INFLACIÓN")) == ["funcas-a"]
    assert ids(S.search(c, None, texto="indice")) == ["ine-c"]


def test_type_tags_geography(spark):
    c = cat(spark)
    assert ids(S.search(c, None, type="REPORT")) == ["bbva-b", "x-d"]
    assert ids(S.search(c, None, tags=["españa", "ECONOMÍA"])) == ["bbva-b", "funcas-a"]
    assert ids(S.search(c, None, geography="españa")) == ["bbva-b"]


def test_order_limit_and_counts(spark):
    c = cat(spark)
    top = [r["id"] for r in S.search(c, 2).collect()]
    assert top == ["funcas-a", "ecb-e"]  # text order on mixed precision: '2024-05-17' > '2024-05' > '2024'
    counts = S.search_counts(c, 2, type="report").first()
    assert (counts["total_found"], counts["shown"]) == (2, 2)
    long = spark.createDataFrame([("i", "s", "t", "", "x" * 500, [], "r", None, "")], SCHEMA)
    assert len(S.search(long, 1).first()["description"]) == 200


def test_summaries(spark):
    c = cat(spark)
    by_src = {r["source"]: r["n"] for r in A.count_by_source(c).collect()}
    assert by_src["Funcas"] == 1 and by_src[""] == 1
    dr = A.date_range(c).first()
    assert (dr["desde"], dr["hasta"]) == ("2023-01-01", "2024-05-17")
    empty = c.filter(F.lit(False))
    assert A.date_range(empty).first()["desde"] == "desconocida"
    tt = [(r["tag"], r["n"]) for r in A.top_tags(c, 2).collect()]
    assert tt == [("España", 2), ("economía", 2)]
    assert [r["type"] for r in A.types(c).collect()] == ["dataset", "report", "time_series", "working_paper"]
    years = {r["year"]: r["n"] for r in A.items_by_year(c).collect()}
    assert years == {"2024": 3, "2023": 1, "sin_fecha": 1}


words = st.sampled_from(["inflación", "empleo", "precios", "INE", "serie", "x"])


@settings(max_examples=15, deadline=None)
@given(texto=words, desde=st.sampled_from([None, "2023", "2024-01-01"]))
def test_search_is_subset(spark, texto, desde):
    c = cat(spark)
    found = set(ids(S.search(c, None, texto=texto, desde=desde)))
    assert found <= {r[0] for r in ROWS}
    assert found == set(ids(S.search(c, None, texto=texto))) & set(ids(S.search(c, None, desde=desde)))


def test_drop_system_pages(spark):
    df = spark.createDataFrame([("a",), ("lista-de-cookies",), ("b",)], "id string")
    assert ids(S.drop_system_pages(df, ["lista-de-cookies"])) == ["a", "b"]
    sys_df = spark.createDataFrame([("b",)], "x string")
    assert ids(S.drop_system_pages(df, sys_df)) == ["a", "lista-de-cookies"]
