"""Normalisers on invented rows shaped like the reference's raw files (FIXTURES §2)."""

from pyspark.sql import functions as F

from vitrina import schemas as SC
from vitrina.operators import normalize as N
from vitrina.operators import render as R

BUNDLE = """---
title: "Un título"
description: ""
url: "https://p.example/docs/a-paper/"
tags: ["economía", "p"]
---

# Un título

## Resumen

## Metadatos

- **URL:** [https://p.example/docs/a-paper/](https://p.example/docs/a-paper/)
"""


def test_normalize_papers(spark):
    raw = spark.createDataFrame([
        ("a-paper", "", "2026-01-02T23:30:00+02:00", "", "Ana Uno, Luis Dos,", "", "P", "2026-02-01T00:00:00+00:00",
         None, None, None, None, None),
        ("b-paper", "https://p.example/docs/b-paper/", "", "Raw title", "", "Junio 2010", "P", "", None, None,
         None, None, None)], SC.PAPER_RAW)
    bundles = spark.createDataFrame([("a-paper", BUNDLE)], "id string, content string")
    rows = {r["id"]: r for r in N.normalize_papers(raw, bundles).collect()}
    a = rows["funcas-a-paper"]
    assert a["title"] == "Un título"
    assert a["description"] == ""  # D3: empty Resumen does not swallow Metadatos
    assert a["url"] == "https://p.example/docs/a-paper/"  # from the bundle body
    assert a["date_iso"] == "2026-01-02"  # offset stamp keeps its local date
    assert a["authors"] == ["Ana Uno", "Luis Dos"]
    b = rows["funcas-b-paper"]
    assert (b["title"], b["date_iso"], b["date_raw"]) == ("Raw title", "2010", "Junio 2010")


def test_normalize_reports(spark):
    raw = spark.createDataFrame([
        ("espa-a-la-inflaci-n", "España | La inflación", "BBVA Research", "13 noviembre 2020", None, None, None,
         "https://l.example", ""),
        ("lista-de-cookies", "Cookies", "BBVA Research", "", None, None, None, "", ""),
        ("global-outlook", "Global | Outlook", "BBVA Research", "", "https://r.example/g", "big-data", None, "", "")],
        SC.REPORT_RAW)
    bundles = spark.createDataFrame([("global-outlook", 'title: "Global outlook 2025"\nurl: "https://b.example"\n')],
                                    "id string, content string")
    rows = {r["id"]: r for r in N.normalize_reports(raw, bundles).collect()}
    assert "bbva-lista-de-cookies" not in rows  # system page
    s = rows["bbva-espa-a-la-inflaci-n"]
    assert s["geography"] == "España" and s["tags"] == ["economía", "España"]
    assert s["url"] == "https://www.bbvaresearch.com/publicaciones/espa-a-la-inflaci-n/"
    assert s["date_iso"] == "2020"  # D4: Spanish month names fail the C-locale formats
    g = rows["bbva-global-outlook"]
    assert (g["title"], g["url"], g["technique"]) == ("Global outlook 2025", "https://r.example/g", "big-data")


def test_normalize_datasets_and_code_map(spark):
    ops = spark.createDataFrame([(25, "IOE25", "Índice de Precios de Consumo", "IPC", None),
                                 (7, "IOE7", "Sin código", "", None)], SC.OPERATION_RAW)
    tables = spark.createDataFrame([(25, 1, 1715983200000), (25, 2, 1700000000000), (25, 3, 0)],
                                   "op_id bigint, Id bigint, Ultima_Modificacion bigint")
    index = spark.createDataFrame([("| **IPC** | Precios al consumo |\n| **X** | y |",)], "md string")
    cm = N.code_map(index)
    assert sorted((r["code"], r["name"]) for r in cm.collect()) == [("IPC", "Precios al consumo"), ("X", "y")]
    bundles = spark.createDataFrame([("ipc", 'url: "https://ine.example/ipc"\n')], "id string, content string")
    rows = {r["id"]: r for r in N.normalize_datasets(ops, tables, bundles, cm).collect()}
    ipc = rows["ine-ipc"]
    assert (ipc["tables_count"], ipc["date_iso"], ipc["description"]) == (3, "2024-05-17", "Precios al consumo")
    assert ipc["url"] == "https://ine.example/ipc" and ipc["tags"] == ["INE", "economía española", "ipc"]
    no = rows["ine-op7"]
    assert (no["tables_count"], no["date_iso"], no["description"], no["tags"]) == (0, "", "Sin código", ["INE"])


def test_normalize_series_and_union(spark):
    series = spark.createDataFrame([
        ("ICP", 0, "FREQ=M | REF_AREA=ES", {"REF_AREA": "ES", "ICP_SUFFIX": "ANR"}, ["M", "ES", "ANR"],
         ["FREQ=M"], [("2024-01", 3.0), ("2024-02", 2.5)])],
        "flow string, position bigint, name string, dimensions map<string,string>, dim_codes array<string>, "
        "dimension_names array<string>, observations array<struct<period:string,value:double>>")
    s = N.normalize_series(N.last_observation(series)).first()
    assert s["id"] == "ecb-ICP-0000"
    assert s["title"] == "[ECB] HICP (Inflación Armonizada): FREQ=M | REF_AREA=ES"
    assert s["description"] == "ECB HICP (Inflación Armonizada) | FREQ=M | REF_AREA=ES | Valor: 2.5 | Obs: 2 (2024-02)"
    assert s["tags"] == ["ECB", "ICP", "anr"] and s["last_observation"] == "2024-02: 2.5"
    assert s["url"].endswith("/ICP/M.ES.ANR")
    a = spark.createDataFrame([("x", "s")], "id string, source string")
    b = spark.createDataFrame([("y", 1)], "id string, tables_count bigint")
    u = N.build_catalog(a, b, conform=True)
    assert u.count() == 2 and u.columns == SC.CATALOG_FIELDS


def test_json_list_matches_python(spark):
    import json
    vals = ["economía", 'a "q" \\ b', "tab\tline\nnext", "ascii", "€ sign"]
    got = spark.range(1).select(R.json_list(F.array(*[F.lit(v) for v in vals])).alias("j")).first()["j"]
    assert got == json.dumps(vals)


def test_dataset_bundle_lists_first_ten(spark):
    ops = spark.createDataFrame([(1, "Precios de vivienda", "IPV")], "Id bigint, Nombre string, Codigo string")
    tables = spark.createDataFrame([(1, i, f"T{i}") for i in range(15)], "op_id bigint, Id bigint, Nombre string")
    b = R.render_dataset_bundle(ops, tables).first()
    assert b["id"] == "ipv"
    assert b["content"].count("](https://servicios.ine.es/wstempus/js/ES/DATOS_TABLA/") == 10
    assert 'tags: ["INE", "econom\\u00eda espa\\u00f1ola", "datos abiertos", "precio", "vivienda"]' in b["content"]


def test_list_index_variants(spark):
    from vitrina.sources.readers import ref_table
    hv = ref_table(spark, "high_value_datasets").withColumn("ordinal", F.col("cap"))
    lines = [r["line"] for r in R.render_list_index(hv, "high_value").orderBy(*R.INDEX_ORDER).collect()]
    heads, lines = lines[:-17], lines[-17:]
    assert "datasets: 17" in heads and lines[0] == "- **Producción industrial** (IPI) — `c=11078`"
    reps = spark.createDataFrame([("España | x", "espa-a-x", "13 noviembre 2020", "España", 1)],
                                 "title string, id string, date_raw string, geography string, ordinal int")
    assert R.render_list_index(reps, "reports").orderBy(*R.INDEX_ORDER).collect()[-1]["line"] == \
        "- [España | x](conceptos/espa-a-x.md) — 13 noviembre 2020 España"
    ops = spark.createDataFrame([(25, "Índice de precios de consumo " + "x" * 80, "IPC", 1), (7, "Otra", "", 2)],
                                "Id bigint, Nombre string, Codigo string, ordinal int")
    key = spark.createDataFrame([(25,)], "op_id bigint")
    rows = R.render_list_index(ops, "operations", key_ids=key).orderBy(*R.INDEX_ORDER).collect()
    out = {(r["k1"], r["k4"]): r["line"] for r in rows if r["k1"] > 0}
    assert out[(2, 2)] == "- [](conceptos/op7.md) — Otra"
    assert len(out[(2, 1)].split(" — ", 1)[1]) == 80
    assert out[(1, 1)].startswith("\n### [Índice de precios de consumo")
    assert [r["line"] for r in rows if r["k1"] == 0][-1] == "## Operaciones Económicas"


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=6), min_size=1, max_size=4))
def test_union_keeps_counts(spark, sizes):
    frames = []
    for i, n in enumerate(sizes):
        cols = "id string, source string" + (", tables_count bigint" if i % 2 else ", flow string")
        rows = [(f"{i}-{j}", f"s{i}", j if i % 2 else f"f{j}") for j in range(n)]
        frames.append(spark.createDataFrame(rows, cols))
    u = N.build_catalog(*frames)
    assert u.count() == sum(sizes)
    by = {r["source"]: r["count"] for r in u.groupBy("source").count().collect()}
    assert all(by.get(f"s{i}", 0) == n for i, n in enumerate(sizes))


def test_one_item_per_raw_row(spark):
    raw = spark.createDataFrame([("a", "T", "", "", ""), ("b", "", "", "", "")], "id string, title string, url string, date_raw string, technique string")
    bundles = spark.createDataFrame([("a", 'title: "old"', 1), ("a", 'title: "new"', 2), ("b", 'title: "x"', 1), ("b", 'title: "w"', 0)], "id string, content string, ordinal int")
    got = sorted((r["id"], r["title"]) for r in N.normalize_reports(raw, bundles).collect())
    assert got == [("bbva-a", "new"), ("bbva-b", "x")]
    ops = spark.createDataFrame([(1, "Op", "IPC")], "Id bigint, Nombre string, Codigo string")
    tables = spark.createDataFrame([(1, 5, 0)], "op_id bigint, Id bigint, Ultima_Modificacion bigint")
    codes = spark.createDataFrame([("IPC", "first", 0), ("IPC", "last", 1)], "code string, name string, ordinal int")
    got = N.normalize_datasets(ops, tables, bundles.withColumn("id", F.lit("ipc")), codes).collect()
    assert [(r["id"], r["description"]) for r in got] == [("ine-ipc", "last")]


def test_index_order(spark):
    from vitrina.operators import render as R
    from vitrina.operators.search import nonblank_title
    p = spark.createDataFrame([("p1", "A", "2019-01-01", ["x"], 10), ("p2", "B", "2024-05-05", ["x", "y", "z"], 2), ("p3", "C", "", [], 3), ("p4", "D", "2024", ["x"], 11)],
                              "id string, title string, date string, authors array<string>, ordinal int")
    lines = [r["line"] for r in R.render_year_index(p).orderBy(*R.INDEX_ORDER).collect()]
    assert lines[0] == "---" and "total_documents: 4" in lines and lines[-1].startswith("- [A]")
    assert [x.strip() for x in lines if x.startswith("\n###")] == ["### sin_fecha (1 documentos)", "### 2024 (2 documentos)", "### 2019 (1 documentos)"]
    assert [x[3] for x in lines if x.startswith("- [")] == ["C", "B", "D", "A"]
    titles = spark.createDataFrame([("\t",), ("\u00a0",), ("x",), (None,)], "title string")
    assert titles.filter(nonblank_title("title")).count() == 1


def test_bundle_counts_all_tables(spark):
    from vitrina.operators import render as R
    ops = spark.createDataFrame([(1, "Op", "C")], "Id bigint, Nombre string, Codigo string")
    tables = spark.createDataFrame([(1, i, f"T{i}") for i in range(25)], "op_id bigint, Id bigint, Nombre string")
    text = R.render_dataset_bundle(ops, tables, spark.createDataFrame([(1, 7, 70)], "op_id bigint, n_series bigint, n_values bigint")).first()["content"]
    assert "tables_count: 25" in text and text.count("(id=") == 10 and "series_count: 7" in text and "values_count: 70" in text
