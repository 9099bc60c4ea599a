"""Scalar text functions against the edge values of FIXTURES §4 and Python's rules."""

import pytest
from pyspark.sql import functions as F

from vitrina.functions import text as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


DATES = [
    ("2024-05-17T23:30:00+02:00", "2024-05-17"),
    ("2024-05-17", "2024-05-17"),
    ("17 May 2024", "2024-05-17"),
    ("13 december 2024", "2024-12-13"),
    ("May 2024", "2024-05-01"),
    ("2024", "2024-01-01"),
    ("13 noviembre 2020", "2020"),
    ("2024-05", "2024"),
    ("2024-05-17T10:00:00.5+00:00", "2024"),
    ("sin fecha", "sin fecha"),
    ("", ""),
    ("  2024-05-17\n", "2024-05-17"),
    ("2024-05-17T10:00:00Z", "2024-05-17"),
    ("2024-02-30", "2024"),
    ("año 2020", "2020"),
    ("5 de May de 2021", "2021-05-05"),
]


@pytest.mark.parametrize("raw,expected", DATES)
def test_parse_date_iso(spark, raw, expected):
    assert one(spark, X.parse_date_iso(F.lit(raw))) == expected


def test_parse_date_null(spark):
    assert one(spark, X.parse_date_iso(F.lit(None).cast("string"))) == ""


def test_epoch_ms_date(spark):
    ms = 1715983200000  # 2024-05-17T22:00:00Z
    assert one(spark, X.epoch_ms_date(F.lit(ms))) == "2024-05-17"
    assert one(spark, X.epoch_ms_date(F.lit(ms), "Europe/Madrid")) == "2024-05-18"
    assert one(spark, X.epoch_ms_date(F.lit("no es un número largo"))) == "no es un n"


def test_slug40(spark):
    assert one(spark, X.slug40(F.lit("España | La inflación"))) == "espa-a-la-inflaci-n"
    long = "A" * 39 + " tail that is cut"
    assert one(spark, X.slug40(F.lit(long))) == "a" * 39


def test_url_slug_and_collision(spark):
    base = "https://p.example/docs/" + "x" * 50
    assert one(spark, X.url_slug(F.lit("https://p.example/docs/a-paper/"))) == "a-paper"
    assert one(spark, X.url_slug(F.lit(base + "-one/"))) == one(spark, X.url_slug(F.lit(base + "-two")))


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


def test_front_matter_and_sections(spark):
    c = F.lit(BUNDLE)
    assert one(spark, X.front_matter(c, "title")) == "Un título"
    assert one(spark, X.front_matter(c, "description")) is None  # (.+) needs a character
    assert one(spark, X.section(c, "Resumen")) == ""  # D3: empty section stays empty
    assert one(spark, X.section(c, "Missing")) is None
    assert one(spark, X.body_url(c)) == "https://p.example/docs/a-paper/"
    assert one(spark, X.md_link_text(F.lit("see [Texto](http://x.example/a) now"))) == "Texto"
    assert one(spark, X.md_link_url(F.lit("see [Texto](http://x.example/a) now"))) == "http://x.example/a"


def test_section_body(spark):
    md = "## Resumen\n\n  Cuerpo del resumen.  \n\n## Otro\nx"
    assert one(spark, X.section(F.lit(md), "Resumen")) == "Cuerpo del resumen."


def test_authors(spark):
    assert one(spark, X.split_authors(F.lit("Ana Uno, Luis Dos,"), ",")) == ["Ana Uno", "Luis Dos"]
    assert one(spark, X.split_authors(F.lit("a; b ;c"), ";")) == ["a", "b", "c"]
    assert one(spark, X.authors_short(F.array(F.lit("a"), F.lit("b"), F.lit("c")))) == "a, b et al."
    assert one(spark, X.authors_short(F.array(F.lit("a"), F.lit("b")))) == "a, b"


def test_geography_technique_type(spark):
    assert one(spark, X.geography_from_title(F.lit("España | La inflación"))) == "España"
    assert one(spark, X.geography_from_title(F.lit("[España | x](u)"))) is None  # D12
    assert one(spark, X.geography_from_slug(F.lit("espa-a-la-inflaci-n"))) == "España"
    assert one(spark, X.geography_from_slug(F.lit("global-outlook"))) == "Global"
    assert one(spark, X.technique(F.lit("Con técnicas Big Data"), F.lit("t"))) == "big-data"
    assert one(spark, X.doc_type(F.lit("Nota Técnica 3"), F.lit(""))) == "nota_tecnica"
    assert one(spark, X.doc_type(F.lit("Otro"), F.lit(""))) == "documento_trabajo"


def test_keyword_and_dim_tags(spark):
    assert one(spark, X.keyword_tags(F.lit("Índice de Precios de Vivienda"))) == ["precio", "vivienda"]
    dims = F.create_map(F.lit("REF_AREA"), F.lit("ES"), F.lit("ADJUSTMENT"), F.lit("N"),
                        F.lit("ICP_SUFFIX"), F.lit("U2"))
    assert one(spark, X.dim_tags(dims)) == ["n"]


def test_quotes_and_compact(spark):
    assert one(spark, X.clean_quotes(F.lit('a "b" c'), 4)) == "a 'b"
    assert one(spark, X.compact_date(F.lit("2024-05-17"))) == "20240517"


@pytest.mark.parametrize("v", [2.0, 35.27, 1e-05, 0.0001234, 12345678.9, 1.5e16, 1e16, -3.25, 100.0, None])
def test_py_number(spark, v):
    expected = "None" if v is None else (str(int(v)) if v == int(v) and abs(v) < 1e16 else repr(v))
    assert one(spark, X.py_number(F.lit(v).cast("double"))) == expected


def test_series_api_url(spark):
    codes = F.array(F.lit("M"), F.lit("ES"))
    assert one(spark, X.series_api_url(F.lit("ICP"), codes)).endswith("/ICP/M.ES")
    assert one(spark, X.series_api_url(F.lit("BOP"), F.array().cast("array<string>"))).endswith("/BOP/BOP")


def test_source_of_id(spark):
    assert one(spark, X.source_of_id(F.lit("bbva-espa-a"), ["funcas", "bbva", "ine"])) == "bbva"
    assert one(spark, X.source_of_id(F.lit("ecb-ICP-0001"), ["funcas", "bbva", "ine"])) is None


def test_report_listing_blocks(spark):
    from vitrina.operators.lines import report_listing
    md = ("Intro line\n### España | La inflación baja\n13 Noviembre 2020 texto\n"
          "ver https://www.bbvaresearch.com/publicaciones/la-inflacion/ y mas\n"
          "## Global | Big data\nCon técnicas Big Data\n01 march 2021\n### \n")
    df = spark.createDataFrame([("p1", md)], "page string, md string")
    rows = {r["block"]: r for r in report_listing(df, "page", "md", "www.bbvaresearch.com").collect()}
    a, b = rows[1], rows[2]
    assert (a["title"], a["date_raw"], a["geography"]) == ("España | La inflación baja", "13 noviembre 2020", "España")
    assert a["url"] == "https://www.bbvaresearch.com/publicaciones/la-inflacion/" and a["technique"] is None
    assert (b["title"], b["date_raw"], b["technique"]) == ("Global | Big data", "01 march 2021", "big-data")
    assert 3 not in rows  # a heading without title is not a block


def test_paper_listing_blocks(spark):
    from vitrina.operators.lines import paper_listing
    md = ("# Publicaciones\n## [Primer documento](https://p.example/a/)\nAna Uno, Luis Dos\nFecha: Junio 2010\n"
          "Descarga el PDF\n## [Segundo](https://p.example/b/)\n**Fecha:** 3 marzo 2021\n")
    df = spark.createDataFrame([("l", md)], "page string, md string")
    rows = {r["block"]: r for r in paper_listing(df, "page", "md").collect()}
    assert (rows[1]["title"], rows[1]["url"], rows[1]["date"], rows[1]["author_raw"]) == \
        ("Primer documento", "https://p.example/a/", "Junio 2010", "Ana Uno, Luis Dos")
    assert (rows[2]["date"], rows[2]["author_raw"]) == ("Marzo 2021", None)


def test_strip_matches_python(spark):
    vals = ["\xa0 Ana Uno\u3000", "\t\x1cdos\x85\n", "\u2007tres\u2009", "", " \xa0"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r["s"] for r in df.select(X.strip_ws("v").alias("s")).collect()] == [v.strip() for v in vals]
