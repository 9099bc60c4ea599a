"""Explicit schemas.  Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


# Common catalogue columns, then the per-type extensions.
CATALOG_COMMON = [
    _f("id", S, False), _f("source", S), _f("title", S), _f("date_iso", S),
    _f("description", S), _f("tags", T.ArrayType(S)), _f("url", S), _f("type", S),
    _f("normalized_at", T.TimestampType()),
]
CATALOG_EXTENSIONS = [
    _f("pdf_url", S), _f("authors", T.ArrayType(S)), _f("date_raw", S),
    _f("geography", S), _f("technique", S),
    _f("operation_id", L), _f("operation_code", S), _f("tables_count", L),
    _f("flow", S), _f("last_value", D), _f("last_observation", S), _f("count", L),
    _f("dimensions", T.MapType(S, S)), _f("dimension_names", T.ArrayType(S)),
]
CATALOG = T.StructType(CATALOG_COMMON + CATALOG_EXTENSIONS)
CATALOG_FIELDS = [f.name for f in CATALOG.fields]
# As stored by the catalogue sink: plus the folded search text of F5.
CATALOG_STORED = T.StructType(CATALOG.fields + [_f("text_folded", S)])

PAPER_RAW = T.StructType([
    _f("id", S), _f("url", S), _f("lastmod", S), _f("title", S), _f("author_raw", S),
    _f("date", S), _f("source", S), _f("scraped_at", S), _f("pdf_url", S),
    _f("pdf_url_en", S), _f("abstract", S), _f("pdf_local", S), _f("pdf_size", L),
])

REPORT_RAW = T.StructType([
    _f("id", S), _f("title", S), _f("source", S), _f("date_raw", S), _f("url", S),
    _f("technique", S), _f("geography", S), _f("source_url", S), _f("scraped_at", S),
])

OPERATION_RAW = T.StructType([
    _f("Id", L), _f("Cod_IOE", S), _f("Nombre", S), _f("Codigo", S), _f("Url", S),
])

TABLE_META_RAW = T.StructType([
    _f("Id", L), _f("Nombre", S), _f("Codigo", S), _f("FK_Periodicidad", I),
    _f("FK_Publicacion", I), _f("FK_Periodo_ini", I), _f("Anyo_Periodo_ini", S),
    _f("FK_Periodo_fin", I), _f("Anyo_Periodo_fin", S), _f("FechaRef_fin", S),
    _f("Ultima_Modificacion", L),
])

STAT_POINT = T.StructType([_f("Fecha", L), _f("FK_Periodo", I), _f("Anyo", I), _f("Valor", D)])
STAT_SERIES_RAW = T.StructType([_f("COD", S), _f("Nombre", S), _f("Data", T.ArrayType(STAT_POINT))])

_DIM_VALUE = T.StructType([_f("id", S), _f("name", S)])
_DIM = T.StructType([_f("id", S), _f("values", T.ArrayType(_DIM_VALUE))])
SDMX_MESSAGE = T.StructType([
    _f("structure", T.StructType([_f("dimensions", T.StructType([
        _f("series", T.ArrayType(_DIM)), _f("observation", T.ArrayType(_DIM)),
    ]))])),
    _f("dataSets", T.ArrayType(T.StructType([
        _f("series", T.MapType(S, T.StructType([
            _f("observations", T.MapType(S, T.ArrayType(D))),
        ]))),
    ]))),
])

OBSERVATION = T.StructType([_f("period", S), _f("value", D)])
DECODED_SERIES = T.StructType([
    _f("flow", S), _f("dim_codes", T.ArrayType(S)), _f("dimensions", T.MapType(S, S)),
    _f("dimension_names", T.ArrayType(S)), _f("name", S),
    _f("observations", T.ArrayType(OBSERVATION)), _f("last_value", D), _f("count", L),
    _f("fetched_at", S),
])
SERIES_FILE = T.StructType([
    _f("flow", S), _f("label", S), _f("has_es", B), _f("fetched_at", S),
    _f("total_series", L), _f("series", T.ArrayType(DECODED_SERIES)),
])

SITEMAP_ENTRY = T.StructType([_f("loc", S), _f("lastmod", S)])
PAGE_TEXT = T.StructType([_f("url", S), _f("md", S)])
BUNDLE = T.StructType([_f("file", S), _f("content", S)])

VECTORS = T.StructType([
    _f("id", S, False), _f("title", S), _f("model", S), _f("vector", T.ArrayType(T.FloatType())),
    _f("ok", B),
])
RUN_LOG = T.StructType([_f("at", T.TimestampType()), _f("action", S), _f("detail", S)])
CROSSING_REQUEST = T.StructType([_f("descr", S), _f("n_rows", L), _f("has_pii", B)])
FANOUT_REPORT = T.StructType([
    _f("n_a", L), _f("n_b", L), _f("n_result", L), _f("dup_keys", B),
    _f("fanout_ratio", D), _f("passed", B), _f("reason", S),
])
