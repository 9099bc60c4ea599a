"""Whole-record normalisers (N1-N5): raw publisher rows to catalogue rows.

Each normaliser is one plan: the raw table left-joined to its bundles by id
(J1: one bundle scan replaces one file open per item), then projections.  The
bundle side is keyed by file stem and is not broadcast by hint: its size grows
with the data, so the join strategy is left to Catalyst/AQE (broadcast when the
runtime size is under the threshold, sort-merge otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions import text as X
from vitrina.operators.search import drop_system_pages
from vitrina.schemas import CATALOG

# Publisher names, id prefixes and fixed tags of the four sources.
PAPER_SOURCE, PAPER_PREFIX = "Funcas", "funcas"
PAPER_TAGS = ["economía", "españa", "funcas"]
REPORT_SOURCE, REPORT_PREFIX = "BBVA Research", "bbva"
DATASET_SOURCE, DATASET_PREFIX = "INE", "ine"
SERIES_SOURCE, SERIES_PREFIX = "ECB", "ecb"
# Labels of the seven series flows.
FLOW_LABELS = {
    "ICP": "HICP (Inflación Armonizada)",
    "MIR": "Tipos de interés bancarios",
    "BSI": "Balances financieros",
    "STS": "Estadísticas coyunturales",
    "EXR": "Tipos de cambio",
    "BOP": "Balanza de pagos",
    "FM": "Mercados financieros",
}
# Ids of listing pages that are not publications.
SYSTEM_PAGES = [
    "centro-de-preferencia-de-la-privacidad",
    "lista-de-cookies",
    "configuraci-n-de-cookies",
    "publicaciones-m-s-recientes",
    "publicaciones-m-s-recientes-de-espa-a",
    "publicaciones-m-s-recientes-sobre-big-da",
]


def _bundles(bundles: DataFrame) -> DataFrame:
    """One bundle per id, as one file per id holds: the last written (``ordinal``, if given), else the greatest text."""
    last = F.max_by("content", F.struct("ordinal", "content")) if "ordinal" in bundles.columns else F.max("content")
    return bundles.groupBy(F.col("id").alias("_bid")).agg(last.alias("_content"))


def with_bundle(raw: DataFrame, bundles: DataFrame, key: Column | str = "id") -> DataFrame:
    """Left join raw items to their bundle text by slug."""
    k = F.col(key) if isinstance(key, str) else key
    b = _bundles(bundles)
    return raw.join(b, k == b["_bid"], "left")


def normalize_papers(raw: DataFrame, bundles: DataFrame, source: str = PAPER_SOURCE,
                     prefix: str = PAPER_PREFIX, tags: list[str] | None = None) -> DataFrame:
    """Papers (N1): bundle title/description/url override raw fields when present."""
    j = with_bundle(raw, bundles)
    content = F.col("_content")
    date_raw = X.or_else("date", "lastmod", F.lit(""))
    return j.select(
        X.item_id(prefix, "id").alias("id"),
        F.lit(source).alias("source"),
        F.coalesce(X.front_matter(content, "title"), X.or_else("title", F.col("id"))).alias("title"),
        X.parse_date_iso(date_raw).alias("date_iso"),
        F.coalesce(X.front_matter(content, "description"), X.section(content, "Resumen"),
                   F.lit("")).alias("description"),
        F.array(*[F.lit(t) for t in (tags or PAPER_TAGS)]).alias("tags"),
        F.coalesce(X.blank_to_null("url"), X.body_url(content), F.lit("")).alias("url"),
        F.coalesce(F.col("pdf_url"), F.lit("")).alias("pdf_url"),
        X.split_authors("author_raw", ",").alias("authors"),
        date_raw.alias("date_raw"),
        F.lit("working_paper").alias("type"),
        F.current_timestamp().alias("normalized_at"),
    )


def normalize_reports(raw: DataFrame, bundles: DataFrame, system_pages: list[str] | DataFrame | None = None,
                      source: str = REPORT_SOURCE, prefix: str = REPORT_PREFIX,
                      url_base: str = X.REPORT_URL_BASE) -> DataFrame:
    """Reports (N2): system pages dropped, url fallback, geography from the slug."""
    pages = SYSTEM_PAGES if system_pages is None else system_pages
    j = with_bundle(drop_system_pages(raw, pages), bundles)
    content = F.col("_content")
    geo = X.geography_from_slug("id")
    return j.select(
        X.item_id(prefix, "id").alias("id"),
        F.lit(source).alias("source"),
        F.coalesce(X.front_matter(content, "title"), X.or_else("title", F.col("id"))).alias("title"),
        X.parse_date_iso(F.coalesce(F.col("date_raw"), F.lit(""))).alias("date_iso"),
        F.coalesce(X.front_matter(content, "description"), F.lit("")).alias("description"),
        F.when(geo != "", F.array(F.lit("economía"), geo)).otherwise(F.array(F.lit("economía")))
        .alias("tags"),
        X.report_fallback_url(F.coalesce(X.blank_to_null("url"), X.front_matter(content, "url")),
                              F.col("id"), url_base).alias("url"),
        geo.alias("geography"),
        F.coalesce(F.col("technique"), F.lit("")).alias("technique"),
        F.coalesce(F.col("date_raw"), F.lit("")).alias("date_raw"),
        F.lit("report").alias("type"),
        F.current_timestamp().alias("normalized_at"),
    )


def table_aggregates(tables: DataFrame, op_col: str = "op_id", mod_col: str = "Ultima_Modificacion",
                     tz: str = "UTC") -> DataFrame:
    """One row per operation: table count and latest modification date.

    Aggregated before the join, so the join with operations is N:1 on a
    pre-combined frame; a hot operation is combined map-side.
    """
    mod = F.when(F.col(mod_col) != 0, F.col(mod_col))
    return tables.groupBy(op_col).agg(
        F.count(F.lit(1)).alias("tables_count"),
        F.max(mod).alias("_last_mod"),
    ).select(op_col, "tables_count", X.epoch_ms_date(F.col("_last_mod"), tz).alias("_mod_date"))


def normalize_datasets(ops: DataFrame, tables: DataFrame, bundles: DataFrame,
                       code_map: DataFrame | None = None, source: str = DATASET_SOURCE,
                       prefix: str = DATASET_PREFIX) -> DataFrame:
    """Datasets (N3): operations with table aggregates, name map and bundle url.

    ``tables`` carries ``op_id`` (from the file name, S2); ``code_map`` is
    ``(code, name)`` (X22) and falls back to the operation name (D5).
    """
    agg = table_aggregates(tables)
    j = ops.join(agg, ops["Id"] == agg["op_id"], "left")
    if code_map is not None:
        # a code that is listed again takes its last name (``ordinal``, if given)
        last = F.max_by("name", F.struct("ordinal", "name")) if "ordinal" in code_map.columns else F.max("name")
        cm = code_map.groupBy(F.col("code").alias("_code")).agg(last.alias("_map_name"))
        j = j.join(cm, j["Codigo"] == cm["_code"], "left")  # J3
    else:
        j = j.withColumn("_map_name", F.lit(None).cast("string"))
    b = _bundles(bundles)
    j = j.join(b, F.lower(F.col("Codigo")) == b["_bid"], "left")
    code = F.coalesce(F.col("Codigo"), F.lit(""))
    has_code = code != ""
    return j.select(
        F.when(has_code, F.concat(F.lit(prefix + "-"), F.lower(code)))
        .otherwise(F.concat(F.lit(prefix + "-op"), F.col("Id").cast("string"))).alias("id"),
        F.lit(source).alias("source"),
        F.coalesce(F.col("Nombre"), F.lit("")).alias("title"),
        F.coalesce(F.col("_mod_date"), F.lit("")).alias("date_iso"),
        F.coalesce(F.col("_map_name"), F.col("Nombre"), F.lit("")).alias("description"),
        F.when(has_code, F.array(F.lit("INE"), F.lit("economía española"), F.lower(code)))
        .otherwise(F.array(F.lit("INE"))).alias("tags"),
        F.coalesce(X.front_matter(F.col("_content"), "url"), F.lit("")).alias("url"),
        F.col("Id").alias("operation_id"),
        code.alias("operation_code"),
        F.coalesce(F.col("tables_count"), F.lit(0)).cast("bigint").alias("tables_count"),
        F.lit("dataset").alias("type"),
        F.current_timestamp().alias("normalized_at"),
    )


def last_observation(series: DataFrame) -> DataFrame:
    """Add ``last_period`` / ``last_value`` / ``count`` from an ``observations`` array."""
    obs = F.coalesce(F.col("observations"), F.array().cast("array<struct<period:string,value:double>>"))
    last = F.try_element_at(obs, F.lit(-1))
    return series.withColumn("last_period", last["period"]) \
        .withColumn("last_value", last["value"]) \
        .withColumn("count", F.size(obs).cast("bigint"))


def normalize_series(series: DataFrame, labels: dict[str, str] | None = None,
                     source: str = SERIES_SOURCE, prefix: str = SERIES_PREFIX) -> DataFrame:
    """Series (N4): one row per series to one catalogue row.

    Input columns: ``flow``, ``position`` (0-based place of the series in its
    flow, W2), ``name``, ``dimensions``, ``dim_codes``, ``dimension_names`` and
    the last observation as ``last_period`` / ``last_value`` / ``count``
    (``last_observation`` derives them from an ``observations`` array).
    """
    lab = labels or FLOW_LABELS
    label_map = F.create_map(*[x for k, v in lab.items() for x in (F.lit(k), F.lit(v))])
    label = F.coalesce(F.try_element_at(label_map, F.col("flow")), F.col("flow"))
    count = F.coalesce(F.col("count"), F.lit(0)).cast("bigint")
    has_obs = F.col("last_period").isNotNull() & (count > 0)
    date_iso = F.when(has_obs, F.substring("last_period", 1, 10)).otherwise(F.lit(""))
    name = F.coalesce(F.col("name"), F.concat(F.col("flow"), F.lit(" series "),
                                              F.col("position").cast("string")))
    dims = F.coalesce(F.col("dimensions"), F.create_map().cast("map<string,string>"))
    return series.select(
        F.concat(F.lit(prefix + "-"), F.col("flow"), F.lit("-"),
                 F.format_string("%04d", F.col("position"))).alias("id"),
        F.lit(source).alias("source"),
        F.col("flow"),
        F.concat(F.lit(f"[{source}] "), label, F.lit(": "), name).alias("title"),
        date_iso.alias("date_iso"),
        X.series_description(label, name, F.col("last_value"), count, date_iso).alias("description"),
        F.concat(F.array(F.lit(source), F.col("flow")), X.dim_tags(dims)).alias("tags"),
        X.series_api_url(F.col("flow"), F.col("dim_codes")).alias("url"),
        F.lit("time_series").alias("type"),
        F.col("last_value"),
        F.when(has_obs, F.concat(F.col("last_period"), F.lit(": "), X.py_number("last_value")))
        .otherwise(F.lit("")).alias("last_observation"),
        count.alias("count"),
        dims.alias("dimensions"),
        F.coalesce(F.col("dimension_names"), F.array().cast("array<string>")).alias("dimension_names"),
        F.current_timestamp().alias("normalized_at"),
    )


def build_catalog(*dfs: DataFrame, conform: bool = False) -> DataFrame:
    """Union of sources with different columns.

    ``unionByName(allowMissingColumns=True)`` fills absent extension columns
    with nulls; a union is a narrow operation (no shuffle).  ``conform=True``
    also casts to the full catalogue schema, in its column order.
    """
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    if conform:
        cols = []
        for f in CATALOG.fields:
            cols.append((F.col(f.name) if f.name in out.columns else F.lit(None))
                        .cast(f.dataType).alias(f.name))
        out = out.select(*cols)
    return out


def code_map(pages: DataFrame, md_col: str = "md") -> DataFrame:
    """Code-to-name pairs from Markdown table rows ``| **CODE** | name |``."""
    pat = r"\|\s*\*\*(\w+)\*\*\s*\|\s*([^|]+?)\s*\|"
    codes = F.regexp_extract_all(F.col(md_col), F.lit(pat), 1)
    names = F.regexp_extract_all(F.col(md_col), F.lit(pat), 2)
    z = pages.select(F.explode(F.arrays_zip(codes.alias("code"), names.alias("name"))).alias("_z"))
    return z.select(F.col("_z")["code"].alias("code"), X.strip_ws(F.col("_z")["name"]).alias("name"))
