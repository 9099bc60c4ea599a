"""Normaliser and renderer queries (S2/S3 shapes, N1-N3, J1-J3, A8, X6-X8, X19, X21, X22, K3-K7, F9).

Stand-in inputs are built from the driver tables by plain projections:
documents play raw papers, pages play raw reports, customers play statistical
operations and orders their tables.  Bundles are rendered by the library's
own renderers (K3-K5) and parsed back by the normalisers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions import text as X
from vitrina.operators import lines as LN
from vitrina.operators import normalize as N
from vitrina.operators import render as R
from vitrina.plans.catalog import GEO_PATTERN, virtual_catalog
from vitrina.plans.registry import register
from vitrina.sources.tables import table

def sql_json_string(e: str) -> str:
    s = f"coalesce({e}, '')"
    s = f"replace({s}, '\\', '\\\\')"
    s = f"replace({s}, '\"', '\\\"')"
    for code, esc in ((10, "\\n"), (13, "\\r"), (9, "\\t"), (8, "\\b"), (12, "\\f")):
        s = f"replace({s}, chr({code}), '{esc}')"
    enc = ("array_to_string(list_transform(string_split({s}, ''), lambda ch: CASE WHEN unicode(ch) < 32 "
           "OR unicode(ch) > 127 THEN '\\u' || lpad(lower(hex(unicode(ch))), 4, '0') ELSE ch END), '')")
    return "'\"' || " + enc.format(s=s) + " || '\"'"


def sql_json_list(e: str) -> str:
    return f"'[' || array_to_string(list_transform({e}, lambda x: {sql_json_string('x')}), ', ') || ']'"


# ---------------------------------------------------------------------------
# papers: K3 bundles + N1
# ---------------------------------------------------------------------------
def paper_rows(docs: DataFrame) -> DataFrame:
    """Documents as listing papers: slug, title, abstract, authors of the first line."""
    first_line = F.substring_index("text", "\n", 1)
    return docs.select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("id"),
        F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("abstract"),
        X.split_authors(first_line, ",").alias("authors"), F.lit("").alias("date_iso"),
        F.lit("").alias("published"),
        F.concat(F.lit("https://docs.example/doc"), F.col("doc_id").cast("string")).alias("url"),
        F.lit("").alias("pdf_url"), F.lit("").alias("pdf_local"), F.lit("").alias("scraped_at"),
        F.lit("Funcas").alias("source"), "lang", "n_chars", "doc_id")


def paper_bundles(spark, sf) -> DataFrame:
    return R.render_paper_bundle(paper_rows(table(spark, sf, "documents")))


_PAPER_SQL = r"""
pr AS (
  SELECT doc_id, lang, n_chars, 'doc' || CAST(doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title, text AS abstract,
         list_filter(list_transform(string_split(split_part(text, chr(10), 1), ','),
                                    lambda x: regexp_replace(x, '^@WS@+|@WS@+$', '', 'g')), lambda x: x <> '') AS authors,
         'https://docs.example/doc' || CAST(doc_id AS VARCHAR) AS url FROM documents),
pb AS (
  SELECT id, replace(title, '"', '''') AS t, replace(abstract, '"', '''') AS d, authors, url FROM pr),
pk AS (
  SELECT *, CASE WHEN contains(lower(t), 'técnica') OR contains(lower(d), 'técnica') THEN 'nota_tecnica'
                 ELSE 'documento_trabajo' END AS dtype FROM pb),
bundles AS (
  SELECT id, '---' || chr(10) || 'okf_version: "1.0.0"' || chr(10) || 'title: "' || t || '"' || chr(10)
    || 'description: "' || substr(d, 1, 500) || '"' || chr(10) || 'source: "Funcas"' || chr(10)
    || 'type: "' || dtype || '"' || chr(10) || 'authors: ' || {authors_json} || chr(10)
    || 'date: ""' || chr(10) || 'published: ""' || chr(10) || 'lang: "es"' || chr(10)
    || 'url: "' || url || '"' || chr(10) || 'pdf_url: ""' || chr(10) || 'pdf_path: ""' || chr(10)
    || 'tags: ' || {tags_json} || chr(10) || 'scraped_at: ""' || chr(10)
    || 'okf_concept: "funcas/documents/' || id || '"' || chr(10) || '---' || chr(10) || chr(10)
    || '# ' || t || chr(10) || chr(10) || '## Resumen' || chr(10) || chr(10) || substr(d, 1, 2000) || chr(10) || chr(10)
    || '## Metadatos' || chr(10) || chr(10) || '- **Fuente:** Funcas' || chr(10) || '- **Tipo:** ' || dtype || chr(10)
    || '- **Fecha:** ' || chr(10)
    || '- **Autores:** ' || CASE WHEN len(authors) > 0 THEN array_to_string(authors, ', ') ELSE 'No especificado' END
    || chr(10) || '- **URL:** [' || url || '](' || url || ')' || chr(10) || '- **PDF:** []()' || chr(10) || chr(10)
    || '## Contenido' || chr(10) || chr(10) || 'Documento de investigación económica publicado por Funcas.' || chr(10)
    AS content
  FROM pk)""".replace("{authors_json}", sql_json_list("authors")).replace(
    "{tags_json}", sql_json_list("['economía', 'españa', 'funcas', CASE WHEN dtype = 'nota_tecnica' "
                                 "THEN 'nota técnica' ELSE 'documento de trabajo' END]"))


@register("bundle_text", "WITH" + _PAPER_SQL + "\nSELECT id, content FROM bundles")
def bundle_text(spark, sf):
    return paper_bundles(spark, sf)


@register("front_matter", "WITH" + _PAPER_SQL + r"""
SELECT id, nullif(regexp_extract(content, '(?m)^title:\s*"(.+)"$', 1), '') AS title,
       nullif(regexp_extract(content, '(?m)^url:\s*"(.+)"$', 1), '') AS url,
       nullif(regexp_extract(content, '(?m)^okf_concept:\s*"(.+)"$', 1), '') AS concept,
       nullif(regexp_extract(content, '\*\*URL:\*\*\s*\[.+?\]\((.+?)\)', 1), '') AS body_url,
       nullif(regexp_extract(content, '\[(.+?)\]\((.+?)\)', 1), '') AS link_text,
       nullif(regexp_extract(content, '\[(.+?)\]\((.+?)\)', 2), '') AS link_url
FROM bundles""")
def front_matter(spark, sf):
    b = paper_bundles(spark, sf)
    c = F.col("content")
    return b.select("id", X.front_matter(c, "title").alias("title"), X.front_matter(c, "url").alias("url"),
                    X.front_matter(c, "okf_concept").alias("concept"), X.body_url(c).alias("body_url"),
                    X.md_link_text(c).alias("link_text"), X.md_link_url(c).alias("link_url"))


@register("normalize_papers", "WITH" + _PAPER_SQL + r""",
raw AS (SELECT id, CASE WHEN n_chars < 1000 THEN '' ELSE url END AS url,
               CASE WHEN lang = 'de' THEN '' ELSE title END AS title,
               array_to_string(authors, ',') AS author_raw FROM pr),
j AS (SELECT raw.*, b.content FROM raw LEFT JOIN (SELECT * FROM bundles WHERE id IN (SELECT id FROM pr WHERE lang = 'en')) b USING (id))
SELECT 'funcas-' || id AS id,
       coalesce(nullif(regexp_extract(content, '(?m)^title:\s*"(.+)"$', 1), ''), nullif(title, ''), id) AS title,
       '' AS date_iso,
       coalesce(nullif(regexp_extract(content, '(?m)^description:\s*"(.+)"$', 1), ''),
                CASE WHEN regexp_matches(content, '(?s)## Resumen[ \t]*(\n|$)')
                     THEN substr(regexp_replace(regexp_extract(content, '(?s)## Resumen[ \t]*\n(.*?)(?:\n##|$)', 1),
                                                '^@WS@+|@WS@+$', '', 'g'), 1, 500) END, '') AS description,
       coalesce(nullif(url, ''), nullif(regexp_extract(content, '\*\*URL:\*\*\s*\[.+?\]\((.+?)\)', 1), ''), '') AS url,
       array_to_string(list_filter(list_transform(string_split(author_raw, ','),
                                                  lambda x: regexp_replace(x, '^@WS@+|@WS@+$', '', 'g')),
                                   lambda x: x <> ''), '|') AS authors,
       '' AS date_raw, 'working_paper' AS type
FROM j""")
def normalize_papers(spark, sf):
    rows = paper_rows(table(spark, sf, "documents"))
    raw = rows.select("id", F.when(F.col("n_chars") < 1000, F.lit("")).otherwise(F.col("url")).alias("url"),
                      F.lit("").alias("lastmod"),
                      F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("title")).alias("title"),
                      F.array_join("authors", ",").alias("author_raw"), F.lit("").alias("date"),
                      F.lit("Funcas").alias("source"), F.lit("").alias("scraped_at"),
                      F.lit(None).cast("string").alias("pdf_url"))
    # only English papers have a bundle: an item without one keeps its raw fields
    n = N.normalize_papers(raw, R.render_paper_bundle(rows.filter(F.col("lang") == "en")))
    return n.select("id", "title", "date_iso", "description", "url", F.array_join("authors", "|").alias("authors"),
                    "date_raw", "type")


# ---------------------------------------------------------------------------
# reports: K4 bundles + N2 + F8
# ---------------------------------------------------------------------------
def report_rows(pages: DataFrame) -> DataFrame:
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    geo = F.regexp_extract("url", GEO_PATTERN, 1)
    return pages.select(X.slug40(title).alias("id"), title.alias("title"), F.lit("").alias("description"),
                        geo.alias("geography"), F.lit("").alias("technique"), F.lit("").alias("date_raw"),
                        F.col("url"), F.lit("").alias("pdf_url"), F.lit("informe").alias("type"),
                        F.lit("").alias("scraped_at"), "page_id")


_REPORT_SQL = r"""
rr AS (
  SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
         trim(regexp_replace(lower(substr(regexp_extract(html, '<title>(.*?)</title>', 1), 1, 40)),
                             '[^a-z0-9]+', '-', 'g'), '-') AS id,
         regexp_extract(url, '^[a-z]+://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)', 1) AS geography FROM pages),
rb AS (
  SELECT id, page_id, geography AS geo_page, '---' || chr(10) || 'okf_version: "1.0.0"' || chr(10) || 'title: "' || replace(title, '"', '''') || '"'
    || chr(10) || 'description: ""' || chr(10) || 'source: "BBVA Research"' || chr(10) || 'type: "informe"' || chr(10)
    || 'geography: "' || geography || '"' || chr(10) || 'technique: ""' || chr(10) || 'date: ""' || chr(10)
    || 'url: "' || url || '"' || chr(10) || 'pdf_url: ""' || chr(10)
    || 'tags: ' || {tags_json} || chr(10) || 'scraped_at: ""' || chr(10)
    || 'okf_concept: "bbva/documents/' || id || '"' || chr(10) || '---' || chr(10) || chr(10)
    || '# ' || replace(title, '"', '''') || chr(10) || chr(10) || '## Metadatos' || chr(10) || chr(10)
    || '- **Fuente:** BBVA Research' || chr(10) || '- **Geografía:** '
    || CASE WHEN geography <> '' THEN geography ELSE 'No especificada' END || chr(10)
    || '- **Técnica:** ' || chr(10) || '- **Fecha:** ' || chr(10) || '- **URL:** [' || url || '](' || url || ')'
    || chr(10) AS content
  FROM rr)""".replace("{tags_json}", sql_json_list(
    "['BBVA Research', 'economía', CASE WHEN geography <> '' THEN lower(geography) ELSE 'españa' END]"))


@register("report_bundle", "WITH" + _REPORT_SQL + "\nSELECT id, content FROM rb")
def report_bundle(spark, sf):
    return R.render_report_bundle(report_rows(table(spark, sf, "pages")))


@register("normalize_reports", "WITH" + _REPORT_SQL + r""",
raw AS (SELECT id, title, CASE WHEN geography = 'en' THEN url ELSE '' END AS url FROM rr),
sys AS (SELECT DISTINCT id FROM rr WHERE contains(url, 'spam-farm')),
b AS (SELECT id, arg_max(content, page_id) AS content FROM rb WHERE geo_page = 'es' GROUP BY id),
j AS (SELECT raw.*, b.content FROM raw LEFT JOIN b USING (id) WHERE raw.id NOT IN (SELECT id FROM sys)),
k AS (SELECT *, CASE WHEN contains(lower(id), 'espana') OR contains(lower(id), 'españa')
                          OR contains(lower(id), 'espa-a') THEN 'España'
                     WHEN contains(lower(id), 'global') THEN 'Global' ELSE '' END AS geo FROM j)
SELECT 'bbva-' || id AS id,
       coalesce(nullif(regexp_extract(content, '(?m)^title:\s*"(.+)"$', 1), ''), nullif(title, ''), id) AS title,
       coalesce(nullif(regexp_extract(content, '(?m)^description:\s*"(.+)"$', 1), ''), '') AS description,
       coalesce(nullif(url, ''), nullif(regexp_extract(content, '(?m)^url:\s*"(.+)"$', 1), ''),
                'https://www.bbvaresearch.com/publicaciones/' || id || '/') AS url,
       geo AS geography, CASE WHEN geo <> '' THEN 'economía|' || geo ELSE 'economía' END AS tags
FROM k""")
def normalize_reports(spark, sf):
    rows = report_rows(table(spark, sf, "pages"))
    raw = rows.select("id", "title", F.when(F.col("geography") == "en", F.col("url")).otherwise(F.lit("")).alias("url"),
                      "date_raw", "technique", F.lit("BBVA Research").alias("source"))
    system = rows.filter(F.col("url").contains("spam-farm")).select("id").distinct()
    # pages that share a slug share a bundle file; the page written last holds it
    bundles = R.render_report_bundle(rows.filter(F.col("geography") == "es").withColumn("ordinal", F.col("page_id")))
    n = N.normalize_reports(raw, bundles, system_pages=system)
    return n.select("id", "title", "description", "url", "geography", F.array_join("tags", "|").alias("tags"))


# ---------------------------------------------------------------------------
# datasets: X22 code map, K5 bundles, N3, K7
# ---------------------------------------------------------------------------
def operations(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("Id"), F.col("c_name").alias("Nombre"),
                    F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("C"), F.col("c_custkey").cast("string")))
                    .otherwise(F.lit("")).alias("Codigo"), "c_mktsegment")


def op_tables(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("o_orderdate"))
    return o.select(F.col("o_custkey").alias("op_id"), F.col("o_orderkey").alias("Id"),
                    F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("Nombre"),
                    ms.alias("Ultima_Modificacion"))


def index_pages(spark, sf) -> DataFrame:
    """Stand-in index text: one Markdown table row per customer."""
    c = table(spark, sf, "customer")
    return c.select(F.concat(F.lit("| **C"), F.col("c_custkey").cast("string"), F.lit("** | "),
                             F.col("c_mktsegment"), F.lit(" segment |")).alias("md"))


_K5_SQL = r"""
ops AS (SELECT c_custkey AS Id, c_name AS Nombre, CASE WHEN c_acctbal >= 0 THEN 'C' || CAST(c_custkey AS VARCHAR)
                                                      ELSE '' END AS Codigo, c_mktsegment FROM customer),
ft AS (SELECT o_custkey AS op_id, o_orderkey AS Id FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 10),
tn AS (SELECT o_custkey AS op_id, count(*) AS n FROM orders GROUP BY 1),
sc AS (SELECT o_custkey AS op_id, count(*) AS ns, CAST(sum(l_quantity) AS BIGINT) AS nv FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
bl AS (SELECT op_id,
              string_agg('- [Order ' || CAST(Id AS VARCHAR) || '](https://servicios.ine.es/wstempus/js/ES/DATOS_TABLA/'
                         || CAST(Id AS VARCHAR) || ') (id=' || CAST(Id AS VARCHAR) || ')' || chr(10), '' ORDER BY Id) AS items
       FROM ft GROUP BY op_id),
kb AS (
  SELECT CASE WHEN Codigo <> '' THEN lower(Codigo) ELSE 'op' || CAST(ops.Id AS VARCHAR) END AS id, c_mktsegment,
    '---' || chr(10) || 'okf_version: "1.0.0"' || chr(10) || 'title: "' || Nombre || '"' || chr(10)
    || 'description: "Operación estadística del INE: ' || Nombre || '. ' || CAST(coalesce(n, 0) AS VARCHAR)
    || ' tablas disponibles con ' || CAST(coalesce(ns, 0) AS VARCHAR) || ' series y ' || CAST(coalesce(nv, 0) AS VARCHAR) || ' valores."' || chr(10) || 'source: "INE"' || chr(10) || 'type: "dataset"'
    || chr(10) || 'operation_id: ' || CAST(ops.Id AS VARCHAR) || chr(10) || 'operation_code: "' || Codigo || '"' || chr(10)
    || 'tables_count: ' || CAST(coalesce(n, 0) AS VARCHAR) || chr(10) || 'series_count: ' || CAST(coalesce(ns, 0) AS VARCHAR) || chr(10)
    || 'values_count: ' || CAST(coalesce(nv, 0) AS VARCHAR) || chr(10) || 'tags: ["INE", "econom\u00eda espa\u00f1ola", "datos abiertos"]' || chr(10)
    || 'license: "CC BY-SA 4.0"' || chr(10) || 'url: "https://www.ine.es/dyngs/DAB/index.htm?cid=1722"' || chr(10)
    || 'api_endpoint: "https://servicios.ine.es/wstempus/js/ES/TABLAS_OPERACION/' || CAST(ops.Id AS VARCHAR) || '"'
    || chr(10) || 'scraped_at: ""' || chr(10) || 'okf_concept: "ine/datasets/'
    || CASE WHEN Codigo <> '' THEN lower(Codigo) ELSE CAST(ops.Id AS VARCHAR) END || '"' || chr(10) || '---' || chr(10)
    || chr(10) || '# ' || Nombre || chr(10) || chr(10) || '## Descripción' || chr(10) || chr(10)
    || 'Operación estadística del INE con código **' || Codigo || '**.' || chr(10) || chr(10)
    || '## Tablas disponibles (' || CAST(coalesce(n, 0) AS VARCHAR) || ')' || chr(10) || chr(10)
    || coalesce(items, '') || chr(10) || chr(10) || '## Acceso API' || chr(10) || chr(10)
    || '**Endpoint REST:** `https://servicios.ine.es/wstempus/js/ES/TABLAS_OPERACION/' || CAST(ops.Id AS VARCHAR) || '`'
    || chr(10) || chr(10) || '**Datos:** `https://servicios.ine.es/wstempus/js/ES/DATOS_TABLA/{table_id}`' || chr(10)
    || chr(10) || '**Formato:** JSON. Fechas en timestamp Unix (ms). Periodo = número de mes.' || chr(10) AS content
  FROM ops LEFT JOIN bl ON ops.Id = bl.op_id LEFT JOIN tn ON ops.Id = tn.op_id LEFT JOIN sc ON ops.Id = sc.op_id)"""


@register("dataset_bundle", "WITH" + _K5_SQL + "\nSELECT id, content FROM kb")
def dataset_bundle(spark, sf):
    return R.render_dataset_bundle(operations(spark, sf), op_tables(spark, sf), stored_series(spark, sf))


def stored_series(spark, sf) -> DataFrame:
    """Stand-in input: series per operation (line items of a customer's orders) and their stored values (quantities)."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("op_id"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    return o.join(li, "o_orderkey").groupBy("op_id").agg(F.count(F.lit(1)).alias("n_series"), F.sum("l_quantity").cast("bigint").alias("n_values"))


@register("code_map", r"""
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS code, c_mktsegment || ' segment' AS name FROM customer""")
def code_map(spark, sf):
    return N.code_map(index_pages(spark, sf), "md")


@register("normalize_datasets", "WITH" + _K5_SQL + r""",
t AS (SELECT o_custkey AS op_id, count(*) AS n, max(nullif(epoch_ms(o_orderdate), 0)) AS mx FROM orders GROUP BY 1)
SELECT CASE WHEN Codigo <> '' THEN 'ine-' || lower(Codigo) ELSE 'ine-op' || CAST(ops.Id AS VARCHAR) END AS id,
       Nombre AS title, coalesce(strftime(make_timestamp(mx * 1000), '%Y-%m-%d'), '') AS date_iso,
       CASE WHEN Codigo <> '' THEN ops.c_mktsegment || ' segment' ELSE Nombre END AS description,
       CASE WHEN Codigo <> '' THEN 'INE|economía española|' || lower(Codigo) ELSE 'INE' END AS tags,
       CASE WHEN Codigo <> '' AND ops.c_mktsegment = 'BUILDING' THEN 'https://www.ine.es/dyngs/DAB/index.htm?cid=1722'
            ELSE '' END AS url,
       ops.Id AS operation_id, Codigo AS operation_code, coalesce(t.n, 0) AS tables_count
FROM ops LEFT JOIN t ON ops.Id = t.op_id""")
def normalize_datasets(spark, sf):
    ops = operations(spark, sf)
    tabs = op_tables(spark, sf)
    bundles = R.render_dataset_bundle(ops.filter(F.col("c_mktsegment") == "BUILDING"), tabs)
    n = N.normalize_datasets(ops.drop("c_mktsegment"), tabs, bundles, code_map=N.code_map(index_pages(spark, sf)))
    return n.select("id", "title", "date_iso", "description", F.array_join("tags", "|").alias("tags"), "url",
                    "operation_id", "operation_code", "tables_count")


@register("last_modified", """
SELECT o_custkey AS op_id, strftime(max(o_orderdate), '%Y-%m-%d') AS last_max,
       strftime(arg_min(o_orderdate, o_orderkey), '%Y-%m-%d') AS first_listed
FROM orders GROUP BY 1""")
def last_modified(spark, sf):
    # The latest modification, and the one of the first table listed
    from vitrina.operators.summary import last_modified as lm
    t = op_tables(spark, sf)
    both = lm(t, "op_id", "Ultima_Modificacion", "both", order_col="Id")
    return both.select("op_id", X.epoch_ms_date("last_modified").alias("last_max"), X.epoch_ms_date("first_modified").alias("first_listed"))


def _numbered(lines: DataFrame) -> DataFrame:
    """An index with the number of each line, as the ordered writer would put them."""
    from vitrina.operators.dedupe import ordinal_within
    return ordinal_within(lines.withColumn("doc", F.lit(0)), ["doc"], R.INDEX_ORDER, "line_no").select("line_no", "line")


def _head_sql(kind: str, count: str, first: str = "NULL", last: str = "NULL") -> str:
    """Heading lines of an index as (k1, k2, k3, k4, line)."""
    line = f"replace(line, '{{n}}', CAST(({count}) AS VARCHAR))"
    for mark, sql in (("from", first), ("to", last)):
        line = f"replace({line}, '{{{mark}}}', coalesce(({sql}), 'sin fecha'))"
    texts = ", ".join("'" + x.replace("'", "''").replace("{at}", "") + "'" for x in R.INDEX_HEADS[kind])
    return f"""SELECT 0 AS k1, 0 AS k2, k3, NULL AS k4, {line} AS line
      FROM (SELECT CAST(generate_subscripts(h, 1) AS INTEGER) - 1 AS k3, unnest(h) AS line FROM (SELECT [{texts}] AS h))"""


_NUMBERED_SQL = "\nSELECT row_number() OVER (ORDER BY k1, k2, k3, k4 NULLS FIRST) - 1 AS line_no, line FROM x"


@register("list_index", "WITH x AS (" + _head_sql("operations", "SELECT count(*) FROM customer") + r"""
UNION ALL SELECT 2, 0, 1, c_custkey,
       '- [' || CASE WHEN c_acctbal >= 0 THEN 'C' || CAST(c_custkey AS VARCHAR) ELSE '' END || '](conceptos/'
       || CASE WHEN c_acctbal >= 0 THEN 'c' || CAST(c_custkey AS VARCHAR) ELSE 'op' || CAST(c_custkey AS VARCHAR) END
       || '.md) — ' || substr(c_name, 1, 80) AS line FROM customer
UNION ALL SELECT 2, 0, 0, NULL, chr(10) || '## Todas las Operaciones' || chr(10)
UNION ALL
SELECT 1, 0, 0, c_custkey,
       chr(10) || '### [' || c_name || '](conceptos/'
       || CASE WHEN c_acctbal >= 0 THEN 'c' || CAST(c_custkey AS VARCHAR) ELSE 'op' || CAST(c_custkey AS VARCHAR) END
       || '.md)' || chr(10) || '- **Código:** ' || CASE WHEN c_acctbal >= 0 THEN 'C' || CAST(c_custkey AS VARCHAR) ELSE '' END
       || ' | **ID:** ' || CAST(c_custkey AS VARCHAR) || chr(10) || '- **API:** `TABLAS_OPERACION/'
       || CAST(c_custkey AS VARCHAR) || '`' FROM customer WHERE c_acctbal > 9000)""" + _NUMBERED_SQL)
def list_index(spark, sf):
    # K7 with F9: key operations (here: accounts over 9000) get their own section
    ops = operations(spark, sf).withColumn("ordinal", F.col("Id"))
    c = table(spark, sf, "customer")
    key = c.filter(F.col("c_acctbal") > 9000).select(F.col("c_custkey").alias("Id"))
    return _numbered(R.render_list_index(ops, "operations", key_ids=key))


@register("report_index", "WITH" + _REPORT_SQL + ", x AS (" + _head_sql("reports", "SELECT count(*) FROM pages") + r"""
UNION ALL SELECT 1, 0, 0, page_id, '- [' || title || '](conceptos/' || id || '.md) —  ' || geography FROM rr)""" + _NUMBERED_SQL)
def report_index(spark, sf):
    # K7, reports: in the order of their pages
    return _numbered(R.render_list_index(report_rows(table(spark, sf, "pages")), "reports", order_col="page_id"))


@register("high_value_index", "WITH x AS (" + _head_sql("high_value", "SELECT count(*) FROM part") + r"""
UNION ALL SELECT 1, 0, 0, p_partkey, '- **' || p_name || '** (' || p_brand || ') — `c=' || CAST(p_size AS VARCHAR) || '`' FROM part)""" + _NUMBERED_SQL)
def high_value_index(spark, sf):
    # K7, high-value datasets: parts stand in for datasets (name, code, download key)
    p = table(spark, sf, "part").select(F.col("p_size").alias("cap"), F.col("p_name").alias("name"), F.col("p_brand").alias("code"), F.col("p_partkey").alias("ordinal"))
    return _numbered(R.render_list_index(p, "high_value"))


@register("year_index", r"""
WITH cat AS (SELECT 'ord-' || CAST(o_orderkey AS VARCHAR) AS id, 'Order ' || CAST(o_orderkey AS VARCHAR) AS title,
                    strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders
             UNION ALL SELECT 'doc-' || CAST(doc_id AS VARCHAR), split_part(text, chr(10), 1), '' FROM documents),
y AS (SELECT *, coalesce(nullif(regexp_extract(date, '(\d{4})', 1), ''), 'sin_fecha') AS year FROM cat),
x AS (""" + _head_sql("years", "SELECT count(*) FROM cat", *[f"SELECT {m}(year) FROM y WHERE year <> 'sin_fecha'" for m in ("min", "max")]) + r"""
UNION ALL SELECT 1, coalesce(-TRY_CAST(year AS INTEGER), -10000), 0, NULL,
       chr(10) || '### ' || year || ' (' || CAST(count(*) AS VARCHAR) || ' documentos)' || chr(10)
FROM y GROUP BY year
UNION ALL
SELECT 1, coalesce(-TRY_CAST(year AS INTEGER), -10000), 1, id, '- [' || title || '](conceptos/' || id || '.md) — ' FROM y)""" + _NUMBERED_SQL)
def year_index(spark, sf):
    cat = virtual_catalog(spark, sf).filter(F.col("type").isin("dataset", "working_paper"))
    papers = cat.select("id", "title", F.col("date_iso").alias("date"),
                        F.array().cast("array<string>").alias("authors"), F.col("id").alias("ordinal"))
    return _numbered(R.render_year_index(papers, "ordinal"))


@register("listing_blocks", r"""
WITH pg AS (SELECT doc_id, '## [' || regexp_replace(split_part(text, chr(10), 1), '[\[\]\n]', ' ', 'g')
                             || '](https://docs.example/doc' || CAST(doc_id AS VARCHAR) || ')' || chr(10) || text AS md
            FROM documents),
l AS (SELECT doc_id, unnest(string_split(md, chr(10))) AS line,
             unnest(range(0, len(string_split(md, chr(10))))) AS ln FROM pg),
b AS (SELECT *, regexp_matches(line, '^## \[(.+?)\]\((.+?)\)') AS is_head,
             sum(CASE WHEN regexp_matches(line, '^## \[(.+?)\]\((.+?)\)') THEN 1 ELSE 0 END)
               OVER (PARTITION BY doc_id ORDER BY ln ROWS UNBOUNDED PRECEDING) AS block FROM l),
c AS (SELECT *, regexp_replace(line, '^@WS@+|@WS@+$', '', 'g') AS st,
             NOT is_head AND NOT contains(line, 'Fecha:') AND regexp_replace(line, '^@WS@+|@WS@+$', '', 'g') <> ''
             AND NOT (starts_with(line, '#') OR starts_with(line, '[') OR starts_with(line, '!') OR starts_with(line, '*'))
             AND length(regexp_replace(line, '^@WS@+|@WS@+$', '', 'g')) < 100 AND NOT starts_with(line, 'http')
             AND NOT (contains(lower(line), 'fecha') OR contains(lower(line), 'versión') OR contains(lower(line), 'download')
                      OR contains(lower(line), 'pdf') OR contains(lower(line), 'política')
                      OR contains(lower(line), 'funcas') OR contains(lower(line), 'publicaciones')) AS is_author
      FROM b WHERE block > 0)
SELECT doc_id, CAST(block AS INTEGER) AS block,
       regexp_replace(arg_max(regexp_extract(line, '^## \[(.+?)\]\((.+?)\)', 1), ln) FILTER (WHERE is_head),
                      '^@WS@+|@WS@+$', '', 'g') AS title,
       regexp_replace(arg_max(regexp_extract(line, '^## \[(.+?)\]\((.+?)\)', 2), ln) FILTER (WHERE is_head),
                      '^@WS@+|@WS@+$', '', 'g') AS url,
       CAST(NULL AS VARCHAR) AS date,
       arg_max(st, ln) FILTER (WHERE is_author) AS author_raw
FROM c GROUP BY doc_id, block""")
def listing_blocks(spark, sf):
    d = table(spark, sf, "documents")
    head = F.concat(F.lit("## ["), F.regexp_replace(F.substring_index("text", "\n", 1), r"[\[\]\n]", " "),
                    F.lit("](https://docs.example/doc"), F.col("doc_id").cast("string"), F.lit(")\n"))
    pages = d.select("doc_id", F.concat(head, F.col("text")).alias("md"))
    return LN.paper_listing(pages, "doc_id", "md")


@register("report_listing", r"""
SELECT page_id, CAST(1 AS INTEGER) AS block, label || 'T ' || title AS title, CAST(page_id % 28 + 1 AS VARCHAR) || ' noviembre 2020' AS date_raw,
       'https://www.bbvaresearch.com/publicaciones/p' || CAST(page_id AS VARCHAR) || '/' AS url,
       CASE WHEN label <> '' THEN regexp_extract(label, '^(.+?) ', 1) END AS geography, CASE WHEN geo = 'fr' THEN 'big-data' END AS technique
FROM (SELECT page_id, regexp_replace(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '[\[\]\n]', ' ', 'g') AS title,
             regexp_extract(url, '^[a-z]+://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)', 1) AS geo,
             CASE geo WHEN 'es' THEN 'España | ' WHEN 'en' THEN 'Global | ' WHEN 'de' THEN 'Europa | ' ELSE '' END AS label FROM pages)""")
def report_listing(spark, sf):
    # X19, report form, D12: headings are links, as the publisher's pages have them
    geo = F.regexp_extract("url", GEO_PATTERN, 1)
    label = F.when(geo == "es", "España | ").when(geo == "en", "Global | ").when(geo == "de", "Europa | ").otherwise("")
    title = F.regexp_replace(F.trim(F.regexp_extract("html", r"<title>([^<]*)</title>", 1)), r"[\[\]\n]", " ")
    pid = F.col("page_id").cast("string")
    md = F.concat(F.lit("intro\n### ["), label, F.lit("T "), title, F.lit("](https://www.bbvaresearch.com/publicaciones/p"), pid, F.lit("/)\nPublicado "),
                  (F.col("page_id") % 28 + 1).cast("string"), F.lit(" Noviembre 2020\n"), F.when(geo == "fr", X.TECHNIQUE_MARKER).otherwise(""))
    return LN.report_listing(table(spark, sf, "pages").select("page_id", md.alias("md")), "page_id", "md", "www.bbvaresearch.com").withColumn(
        "geography", X.blank_to_null("geography"))


@register("md_links", "WITH" + _PAPER_SQL + r"""
SELECT id, CAST(len(regexp_extract_all(content, '\[(.*?)\]\((.+?)\)', 2)) AS INTEGER) AS n_links,
       array_to_string(regexp_extract_all(content, '\[(.*?)\]\((.+?)\)', 1), '|') AS texts,
       array_to_string(regexp_extract_all(content, '\[(.*?)\]\((.+?)\)', 2), '|') AS urls
FROM bundles""")
def md_links(spark, sf):
    # X8 over rendered bundles: every Markdown link, in text order
    b = paper_bundles(spark, sf).select("id", X.md_links("content").alias("links"))
    return b.select("id", F.size("links").alias("n_links"),
                    F.array_join(F.transform("links", lambda l: l["text"]), "|").alias("texts"),
                    F.array_join(F.transform("links", lambda l: l["url"]), "|").alias("urls"))
