"""Bundle and index rendering (K3-K7).

A bundle is one row ``(id, content)`` built with native string functions.
An index is never one text: it is a table of lines ``(k1, k2, k3, line)``
whose sort keys give the file order, so a collection of any size is rendered
by all tasks and written in order by a range-partitioned sink
(``sinks.write_lines``).  Lists inside a bundle are bounded (the dataset
bundle lists its first 10 tables, as the reference does).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.functions import text as X

# Bundle format constants.
BUNDLE_FORMAT_VERSION = "1.0.0"
NO_AUTHORS = "No especificado"
PAPER_BODY_NOTE = "Documento de investigación económica publicado por Funcas."
DATASET_LICENSE = "CC BY-SA 4.0"
DATASET_URL = "https://www.ine.es/dyngs/DAB/index.htm?cid=1722"
DATASET_API = "https://servicios.ine.es/wstempus/js/ES/"
BUNDLE_TABLES = 10  # tables listed in a dataset bundle


def _cc(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_string(c: Column | str) -> Column:
    """A JSON string literal as Python's ``json.dumps`` writes it (ASCII only).

    Escapes backslash, quote and control characters; every non-ASCII
    character becomes ``\\uXXXX``.
    """
    s = F.coalesce(_cc(c), F.lit(""))
    s = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    s = F.replace(s, F.lit('"'), F.lit('\\"'))
    for ch, esc in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        s = F.replace(s, F.lit(ch), F.lit(esc))
    chars = F.split(s, "")

    def enc(ch):
        code = F.ascii(ch)
        hexed = F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))
        return F.when((code < 32) | (code > 127), hexed).otherwise(ch)
    escaped = F.when(s.rlike(r"[^\x20-\x7f]"), F.array_join(F.transform(chars, enc), "")).otherwise(s)
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def json_list(c: Column | str) -> Column:
    """``json.dumps(list_of_str)``: ``["a", "b"]`` with ``, `` separators."""
    arr = F.coalesce(_cc(c), F.array().cast("array<string>"))
    return F.concat(F.lit("["), F.array_join(F.transform(arr, json_string), ", "), F.lit("]"))


def _lines(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def render_paper_bundle(df: DataFrame) -> DataFrame:
    """Paper bundle (K3).  Input columns: id, title, abstract, authors, date_iso,
    published, url, pdf_url, pdf_local, scraped_at, source."""
    title = X.clean_quotes(F.coalesce(F.col("title"), F.lit("Sin título")))
    desc = X.clean_quotes(F.coalesce(F.col("abstract"), F.lit("")))
    dtype = X.doc_type(title, desc)
    tags = F.array(F.lit("economía"), F.lit("españa"), F.lit("funcas"), X.doc_type_tag(title, desc))
    authors = F.coalesce(F.col("authors"), F.array().cast("array<string>"))
    authors_txt = F.when(F.size(authors) > 0, F.array_join(authors, ", ")).otherwise(F.lit(NO_AUTHORS))
    url, pdf = F.coalesce(F.col("url"), F.lit("")), F.coalesce(F.col("pdf_url"), F.lit(""))
    content = _lines(
        '---\nokf_version: "', BUNDLE_FORMAT_VERSION, '"\ntitle: "', title, '"\ndescription: "',
        F.substring(desc, 1, 500), '"\nsource: "Funcas"\ntype: "', dtype, '"\nauthors: ', json_list(authors),
        '\ndate: "', F.coalesce(F.col("date_iso"), F.lit("")), '"\npublished: "',
        F.coalesce(F.col("published"), F.lit("")), '"\nlang: "es"\nurl: "', url, '"\npdf_url: "', pdf,
        '"\npdf_path: "', F.coalesce(F.col("pdf_local"), F.lit("")), '"\ntags: ', json_list(tags),
        '\nscraped_at: "', F.coalesce(F.col("scraped_at"), F.lit("")), '"\nokf_concept: "funcas/documents/',
        F.col("id"), '"\n---\n\n# ', title, "\n\n## Resumen\n\n", F.substring(desc, 1, 2000),
        "\n\n## Metadatos\n\n- **Fuente:** ", F.coalesce(F.col("source"), F.lit("Funcas")),
        "\n- **Tipo:** ", dtype, "\n- **Fecha:** ", F.coalesce(F.col("date_iso"), F.lit("")),
        "\n- **Autores:** ", authors_txt, "\n- **URL:** [", url, "](", url, ")\n- **PDF:** [", pdf, "](", pdf,
        ")\n\n## Contenido\n\n", PAPER_BODY_NOTE, "\n")
    return df.select(F.col("id"), content.alias("content"))


def render_report_bundle(df: DataFrame) -> DataFrame:
    """Report bundle (K4).  Input: id, title, description, geography, technique,
    date_raw, url, pdf_url, type, scraped_at."""
    title = X.clean_quotes(F.coalesce(F.col("title"), F.lit("Sin título")))
    desc = X.clean_quotes(F.coalesce(F.col("description"), F.lit("")))
    geo = F.coalesce(F.col("geography"), F.lit(""))
    tech = F.coalesce(F.col("technique"), F.lit(""))
    tags = F.concat(F.array(F.lit("BBVA Research"), F.lit("economía"),
                            F.when(geo != "", F.lower(geo)).otherwise(F.lit("españa"))),
                    F.when(tech == "big-data", F.array(F.lit("big data"), F.lit("IA")))
                    .otherwise(F.array().cast("array<string>")))
    url = F.coalesce(F.col("url"), F.lit(""))
    date_raw = F.coalesce(F.col("date_raw"), F.lit(""))
    content = _lines(
        '---\nokf_version: "', BUNDLE_FORMAT_VERSION, '"\ntitle: "', title, '"\ndescription: "', F.substring(desc, 1, 500),
        '"\nsource: "BBVA Research"\ntype: "', F.coalesce(F.col("type"), F.lit("informe")),
        '"\ngeography: "', geo, '"\ntechnique: "', tech, '"\ndate: "', date_raw, '"\nurl: "', url,
        '"\npdf_url: "', F.coalesce(F.col("pdf_url"), F.lit("")), '"\ntags: ', json_list(tags),
        '\nscraped_at: "', F.coalesce(F.col("scraped_at"), F.lit("")), '"\nokf_concept: "bbva/documents/',
        F.col("id"), '"\n---\n\n# ', title, "\n\n## Metadatos\n\n- **Fuente:** BBVA Research\n- **Geografía:** ",
        F.when(geo != "", geo).otherwise(F.lit("No especificada")), "\n- **Técnica:** ",
        F.coalesce(F.col("technique"), F.lit("Convencional")), "\n- **Fecha:** ", date_raw,
        "\n- **URL:** [", url, "](", url, ")\n")
    return df.select(F.col("id"), content.alias("content"), *[c for c in df.columns if c == "ordinal"])


def render_dataset_bundle(ops: DataFrame, tables: DataFrame, series_counts: DataFrame | None = None,
                          listed: int = BUNDLE_TABLES) -> DataFrame:
    """Dataset bundle (K5): one per operation, with its table count and its first tables.

    ``ops``: Id, Nombre, Codigo.  ``tables``: op_id, Id, Nombre (listed in
    ``Id`` order, ``listed`` of them; the count is of all, D13).
    ``series_counts``: op_id, n_series, n_values (0 if absent, D10: counts
    come from stored data).  The pick is a ``row_number() <= listed`` (partial
    per task), so only that many rows per operation are gathered into its bundle.
    """
    w = Window.partitionBy("op_id").orderBy("Id")
    first = (tables.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= listed))
    counts = tables.groupBy("op_id").agg(F.count(F.lit(1)).alias("_n"))
    bullets = first.groupBy("op_id").agg(
        F.array_sort(F.collect_list(F.struct("_rn", "Id", "Nombre"))).alias("_t"))
    j = ops.join(bullets, ops["Id"] == bullets["op_id"], "left").drop("op_id")
    j = j.join(counts, j["Id"] == counts["op_id"], "left").drop("op_id")
    if series_counts is not None:
        j = j.join(series_counts, j["Id"] == series_counts["op_id"], "left").drop("op_id")
    else:
        j = j.withColumn("n_series", F.lit(0)).withColumn("n_values", F.lit(0))
    t = F.coalesce(F.col("_t"), F.array())
    n = F.coalesce("_n", F.lit(0)).cast("string")
    name = F.coalesce(F.col("Nombre"), F.lit("Sin nombre"))
    code = F.coalesce(F.col("Codigo"), F.lit(""))
    oid = F.col("Id").cast("string")
    stem = F.when(code != "", F.lower(code)).otherwise(F.concat(F.lit("op"), oid))
    kw = F.concat(F.array(F.lit("INE"), F.lit("economía española"), F.lit("datos abiertos")), X.keyword_tags(name))
    items = F.array_join(F.transform(t, lambda r: F.concat(
        F.lit("- ["), F.coalesce(r["Nombre"], F.lit("???")), F.lit("](" + DATASET_API + "DATOS_TABLA/"),
        r["Id"].cast("string"), F.lit(") (id="), r["Id"].cast("string"), F.lit(")\n"))), "")
    ns, nv = F.coalesce(F.col("n_series"), F.lit(0)).cast("string"), F.coalesce(F.col("n_values"), F.lit(0)).cast("string")
    content = _lines(
        '---\nokf_version: "', BUNDLE_FORMAT_VERSION, '"\ntitle: "', name, '"\ndescription: "Operación estadística del INE: ',
        name, ". ", n, " tablas disponibles con ", ns, " series y ", nv, ' valores."\nsource: "INE"\ntype: "dataset"\n'
        "operation_id: ", oid, '\noperation_code: "', code, '"\ntables_count: ', n, "\nseries_count: ", ns,
        "\nvalues_count: ", nv, "\ntags: ", json_list(kw), '\nlicense: "', DATASET_LICENSE, '"\nurl: "', DATASET_URL,
        '"\napi_endpoint: "', DATASET_API, "TABLAS_OPERACION/", oid, '"\nscraped_at: ""\nokf_concept: "ine/datasets/',
        F.when(code != "", F.lower(code)).otherwise(oid), '"\n---\n\n# ', name,
        "\n\n## Descripción\n\nOperación estadística del INE con código **", code, "**.\n\n## Tablas disponibles (",
        n, ")\n\n", items, "\n\n## Acceso API\n\n**Endpoint REST:** `", DATASET_API, "TABLAS_OPERACION/", oid,
        "`\n\n**Datos:** `", DATASET_API, "DATOS_TABLA/{table_id}`\n\n"
        "**Formato:** JSON. Fechas en timestamp Unix (ms). Periodo = número de mes.\n")
    return j.select(stem.alias("id"), content.alias("content"))


# Front matter and headings of the four index documents ({n}: number of items, {at}: when they were read).
INDEX_HEADS = {
    "years": ["---", 'okf_version: "1.0.0"', 'title: "Funcas - Documentos de Trabajo y Notas Técnicas"',
              'description: "Repositorio OKF de publicaciones económicas de Funcas ({n} documentos, {from}-{to})"', 'source: "Funcas"', 'type: "collection"',
              "total_documents: {n}", 'scraped_at: "{at}"', 'tags: ["funcas", "economía española", "documentos de trabajo", "notas técnicas"]', "---", "",
              "# Funcas - Catálogo de Documentos", "", "Total: **{n} documentos** | Rango: {from}–{to} | Fuente: [Funcas](https://www.funcas.es)", "", "## Por año"],
    "reports": ["---", 'okf_version: "1.0.0"', 'title: "BBVA Research - Publicaciones"',
                'description: "Repositorio OKF de publicaciones económicas de BBVA Research ({n} documentos)"', 'source: "BBVA Research"', 'type: "collection"',
                "total_documents: {n}", 'scraped_at: "{at}"', 'tags: ["BBVA Research", "economía", "big data", "españa"]', "---", "",
                "# BBVA Research - Catálogo de Publicaciones", "", "Total: **{n} publicaciones** | Fuente: [BBVA Research](https://www.bbvaresearch.com)", "",
                "## Publicaciones"],
    "high_value": ["---", 'okf_version: "1.0.0"', 'title: "INE - Datos de Alto Valor (HVD)"',
                   'description: "{n} datasets de alto valor según Reglamento UE 2023/138. Descarga directa en CSV, PC-Axis y XLSX."', 'source: "INE"', 'type: "collection"',
                   "datasets: {n}", 'scraped_at: "{at}"', 'tags: ["INE", "HVD", "datos de alto valor", "UE 2023/138"]', "---", "", "# INE - Datos de Alto Valor (HVD)", "",
                   "## Datasets disponibles\n"],
    "operations": ["---", 'okf_version: "1.0.0"', 'title: "INE - Catálogo de Datos Abiertos"',
                   'description: "Repositorio OKF del Instituto Nacional de Estadística. {n} operaciones estadísticas, acceso API JSON."',
                   'source: "INE"', 'type: "collection"', "total_operations: {n}", 'scraped_at: "{at}"',
                   'tags: ["INE", "economía española", "datos abiertos", "API", "estadísticas"]', "---", "", "# INE - Catálogo de Datos Abiertos", "",
                   "Fuente: [INE Datos Abiertos](https://www.ine.es/dyngs/DAB/index.htm?cid=1722)",
                   "Total operaciones: **{n}** | API: `https://servicios.ine.es/wstempus/js/ES/`", "", "## Operaciones Económicas"],
}
#: Order of an index's lines: section, year (newest first), place in the block, the item's own ordinal.
INDEX_ORDER = ["k1", "k2", "k3", "k4"]


def _index_lines(items: DataFrame, kind: str, order_col: str, at: str, *parts: DataFrame, year: Column | None = None) -> DataFrame:
    """The heading of an index document, with the totals of its items, and its other lines; ``k4`` has the type of the items' ordinal."""
    kind_of = items.schema[order_col].dataType
    year = F.lit(None).cast("string") if year is None else year
    facts = items.select(year.alias("y")).agg(F.count(F.lit(1)).cast("string").alias("n"), F.coalesce(F.min("y"), F.lit("sin fecha")).alias("from"),
                                              F.coalesce(F.max("y"), F.lit("sin fecha")).alias("to"))

    def fill(line: str) -> Column:
        out = F.replace(F.lit(line), F.lit("{at}"), F.lit(at))
        for fact in facts.columns:
            out = F.replace(out, F.lit(f"{{{fact}}}"), F.col(fact)) if f"{{{fact}}}" in line else out
        return out

    head = facts.select(F.posexplode(F.array(*[fill(x) for x in INDEX_HEADS[kind]])).alias("k3", "line"))
    out = head.select(F.lit(0).alias("k1"), F.lit(0).alias("k2"), "k3", F.lit(None).cast(kind_of).alias("k4"), "line")
    for part in parts:
        out = out.unionByName(part.select("k1", "k2", "k3", F.col("k4").cast(kind_of).alias("k4"), "line"))
    return out


def _at(k1: int, k2: Column | int, k3: int, k4: Column | None, line: Column) -> list[Column]:
    return [F.lit(k1).alias("k1"), (F.lit(k2) if isinstance(k2, int) else k2).cast("int").alias("k2"), F.lit(k3).alias("k3"),
            (F.lit(None) if k4 is None else k4).alias("k4"), line.alias("line")]


def render_year_index(papers: DataFrame, order_col: str = "ordinal", at: str = "") -> DataFrame:
    """Paper index by year (K6) as lines ``(k1, k2, k3, k4, line)`` in the order of ``INDEX_ORDER``.

    A heading with the total and the range of years, then by year, newest first: year = first
    four-digit run of ``date`` (D11), else ``sin_fecha``, which stands before
    the years; a heading with the count per year, then one bullet per paper in
    ``order_col`` order (numbers as numbers) with its first two authors.
    """
    p = papers.withColumn("_year", F.coalesce(X.year_of("date"), F.lit("sin_fecha")))
    newest = F.coalesce(-F.col("_year").try_cast("int"), F.lit(-10_000))
    heads = p.groupBy("_year").agg(F.count(F.lit(1)).alias("_n")).select(*_at(1, newest, 0, None, F.concat(
        F.lit("\n### "), F.col("_year"), F.lit(" ("), F.col("_n").cast("string"), F.lit(" documentos)\n"))))
    authors = X.authors_short(F.coalesce(F.col("authors"), F.array().cast("array<string>")))
    items = p.select(*_at(1, newest, 1, F.col(order_col), F.concat(
        F.lit("- ["), F.coalesce(F.col("title"), F.lit("Sin título")), F.lit("](conceptos/"), F.col("id"), F.lit(".md) — "), authors)))
    return _index_lines(papers, "years", order_col, at, heads, items, year=X.year_of("date"))


def render_list_index(items: DataFrame, kind: str = "operations", key_ids: DataFrame | None = None,
                      order_col: str = "ordinal", at: str = "") -> DataFrame:
    """List index (K7) as lines in the order of ``INDEX_ORDER``, heading first.

    ``operations``: a key-operations section (semi-join with ``key_ids``) and
    an all-operations list with names cut at 80.  ``reports``: one bullet per
    report with date and geography.  ``high_value``: one bullet per dataset
    of the high-value table (``cap, name, code``).
    """
    k4 = F.col(order_col)
    text = lambda c, other="": F.coalesce(F.col(c).cast("string"), F.lit(other))
    if kind == "high_value":
        bullet = F.concat(F.lit("- **"), text("name"), F.lit("** ("), text("code"), F.lit(") — `c="), text("cap"), F.lit("`"))
        return _index_lines(items, kind, order_col, at, items.select(*_at(1, 0, 0, k4, bullet)))
    if kind == "reports":
        bullet = F.concat(F.lit("- ["), text("title", "?"), F.lit("](conceptos/"), text("id", "?"), F.lit(".md) — "), text("date_raw"), F.lit(" "), text("geography"))
        return _index_lines(items, kind, order_col, at, items.select(*_at(1, 0, 0, k4, bullet)))
    code, oid, name = text("Codigo"), F.col("Id").cast("string"), text("Nombre")
    stem = F.when(code != "", F.lower(code)).otherwise(F.concat(F.lit("op"), oid))
    section = F.concat(F.lit("\n### ["), name, F.lit("](conceptos/"), stem, F.lit(".md)\n- **Código:** "), code, F.lit(" | **ID:** "), oid,
                       F.lit("\n- **API:** `TABLAS_OPERACION/"), oid, F.lit("`"))
    keyed = items.limit(0) if key_ids is None else items.join(key_ids.select(F.col(key_ids.columns[0]).alias("Id")), "Id", "left_semi")
    title = items.agg(F.count(F.lit(1))).select(*_at(2, 0, 0, None, F.lit("\n## Todas las Operaciones\n")))
    bullet = F.concat(F.lit("- ["), code, F.lit("](conceptos/"), stem, F.lit(".md) — "), F.substring(name, 1, 80))
    return _index_lines(items, kind, order_col, at, keyed.select(*_at(1, 0, 0, k4, section)), title, items.select(*_at(2, 0, 1, k4, bullet)))
