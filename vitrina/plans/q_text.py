"""Scalar-function queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrina.functions import text as X
from vitrina.operators import lines as LN
from vitrina.plans.registry import register
from vitrina.sources.tables import table

# Spanish month names, used to render the "D de mes de YYYY" form.
SPANISH_MONTHS = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
                  "septiembre", "octubre", "noviembre", "diciembre"]

_ES = "[" + ", ".join(f"'{m}'" for m in SPANISH_MONTHS) + "]"
# Python's whitespace (str.isspace) as an RE2 class, for the oracle's strip
_WS = "@WS@"
_WS_STRIP = f"^{_WS}+|{_WS}+$"


def date_renderings(orders):
    """Stand-in input for X1: every order date written in twelve text forms."""
    d = F.col("o_orderdate")
    es_month = F.element_at(F.array(*[F.lit(m) for m in SPANISH_MONTHS]), F.month(d))
    forms = F.array(
        F.date_format(d, "yyyy-MM-dd'T'23:30:00+02:00"),
        F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"),
        F.date_format(d, "yyyy-MM-dd"),
        F.date_format(d, "d MMMM yyyy"),
        F.date_format(d, "MMMM yyyy"),
        F.date_format(d, "yyyy"),
        F.concat(F.date_format(d, "d"), F.lit(" de "), es_month, F.lit(" de "), F.date_format(d, "yyyy")),
        F.date_format(d, "yyyy-MM"),
        F.date_format(d, "yyyy-MM-dd'T'10:00:00.5+00:00"),
        F.lit("sin fecha"),
        F.concat(F.lit("  "), F.date_format(d, "yyyy-MM-dd"), F.lit("\n")),
        F.lit(""),
    )
    return orders.select("o_orderkey", F.posexplode(forms).alias("form", "raw"))


_RENDER_SQL = f"""
r AS (
  SELECT o_orderkey, CAST(u.form AS INTEGER) AS form, u.raw FROM orders,
  LATERAL (SELECT unnest(range(0, 12)) AS form,
                  unnest([strftime(o_orderdate, '%Y-%m-%dT23:30:00+02:00'),
                          strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'),
                          strftime(o_orderdate, '%Y-%m-%d'),
                          strftime(o_orderdate, '%-d %B %Y'),
                          strftime(o_orderdate, '%B %Y'),
                          strftime(o_orderdate, '%Y'),
                          strftime(o_orderdate, '%-d') || ' de ' || {_ES}[month(o_orderdate)]
                            || ' de ' || strftime(o_orderdate, '%Y'),
                          strftime(o_orderdate, '%Y-%m'),
                          strftime(o_orderdate, '%Y-%m-%dT10:00:00.5+00:00'),
                          'sin fecha',
                          '  ' || strftime(o_orderdate, '%Y-%m-%d') || chr(10),
                          '']) AS raw) u
), s AS (
  SELECT *, regexp_replace(raw, '{_WS_STRIP}', '', 'g') AS st,
         regexp_replace(regexp_replace(raw, '{_WS_STRIP}', '', 'g'), '\\s+', ' ', 'g') AS s1
  FROM r
)"""


@register("parse_dates", "WITH" + _RENDER_SQL + r"""
SELECT o_orderkey, form, raw, CASE
  WHEN raw IS NULL OR raw = '' THEN ''
  WHEN regexp_full_match(st, '\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)?')
       AND try_strptime(regexp_replace(st, '(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)$', ''), '%Y-%m-%dT%H:%M:%S') IS NOT NULL
    THEN strftime(try_strptime(regexp_replace(st, '(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)$', ''), '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%d')
  WHEN regexp_full_match(st, '\d{4}-\d{1,2}-\d{1,2}') AND try_strptime(st, '%Y-%m-%d') IS NOT NULL
    THEN strftime(try_strptime(st, '%Y-%m-%d'), '%Y-%m-%d')
  WHEN regexp_full_match(s1, '\d{1,2} [A-Za-z]+ \d{4}') AND try_strptime(s1, '%d %B %Y') IS NOT NULL
    THEN strftime(try_strptime(s1, '%d %B %Y'), '%Y-%m-%d')
  WHEN regexp_full_match(s1, '\d{1,2} de [A-Za-z]+ de \d{4}') AND try_strptime(s1, '%d de %B de %Y') IS NOT NULL
    THEN strftime(try_strptime(s1, '%d de %B de %Y'), '%Y-%m-%d')
  WHEN regexp_full_match(s1, '[A-Za-z]+ \d{4}') AND try_strptime(s1, '%B %Y') IS NOT NULL
    THEN strftime(try_strptime(s1, '%B %Y'), '%Y-%m-%d')
  WHEN regexp_full_match(st, '\d{4}') AND st <> '0000' THEN st || '-01-01'
  WHEN regexp_extract(raw, '(\d{4})', 1) <> '' THEN regexp_extract(raw, '(\d{4})', 1)
  ELSE substr(raw, 1, 10) END AS date_iso
FROM s""")
def parse_dates(spark, sf):
    r = date_renderings(table(spark, sf, "orders"))
    return r.select("o_orderkey", "form", "raw", X.parse_date_iso("raw").alias("date_iso"))


@register("epoch_dates", """
SELECT o_orderkey, epoch_ms(o_orderdate) AS ms, strftime(o_orderdate, '%Y-%m-%d') AS date_utc,
       strftime(o_orderdate AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Tokyo', '%Y-%m-%d') AS date_tokyo
FROM orders""")
def epoch_dates(spark, sf):
    o = table(spark, sf, "orders")
    # Stand-in input: the order date as epoch milliseconds (zone-free arithmetic).
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                         F.col("o_orderdate"))
    e = o.select("o_orderkey", ms.alias("ms"))
    return e.select("o_orderkey", "ms", X.epoch_ms_date("ms").alias("date_utc"),
                    X.epoch_ms_date("ms", "Asia/Tokyo").alias("date_tokyo"))


@register("slug40", r"""
SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
       trim(regexp_replace(lower(substr(regexp_extract(html, '<title>(.*?)</title>', 1), 1, 40)),
                           '[^a-z0-9]+', '-', 'g'), '-') AS slug
FROM pages""")
def slug40(spark, sf):
    p = table(spark, sf, "pages").select("page_id",
                                         F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"))
    return p.select("page_id", "title", X.slug40("title").alias("slug"))


@register("url_slug", r"""
SELECT page_id, url, substr(string_split(regexp_replace(url, '/+$', ''), '/')[-1], 1, 50) AS slug
FROM pages""")
def url_slug(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", X.url_slug("url").alias("slug"))


@register("id_collisions", r"""
SELECT slug, count(*) AS n, min(page_id) AS first_page FROM (
  SELECT page_id, substr(string_split(regexp_replace(url, '/+$', ''), '/')[-1], 1, 50) AS slug
  FROM pages) GROUP BY slug HAVING count(*) > 1""")
def id_collisions(spark, sf):
    from vitrina.operators.quality import id_collisions as collisions
    p = table(spark, sf, "pages").select("page_id", X.url_slug("url").alias("slug"))
    return collisions(p, "slug", "page_id", first_name="first_page")


@register("authors_split", r"""
WITH a AS (
  SELECT conv_id, turn,
         list_filter(list_transform(string_split(coalesce(text, ''), ','),
                                    lambda x: regexp_replace(x, '^@WS@+|@WS@+$', '', 'g')),
                     lambda x: x <> '') AS authors
  FROM conversations)
SELECT conv_id, turn, CAST(len(authors) AS INTEGER) AS n_authors,
       array_to_string(authors, '|') AS authors,
       CASE WHEN len(authors) > 2 THEN array_to_string(authors[1:2], ', ') || ' et al.'
            ELSE array_to_string(authors[1:2], ', ') END AS authors_short
FROM a""")
def authors_split(spark, sf):
    c = table(spark, sf, "conversations")
    a = c.select("conv_id", "turn", X.split_authors("text", ",").alias("authors"))
    return a.select("conv_id", "turn", F.size("authors").alias("n_authors"),
                    F.array_join("authors", "|").alias("authors"),
                    X.authors_short("authors").alias("authors_short"))


_KW = "[" + ", ".join(f"'{k}'" for k in X.DATASET_KEYWORDS) + "]"


@register("keyword_tags", f"""
SELECT doc_id, array_to_string(list_filter({_KW}, lambda k: contains(lower(text), k)), '|') AS tags
FROM documents""")
def keyword_tags(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.array_join(X.keyword_tags("text"), "|").alias("tags"))


_GEO = "|".join(X.GEOGRAPHY_NAMES)


@register("geography", rf"""
WITH p AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
                  substr(string_split(regexp_replace(url, '/+$', ''), '/')[-1], 1, 50) AS slug
           FROM pages)
SELECT page_id,
       nullif(regexp_extract(title, '^({_GEO})\s*[|]', 1), '') AS geo_title,
       CASE WHEN contains(lower(slug), 'espana') OR contains(lower(slug), 'españa')
                 OR contains(lower(slug), 'espa-a') THEN 'España'
            WHEN contains(lower(slug), 'global') THEN 'Global' ELSE '' END AS geo_slug,
       CASE WHEN contains(title, 'Con técnicas Big Data') THEN 'big-data' END AS technique,
       CASE WHEN contains(lower(title), 'técnica') THEN 'nota_tecnica'
            ELSE 'documento_trabajo' END AS doc_type
FROM p""")
def geography(spark, sf):
    p = table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
        X.url_slug("url").alias("slug"))
    return p.select("page_id", X.geography_from_title("title").alias("geo_title"),
                    X.geography_from_slug("slug").alias("geo_slug"),
                    X.technique(F.lit(""), "title").alias("technique"),
                    X.doc_type("title", F.lit("")).alias("doc_type"))


@register("page_details", r"""
WITH p AS (SELECT page_id, html,
                  regexp_extract_all(html, '(https://www\.funcas\.es/wp-content/uploads/[^"'')\s]+\.pdf)', 1) AS pdfs,
                  list_filter(string_split(html, chr(10)),
                              lambda l: contains(l, 'Fecha:') AND regexp_matches(l, '\*\*(.+?)\*\*')) AS fl
           FROM pages)
SELECT page_id,
       nullif(regexp_replace(regexp_extract(html, '# (.+)', 1), '^@WS@+|@WS@+$', '', 'g'), '') AS heading,
       pdfs[1] AS pdf_url,
       CASE WHEN contains(lower(html), 'english') OR contains(lower(html), 'inglés') THEN pdfs[2] END
         AS pdf_url_en,
       CASE WHEN regexp_matches(html, '(?s)Resumen:(.+?)(##|$)')
            THEN regexp_replace(regexp_extract(html, '(?s)Resumen:(.+?)(?:##|$)', 1), '^@WS@+|@WS@+$', '', 'g')
       END AS abstract,
       CASE WHEN len(fl) > 0 THEN regexp_replace(regexp_extract(fl[-1], '\*\*(.+?)\*\*', 1),
                                                 '^@WS@+|@WS@+$', '', 'g') END AS date
FROM p""")
def page_details(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", X.first_heading("html").alias("heading"),
                    X.page_pdf("html").alias("pdf_url"),
                    X.page_pdf_english("html").alias("pdf_url_en"),
                    X.page_abstract("html").alias("abstract"),
                    X.page_date("html").alias("date"))


@register("working_paper_lines", r"""
SELECT doc_id, CAST(pos AS INTEGER) AS line_no,
       substr(regexp_replace(line, '^@WS@+|@WS@+$', '', 'g'), 1, 120) AS line
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents)
WHERE contains(line, 'Working Paper') OR contains(line, 'Documento de Trabajo') OR contains(line, 'WP_')
   OR contains(line, 'Lizenz') OR contains(line, 'License')""")
def working_paper_lines(spark, sf):
    # F14 with the reference's markers; license-line markers, which this data
    # does contain, are added so the operator has lines to keep
    d = table(spark, sf, "documents")
    markers = LN.WORKING_PAPER_MARKERS + ["Lizenz", "License"]
    return LN.marked_lines(d, "doc_id", "text", markers, width=120)


@register("nonblank_titles", r"""
SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages
WHERE regexp_replace(regexp_extract(html, '<title>(.*?)</title>', 1), '^@WS@+|@WS@+$', '', 'g') <> ''""")
def nonblank_titles(spark, sf):
    from vitrina.operators.search import nonblank_title
    p = table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"))
    return p.filter(nonblank_title("title"))


@register("recent_items", r"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS lastmod FROM orders
WHERE substr(coalesce(nullif(strftime(o_orderdate, '%Y-%m-%d'), ''), ''), 1, 4) IN ('1996', '1998')""")
def recent_items(spark, sf):
    from vitrina.operators.search import recent
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("lastmod"),
        F.lit("").alias("date"))
    return recent(o, ["1996", "1998"]).select("o_orderkey", "lastmod")


@register("date_bounds", r"""
SELECT o_orderkey, replace(strftime(o_orderdate, '%Y-%m-%d'), '-', '') AS compact
FROM orders WHERE replace(strftime(o_orderdate, '%Y-%m-%d'), '-', '') BETWEEN '19970301' AND '19970315'""")
def date_bounds(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", X.compact_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("compact"))
    lo, hi = X.compact_date(F.lit("1997-03-01")), X.compact_date(F.lit("19970315"))
    return o.filter((F.col("compact") >= lo) & (F.col("compact") <= hi))


@register("clean_quotes", r"""
SELECT doc_id, substr(replace(text, '"', ''''), 1, 500) AS header_desc,
       substr(replace(text, '"', ''''), 1, 2000) AS body_desc
FROM documents""")
def clean_quotes(spark, sf):
    # The bundle header keeps 500 characters, the body 2000 (reference rule)
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.clean_quotes("text", 500).alias("header_desc"),
                    X.clean_quotes("text", 2000).alias("body_desc"))
