"""Catalogue queries: union, search, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.operators import search as S
from vitrina.operators import summary as A
from vitrina.plans.catalog import CATALOG_SQL, virtual_catalog
from vitrina.plans.registry import register


def flat(df: DataFrame) -> DataFrame:
    """Arrays as ``|``-joined text so results hash the same in any engine."""
    return df.withColumn("tags", F.array_join(F.col("tags"), "|"))


WITH = "WITH " + CATALOG_SQL
FLAT_COLS = ("id, source, title, date_iso, substr(coalesce(description, ''), 1, 200) AS description, "
             "url, array_to_string(tags, '|') AS tags, type")
FOLDED = "strip_accents(lower(coalesce(title, '') || ' ' || coalesce(description, '')))"
PLAIN = "lower(coalesce(title, '') || ' ' || coalesce(description, ''))"


@register("catalog_union", WITH + """
SELECT id, source, title, date_iso, description, array_to_string(tags, '|') AS tags, url, type,
       geography
FROM cat""")
def catalog_union(spark, sf):
    return flat(virtual_catalog(spark, sf)).select(
        "id", "source", "title", "date_iso", "description", "tags", "url", "type", "geography")


@register("search_text_folded", WITH + f"""
SELECT {FLAT_COLS} FROM cat
WHERE contains({PLAIN}, 'cion') OR contains({FOLDED}, 'cion')""")
def search_text_folded(spark, sf):
    return flat(S.search(virtual_catalog(spark, sf), limit=None, texto="CIÓN"))


@register("search_multi", WITH + f"""
SELECT {FLAT_COLS} FROM cat
WHERE (lower(source) = 'src1' OR contains(lower(source), 'src1') OR contains('src1', lower(source)))
  AND lower(type) = 'working_paper'
  AND (contains({PLAIN}, 'eaux') OR contains({FOLDED}, 'eaux'))
  AND list_has_all(list_transform(tags, lambda x: lower(x)), ['en'])
ORDER BY date_iso DESC, id LIMIT 20""")
def search_multi(spark, sf):
    return flat(S.search(virtual_catalog(spark, sf), limit=20, source="src1",
                         tipo="Working_Paper", texto="eaux", tags=["EN"]))


@register("search_dates", WITH + f"""
SELECT {FLAT_COLS} FROM cat
WHERE coalesce(date_iso, '') >= '1998-02' AND coalesce(date_iso, '') <= '1998-02-28'
ORDER BY date_iso DESC, id LIMIT 50""")
def search_dates(spark, sf):
    return flat(S.search(virtual_catalog(spark, sf), limit=50, desde="1998-02", hasta="1998-02-28"))


@register("search_hasta", WITH + f"""
SELECT {FLAT_COLS} FROM cat WHERE coalesce(date_iso, '') <= '1995-01-03'""")
def search_hasta(spark, sf):
    # only an upper bound: undated items ('') pass it
    return flat(S.search(virtual_catalog(spark, sf), limit=None, hasta="1995-01-03"))


@register("search_tags", WITH + f"""
SELECT {FLAT_COLS} FROM cat
WHERE list_has_all(list_transform(tags, lambda x: lower(x)), ['p', '1-urgent'])
ORDER BY date_iso DESC, id LIMIT 30""")
def search_tags(spark, sf):
    return flat(S.search(virtual_catalog(spark, sf), limit=30, tags=["P", "1-URGENT"]))


@register("search_source", WITH + f"""
SELECT {FLAT_COLS} FROM cat
WHERE (lower(source) = 'events stream' OR contains(lower(source), 'events stream')
       OR contains('events stream', lower(source)))
  AND lower(type) = 'time_series'
ORDER BY date_iso DESC, id LIMIT 25""")
def search_source(spark, sf):
    return flat(S.search(virtual_catalog(spark, sf), limit=25, source="Events Stream",
                         type="TIME_SERIES"))


@register("search_geo", WITH + f"""
SELECT {FLAT_COLS} FROM cat
WHERE (lower(source) = 'web' OR contains(lower(source), 'web') OR contains('web', lower(source)))
  AND lower(coalesce(geography, '')) = 'es'""")
def search_geo(spark, sf):
    return flat(S.search(virtual_catalog(spark, sf), limit=None, source="WEB", geography="ES"))


@register("search_counts", WITH + f"""
SELECT count(*) AS total_found, least(count(*), 20) AS shown FROM cat
WHERE contains({PLAIN}, 'eaux') OR contains({FOLDED}, 'eaux')""")
def search_counts(spark, sf):
    return S.search_counts(virtual_catalog(spark, sf), limit=20, texto="eaux")


@register("count_by_source", WITH + """
SELECT coalesce(source, 'desconocido') AS source, count(*) AS n FROM cat GROUP BY 1""")
def count_by_source(spark, sf):
    return A.count_by_source(virtual_catalog(spark, sf))


@register("count_by_type", WITH + "SELECT type, count(*) AS n FROM cat GROUP BY 1")
def count_by_type(spark, sf):
    return A.count_by_type(virtual_catalog(spark, sf))


@register("types", WITH + """
SELECT DISTINCT type FROM cat WHERE type IS NOT NULL AND type <> ''""")
def types(spark, sf):
    return A.types(virtual_catalog(spark, sf))


@register("date_range", WITH + """
SELECT coalesce(min(nullif(date_iso, '')), 'desconocida') AS desde,
       coalesce(max(nullif(date_iso, '')), 'desconocida') AS hasta FROM cat""")
def date_range(spark, sf):
    return A.date_range(virtual_catalog(spark, sf))


@register("top_tags", WITH + """
SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM cat)
GROUP BY tag ORDER BY n DESC, tag LIMIT 10""")
def top_tags(spark, sf):
    return A.top_tags(virtual_catalog(spark, sf), 10)


@register("catalog_total", WITH + "SELECT count(*) AS total_items FROM cat")
def catalog_total(spark, sf):
    return A.summary(virtual_catalog(spark, sf))["total"]


QUERY_SUMMARY = WITH + """,
tops AS (SELECT tag, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, tag) AS INTEGER) AS p FROM (SELECT unnest(tags) AS tag FROM cat) GROUP BY tag),
f AS (SELECT [""" + ", ".join(f"'{x}'" for x in A.SUMMARY_FIELDS) + """] AS l)
SELECT 'total_items' AS piece, CAST(NULL AS INTEGER) AS position, CAST(NULL AS VARCHAR) AS name, count(*) AS n FROM cat
UNION ALL SELECT 'por_fuente', NULL, coalesce(source, 'desconocido'), count(*) FROM cat GROUP BY ALL
UNION ALL SELECT DISTINCT 'tipos_disponibles', NULL, type, NULL FROM cat WHERE coalesce(type, '') <> ''
UNION ALL SELECT 'rango_temporal', NULL, unnest(['desde ' || coalesce(min(nullif(date_iso, '')), 'desconocida'), 'hasta ' || coalesce(max(nullif(date_iso, '')), 'desconocida')]), NULL FROM cat
UNION ALL SELECT 'tags_mas_frecuentes', p, tag, n FROM tops WHERE p <= 10
UNION ALL SELECT 'campos_disponibles', CAST(generate_subscripts(l, 1) AS INTEGER), unnest(l), NULL FROM f"""


@register("catalog_summary", QUERY_SUMMARY)
def catalog_summary(spark, sf):
    return A.summary_table(virtual_catalog(spark, sf))


def _stored(spark, sf, cluster: bool = False) -> str:
    """The virtual catalogue stored in two batches with their counts."""
    import uuid

    from vitrina.operators.stored import write_stored
    from vitrina.session import scratch_path
    path = scratch_path(spark, f"stored-{uuid.uuid4().hex}")
    cat = virtual_catalog(spark, sf)
    texts = F.col("type").isin("working_paper", "report")
    write_stored(cat.where(texts), path, cluster=cluster)
    write_stored(cat.where(~texts), path, cluster=cluster)
    return path


@register("catalog_summary_stored", QUERY_SUMMARY)
def catalog_summary_stored(spark, sf):
    # A1 from the counts stored with each batch: no item is read
    from vitrina.operators.stored import stored_summary
    return stored_summary(spark, _stored(spark, sf))


@register("search_clustered", WITH + f"""
SELECT {FLAT_COLS} FROM cat
WHERE (lower(source) = 'events' OR contains(lower(source), 'events') OR contains('events', lower(source))) AND lower(type) = 'time_series'
  AND coalesce(date_iso, '') >= '2024-01-20'""")
def search_clustered(spark, sf):
    # F2, F3, F4 over the layout along date, source and type: source and type resolved before the scan
    from vitrina.operators.stored import search_stored as stored
    return flat(stored(spark, _stored(spark, sf, cluster=True), limit=None, source="Events", type="Time_Series", desde="2024-01-20"))


@register("items_by_year", WITH + r"""
SELECT coalesce(nullif(regexp_extract(date_iso, '(\d{4})', 1), ''), 'sin_fecha') AS year,
       count(*) AS n
FROM cat GROUP BY 1""")
def items_by_year(spark, sf):
    return A.items_by_year(virtual_catalog(spark, sf))


@register("catalog_order", WITH + """
SELECT id, date_iso, CAST(row_number() OVER (ORDER BY date_iso DESC, id) AS BIGINT) AS rank
FROM cat QUALIFY rank <= 100""")
def catalog_order(spark, sf):
    # W7 + W8: the first 100 of the catalogue order, with their rank
    cat = virtual_catalog(spark, sf)
    top = cat.select("id", "date_iso").orderBy(*S.catalog_order(cat)).limit(100)
    from pyspark.sql import Window
    w = Window.orderBy(F.col("date_iso").desc(), F.col("id"))
    return top.select("id", "date_iso", F.row_number().over(w).cast("bigint").alias("rank"))


@register("json_results", WITH + f"""
SELECT id, title, array_to_string(tags, '|') AS tags, date_iso FROM cat
WHERE list_has_all(list_transform(tags, lambda x: lower(x)), ['o', '1-urgent'])
ORDER BY date_iso DESC, id LIMIT 25""")
def json_results(spark, sf):
    # M6: search results rendered as JSON text, then read back field by field
    from vitrina.operators.nested import to_json_result
    hits = S.search(virtual_catalog(spark, sf), limit=25, tags=["O", "1-URGENT"])
    js = to_json_result(hits, ["id", "title", "date_iso", "tags"])
    parsed = F.from_json("json", "id string, title string, date_iso string, tags array<string>")
    return js.select(parsed.alias("r")).select("r.id", "r.title", F.array_join("r.tags", "|").alias("tags"),
                                               "r.date_iso")


@register("flagship_by_source", WITH + f"""
SELECT source, count(*) AS n, min(id) AS first_id FROM cat
WHERE lower(type) = 'working_paper'
  AND (contains({PLAIN}, 'tion') OR contains({FOLDED}, 'tion'))
  AND list_has_all(list_transform(tags, lambda x: lower(x)), ['en'])
GROUP BY source""")
def flagship_by_source(spark, sf):
    """Working papers in English that mention a term (plain or accent-folded), by source."""
    cat = virtual_catalog(spark, sf)
    hits = cat.filter(S.search_predicate(cat, tipo="working_paper", texto="tión", tags=["EN"]))
    return hits.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


@register("search_stored", WITH + f"""
SELECT {FLAT_COLS} FROM cat
WHERE lower(type) = 'dataset' AND coalesce(date_iso, '') >= '1998-02' AND coalesce(date_iso, '') <= '1998-02-28'
  AND (contains({PLAIN}, 'urgent') OR contains({FOLDED}, 'urgent'))
ORDER BY date_iso DESC, id LIMIT 40""")
def search_stored(spark, sf):
    """Search on the stored catalogue: written once by the catalogue sink
    (K2, folded text stored), read back (S8); the type and date filters are
    pushed into the Parquet scan and the text test reads the stored folded
    column instead of folding at query time."""
    import uuid

    from vitrina.session import scratch_path
    from vitrina.sources.readers import load_catalog
    from vitrina.sources.sinks import write_catalog
    path = scratch_path(spark, f"catalog-{uuid.uuid4().hex}")
    write_catalog(virtual_catalog(spark, sf), path)
    cat = load_catalog(spark, path)
    return flat(S.search(cat, limit=40, type="dataset", desde="1998-02", hasta="1998-02-28", texto="URGENT"))


def _indexed(spark, sf):
    """The virtual catalogue, stored with its text index."""
    import uuid

    from vitrina.operators.text_index import write_indexed_catalog
    from vitrina.session import scratch_path
    path = scratch_path(spark, f"indexed-{uuid.uuid4().hex}")
    write_indexed_catalog(virtual_catalog(spark, sf), path, block_rows=64)
    return path


@register("search_indexed", WITH + f"""
SELECT {FLAT_COLS} FROM cat
WHERE (contains({PLAIN}, 'wh onwh') OR contains({FOLDED}, 'wh onwh')) AND lower(type) = 'working_paper'""")
def search_indexed(spark, sf):
    from vitrina.operators.text_index import search_indexed as indexed
    return flat(indexed(spark, _indexed(spark, sf), "WH ÓNWH", limit=None, type="working_paper"))


NEEDLES = ["1-urgent", "wh onwh", "ñó", "é", "clerk#no such", "order 12", "\u00dcber", "tion of"]


@register("search_indexed_counts", WITH + ", needle AS (SELECT unnest([" + ", ".join(f"'{n}'" for n in NEEDLES) + f"""]) AS needle)
SELECT needle, count(*) FILTER (WHERE contains(p, lower(needle)) OR contains(f, strip_accents(lower(needle)))) AS found
FROM needle, (SELECT {PLAIN} AS p, {FOLDED} AS f FROM cat) GROUP BY needle""")
def search_indexed_counts(spark, sf):
    # F5 by the index for rare, short, absent and frequent needles: how many items each finds
    from functools import reduce

    from vitrina.operators.text_index import narrowed
    path = _indexed(spark, sf)
    counts = [S.search_counts(narrowed(spark, path, n), texto=n).select(F.lit(n).alias("needle"), F.col("total_found").alias("found")) for n in NEEDLES]
    return reduce(lambda a, b: a.unionByName(b), counts)
