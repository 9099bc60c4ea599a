"""Lookup, dedupe and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrina.functions import text as X
from vitrina.operators import dedupe as W
from vitrina.operators import lookup as L
from vitrina.operators import summary as A
from vitrina.plans.catalog import GEO_PATTERN
from vitrina.plans.registry import register
from vitrina.sources.tables import table

_SLUG = "string_split(regexp_replace({c}, '/+$', ''), '/')[-1]"


def listing_and_sitemap(spark, sf):
    """Stand-in input for J4: the sitemap is every page url; the listing has two
    entries per page, the page url itself (ordinal 2*id) and a mirror url with
    the same last path segment (ordinal 2*id+1)."""
    p = table(spark, sf, "pages").select("page_id", "url",
                                         F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"))
    sitemap = p.select("url")
    own = p.select(F.col("url"), (F.col("page_id") * 2).alias("ordinal"), "title")
    mirror = p.select(F.concat(F.lit("https://mirror.example/docs/"),
                               F.element_at(F.split(F.regexp_replace("url", "/+$", ""), "/"), -1)).alias("url"),
                      (F.col("page_id") * 2 + 1).alias("ordinal"), "title")
    return sitemap, own.unionByName(mirror)


@register("lookup_two_key", f"""
WITH p AS (SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages),
l AS (SELECT url, page_id * 2 AS ordinal, title FROM p
      UNION ALL SELECT 'https://mirror.example/docs/' || {_SLUG.format(c='url')}, page_id * 2 + 1, title FROM p),
m AS (SELECT s.url, l.ordinal, l.title, l.url AS lurl FROM p s JOIN l
      ON l.url = s.url OR {_SLUG.format(c='l.url')} = {_SLUG.format(c='s.url')})
SELECT url, min(ordinal) AS match_ordinal, arg_min(title, ordinal) AS match_title,
       arg_min(lurl, ordinal) AS match_url FROM m GROUP BY url""")
def lookup_two_key(spark, sf):
    sitemap, listing = listing_and_sitemap(spark, sf)
    return L.match_listing(sitemap, listing, fields=["title"])


def bundle_ids(spark, sf):
    """Stand-in input for J6: bundle stems are the slugs of part names, in the
    folder of one source and, for large parts, also of a second; five lookup
    ids per part (its slug, which names no source, the slug after either
    source's prefix, that and the brand, unknown)."""
    part = table(spark, sf, "part")
    slug = X.slug40("p_name")
    bundles = part.select(F.explode(F.when(F.col("p_size") > 25, F.array(F.lit("funcas"), F.lit("ine"))).otherwise(F.array(F.lit("funcas")))).alias("source"),
                          slug.alias("stem")).distinct()
    brand = F.lower(F.regexp_replace("p_brand", "[^A-Za-z0-9]+", "-"))
    ids = part.select("p_partkey", F.explode(F.array(
        slug, F.concat(F.lit("funcas-"), slug), F.concat(F.lit("ine-"), slug), F.concat(F.lit("ine-"), slug, F.lit("-"), brand),
        F.concat(F.lit("bbva-zz-"), F.col("p_partkey").cast("string")))).alias("id"))
    return ids.distinct(), bundles


@register("bundle_lookup", r"""
WITH part_s AS (SELECT p_partkey, p_brand, p_size,
                       trim(regexp_replace(lower(substr(p_name, 1, 40)), '[^a-z0-9]+', '-', 'g'), '-') AS slug
                FROM part),
b AS (SELECT 'funcas' AS source, slug AS stem FROM part_s UNION SELECT 'ine', slug FROM part_s WHERE p_size > 25),
i AS (SELECT DISTINCT p_partkey, unnest([slug, 'funcas-' || slug, 'ine-' || slug,
                                         'ine-' || slug || '-' || lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '-', 'g')),
                                         'bbva-zz-' || CAST(p_partkey AS VARCHAR)]) AS id FROM part_s),
k AS (SELECT DISTINCT id, nullif(regexp_extract(id, '^(funcas|ine|bbva)-', 1), '') AS source,
             regexp_replace(id, '^(funcas|ine|bbva)-', '') AS slug FROM i),
c AS (SELECT id, stem, 1 AS tier FROM k JOIN b ON id = stem AND k.source = b.source
      UNION ALL SELECT id, stem, 2 FROM k JOIN b ON slug = stem AND k.source = b.source),
r AS (SELECT id, min_by(stem, (tier, stem)) AS stem, min(tier) AS tier FROM c GROUP BY id),
p AS (SELECT k.id, min(b.stem) AS stem FROM k JOIN b ON k.source = b.source AND (contains(k.slug, b.stem) OR contains(b.stem, k.slug))
      WHERE k.id NOT IN (SELECT id FROM r) GROUP BY k.id),
a AS (SELECT id, stem, CASE tier WHEN 1 THEN 'exact' ELSE 'slug' END AS how FROM r
      UNION ALL SELECT id, stem, 'partial' FROM p)
SELECT i.p_partkey, i.id, k.source, a.stem, a.how
FROM i JOIN k USING (id) LEFT JOIN a USING (id)""")
def bundle_lookup(spark, sf):
    ids, bundles = bundle_ids(spark, sf)
    src = X.source_of_id("id", ["funcas", "bbva", "ine"])
    return L.find_bundle(ids, bundles, "id", source=src).select("p_partkey", "id", src.alias("source"), "stem", "how")


@register("bundle_lookup_sources", r"""
WITH part_s AS (SELECT p_partkey, p_brand, p_size,
                       trim(regexp_replace(lower(substr(p_name, 1, 40)), '[^a-z0-9]+', '-', 'g'), '-') AS slug
                FROM part),
b AS (SELECT 'funcas' AS source, slug AS stem FROM part_s UNION SELECT 'ine', slug FROM part_s WHERE p_size > 25),
i AS (SELECT p_partkey, slug AS id, unnest(['funcas', 'ine', NULL]) AS source FROM part_s),
e AS (SELECT DISTINCT i.source, i.id FROM i JOIN b ON i.source = b.source AND id = stem),
p AS (SELECT i.source, i.id, min(b.stem) AS stem FROM (SELECT DISTINCT source, id FROM i) i JOIN b ON i.source = b.source AND (contains(i.id, b.stem) OR contains(b.stem, i.id))
      WHERE (i.source, i.id) NOT IN (SELECT (source, id) FROM e) GROUP BY ALL)
SELECT p_partkey, i.id, i.source, CASE WHEN e.id IS NOT NULL THEN i.id ELSE p.stem END AS stem,
       CASE WHEN e.id IS NOT NULL THEN 'exact' WHEN p.id IS NOT NULL THEN 'partial' END AS how
FROM i LEFT JOIN e ON i.id = e.id AND i.source = e.source LEFT JOIN p ON i.id = p.id AND i.source = p.source""")
def bundle_lookup_sources(spark, sf):
    # J6 with every id under two sources and under none: each source's own bundle
    _, bundles = bundle_ids(spark, sf)
    ids = table(spark, sf, "part").select("p_partkey", X.slug40("p_name").alias("id"), F.explode(F.array(F.lit("funcas"), F.lit("ine"), F.lit(None))).alias("source"))
    return L.find_bundle(ids, bundles, "id", source=F.col("source"))


@register("dedupe_title", r"""
SELECT doc_id, title FROM (
  SELECT doc_id, split_part(text, chr(10), 1) AS title,
         lower(regexp_replace(split_part(text, chr(10), 1), '^@WS@+|@WS@+$', '', 'g')) AS k FROM documents)
WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id) = 1""")
def dedupe_title(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("title"))
    return W.dedupe_by_title(d, "doc_id")


@register("tables_per_op", """
SELECT o_orderkey, count(l_orderkey) AS tables_count FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY o_orderkey""")
def tables_per_op(spark, sf):
    # A7 aggregated first, then J2 (left join of the per-order aggregate)
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    agg = A.tables_per_op(li, "o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey")
    return o.join(agg, "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("tables_count", F.lit(0)).alias("tables_count"))


_LI_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("first_tables", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_LI_ORDER)}) AS rank
FROM lineitem QUALIFY rank <= 3""")
def first_tables(spark, sf):
    li = table(spark, sf, "lineitem")
    out = W.first_k_per_group(li, ["l_orderkey"], _LI_ORDER, 3)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rank")


@register("concat_listings", r"""
WITH p AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
                  regexp_extract(url, '^[a-z]+://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)', 1) AS geo FROM pages),
u AS (SELECT page_id, title, 'https://listing.example/' || geo AS source_url,
             list_position(['en', 'es', 'fr', 'de'], geo) - 1 AS li FROM p WHERE geo IN ('en', 'es', 'fr', 'de'))
SELECT page_id, title, source_url FROM u
WHERE lower(regexp_replace(title, '^@WS@+|@WS@+$', '', 'g')) <> ''
QUALIFY row_number() OVER (PARTITION BY lower(regexp_replace(title, '^@WS@+|@WS@+$', '', 'g')) ORDER BY li, page_id) = 1""")
def concat_listings(spark, sf):
    p = table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("url", GEO_PATTERN, 1).alias("geo"))
    listings = {f"https://listing.example/{g}": p.filter(F.col("geo") == g).select("page_id", "title")
                for g in ["en", "es", "fr", "de"]}
    u = W.concat_listings(listings)
    d = W.dedupe_by_title(u.withColumn("_o", F.struct("_listing", "page_id")), "_o")
    return d.select("page_id", "title", "source_url")


@register("prefer_first", """
WITH u AS (SELECT s_nationkey AS nk, s_name AS name, 0 AS prio FROM supplier
           UNION ALL SELECT c_nationkey, c_name, 1 FROM customer)
SELECT nk, name, prio FROM u QUALIFY prio = min(prio) OVER (PARTITION BY nk)""")
def prefer_first(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nk"), F.col("s_name").alias("name"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nk"), F.col("c_name").alias("name"))
    return W.prefer_first([s, c], ["nk"]).select("nk", "name", F.col("_prio").alias("prio"))
