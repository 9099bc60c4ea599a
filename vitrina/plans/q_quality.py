"""Quality, privacy and provenance queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.operators import quality as Q
from vitrina.plans.catalog import CATALOG_SQL, virtual_catalog
from vitrina.plans.registry import register
from vitrina.sources.tables import table

SECRET, PEPPER = "run-secret", "global-pepper"


def _crossings(spark, sf) -> list[tuple[str, DataFrame]]:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    reports = [
        ("orders_lineitem_1n", Q.crossing_report(o, li, ["o_orderkey"], "inner", "1:N")),
        ("orders_lineitem_11", Q.crossing_report(o, li, ["o_orderkey"], "inner", "1:1")),
        ("orders_customer_left", Q.crossing_report(o, c, ["o_custkey"], "left", "1:1")),
        ("customer_nation_11", Q.crossing_report(c, n, ["c_nationkey"], "inner", "1:1")),
    ]
    return [(name, r.withColumn("crossing", F.lit(name))) for name, r in reports]


@register("fanout_report", """
WITH o AS (SELECT count(*) AS n FROM orders), l AS (SELECT count(*) AS n FROM lineitem),
c AS (SELECT count(*) AS n FROM customer), na AS (SELECT count(*) AS n FROM nation),
ol AS (SELECT count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
ol_dup AS (SELECT count(*) > 0 AS d FROM (SELECT o_orderkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey
                                        GROUP BY 1 HAVING count(*) > 1)),
oc AS (SELECT count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
oc_dup AS (SELECT count(*) > 0 AS d FROM (SELECT o_custkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey
                                        GROUP BY 1 HAVING count(*) > 1)),
cn AS (SELECT count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey),
cn_dup AS (SELECT count(*) > 0 AS d FROM (SELECT c_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey
                                        GROUP BY 1 HAVING count(*) > 1)),
r AS (
  SELECT 'orders_lineitem_1n' AS crossing, o.n AS n_a, l.n AS n_b, ol.n AS n_result, false AS dup_keys,
         CASE WHEN ol.n > floor(greatest(o.n, l.n) * 1.05) THEN '1:N explosion: result over max(|a|,|b|) * tolerance'
              WHEN ol.n = 0 AND o.n > 0 AND l.n > 0 THEN 'leakage: empty result from non-empty inputs' END AS reason
  FROM o, l, ol
  UNION ALL
  SELECT 'orders_lineitem_11', o.n, l.n, ol.n, ol_dup.d,
         CASE WHEN ol_dup.d THEN 'duplicate keys in a 1:1 crossing: underlying N:M'
              WHEN ol.n > least(o.n, l.n) THEN 'inner join explosion: result larger than the smaller input'
              WHEN ol.n = 0 AND o.n > 0 AND l.n > 0 THEN 'leakage: empty result from non-empty inputs' END
  FROM o, l, ol, ol_dup
  UNION ALL
  SELECT 'orders_customer_left', o.n, c.n, oc.n, oc_dup.d,
         CASE WHEN oc_dup.d THEN 'duplicate keys in a 1:1 crossing: underlying N:M'
              WHEN oc.n <> o.n THEN 'left join leak: result size differs from the left input'
              WHEN oc.n = 0 AND o.n > 0 AND c.n > 0 THEN 'leakage: empty result from non-empty inputs' END
  FROM o, c, oc, oc_dup
  UNION ALL
  SELECT 'customer_nation_11', c.n, na.n, cn.n, cn_dup.d,
         CASE WHEN cn_dup.d THEN 'duplicate keys in a 1:1 crossing: underlying N:M'
              WHEN cn.n > least(c.n, na.n) THEN 'inner join explosion: result larger than the smaller input'
              WHEN cn.n = 0 AND c.n > 0 AND na.n > 0 THEN 'leakage: empty result from non-empty inputs' END
  FROM c, na, cn, cn_dup)
SELECT crossing, n_a, n_b, n_result, dup_keys,
       round(n_result / greatest(n_a, n_b), 6) AS fanout_ratio, reason IS NULL AS passed, reason FROM r""")
def fanout_report(spark, sf):
    return reduce(DataFrame.unionByName, [r for _, r in _crossings(spark, sf)]).select(
        "crossing", "n_a", "n_b", "n_result", "dup_keys", "fanout_ratio", "passed", "reason")


@register("fanout_average", """
WITH n AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM lineitem) AS l, (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM nation) AS na,
  (SELECT count(*) FROM orders JOIN lineitem ON o_orderkey = l_orderkey) AS ol, (SELECT count(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey) AS oc,
  (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey) AS cn,
  (SELECT max(k) FROM (SELECT count(*) AS k FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)) AS ol_k,
  (SELECT max(k) FROM (SELECT count(*) AS k FROM orders GROUP BY o_custkey)) AS oc_k, (SELECT max(k) FROM (SELECT count(*) AS k FROM customer GROUP BY c_nationkey)) AS cn_k),
r AS (SELECT round(ol / greatest(o, l), 6) AS f, ol <= floor(greatest(o, l) * 1.05) AS ok FROM n UNION ALL SELECT round(ol / greatest(o, l), 6), ol_k = 1 AND ol <= least(o, l) FROM n
      UNION ALL SELECT round(oc / greatest(o, c), 6), oc_k = 1 AND oc = o FROM n UNION ALL SELECT round(cn / greatest(c, na), 6), cn_k = 1 AND cn <= least(c, na) FROM n)
SELECT count(*) AS crossings, count(f) AS rated, round(avg(f), 6) AS fanout_ratio_average, max(f) AS fanout_ratio_max, count(*) FILTER (WHERE NOT ok) AS failed FROM r""")
def fanout_average(spark, sf):
    # The ratio over all crossings of a run
    from vitrina.operators.summary import mean_fanout
    return mean_fanout(reduce(DataFrame.unionByName, [r for _, r in _crossings(spark, sf)]))


@register("checked_join_1n", """
SELECT o_orderkey, o_custkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def checked_join_1n(spark, sf):
    # The join passes its 1:N review, so its rows are returned
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    return Q.checked_join(o, li, ["o_orderkey"], "inner", "1:N")


@register("cross_by_year", """
WITH a AS (SELECT substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) AS year, count(*) AS n_orders
           FROM orders GROUP BY 1),
b AS (SELECT substr(strftime(l_shipdate, '%Y-%m-%d'), 1, 4) AS year, l_orderkey FROM lineitem)
SELECT year, n_orders, count(*) AS n_lines FROM a JOIN b USING (year) GROUP BY year, n_orders""")
def cross_by_year(spark, sf):
    # Yearly statistics (orders per year, one row per year) crossed 1:N
    # with dated items (line items by ship year), checked, then counted
    o = table(spark, sf, "orders")
    a = o.groupBy(Q.year_key(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("year")) \
        .agg(F.count(F.lit(1)).alias("n_orders"))
    b = table(spark, sf, "lineitem").select(
        Q.year_key(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("year"), "l_orderkey")
    Q.check_crossing(a, b, ["year"], "inner", "1:N")
    lines = b.groupBy("year").agg(F.count(F.lit(1)).alias("n_lines"))  # seven keys: counted before the join
    return a.join(lines, "year").select("year", "n_orders", "n_lines")


def _hmac_sql() -> str:
    ipad, opad = Q.hmac_pads(SECRET, PEPPER)
    return f"""
SELECT c_custkey, c_name,
       sha256(unhex('{opad}') || unhex(sha256(unhex('{ipad}') || encode(CAST(c_name AS VARCHAR))))) AS pseudonym
FROM customer"""


@register("hmac_customer", _hmac_sql())
def hmac_customer(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", "c_name", Q.hmac_sha256("c_name", SECRET, PEPPER).alias("pseudonym"))


@register("validate_catalog", "WITH " + CATALOG_SQL + """
SELECT rule, id, coalesce(source, '') AS detail FROM (
  SELECT id, source, unnest([CASE WHEN coalesce(id, '') = '' THEN 'missing_id' END, CASE WHEN coalesce(title, '') = '' THEN 'missing_title' END,
                             CASE WHEN coalesce(source, '') = '' THEN 'missing_source' END,
                             CASE WHEN coalesce(source, '') <> '' AND source NOT IN ('src0', 'src1', 'src2', 'web', 'orders', 'events') THEN 'source_not_allowed' END]) AS rule
  FROM cat) WHERE rule IS NOT NULL
UNION ALL
SELECT 'too_many_items', NULL, CAST(count(*) AS VARCHAR) FROM cat HAVING count(*) > 10000
UNION ALL
SELECT 'missing_source_family', NULL, s FROM (SELECT unnest(['web', 'orders', 'events', 'ECB']) AS s)
WHERE s NOT IN (SELECT DISTINCT source FROM cat)""")
def validate_catalog(spark, sf):
    cat = virtual_catalog(spark, sf)
    return Q.validate_catalog(cat, allowed=["src0", "src1", "src2", "web", "orders", "events"], min_items=1,
                              max_items=10000, required_sources=["web", "orders", "events", "ECB"])


@register("size_class", """
WITH r AS (
  SELECT 'crossing id=' || CAST(c_custkey AS VARCHAR) || ' ' || c_mktsegment AS descr,
         CAST(trunc(c_acctbal * 100) AS BIGINT) AS n_rows, c_acctbal < 0 AS has_pii FROM customer
  UNION ALL
  SELECT 'semantic match of ' || p_name, CAST(p_size AS BIGINT) * 10000, false FROM part)
SELECT descr, n_rows, has_pii,
       CASE WHEN n_rows < 100000 AND NOT coalesce(has_pii, false) AND contains(descr, 'id=') THEN 'S'
            WHEN contains(lower(descr), 'semantic') OR contains(lower(descr), 'fuzzy') THEN 'L'
            ELSE 'M' END AS size FROM r""")
def size_class(spark, sf):
    # Stand-in crossing requests: one per customer (keyed, sized by balance, PII
    # when the balance is negative) and one semantic request per part.
    c = table(spark, sf, "customer").select(
        F.concat(F.lit("crossing id="), F.col("c_custkey").cast("string"), F.lit(" "), "c_mktsegment").alias("descr"),
        (F.col("c_acctbal") * 100).cast("bigint").alias("n_rows"), (F.col("c_acctbal") < 0).alias("has_pii"))
    p = table(spark, sf, "part").select(
        F.concat(F.lit("semantic match of "), "p_name").alias("descr"),
        (F.col("p_size").cast("bigint") * 10000).alias("n_rows"), F.lit(False).alias("has_pii"))
    r = c.unionByName(p)
    return r.select("descr", "n_rows", "has_pii", Q.size_class("descr", "n_rows", "has_pii").alias("size"))


@register("provenance_cols", """
SELECT 'ord-' || CAST(o_orderkey AS VARCHAR) AS id, 'orders' AS source,
       'https://orders.example/' || CAST(o_orderkey AS VARCHAR) AS url,
       strftime(o_orderdate, '%Y-%m-%d') AS scraped_at, true AS has_normalized_at FROM orders""")
def provenance_cols(spark, sf):
    o = table(spark, sf, "orders").select(
        F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.lit("https://orders.example/"), F.col("o_orderkey").cast("string")).alias("page"),
        "o_orderdate")
    p = Q.with_provenance(o, source="orders", url_col="page",
                          scraped_at=F.date_format("o_orderdate", "yyyy-MM-dd"))
    # normalized_at is the query's timestamp: checked for presence, not value
    return p.select("id", "source", "url", "scraped_at", F.col("normalized_at").isNotNull().alias("has_normalized_at"))


@register("schema_drift", """
WITH k AS (SELECT unnest(json_keys(props)) AS "column", props FROM events),
t AS (SELECT "column", CASE json_type(props, '$.' || "column") WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING'
                            ELSE json_type(props, '$.' || "column") END AS actual FROM k)
SELECT "column", CASE WHEN "column" = 'k' THEN 'type_changed' ELSE 'extra' END AS kind, CASE WHEN "column" = 'k' THEN 'STRING' END AS expected,
       actual, count(*) AS n
FROM t WHERE "column" <> 'k' OR actual <> 'STRING' GROUP BY 1, 4
UNION ALL
SELECT f, 'missing', e, NULL, n FROM (
  SELECT 'k' AS f, 'STRING' AS e, count(*) FILTER (WHERE NOT coalesce(list_contains(json_keys(props), 'k'), false)) AS n FROM events
  UNION ALL SELECT 'unit', 'STRING', count(*) FILTER (WHERE NOT coalesce(list_contains(json_keys(props), 'unit'), false)) FROM events) WHERE n > 0""")
def schema_drift(spark, sf):
    # Q6: every event's properties against a contract that wants k as text and a unit
    return Q.record_drift(table(spark, sf, "events"), "props", {"k": "STRING", "unit": "STRING"})


@register("file_hashes")
def file_hashes(spark, sf):
    # Q3: content hash and size of every table file of the scale factor
    return Q.file_hashes(spark, f"{sf.rstrip('/')}/*.parquet").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "size", "sha256")


@register("file_hashes_written", """
SELECT 'page-' || CAST(page_id AS VARCHAR) || '.html' AS file, CAST(octet_length(encode(html)) AS BIGINT) AS size, sha256(html) AS sha256 FROM pages""")
def file_hashes_written(spark, sf):
    """Q3 over a file for each page: those over 4 KB are read in blocks, the others whole."""
    import uuid

    from vitrina.session import scratch_path
    from vitrina.sources.sinks import write_bundles
    root = scratch_path(spark, f"hashed-{uuid.uuid4().hex}")
    pages = table(spark, sf, "pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("id"), F.col("html").alias("content"))
    write_bundles(pages, root, suffix=".html").select(F.sum("bytes")).first()
    return Q.file_hashes(spark, root, whole_file=4096).select(F.element_at(F.split("path", "/"), -1).alias("file"), "size", "sha256")
