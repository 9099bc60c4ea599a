"""The virtual catalogue over the driver's tables.

Four of the driver tables stand in for the four publishers, each mapped to
catalogue rows by a projection (and, for events, one aggregation):

* ``documents`` -> ``working_paper`` items (title = first line of the text, description = the whole text, tags = [lang, source], undated);
* ``pages``     -> ``report`` items (title from ``<title>``, geography = a
  two-letter first path segment of the url);
* ``orders``    -> ``dataset`` items (date = order date, tags = status, priority);
* ``events``    -> ``time_series`` items, one per (event_type, user_id).

``CATALOG_SQL`` is the same mapping as a DuckDB CTE for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.text import item_id
from vitrina.operators.normalize import build_catalog
from vitrina.sources.tables import table

GEO_PATTERN = r"^[a-z]+://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)"
TITLE_PATTERN = r"<title>(.*?)</title>"


def papers_from_documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        item_id("doc", "doc_id").alias("id"),
        F.col("source"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.lit("").alias("date_iso"),
        F.col("text").alias("description"),
        F.array(F.col("lang"), F.col("source")).alias("tags"),
        F.concat(F.lit("https://docs.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit("working_paper").alias("type"),
    )


def reports_from_pages(pages: DataFrame) -> DataFrame:
    geo = F.regexp_extract("url", GEO_PATTERN, 1)
    return pages.select(
        item_id("page", "page_id").alias("id"),
        F.lit("web").alias("source"),
        F.regexp_extract("html", TITLE_PATTERN, 1).alias("title"),
        F.lit("").alias("date_iso"),
        F.lit("").alias("description"),
        F.when(geo != "", F.array(F.lit("web"), geo)).otherwise(F.array(F.lit("web"))).alias("tags"),
        F.col("url"),
        F.lit("report").alias("type"),
        geo.alias("geography"),
    )


def datasets_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        item_id("ord", "o_orderkey").alias("id"),
        F.lit("orders").alias("source"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_iso"),
        F.concat(F.lit("status "), F.col("o_orderstatus"), F.lit(", priority "),
                 F.col("o_orderpriority")).alias("description"),
        F.array(F.lower("o_orderstatus"), F.lower("o_orderpriority")).alias("tags"),
        F.lit("").alias("url"),
        F.lit("dataset").alias("type"),
    )


def series_from_events(events: DataFrame) -> DataFrame:
    g = events.groupBy("event_type", "user_id").agg(
        F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_obs"))
    uid = F.col("user_id").cast("string")
    return g.select(
        F.concat(F.lit("ev-"), F.col("event_type"), F.lit("-"), uid).alias("id"),
        F.lit("events").alias("source"),
        F.concat(F.lit("[EV] "), F.col("event_type"), F.lit(": user "), uid).alias("title"),
        F.date_format("last_ts", "yyyy-MM-dd").alias("date_iso"),
        F.concat(F.lit("events "), F.col("event_type"), F.lit(" of user "), uid, F.lit(": "),
                 F.col("n_obs").cast("string"), F.lit(" observations")).alias("description"),
        F.array(F.lit("events"), F.col("event_type")).alias("tags"),
        F.lit("").alias("url"),
        F.lit("time_series").alias("type"),
    )


def virtual_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the four mapped sources."""
    return build_catalog(
        papers_from_documents(table(spark, sf_dir, "documents")),
        reports_from_pages(table(spark, sf_dir, "pages")),
        datasets_from_orders(table(spark, sf_dir, "orders")),
        series_from_events(table(spark, sf_dir, "events")),
    )


# DuckDB form of the same mapping, used by the oracle SQL of every query that
# reads the virtual catalogue.
CATALOG_SQL = r"""
cat AS (
  SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS id, source, split_part(text, chr(10), 1) AS title,
         '' AS date_iso, text AS description, [lang, source] AS tags,
         'https://docs.example/' || CAST(doc_id AS VARCHAR) AS url, 'working_paper' AS type,
         CAST(NULL AS VARCHAR) AS geography
  FROM documents
  UNION ALL
  SELECT 'page-' || CAST(page_id AS VARCHAR), 'web',
         regexp_extract(html, '<title>(.*?)</title>', 1), '', '',
         CASE WHEN regexp_extract(url, '^[a-z]+://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)', 1) <> ''
              THEN ['web', regexp_extract(url, '^[a-z]+://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)', 1)]
              ELSE ['web'] END,
         url, 'report', regexp_extract(url, '^[a-z]+://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)', 1)
  FROM pages
  UNION ALL
  SELECT 'ord-' || CAST(o_orderkey AS VARCHAR), 'orders', 'Order ' || CAST(o_orderkey AS VARCHAR),
         strftime(o_orderdate, '%Y-%m-%d'),
         'status ' || o_orderstatus || ', priority ' || o_orderpriority,
         [lower(o_orderstatus), lower(o_orderpriority)], '', 'dataset', CAST(NULL AS VARCHAR)
  FROM orders
  UNION ALL
  SELECT 'ev-' || event_type || '-' || CAST(user_id AS VARCHAR), 'events',
         '[EV] ' || event_type || ': user ' || CAST(user_id AS VARCHAR),
         strftime(max(ts), '%Y-%m-%d'),
         'events ' || event_type || ' of user ' || CAST(user_id AS VARCHAR) || ': '
           || CAST(count(*) AS VARCHAR) || ' observations',
         ['events', event_type], '', 'time_series', CAST(NULL AS VARCHAR)
  FROM events GROUP BY event_type, user_id
)"""
