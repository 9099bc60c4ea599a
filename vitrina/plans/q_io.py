"""Source/sink round trips: data written by a sink and read back by its source
(S1-S3, S7-S10, K1, K2, K8-K10).  Files go under the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vitrina import schemas as SC
from vitrina.plans.catalog import CATALOG_SQL, virtual_catalog
from vitrina.plans.q_normalize import _PAPER_SQL, paper_bundles
from vitrina.plans.registry import register
from vitrina.session import scratch_path
from vitrina.sources import readers as RD
from vitrina.sources import sinks as SK
from vitrina.sources.tables import table


def _dir(spark, name: str) -> str:
    return scratch_path(spark, f"io/{name}-{uuid.uuid4().hex}")


@register("roundtrip_jsonl", "SELECT * FROM customer")
def roundtrip_jsonl(spark, sf):
    c = table(spark, sf, "customer")
    path = _dir(spark, "clean")
    SK.write_clean(c, path, "json", partition_col="c_mktsegment")
    schema = c.schema
    return RD.read_jsonl(spark, path, schema).select(*c.columns)


@register("roundtrip_tables", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS op_id, o_orderkey AS Id, 'Order ' || CAST(o_orderkey AS VARCHAR) AS Nombre,
       epoch_ms(o_orderdate) AS Ultima_Modificacion FROM orders""")
def roundtrip_tables(spark, sf):
    # S2 layout: one folder per operation (here: order year, a handful of
    # operations as in the statistics catalogue), op id read back from the path
    o = table(spark, sf, "orders")
    t = o.select(
        F.year("o_orderdate").cast("bigint").alias("op_id"), F.col("o_orderkey").alias("Id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("Nombre"),
        F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                         F.col("o_orderdate")).alias("Ultima_Modificacion"))
    path = _dir(spark, "tables")
    SK.write_partitioned(t, path, "op_id", "json")
    back = RD.read_tables(spark, path)
    return back.select("op_id", "Id", "Nombre", "Ultima_Modificacion")


@register("roundtrip_bundles", "WITH" + _PAPER_SQL + "\nSELECT id, content FROM bundles")
def roundtrip_bundles(spark, sf):
    root = _dir(spark, "bundles")
    report = SK.write_bundles(paper_bundles(spark, sf), root)
    report.agg(F.sum("bytes")).collect()  # runs the executor-side writer once
    return RD.read_bundles(spark, root + "/*.md")


@register("roundtrip_sitemap", "SELECT url, '' AS lastmod FROM pages")
def roundtrip_sitemap(spark, sf):
    p = table(spark, sf, "pages").select(F.col("url").alias("loc"))
    path = _dir(spark, "sitemap")
    p.write.format("xml").option("rowTag", "url").option("rootTag", "urlset").mode("overwrite").save(path)
    return RD.read_sitemap(spark, path)


@register("roundtrip_catalog", "WITH " + CATALOG_SQL + """
SELECT id, source, title, date_iso, description, array_to_string(tags, '|') AS tags, url, type, geography FROM cat""")
def roundtrip_catalog(spark, sf):
    path = _dir(spark, "catalog")
    SK.write_catalog(virtual_catalog(spark, sf), path)
    back = RD.load_catalog(spark, path)
    return back.select("id", "source", "title", "date_iso", "description",
                       F.array_join("tags", "|").alias("tags"), "url", "type", "geography")


@register("roundtrip_vectors", """
SELECT 'doc-' || CAST(vec_id AS VARCHAR) AS id, 'stored' AS model, true AS ok, CAST(len(embedding) AS INTEGER) AS dim,
       round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS vsum FROM embeddings""")
def roundtrip_vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    vecs = e.select(F.concat(F.lit("doc-"), F.col("vec_id").cast("string")).alias("id"), F.lit("").alias("title"),
                    F.lit("stored").alias("model"), F.col("embedding").alias("vector"), F.lit(True).alias("ok"))
    path = _dir(spark, "vectors")
    SK.write_vectors(vecs, path)
    back = RD.load_vectors(spark, path)
    vsum = F.aggregate(F.transform("vector", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return back.select("id", "model", "ok", F.size("vector").alias("dim"), F.round(vsum, 4).alias("vsum"))


@register("run_log", "WITH " + CATALOG_SQL + """,
per AS (SELECT source, count(*) AS n FROM cat GROUP BY 1),
d AS (SELECT CAST(sum(n) AS VARCHAR) || ' items (' || string_agg(source || ': ' || CAST(n AS VARCHAR), ', '
             ORDER BY source || ': ' || CAST(n AS VARCHAR)) || ')' AS detail FROM per)
SELECT 'refresh' AS action, detail FROM d UNION ALL SELECT 'refresh', detail FROM d""")
def run_log(spark, sf):
    # K9: two runs append two log rows with the catalogue counts
    path = _dir(spark, "runlog")
    cat = virtual_catalog(spark, sf)
    SK.append_run_log(cat, path, "refresh")
    SK.append_run_log(cat, path, "refresh")
    return spark.read.schema(SC.RUN_LOG).parquet(path).select("action", "detail")


@register("key_operations", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (%s)""" % ", ".join(str(i) for i in RD.KEY_OPERATIONS))
def key_operations(spark, sf):
    # F9 with the S10 key-operation table (25 fixed ids, broadcast)
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    keys = RD.ref_table(spark, "key_operations")
    return c.join(F.broadcast(keys), c.c_custkey == keys.op_id, "left_semi")
