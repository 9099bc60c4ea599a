"""Incremental-refresh queries: diffs, state, upsert, streaming refresh."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.session import scratch_path
from vitrina.plans.registry import register
from vitrina.sources.tables import table
from vitrina.streaming import incremental as I

CUTOFF = "1998-01-01"


def snapshots(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Stand-in input: two snapshots of the orders.

    The stored state is the orders dated before 1998 with their order date
    as lastmod; the current crawl is every order, where open orders (status
    O) carry a lastmod 30 days after their order date.
    """
    o = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    state = o.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("source"), day.alias("lastmod"))
    bumped = F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd")
    cur = o.select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("source"),
                   F.when(F.col("o_orderstatus") == "O", bumped).otherwise(day).alias("lastmod"))
    return state, cur


_SNAP = """
state AS (SELECT o_orderkey, o_custkey, o_orderpriority AS source, strftime(o_orderdate, '%Y-%m-%d') AS lastmod
          FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
cur AS (SELECT o_orderkey, o_custkey, o_orderpriority AS source,
               CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d')
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS lastmod FROM orders)"""


@register("new_items", "WITH" + _SNAP + """
SELECT o_orderkey, lastmod FROM cur WHERE o_orderkey NOT IN (SELECT o_orderkey FROM state)""")
def new_items(spark, sf):
    state, cur = snapshots(spark, sf)
    return I.new_items(cur, state, "o_orderkey").select("o_orderkey", "lastmod")


@register("changed_items", "WITH" + _SNAP + """
SELECT c.o_orderkey, c.lastmod FROM cur c LEFT JOIN state s USING (o_orderkey)
WHERE s.lastmod IS NULL OR c.lastmod > s.lastmod""")
def changed_items(spark, sf):
    state, cur = snapshots(spark, sf)
    return I.changed_items(cur, state, "o_orderkey", "lastmod").select("o_orderkey", "lastmod")


@register("table_diff", "WITH" + _SNAP + """
SELECT o_custkey, count(*) AS n_new FROM cur WHERE o_orderkey NOT IN (SELECT o_orderkey FROM state)
GROUP BY o_custkey""")
def table_diff(spark, sf):
    # New tables per operation (orders per customer not seen before)
    state, cur = snapshots(spark, sf)
    return I.new_items(cur, state, ["o_custkey", "o_orderkey"]).groupBy("o_custkey") \
        .agg(F.count(F.lit(1)).alias("n_new"))


@register("source_state", "WITH" + _SNAP + """,
u AS (SELECT source, lastmod FROM cur UNION ALL SELECT source, lastmod FROM state)
SELECT CASE WHEN source LIKE '4%' THEN NULL ELSE source END AS source, max(lastmod) AS last, count(*) AS n FROM u GROUP BY 1""")
def source_state(spark, sf):
    # orders of one priority have no source
    state, cur = (d.withColumn("source", F.when(~F.col("source").startswith("4"), F.col("source"))) for d in snapshots(spark, sf))
    return I.update_state(cur, "source", "lastmod", state=I.update_state(state, "source", "lastmod"))


@register("upsert_latest", "WITH" + _SNAP + """,
incoming AS (SELECT c.* FROM cur c LEFT JOIN state s USING (o_orderkey)
             WHERE s.lastmod IS NULL OR c.lastmod > s.lastmod),
u AS (SELECT o_orderkey, lastmod, 0 AS prio FROM state UNION ALL SELECT o_orderkey, lastmod, 1 FROM incoming)
SELECT o_orderkey, lastmod, CASE WHEN prio = 1 THEN 'incoming' ELSE 'stored' END AS version FROM u
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY lastmod DESC, prio DESC) = 1""")
def upsert_latest(spark, sf):
    state, cur = snapshots(spark, sf)
    incoming = I.changed_items(cur, state, "o_orderkey", "lastmod")
    stored = state.select("o_orderkey", "lastmod", F.lit("stored").alias("version"))
    inc = incoming.select("o_orderkey", "lastmod", F.lit("incoming").alias("version"))
    return I.upsert_latest(stored, inc, "o_orderkey", "lastmod")


@register("stream_refresh", """
SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_ids FROM events GROUP BY 1""")
def stream_refresh(spark, sf):
    """Events land in two drops of files, the later half first; the second
    drop is older and repeats a day of the first.  Each refresh run processes
    only files it has not seen and drops ids that are stored; the sink then
    holds every event once."""
    ev = table(spark, sf, "events")
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    src, sink, ckpt = f"{base}/incoming", f"{base}/sink", f"{base}/checkpoint"
    split, again = (F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz") for d in (15, 16))
    ev.filter(F.col("ts") >= split).write.mode("append").parquet(src)
    I.stream_refresh(spark, src, ev.schema, sink, ckpt, "event_id", "ts")
    ev.filter(F.col("ts") < again).write.mode("append").parquet(src)
    I.stream_refresh(spark, src, ev.schema, sink, ckpt, "event_id", "ts")
    out = spark.read.schema(ev.schema).parquet(sink)
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                         F.countDistinct("event_id").alias("n_ids"))


@register("stream_upsert", "WITH" + _SNAP + """,
u AS (SELECT o_orderkey, lastmod, 0 AS prio FROM state UNION ALL SELECT o_orderkey, lastmod, 1 FROM cur)
SELECT o_orderkey, lastmod FROM u
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY lastmod DESC, prio DESC) = 1""")
def stream_upsert(spark, sf):
    """T5 on a stream: the stored snapshot arrives first, the current crawl
    second; each micro-batch is merged so the latest lastmod per order wins."""
    state, cur = snapshots(spark, sf)
    base = scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    src, table_dir, ckpt = f"{base}/incoming", f"{base}/table", f"{base}/checkpoint"
    cols = ["o_orderkey", "lastmod"]
    state.select(*cols).write.mode("append").parquet(src)
    schema = state.select(*cols).schema
    I.stream_upsert(spark, src, schema, table_dir, ckpt, "o_orderkey", "lastmod")
    cur.select(*cols).write.mode("append").parquet(src)
    I.stream_upsert(spark, src, schema, table_dir, ckpt, "o_orderkey", "lastmod")
    return I.read_upserted(spark, table_dir, schema, "o_orderkey", "lastmod")


@register("sitemap_diff", "WITH" + _SNAP + """
SELECT 'https://orders.example/' || CAST(c.o_orderkey AS VARCHAR) AS url, c.lastmod
FROM cur c LEFT JOIN state s USING (o_orderkey) WHERE s.lastmod IS NULL OR c.lastmod > s.lastmod""")
def sitemap_diff(spark, sf):
    """T2 end to end: two crawls written as sitemap XML, read back with the
    sitemap reader (S7), entries new or with a later lastmod kept."""
    from vitrina.sources.readers import read_sitemap
    state, cur = snapshots(spark, sf)
    base = scratch_path(spark, f"sitemap-{uuid.uuid4().hex}")
    for name, snap in (("old", state), ("new", cur)):
        (snap.select(F.concat(F.lit("https://orders.example/"), F.col("o_orderkey").cast("string")).alias("loc"),
                     "lastmod")
         .write.format("xml").option("rowTag", "url").option("rootTag", "urlset").mode("overwrite")
         .save(f"{base}/{name}"))
    old = read_sitemap(spark, f"{base}/old")
    new = read_sitemap(spark, f"{base}/new")
    return I.changed_items(new, old, "url", "lastmod")
