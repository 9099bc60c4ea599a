"""Series queries: SDMX decoding, positions, last values, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrina.operators import dedupe as W
from vitrina.operators import nested as M
from vitrina.operators import normalize as N
from vitrina.operators import summary as A
from vitrina.plans.registry import register
from vitrina.sources.tables import table



def sdmx_messages(spark, sf) -> DataFrame:
    """Stand-in input: one SDMX-JSON message per region and order priority, as text.

    Series dimensions REF_AREA (the region's nations; Germany has the code
    ``ES``) and PRIORITY (one code), observations by month.  Each message also
    has a series of codes and a period beyond its lists, and one without observations.
    Rows are gathered per message only, and lists are bounded by codes and months.
    """
    code = F.when(F.col("n_name") == "GERMANY", F.lit("ES")).otherwise(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")))
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("rk"), code.alias("code"))
    cust = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"),
                                               F.substring("o_orderpriority", 1, 1).alias("prio"))
    totals = (orders.join(cust, "c_custkey").groupBy("n_nationkey", "prio", "month").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
              .join(nation, "n_nationkey").withColumn("flow", F.concat(F.lit("ORD_R"), F.col("rk").cast("string"), F.lit("_P"), F.col("prio"))))
    lists = totals.groupBy("flow", "prio").agg(
        F.array_sort(F.collect_set(F.struct("n_nationkey", "code", "n_name"))).alias("areas"), F.array_sort(F.collect_set("month")).alias("months"))
    place = lambda arr, x: (F.array_position(arr, x) - 1).cast("string")
    points = totals.join(lists.select("flow", "areas", "months"), "flow").select(
        "flow", F.concat(place(F.col("areas"), F.struct("n_nationkey", "code", "n_name")), F.lit(":0")).alias("k"),
        F.struct(place(F.col("months"), F.col("month")).alias("key"), F.array("total").alias("value")).alias("o"))
    series = (points.groupBy("flow", "k").agg(F.map_from_entries(F.collect_list("o")).alias("observations"))
              .groupBy("flow").agg(F.collect_list(F.struct("k", F.struct("observations").alias("s"))).alias("series")))
    beyond = F.array(F.struct(F.lit("77:3").alias("k"), F.struct(F.create_map(F.lit("500"), F.array(F.lit(1.5)))).alias("s")),
                     F.struct(F.lit("1:1").alias("k"), F.struct(F.create_map().cast("map<string,array<double>>")).alias("s")))
    full = lists.join(series, "flow")
    values = lambda c, f: F.transform(c, f)
    message = F.struct(
        F.struct(F.struct(
            F.array(F.struct(F.lit("REF_AREA").alias("id"), values("areas", lambda x: F.struct(x["code"].alias("id"), x["n_name"].alias("name"))).alias("values")),
                    F.struct(F.lit("PRIORITY").alias("id"), F.array(F.struct(F.concat(F.lit("P"), F.col("prio")).alias("id"), F.concat(F.lit("priority "), F.col("prio")).alias("name"))).alias("values"))
                    ).alias("series"),
            F.array(F.struct(F.lit("TIME_PERIOD").alias("id"), values("months", lambda x: F.struct(x.alias("id"), x.alias("name"))).alias("values"))).alias("observation")).alias("dimensions")).alias("structure"),
        F.array(F.struct(F.map_from_entries(F.concat("series", beyond.cast("array<struct<k:string,s:struct<observations:map<string,array<double>>>>>"))).alias("series"))).alias("dataSets"))
    return full.select("flow", F.to_json(message).alias("text"))


def read_messages(spark, sf, whole: int | None = None) -> DataFrame:
    """The messages as files, one each, read back (S6): ``flow, msg, has_es``; those of more than ``whole`` bytes in pieces."""
    import uuid

    from vitrina.session import scratch_path
    from vitrina.sources import readers, sinks
    root = scratch_path(spark, f"sdmx-{uuid.uuid4().hex}")
    sinks.write_bundles(sdmx_messages(spark, sf), root, "flow", "text", ".json").select(F.sum("bytes")).first()
    msg = readers.read_sdmx(spark, root, readers.WHOLE_DOCUMENT if whole is None else whole)
    areas = F.element_at(F.col("msg.structure.dimensions.series"), 1)["values"]
    return msg.withColumn("has_es", F.exists(areas, lambda v: v["id"] == "ES"))


def decoded(spark, sf, whole: int | None = None) -> DataFrame:
    d = M.decode_series(read_messages(spark, sf, whole), "msg", keep=["flow", "has_es"])
    return M.area_filter(d, "has_es")


def flat_series(d: DataFrame) -> DataFrame:
    obs = F.array_join(F.transform("observations", lambda o: F.concat(o["period"], F.lit("="), F.format_string("%.2f", o["value"]))), ";")
    return d.select("flow", "series_key", F.array_join("dim_codes", ".").alias("dim_codes"), "name",
                    obs.alias("observations"), "last_value", "count")


_SDMX_SQL = """
WITH n AS (SELECT n_nationkey, n_name, n_regionkey AS rk, CASE WHEN n_name = 'GERMANY' THEN 'ES' ELSE 'N' || CAST(n_nationkey AS VARCHAR) END AS code FROM nation),
agg AS (
  SELECT rk, code, n_name, n_nationkey, substr(o_orderpriority, 1, 1) AS prio, strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN n ON c_nationkey = n_nationkey GROUP BY ALL),
place AS (SELECT DISTINCT rk, prio, n_nationkey, dense_rank() OVER (PARTITION BY rk, prio ORDER BY n_nationkey) - 1 AS ni FROM agg),
flows AS (SELECT rk, prio, bool_or(code = 'ES') AS has_es FROM agg GROUP BY ALL),
s AS (
  SELECT 'ORD_R' || CAST(rk AS VARCHAR) || '_P' || prio AS flow, CAST(ni AS VARCHAR) || ':0' AS series_key,
         code || '.P' || prio AS dim_codes, 'REF_AREA=' || n_name || ' | PRIORITY=priority ' || prio AS name,
         string_agg(month || '=' || printf('%.2f', total), ';' ORDER BY month) AS observations,
         arg_max(total, month) AS last_value, count(*) AS count
  FROM agg JOIN place USING (rk, prio, n_nationkey) JOIN flows USING (rk, prio) WHERE NOT has_es OR code = 'ES'
  GROUP BY rk, prio, ni, code, n_name
  UNION ALL
  SELECT 'ORD_R' || CAST(rk AS VARCHAR) || '_P' || prio, '77:3', 'idx77.idx3', 'REF_AREA=idx77 | PRIORITY=idx3', '500=1.50', 1.5, 1
  FROM flows WHERE NOT has_es)
"""


@register("sdmx_decode", _SDMX_SQL + "SELECT * FROM s")
def sdmx_decode(spark, sf):
    """M1-M3, F10, F11 over many message files: codes and periods beyond the
    lists fall back, empty series and other areas of a flow with ES drop out."""
    return flat_series(decoded(spark, sf))


@register("sdmx_decode_cut", _SDMX_SQL + "SELECT * FROM s")
def sdmx_decode_cut(spark, sf):
    # the same with every message over 2 KB cut into pieces while it is read
    return flat_series(decoded(spark, sf, whole=2048))


@register("series_files", _SDMX_SQL + """
SELECT flow, 'flow ' || flow AS label, CAST(row_number() OVER (PARTITION BY flow ORDER BY name, dim_codes) - 1 AS INTEGER) AS position, name, last_value, count FROM s
UNION ALL SELECT 'BROKEN', NULL, -1, NULL, NULL, NULL""")
def series_files(spark, sf):
    """Decoded series as one JSON document per flow, written and read back; a
    broken document is left out and reported."""
    import uuid

    from vitrina.session import scratch_path
    from vitrina.sources import readers, sinks
    one = F.struct("name", F.array_join("dim_codes", ".").alias("codes"), F.struct("flow", "dim_codes", "name", "last_value", "count", "observations").alias("s"))
    docs = decoded(spark, sf).groupBy("flow", "has_es").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["s"]).alias("series"))
    text = docs.select("flow", F.to_json(F.struct("flow", F.concat(F.lit("flow "), F.col("flow")).alias("label"), "has_es",
                                                  F.size("series").alias("total_series"), "series")).alias("text"))
    broken = docs.agg(F.count(F.lit(1))).select(F.lit("BROKEN").alias("flow"), F.lit('{"flow": "BROKEN", "series": [').alias("text"))
    root = scratch_path(spark, f"series-{uuid.uuid4().hex}")
    sinks.write_bundles(text.unionByName(broken), root, "flow", "text", ".json").select(F.sum("bytes")).first()
    good = readers.read_series(spark, root).select("flow", "label", "position", "name", "last_value", "count")
    bad = readers.bad_series_files(spark, root).select(
        F.regexp_extract("file", r"([^/]+)\.json$", 1).alias("flow"), F.col("flow").alias("label"), F.lit(-1).alias("position"),
        F.lit(None).cast("string").alias("name"), F.lit(None).cast("double").alias("last_value"), F.lit(None).cast("bigint").alias("count"))
    return good.unionByName(bad)


def stat_series(spark, sf) -> DataFrame:
    """Stand-in input for S5: a JSON line per customer with its orders as nested
    values, written beside lines that are no objects, and read back."""
    import uuid

    from vitrina.session import scratch_path
    from vitrina.sources.readers import read_stat_series
    o = table(spark, sf, "orders")
    point = F.struct(F.col("o_orderdate").alias("d"), F.col("o_orderkey").alias("k"), F.struct(
        F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("o_orderdate")).alias("Fecha"),
        F.month("o_orderdate").alias("FK_Periodo"), F.year("o_orderdate").alias("Anyo"), F.col("o_totalprice").alias("Valor")).alias("v"))
    data = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.transform(F.array_sort(F.collect_list(point)), lambda x: x["v"]).alias("Data"))
    cust = table(spark, sf, "customer").join(data, "c_custkey", "left")
    line = F.to_json(F.struct(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("COD"), F.col("c_mktsegment").alias("Nombre"),
                              F.coalesce("Data", F.array()).alias("Data")))
    path = scratch_path(spark, f"stat-{uuid.uuid4().hex}")
    cust.select(F.explode(F.array(line, F.concat(F.lit('"'), F.col("c_name"), F.lit('"')))).alias("value")).write.text(path)
    return read_stat_series(spark, path)


@register("stat_series_long", """
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS cod, strftime(o_orderdate, '%Y-%m-%d') AS fecha, month(o_orderdate) AS periodo, year(o_orderdate) AS anyo,
       o_totalprice AS valor, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
                                   - 1 - greatest(count(*) OVER (PARTITION BY o_custkey) - 4, 0) AS INTEGER) AS pos
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 4""")
def stat_series_long(spark, sf):
    # S5, W4 (nested form), M4: the last four values of each stored series as rows
    s = stat_series(spark, sf).withColumn("Data", M.last_n_array("Data", 4))
    return M.series_long(s, ["COD"]).select(F.col("COD").alias("cod"), "fecha", F.col("periodo").cast("bigint").alias("periodo"), F.col("anyo").cast("bigint").alias("anyo"), "valor", "pos")


@register("stat_series_totals", """
SELECT c_mktsegment AS segment, count(*) AS n_series, CAST(sum(n) AS BIGINT) AS n_values, grouping(c_mktsegment) = 1 AS is_total
FROM (SELECT c_mktsegment, c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
GROUP BY ROLLUP (c_mktsegment)""")
def stat_series_totals(spark, sf):
    # A9 over nested values as stored
    return A.series_totals(stat_series(spark, sf), "Nombre", "Data").withColumnRenamed("Nombre", "segment")


@register("sdmx_labels", """
WITH n AS (SELECT *, CASE WHEN n_name = 'GERMANY' THEN 'ES' ELSE 'N' || CAST(n_nationkey AS VARCHAR) END AS code FROM nation),
seen AS (SELECT DISTINCT c_nationkey AS k FROM customer JOIN orders ON o_custkey = c_custkey)
SELECT 'REF_AREA' AS dim_id, n.code, CASE WHEN n_nationkey IN (SELECT k FROM seen) THEN n_name ELSE n.code END AS label, count(*) AS n
FROM customer JOIN n ON c_nationkey = n_nationkey GROUP BY ALL
UNION ALL SELECT 'REF_AREA', 'X' || CAST(s_nationkey AS VARCHAR), 'X' || CAST(s_nationkey AS VARCHAR), count(*) FROM supplier GROUP BY ALL""")
def sdmx_labels(spark, sf):
    # Customer nation codes labelled from the code lists of all messages;
    # supplier codes are in none and show the fallback to the code itself
    msg = sdmx_messages(spark, sf).select(M.parse_sdmx("text").alias("msg"))
    dims = M.explode_dimensions(msg)
    nation = table(spark, sf, "nation").select("n_nationkey", F.when(F.col("n_name") == "GERMANY", F.lit("ES"))
                                               .otherwise(F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))).alias("code"))
    cust = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    other = table(spark, sf, "supplier").groupBy(F.concat(F.lit("X"), F.col("s_nationkey").cast("string")).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    labelled = M.label_codes(cust.unionByName(other).withColumn("dim_id", F.lit("REF_AREA")), dims)
    return labelled.select("dim_id", "code", "label", "n")


def event_series(spark, sf) -> DataFrame:
    """Stand-in input for N4/W2: one decoded series per (event_type, user_id).

    The last observation is an aggregate (``max_by`` on time, then event id),
    so no series is ever gathered into one row.
    """
    ev = table(spark, sf, "events")
    g = ev.groupBy("event_type", "user_id").agg(
        F.count(F.lit(1)).alias("count"),
        F.max_by(F.struct("ts", "value"), F.struct("ts", "event_id")).alias("_last"))
    uid = F.col("user_id").cast("string")
    return g.select(
        F.col("event_type").alias("flow"), "user_id",
        F.concat(F.lit("USER="), uid).alias("name"),
        F.array(F.lit("D"), F.concat(F.lit("U"), uid)).alias("dim_codes"),
        F.create_map(F.lit("FREQ"), F.lit("D"), F.lit("REF_AREA"), F.concat(F.lit("U"), uid)).alias("dimensions"),
        F.array(F.lit("FREQ=D"), F.concat(F.lit("REF_AREA=U"), uid)).alias("dimension_names"),
        F.date_format(F.col("_last")["ts"], "yyyy-MM-dd'T'HH:mm:ss").alias("last_period"),
        F.col("_last")["value"].alias("last_value"), "count")


_POS_SQL = """
p AS (SELECT event_type, user_id,
             CAST(row_number() OVER (PARTITION BY event_type ORDER BY 'USER=' || CAST(user_id AS VARCHAR),
                                     'D' || '.' || 'U' || CAST(user_id AS VARCHAR)) - 1 AS BIGINT) AS position
      FROM (SELECT DISTINCT event_type, user_id FROM events))"""


@register("series_ids", "WITH" + _POS_SQL + """
SELECT event_type, user_id, position, 'ev-' || event_type || '-' || lpad(CAST(position AS VARCHAR), 4, '0') AS series_id
FROM p""")
def series_ids(spark, sf):
    s = event_series(spark, sf).withColumn("_codes", F.array_join("dim_codes", "."))
    p = W.ordinal_within(s, ["flow"], ["name", "_codes"])
    return p.select(F.col("flow").alias("event_type"), "user_id", "position",
                    F.concat(F.lit("ev-"), F.col("flow"), F.lit("-"), F.format_string("%04d", "position"))
                    .alias("series_id"))


@register("normalize_series", "WITH" + _POS_SQL + """,
l AS (SELECT event_type, user_id, count(*) AS count,
             arg_max(value, (ts, event_id)) AS last_value, arg_max(ts, (ts, event_id)) AS last_ts
      FROM events GROUP BY 1, 2)
SELECT 'ecb-' || l.event_type || '-' || lpad(CAST(position AS VARCHAR), 4, '0') AS id,
       '[ECB] ' || l.event_type || ': USER=' || CAST(l.user_id AS VARCHAR) AS title,
       strftime(last_ts, '%Y-%m-%d') AS date_iso,
       'ECB ' || l.event_type || ' | USER=' || CAST(l.user_id AS VARCHAR) || ' | Valor: '
         || CASE WHEN last_value = floor(last_value) THEN CAST(CAST(last_value AS BIGINT) AS VARCHAR)
                 ELSE CAST(last_value AS VARCHAR) END
         || ' | Obs: ' || CAST(count AS VARCHAR) || ' (' || strftime(last_ts, '%Y-%m-%d') || ')' AS description,
       'ECB|' || l.event_type || CASE WHEN 'U' || CAST(l.user_id AS VARCHAR) IN ('ES', 'U2') THEN ''
                                      ELSE '|u' || CAST(l.user_id AS VARCHAR) END AS tags,
       'https://data-api.ecb.europa.eu/service/data/' || l.event_type || '/D.U' || CAST(l.user_id AS VARCHAR) AS url,
       strftime(last_ts, '%Y-%m-%dT%H:%M:%S') || ': '
         || CASE WHEN last_value = floor(last_value) THEN CAST(CAST(last_value AS BIGINT) AS VARCHAR)
                 ELSE CAST(last_value AS VARCHAR) END AS last_observation,
       count
FROM l JOIN p USING (event_type, user_id)""")
def normalize_series(spark, sf):
    s = event_series(spark, sf).withColumn("_codes", F.array_join("dim_codes", "."))
    p = W.ordinal_within(s, ["flow"], ["name", "_codes"])
    n = N.normalize_series(p)
    return n.select("id", "title", "date_iso", "description", F.array_join("tags", "|").alias("tags"),
                    "url", "last_observation", "count")


@register("series_last", """
SELECT event_type, user_id, count(*) AS count, arg_max(value, (ts, event_id)) AS last_value
FROM events GROUP BY 1, 2""")
def series_last(spark, sf):
    ev = table(spark, sf, "events").withColumn("_ord", F.struct("ts", "event_id"))
    return A.series_stats(ev, ["event_type", "user_id"], "_ord", "value")


@register("series_last_n", """
SELECT event_type, user_id, event_id, value,
       CAST(row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rn
FROM events QUALIFY rn <= 3""")
def series_last_n(spark, sf):
    ev = table(spark, sf, "events").withColumn("_ord", F.struct("ts", "event_id"))
    last = M.last_n(ev, ["event_type", "user_id"], "_ord", 3)
    w = Window.partitionBy("event_type", "user_id").orderBy(F.col("_ord").desc())
    return last.select("event_type", "user_id", "event_id", "value", F.row_number().over(w).alias("rn"))


@register("series_totals", """
SELECT event_type, count(*) AS n_series, CAST(sum(n) AS BIGINT) AS n_values,
       grouping(event_type) = 1 AS is_total
FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2)
GROUP BY ROLLUP (event_type)""")
def series_totals(spark, sf):
    per_series = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return A.series_totals(per_series, "event_type", "n")


@register("series_values", """
WITH t AS (SELECT * FROM events WHERE event_type = 'click'
           AND replace(strftime(ts, '%Y-%m-%d'), '-', '') >= '20240105'
           AND replace(strftime(ts, '%Y-%m-%d'), '-', '') <= '20240120'),
k AS (SELECT DISTINCT user_id FROM t ORDER BY user_id LIMIT 5)
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d') AS fecha, value AS valor FROM t
WHERE user_id IN (SELECT user_id FROM k)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3""")
def series_values(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_type", "user_id", "event_id", "value",
        F.date_format("ts", "yyyy-MM-dd").alias("fecha"), F.struct("ts", "event_id").alias("_ord"))
    out = M.series_values(ev, "event_type", "click", "user_id", "fecha", "_ord",
                          desde="2024-01-05", hasta="20240120", max_series=5, max_values=3)
    return out.select("user_id", "event_id", "fecha", F.col("value").alias("valor"))


@register("first_series", """
SELECT user_id, count(*) AS n FROM events
WHERE user_id IN (SELECT DISTINCT user_id FROM events ORDER BY user_id LIMIT 5) GROUP BY 1""")
def first_series(spark, sf):
    ev = table(spark, sf, "events").select("user_id")
    return M.first_n_series(ev, "user_id", 5).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
