"""Vector queries over ``embeddings`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.operators import vectors as V
from vitrina.plans.catalog import papers_from_documents
from vitrina.plans.registry import register
from vitrina.sources.tables import table


def vectors(spark, sf) -> DataFrame:
    """Stored vectors keyed like catalogue items: ``doc-{vec_id}``."""
    e = table(spark, sf, "embeddings")
    return e.select(F.concat(F.lit("doc-"), F.col("vec_id").cast("string")).alias("id"),
                    F.col("embedding").alias("vector"), "label", "vec_id")


def centroids(spark, sf) -> DataFrame:
    """One query vector per label: the mean embedding (aggregated per label and position)."""
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("_i", "_x"))
    m = e.groupBy("label", "_i").agg(F.avg("_x").alias("_m"))
    return m.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))),
                                              lambda s: s["_m"]).alias("q"))


_Q = """
q AS (SELECT list(m ORDER BY i) AS q FROM (
        SELECT i, avg(e) AS m FROM (
          SELECT unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i
          FROM embeddings WHERE label = {label}) GROUP BY i)),
s AS (SELECT 'doc-' || CAST(vec_id AS VARCHAR) AS id,
             list_dot_product(CAST(embedding AS DOUBLE[]), q)
               / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))
                  * sqrt(list_dot_product(q, q)) + 1e-10) AS score
      FROM embeddings, q),
d AS (SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title, source,
             '' AS date_iso, substr(text, 1, 150) AS description,
             'https://docs.example/' || CAST(doc_id AS VARCHAR) AS url FROM documents)"""


_TOPK = "WITH" + _Q.format(label=3) + """
SELECT d.id, title, source, date_iso, description, url, round(score, 4) AS score
FROM s JOIN d USING (id) WHERE score >= 0.0
ORDER BY s.score DESC, d.id LIMIT 10"""


@register("semantic_topk", _TOPK)
def semantic_topk(spark, sf):
    vec = vectors(spark, sf)
    q = V.mean_vector(vec.filter(F.col("label") == 3), "vector")
    cat = papers_from_documents(table(spark, sf, "documents"))
    return V.semantic_search(vec, cat, q, k=10, min_score=0.0)


@register("semantic_view", "WITH" + _Q.format(label=7) + """
SELECT d.id, title, source, date_iso, description, url, round(score, 4) AS score
FROM s JOIN d USING (id) WHERE score >= 0.3""")
def semantic_view(spark, sf):
    vec = vectors(spark, sf)
    q = V.mean_vector(vec.filter(F.col("label") == 7), "vector")
    scored = V.score_against(vec.select("id", "vector"), q).filter(F.col("score") >= 0.3)
    cat = papers_from_documents(table(spark, sf, "documents"))
    return V.semantic_view(V.hits_to_items(scored.select("id", "score"), cat))


_BATCH = """
WITH c AS (SELECT label, list(m ORDER BY i) AS q FROM (
             SELECT label, i, avg(e) AS m FROM (
               SELECT label, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings)
             GROUP BY label, i) GROUP BY label),
s AS (SELECT c.label, CAST(vec_id AS VARCHAR) AS vec_id,
             list_dot_product(CAST(embedding AS DOUBLE[]), q)
               / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))
                  * sqrt(list_dot_product(q, q)) + 1e-10) AS score
      FROM c, embeddings e)
SELECT CAST(label AS VARCHAR) AS label, vec_id, round(score, 6) AS score,
       CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM s QUALIFY rank <= 5"""


@register("semantic_batch", _BATCH)
def semantic_batch(spark, sf):
    # Top-5 vectors for each label centroid, exact, blockwise
    e = table(spark, sf, "embeddings")
    t = V.topk_join(centroids(spark, sf), e, 5, "label", "q", "vec_id", "embedding", block_rows=128)
    return t.select(F.col("q_id").alias("label"), F.col("c_id").alias("vec_id"),
                    F.round("score", 6).alias("score"), "rank")


def _indexed(spark, sf, df: DataFrame, key: str, vec: str) -> str:
    import uuid

    from vitrina.operators.vector_index import write_ball_index
    from vitrina.session import scratch_path
    path = scratch_path(spark, f"balls-{uuid.uuid4().hex}")
    write_ball_index(df, path, key=key, vec_col=vec)
    return path


@register("semantic_topk_index", _TOPK)
def semantic_topk_index(spark, sf):
    # V2 over a ball index: exact, balls whose bound is too low are not read
    from vitrina.operators.vector_index import search_index
    vec = vectors(spark, sf)
    q = V.mean_vector(vec.filter(F.col("label") == 3), "vector")
    return search_index(spark, _indexed(spark, sf, vec.select("id", "vector"), "id", "vector"), papers_from_documents(table(spark, sf, "documents")), q, k=10)


@register("semantic_batch_index", _BATCH)
def semantic_batch_index(spark, sf):
    # W3 over a ball index
    from vitrina.operators.vector_index import topk_index
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vector"))
    t = topk_index(centroids(spark, sf), _indexed(spark, sf, e, "id", "vector"), 5, "label", "q")
    return t.select(F.col("q_id").alias("label"), F.col("c_id").alias("vec_id"), F.round("score", 6).alias("score"), "rank")


@register("semantic_cross", """
WITH s AS (
  SELECT a.label, CAST(a.vec_id AS VARCHAR) AS vec_id, CAST(b.vec_id AS VARCHAR) AS match_id,
         list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
           / (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])))
              * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) + 1e-10)
           AS score
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)
SELECT label, vec_id, match_id, round(score, 6) AS score FROM s
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, match_id) = 1""")
def semantic_cross(spark, sf):
    # Every vector's best match among the other vectors of its label
    e = table(spark, sf, "embeddings")
    t = V.topk_join(e, e, 1, "vec_id", "embedding", "vec_id", "embedding", group="label",
                    exclude_self=True, block_rows=64)
    return t.select("label", F.col("q_id").alias("vec_id"), F.col("c_id").alias("match_id"),
                    F.round("score", 6).alias("score"))


@register("semantic_cross_blocked", """
WITH e AS (SELECT vec_id, embedding, nullif(label, 0) AS label FROM embeddings),
s AS (
  SELECT a.label, CAST(a.vec_id AS VARCHAR) AS vec_id, CAST(b.vec_id AS VARCHAR) AS match_id,
         list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
           / (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])))
              * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) + 1e-10)
           AS score
  FROM e a JOIN e b ON a.label IS NOT DISTINCT FROM b.label AND a.vec_id <> b.vec_id)
SELECT label, vec_id, match_id, round(score, 6) AS score FROM s
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, match_id) <= 2""")
def semantic_cross_blocked(spark, sf):
    # W3/J9 by blocks, as for queries too many to broadcast; one label is null, a group like any other
    e = table(spark, sf, "embeddings").withColumn("label", F.nullif("label", F.lit(0)))
    t = V.topk_join(e, e, 2, "vec_id", "embedding", "vec_id", "embedding", group="label",
                    exclude_self=True, block_rows=256, strategy="blocked")
    return t.select("label", F.col("q_id").alias("vec_id"), F.col("c_id").alias("match_id"),
                    F.round("score", 6).alias("score"))


_STORED = """
WITH""" + _Q.format(label=5) + """,
c AS (SELECT id, CASE WHEN CAST(substr(id, 5) AS BIGINT) % 3 = 0 THEN NULL ELSE title END AS title, source, description, url, 0 AS copy FROM d
      UNION ALL SELECT id, 'zz copy', source, description, url, 1 FROM d)"""


def _stored_catalog(spark, sf) -> DataFrame:
    """Stand-in input: a stored catalogue in its full schema, each item twice, some without a title of their own."""
    import uuid

    from vitrina.operators.normalize import build_catalog
    from vitrina.session import scratch_path
    from vitrina.sources.readers import load_catalog
    from vitrina.sources.sinks import write_catalog
    d = papers_from_documents(table(spark, sf, "documents")).withColumn(
        "dimensions", F.create_map(F.lit("lang"), F.element_at("tags", 1)))
    own = d.withColumn("title", F.when(F.substring_index("id", "-", -1).cast("bigint") % 3 == 0, None).otherwise(F.col("title")))
    path = scratch_path(spark, f"catalog-{uuid.uuid4().hex}")
    write_catalog(build_catalog(own, d.withColumn("title", F.lit("zz copy"))), path)
    return load_catalog(spark, path)


@register("semantic_stored", _STORED + """
SELECT id, coalesce(c.title, 'vector ' || id) AS title, source, '' AS date_iso, description, url, round(score, 4) AS score
FROM s JOIN c USING (id) WHERE copy = 0 AND score >= 0.0 ORDER BY s.score DESC, id LIMIT 10""")
def semantic_stored(spark, sf):
    """V2 over the stored catalogue (K2, S8): every column of its schema, maps
    included, ids that occur twice, the model checked, titles from the vectors where the item has none."""
    vec = vectors(spark, sf).withColumns({"model": F.lit("m-64"), "title": F.concat(F.lit("vector "), F.col("id"))})
    q = V.mean_vector(vec.filter(F.col("label") == 5), "vector")
    return V.semantic_search(vec, _stored_catalog(spark, sf), q, k=10, min_score=0.0, model="m-64")


@register("dedupe_title_stored", _STORED + """
SELECT id, title FROM c WHERE regexp_replace(lower(coalesce(title, '')), '^@WS@+|@WS@+$', '', 'g') <> ''
QUALIFY row_number() OVER (PARTITION BY lower(regexp_replace(title, '^@WS@+|@WS@+$', '', 'g')) ORDER BY id) = 1""")
def dedupe_title_stored(spark, sf):
    # W1 over the stored catalogue
    from vitrina.operators import dedupe as W
    return W.dedupe_by_title(_stored_catalog(spark, sf), "id").select("id", "title")


def _text_items(spark, sf) -> DataFrame:
    docs = papers_from_documents(table(spark, sf, "documents"))
    labels = table(spark, sf, "labels").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"), "quality", "toxic")
    j = docs.join(labels, "id", "left")
    tags = F.concat(F.col("tags"), F.when(F.col("toxic") == 1, F.array(F.lit("toxic")))
                    .otherwise(F.array().cast("array<string>")))
    return j.select("id", "title", "description", tags.alias("tags"))


@register("embedding_text", """
WITH j AS (SELECT 'doc-' || CAST(d.doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title, text AS description,
                  CASE WHEN toxic = 1 THEN [lang, source, 'toxic'] ELSE [lang, source] END AS tags
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
t AS (SELECT id, regexp_replace(array_to_string(list_filter([coalesce(title, ''), coalesce(description, ''),
                                                              array_to_string(tags, ' ')], lambda p: p <> ''), ' | '),
                               '^@WS@+|@WS@+$', '', 'g') AS txt FROM j)
SELECT id, CASE WHEN txt = '' THEN id ELSE txt END AS text FROM t""")
def embedding_text(spark, sf):
    it = _text_items(spark, sf)
    return it.select("id", V.embedding_text().alias("text"))


@register("embed_hashing", """
WITH j AS (SELECT 'doc-' || CAST(d.doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title, text AS description,
                  CASE WHEN toxic = 1 THEN [lang, source, 'toxic'] ELSE [lang, source] END AS tags
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
t AS (SELECT id, regexp_replace(array_to_string(list_filter([coalesce(title, ''), coalesce(description, ''),
                                                              array_to_string(tags, ' ')], lambda p: p <> ''), ' | '),
                               '^@WS@+|@WS@+$', '', 'g') AS txt FROM j),
w AS (SELECT id, unnest(regexp_extract_all(lower(CASE WHEN txt = '' THEN id ELSE txt END), '[\\p{L}\\p{N}_]+')) AS tok FROM t),
h AS (SELECT id, CAST('0x' || substr(md5(tok), 1, 15) AS BIGINT) AS h FROM w),
b AS (SELECT id, h % 64 AS i, sum(CASE WHEN h >= 576460752303423488 THEN 1 ELSE -1 END) AS x FROM h GROUP BY 1, 2),
n AS (SELECT id, sqrt(CAST(sum(x * x) AS DOUBLE)) AS norm FROM b GROUP BY 1),
v AS (SELECT id, i, CAST(floor(CAST(CAST(CAST(coalesce(x, 0) AS DOUBLE) / CASE WHEN norm > 0 THEN norm ELSE 1 END AS FLOAT) AS DOUBLE) * 1000000) AS BIGINT) AS x
      FROM n CROSS JOIN (SELECT unnest(range(64)) AS i) LEFT JOIN b USING (id, i))
SELECT id, 'hashing-64' AS model, true AS ok, string_agg(CAST(x AS VARCHAR), ',' ORDER BY i) AS vector FROM v GROUP BY id""")
def embed_hashing(spark, sf):
    # V3 with the offline hashing embedder: every component of every vector, in millionths
    it = _text_items(spark, sf).select("id", "title", V.embedding_text().alias("text"))
    out = V.embed(it, V.hashing_embedder(64), text_col="text", batch=50)
    parts = F.transform("vector", lambda x: F.floor(x.cast("double") * 1_000_000).cast("bigint").cast("string"))
    return out.select("id", "model", "ok", F.array_join(parts, ",").alias("vector"))
