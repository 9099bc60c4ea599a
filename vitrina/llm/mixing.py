"""Mixing sources to target weights by capped water-filling.

Each source gets the share of the word budget that its weight asks for, but at
most ``max_epochs`` passes over its own words; what a capped source leaves goes
to the others by weight until none is above its cap.  Documents are then taken
whole: every document of a source ``floor(target / size)`` times, and a seeded
subset of them once more so that the source's words come as near its target as
whole documents allow.

All of it is DataFrame code.  Rows are only ever gathered per source *and*
hash bucket, so a source that holds most of the rows is spread like any other;
the one window without a key runs over the table of sources (one row each).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.common import checkpointed, n_words, wrapped

#: Hex digits of the seeded hash that name a bucket: 4,096 buckets a source.
BUCKET_DIGITS = 3


def seeded_hash(doc_id: Column, seed: int) -> Column:
    """Uniform hex key of a document; a null id counts as the text ``null``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights for sources in code point order (null last): the cycle, repeating."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.select("source").distinct().select(
        "source", F.element_at(F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int")).cast("double").alias("weight"))


def water_fill(sizes: DataFrame, weights: DataFrame, share: float = 1.0, max_epochs: float = 3.0) -> DataFrame:
    """Targets per source from ``(source, source_size)`` and ``(source, weight)``.

    The budget is ``share`` of all sizes.  In the order of cap over weight the
    capped sources come first, so one running sum finds the water level at which
    redistribution would stop.  A source without a weight has weight 0 and
    target 0; with nothing to share every target is 0.

    Returns ``source, source_size, target``.
    """
    w = weights.groupBy(F.col("source").alias("w_source")).agg(F.max("weight").alias("weight"))
    t = (sizes.join(w, sizes["source"].eqNullSafe(w["w_source"]), "left")
         .select("source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"),
                 (F.col("source_size") * F.lit(float(max_epochs))).alias("cap")))
    every = Window.partitionBy()
    t = t.withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
    weighted = t.where("weight > 0")
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    run = (weighted.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("weight_onward", F.sum("weight").over(onward)))
    capped = F.col("cap") * F.col("weight_onward") < F.col("weight") * (F.col("budget") - F.col("cap_before"))
    level = (run.withColumn("capped", capped)
             .withColumn("level", (F.col("budget") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0)))
                         / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)))
    # share can ask for more than all caps together: then the level is null and every source stops at its cap
    filled = level.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(
        F.least(F.coalesce(F.col("weight") * F.col("level"), F.col("cap")), F.col("cap"))).alias("target"))
    return filled.unionByName(t.where("weight = 0").select("source", "source_size", F.lit(0.0).alias("target")))


def epochs(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole passes and the hash up to which a document is taken once more.

    ``slim`` has ``source, size, h``.  Sizes are summed per source and bucket,
    the bucket in which the running sum passes the goal is found, and only that
    bucket is ordered by hash.  The end nearest to the goal wins; equal
    distances go to the shorter prefix.
    """
    goals = targets.select(
        "source", "source_size", "target",
        F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long").alias("whole"),
    ).withColumn("goal", F.col("target") - F.col("whole") * F.col("source_size"))
    bucket = F.substring("h", 1, BUCKET_DIGITS)
    sums = slim.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("held"))
    upto = F.sum("held").over(Window.partitionBy("source").orderBy("bucket"))
    g = goals.select(F.col("source").alias("g_source"), "goal")
    crossing = (sums.withColumn("upto", upto).join(g, F.col("source").eqNullSafe(F.col("g_source")))
                .where((F.col("upto") - F.col("held") < F.col("goal")) & (F.col("goal") <= F.col("upto")))
                .select("g_source", "bucket", "goal", (F.col("upto") - F.col("held")).alias("base")))
    inside = (slim.withColumn("h_bucket", bucket)
              .join(crossing, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("h_bucket") == F.col("bucket")))
              .select("g_source", "h", "goal",
                      (F.col("base") + F.sum("size").over(Window.partitionBy("g_source").orderBy("h"))).alias("reached")))
    ends = inside.unionByName(crossing.select("g_source", F.col("bucket").alias("h"), "goal", F.col("base").alias("reached")))
    last = ends.groupBy("g_source").agg(
        F.min_by("h", F.struct(F.abs(F.col("reached") - F.col("goal")), F.col("h"))).alias("last_h"))
    return (goals.join(last, F.col("source").eqNullSafe(F.col("g_source")), "left")
            .select("source", "source_size", "target", "whole", F.coalesce("last_h", F.lit("")).alias("last_h")))


def mix_plan(docs: DataFrame, weights: DataFrame | None = None, share: float = 1.0, max_epochs: float = 3.0, seed: int = 7,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs``: slim rows ``(doc_id, source, size, h)`` and the table of sources."""
    slim = checkpointed(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                    n_words(F.col(text_col)).alias("size"), seeded_hash(F.col(id_col), seed).alias("h")))
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = water_fill(sizes, cycled_weights(sizes) if weights is None else weights, share, max_epochs)
    return slim, checkpointed(epochs(slim, targets))


def repeats(h: Column) -> Column:
    """How often a document is taken, from its hash and its source's row."""
    return F.col("whole") + (h <= F.col("last_h")).cast("long")


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, share: float = 1.0, max_epochs: float = 3.0, seed: int = 7) -> DataFrame:
    """One row per document with its part in the mix.

    Returns ``doc_id, size, source_size, target, taken``: ``taken`` is the
    words that the mix takes from the document, repeats counted.  Null text has
    size 0, a null source is a source of its own (last in order), rows that
    share an id share the decision, and no rows give no rows.
    """
    slim, plan = mix_plan(docs, weights, share, max_epochs, seed)
    p = plan.withColumnRenamed("source", "p_source")
    return slim.join(p, F.col("source").eqNullSafe(F.col("p_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repeats(F.col("h"))).alias("taken"))


def mixed_documents(docs: DataFrame, weights: DataFrame | None = None, share: float = 1.0, max_epochs: float = 3.0, seed: int = 7) -> DataFrame:
    """The documents that the mix takes, with all their columns and ``mix_repeats``.

    A document that the mix leaves out (0 repeats) is not returned; writing the
    mix repeats each row ``mix_repeats`` times.  A column of ``docs`` by that name is replaced.
    """
    _, plan = mix_plan(docs, weights, share, max_epochs, seed)
    p = plan.select(F.col("source").alias("p_source"), "whole", "last_h")
    rows = wrapped(docs, "doc_id", "source").join(p, F.col("source").eqNullSafe(F.col("p_source")))
    return rows.withColumn("mix_repeats", repeats(seeded_hash(F.col("doc_id"), seed))).where("mix_repeats > 0").select(
        *[F.col(f"row.`{c}`") for c in docs.columns if c.lower() != "mix_repeats"], "mix_repeats")


#: DuckDB SQL of ``mix_sources(documents)`` with the default parameters.
MIX_SQL = r"""
WITH slim AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM slim GROUP BY source),
weighted AS (
  SELECT source, source_size, source_size * 3.0::DOUBLE AS cap,
         CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM sizes),
run AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         sum(weight) OVER (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_onward,
         (SELECT CAST(sum(source_size) AS DOUBLE) FROM sizes) AS budget
  FROM weighted),
marked AS (SELECT *, cap * weight_onward < weight * (budget - cap_before) AS capped FROM run),
filled AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap ELSE least(weight * ((budget - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0)) / sum(CASE WHEN NOT capped THEN weight END) OVER ()), cap) END AS target
  FROM marked),
goals AS (
  SELECT *, CAST(coalesce(floor(target / nullif(source_size, 0)), 0) AS BIGINT) AS whole FROM filled),
ends AS (
  SELECT s.source, s.h, g.target - g.whole * g.source_size AS goal,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS reached
  FROM slim s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
  UNION ALL SELECT source, '', target - whole * source_size, 0 FROM goals),
last AS (SELECT source, arg_min(h, struct_pack(d := abs(reached - goal), h := h)) AS last_h FROM ends GROUP BY source)
SELECT s.doc_id, s.size, g.source_size, g.target,
       CAST(s.size * (g.whole + CASE WHEN s.h <= l.last_h THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM slim s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source JOIN last l ON s.source IS NOT DISTINCT FROM l.source
"""
