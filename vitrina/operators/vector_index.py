"""Exact vector search that skips what cannot win: balls around centres.

``write_ball_index`` stores vectors with the ball they belong to, the nearest of some centres by
angle, and for each ball its centre, its radius (the greatest angle of its vectors) and how many they are.
No vector of a ball can be nearer to a query than the angle to the centre less the radius
(angles obey the triangle inequality), so a ball whose bound is below the score of
the k-th best found so far holds no winner.  A search scores the most
promising balls first, and then all whose bound reaches that score: rows and scores are those of
a full scan by construction.  What is skipped depends on the vectors: clustered ones leave most balls out,
while vectors that point in all directions evenly have nothing to skip (``scored`` tells).

Sizes: centres are drawn from the vectors by a hash of their id, as many as ``CENTRE_BYTES``
hold at most; they are all that the driver and each task hold besides the queries, whose
size is checked.  A ball is a range of the stored order, so balls are read by the scan's own statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.operators.text_index import block_ranges
from vitrina.operators.vectors import BROADCAST_QUERY_BYTES, _best, _matrix, semantic_search
from vitrina.session import ship_package

CENTRE_BYTES = 32 << 20
MAX_BALLS = 1 << 14
PAGE_ROWS = 256
#: Vectors that are scored first, for each row asked for.
FIRST = 20
#: What rounding may add to a bound.
SLACK = 1e-9
#: Balls of vectors without a direction (all zero, score 0) and without a score (null, empty, or of another length than the centres).
ZERO, NONE = -1, -2


def _units(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n > 0, n, 1), n[:, 0]


def _assigned(centres: np.ndarray):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            ball, angle = np.full(len(pdf), NONE), np.zeros(len(pdf))
            whole = np.array([v is not None and len(v) == centres.shape[1] and not pd.isna(v).any() for v in pdf["vector"]], bool)
            at = np.flatnonzero(whole)
            for lo in range(0, len(at), 4096):
                part = at[lo : lo + 4096]
                unit, norm = _units(_matrix(pdf["vector"].iloc[part]))
                cos = unit @ centres.T
                near = cos.argmax(axis=1)
                ball[part] = np.where(norm > 0, near, ZERO)
                angle[part] = np.where(norm > 0, np.arccos(np.clip(cos[np.arange(len(part)), near], -1, 1)), 0)
            yield pdf.assign(ball=ball, angle=angle)
    return run


def write_ball_index(vectors: DataFrame, path: str, balls: int | None = None, key: str = "id", vec_col: str = "vector") -> None:
    """Store ``vectors (key, vec_col, ...)`` by balls under ``path/vectors`` and the balls under ``path/balls``."""
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.col(vec_col)
    named = vectors.withColumnRenamed(vec_col, "vector").withColumnRenamed(key, "id") if (key, vec_col) != ("id", "vector") else vectors
    usable = vectors.where(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double"))) & F.exists(v, lambda x: x != 0))
    n, d = usable.agg(F.count("*"), F.max(F.size(v))).first()
    most = min(MAX_BALLS, CENTRE_BYTES // (8 * max(d or 1, 1)))
    m = min(balls or int(2 * n**0.5) + 1, max(most, 1))
    drawn = usable.where(F.size(v) == (d or 0)).orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key).cast("string")).limit(m).select(v.cast("array<double>").alias("c"))
    centres = _units(np.array([r["c"] for r in drawn.collect()], float).reshape(-1, d or 1))[0]  # m rows, CENTRE_BYTES at most
    schema = T.StructType([*named.schema.fields, T.StructField("ball", T.IntegerType()), T.StructField("angle", T.DoubleType())])
    if len(centres):
        placed = named.mapInPandas(_assigned(centres), schema)
    else:
        zero = F.col("vector").isNotNull() & (F.size("vector") > 0)
        placed = named.withColumn("ball", F.when(zero, ZERO).otherwise(NONE)).withColumn("angle", F.lit(0.0))
    laid = placed.repartitionByRange("ball", "id").sortWithinPartitions("ball", "id")
    laid.write.mode("overwrite").option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.block.size", 8 << 20).parquet(f"{path}/vectors")
    stored = spark.read.parquet(f"{path}/vectors")
    found = stored.groupBy("ball").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect()  # a row for each ball
    rows = [(int(r["ball"]), centres[r["ball"]].tolist() if r["ball"] >= 0 else None, float(r["radius"]), int(r["n"])) for r in found]
    spark.createDataFrame(rows, "ball int, centre array<double>, radius double, n long").coalesce(1).write.mode("overwrite").parquet(f"{path}/balls")


@dataclass
class Balls:
    """What is known of the balls of an index."""

    number: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    n: np.ndarray
    zeros: int

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Balls:
        rows = sorted(spark.read.parquet(f"{path}/balls").collect(), key=lambda r: r["ball"])  # MAX_BALLS at most
        real = [r for r in rows if r["ball"] >= 0]
        return cls(np.array([r["ball"] for r in real], int), np.array([r["centre"] for r in real], float).reshape(len(real), len(real[0]["centre"]) if real else 0),
                   np.array([r["radius"] for r in real]), np.array([r["n"] for r in real], int), sum(r["n"] for r in rows if r["ball"] == ZERO))

    def bounds(self, unit: np.ndarray) -> np.ndarray:
        """The greatest score that a vector of each ball can have with each query (of length 1); not below 0, as small norms lift negative scores."""
        angle = np.arccos(np.clip(unit @ self.centre.T, -1, 1))
        return np.maximum(np.cos(np.maximum(angle - self.radius, 0)), 0) + SLACK


def _in_balls(spark: SparkSession, path: str, balls: list[int]) -> DataFrame:
    stored = spark.read.parquet(f"{path}/vectors")
    ranges = block_ranges(balls)
    return stored.where(reduce(lambda a, b: a | b, [F.col("ball").between(lo, hi) for lo, hi in ranges])) if ranges else stored.where("false")


def candidates(spark: SparkSession, path: str, catalog: DataFrame, query: list[float], k: int, min_score: float = 0.0) -> tuple[DataFrame, int, int]:
    """The vectors among which a query's winners are, how many they are, and how many there are in all."""
    balls, q = Balls.read(spark, path), np.array(query, float)
    if not np.linalg.norm(q):
        raise ValueError("zero query vector")
    total = int(balls.n.sum()) + balls.zeros
    if not len(balls.n) or len(q) != balls.centre.shape[1]:
        return _in_balls(spark, path, [ZERO] if not len(balls.n) else []), balls.zeros, total
    bound = balls.bounds(_units(q[None, :])[0])[0]
    order = np.argsort(-bound, kind="stable")
    first = order[: int(np.searchsorted(np.cumsum(balls.n[order]), k * FIRST)) + 1]
    from vitrina.operators.vectors import score_against
    vector = F.array(*[F.lit(float(x)) for x in q])
    hits = score_against(_in_balls(spark, path, balls.number[first].tolist()).select("id", "vector"), vector).where(F.col("score") >= min_score)
    best = hits.join(catalog.select("id"), "id", "left_semi").orderBy(F.col("score").desc()).limit(k).agg(F.count("*").alias("c"), F.min("score").alias("s")).first()
    least = max(best["s"], min_score) if best["c"] == k else min_score
    wanted = np.flatnonzero(bound >= least)
    zeros = least <= 0
    chosen = balls.number[wanted].tolist() + ([ZERO] if zeros else [])
    return _in_balls(spark, path, chosen), int(balls.n[wanted].sum()) + (balls.zeros if zeros else 0), total


def search_index(spark: SparkSession, path: str, catalog: DataFrame, q: Column, k: int = 10, min_score: float = 0.0, model: str | None = None) -> DataFrame:
    """``semantic_search`` over a ball index: the same rows, from the balls that may hold them."""
    query = spark.range(1).select(q.alias("q")).first()["q"]  # one vector
    found, _, _ = candidates(spark, path, catalog, query, k, min_score)
    return semantic_search(found, catalog, F.array(*[F.lit(float(x)) for x in query]), k=k, min_score=min_score, model=model)


def _scored(shared, mode: str, k: int, exclude_self: bool):
    """Rows (q_id, c_id, score) of each ball's best for the queries that may find some there."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, matrix, unit, balls, home, least = shared.value
        place = {b: i for i, b in enumerate(balls.number.tolist())}
        for pdf in it:
            for ball, part in pdf.groupby("ball", sort=True):
                if ball == ZERO:
                    mine = np.flatnonzero(least <= 0) if mode == "all" else np.zeros(0, int)
                elif mode == "home":
                    mine = np.flatnonzero(home == place[ball])
                else:
                    one = Balls(balls.number[[place[ball]]], balls.centre[[place[ball]]], balls.radius[[place[ball]]], balls.n[[place[ball]]], 0)
                    mine = np.flatnonzero(one.bounds(unit)[:, 0] >= least)
                if len(mine):
                    c_ids = part["id"].astype(str).to_numpy()
                    r, c, s = _best(matrix[mine], ids[mine], _matrix(part["vector"]), c_ids, k, exclude_self)
                    yield pd.DataFrame({"q_id": ids[mine][r], "c_id": c_ids[c], "score": s})
    return run


def topk_index(queries: DataFrame, path: str, k: int, q_id: str, q_vec: str, exclude_self: bool = False, min_score: float | None = None,
               max_bytes: int = BROADCAST_QUERY_BYTES) -> DataFrame:
    """``topk_join`` of queries with an index, without groups: ``(q_id, c_id, score, rank)``.

    Queries go to every task, so they must fit ``max_bytes``.  A first pass over each query's nearest
    ball gives the score that others must reach.  Queries that are null, empty, zero, or of another length than the vectors find nothing but
    what scores 0.
    """
    spark = queries.sparkSession
    ship_package(spark)
    v = F.col(q_vec)
    whole = queries.where(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull())).select(F.col(q_id).cast("string").alias("q"), v.cast("array<double>").alias("v"))
    balls = Balls.read(spark, path)
    d = balls.centre.shape[1] if len(balls.n) else 0
    whole = whole.where(F.size("v") == d)
    count = whole.count()
    if count * max(d, 1) * 8 > max_bytes:
        raise ValueError(f"{count} queries of {d} numbers do not fit {max_bytes} bytes")
    got = whole.toPandas()
    ids, matrix = got["q"].to_numpy(object), np.array(got["v"].tolist(), float).reshape(len(got), max(d, 1))
    unit, norm = _units(matrix)
    home = np.concatenate([balls.bounds(unit[lo : lo + 1024]).argmax(axis=1) for lo in range(0, len(unit), 1024)]) if len(unit) and d else np.zeros(len(unit), int)
    floor = -np.inf if min_score is None else min_score
    least = np.full(len(ids), floor)
    schema = "q_id string, c_id string, score double"
    stored = spark.read.parquet(f"{path}/vectors").where(F.col("ball") != NONE).select("ball", F.col("id").cast("string").alias("id"), "vector")
    if len(ids):
        shared = spark.sparkContext.broadcast((ids, matrix, unit, balls, home, least))
        own = stored.where("ball >= 0").mapInPandas(_scored(shared, "home", k, exclude_self), schema)
        ranked = own.withColumn("r", F.row_number().over(Window.partitionBy("q_id").orderBy(F.col("score").desc()))).where(F.col("r") == k)
        kth = {r["q_id"]: r["score"] for r in ranked.select("q_id", "score").collect()}  # a number for each query
        least = np.maximum(least, [kth.get(i, -np.inf) for i in ids])
    shared = spark.sparkContext.broadcast((ids, matrix, unit, balls, home, np.asarray(least, float)))
    part = stored.mapInPandas(_scored(shared, "all", k, exclude_self), schema)
    if min_score is not None:
        part = part.where(F.col("score") >= min_score)
    w = Window.partitionBy("q_id").orderBy(F.col("score").desc(), F.col("c_id").asc())
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
