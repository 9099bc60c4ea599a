"""The ball index: the rows of a full scan, with few vectors scored where they are clustered."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrina.operators import vector_index as X
from vitrina.operators import vectors as V


def clustered(n, d, centres, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, d))
    return (c[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, d))) * rng.uniform(0.5, 3, (n, 1))


@pytest.fixture(scope="module", params=["clustered", "even"])
def stored(request, spark, tmp_path_factory):
    m = clustered(1500, 16, 30, 1) if request.param == "clustered" else np.random.default_rng(2).normal(size=(600, 16))
    rows = [(f"v{i:04d}", v.astype(np.float32).tolist()) for i, v in enumerate(m)]
    rows += [("v0001x", rows[1][1]), ("zero", [0.0] * 16), ("null", None), ("empty", []), ("short", [1.0, 2.0]), ("hole", [1.0, None] * 8)]
    df = spark.createDataFrame(rows, "id string, vector array<float>").repartition(3)
    path = str(tmp_path_factory.mktemp("balls"))
    df.write.mode("overwrite").parquet(f"{path}/plain")
    X.write_ball_index(df, path)
    return request.param, spark.read.parquet(f"{path}/plain"), path


@pytest.fixture(scope="module")
def catalog(spark, stored):
    # some vectors have no item
    ids = stored[1].where(~F.col("id").endswith("3")).select("id")
    return ids.selectExpr("id", "concat('t ', id) AS title", "'s' AS source", "'' AS date_iso", "'' AS description", "'' AS url")


def test_balls_hold_their_vectors(spark, stored):
    kind, df, path = stored
    balls = X.Balls.read(spark, path)
    for r in spark.read.parquet(f"{path}/vectors").collect():
        want = {"zero": X.ZERO, "null": X.NONE, "empty": X.NONE, "short": X.NONE, "hole": X.NONE}.get(r["id"])
        assert want is None or r["ball"] == want
        if want is None:
            at = balls.number.tolist().index(r["ball"])
            u = np.array(r["vector"], float)
            assert np.arccos(np.clip(u @ balls.centre[at] / np.linalg.norm(u), -1, 1)) <= balls.radius[at] + 1e-9
    assert balls.zeros == 1 and balls.n.sum() == df.count() - 5


@pytest.mark.parametrize(("k", "least"), [(1, 0.0), (10, 0.0), (5, 0.9), (5, -1.0), (3000, 0.0)])
def test_search_equals_the_scan(spark, stored, catalog, k, least):
    kind, df, path = stored
    good = df.where("id LIKE 'v%' OR id = 'zero'")
    for query in (clustered(1, 16, 30, 1)[0], np.ones(16), -np.arange(16.0)):
        q = F.array(*[F.lit(float(x)) for x in query])
        got = X.search_index(spark, path, catalog, q, k=k, min_score=least).collect()
        assert got == V.semantic_search(good, catalog, q, k=k, min_score=least).collect()


def test_clustered_vectors_are_skipped(spark, stored, catalog):
    kind, df, path = stored
    query = next(r["vector"] for r in df.where("id = 'v0001'").collect())
    _, scored, total = X.candidates(spark, path, catalog, query, 10)
    assert scored < total / 10 if kind == "clustered" else scored <= total
    with pytest.raises(ValueError, match="zero query vector"):
        X.candidates(spark, path, catalog, [0.0] * 16, 10)


@pytest.mark.parametrize(("k", "own", "least"), [(3, True, None), (5, False, 0.5), (700, False, None)])
def test_many_queries_equal_the_join(spark, stored, k, own, least):
    kind, df, path = stored
    queries = df.where("hash(id) % 40 = 0 OR id IN ('v0001', 'zero', 'null', 'short', 'hole')").withColumnRenamed("id", "q").withColumnRenamed("vector", "qv")
    rows = lambda d: sorted((r["q_id"], r["rank"], r["c_id"], round(r["score"], 9)) for r in d.collect())
    whole = df.where("size(vector) = 16 AND id <> 'hole'")  # an index has vectors of one length
    want = rows(V.topk_join(queries, whole, k, "q", "qv", "id", "vector", exclude_self=own, min_score=least).where("q_id <> 'short'"))
    assert rows(X.topk_index(queries, path, k, "q", "qv", exclude_self=own, min_score=least)) == want and want
    with pytest.raises(ValueError, match="do not fit"):
        X.topk_index(queries, path, k, "q", "qv", max_bytes=8)


def test_nothing_to_index(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("z", [0.0, 0.0])], "id string, vector array<float>")
    cat = df.selectExpr("id", "id AS title", "'s' AS source", "'' AS date_iso", "'' AS description", "'' AS url")
    for rows in (df, df.limit(0)):
        X.write_ball_index(rows, str(tmp_path))
        got = X.search_index(spark, str(tmp_path), cat, F.array(F.lit(1.0), F.lit(0.0)), k=2).collect()
        assert [r["id"] for r in got] == (["z"] if rows is df else [])
        assert X.topk_index(df, str(tmp_path), 1, "id", "vector").count() == 0
