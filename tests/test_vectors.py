"""Vectors: cosine search edge cases and blocked top-k against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrina.operators import vectors as V


def test_embedding_text(spark):
    df = spark.createDataFrame([("id1", "T", "", ["a", "b"]), ("id2", "", "  ", []), ("id3", " ", "D", None)],
                               "id string, title string, description string, tags array<string>")
    got = [r["t"] for r in df.select(V.embedding_text().alias("t")).collect()]
    assert got == ["T | a b", "id2", "| D"]  # parts joined before the strip, as the reference does


def catalog(spark):
    return spark.createDataFrame([("a", "A", "s", "", "desc a", "u"), ("b", "B", "s", "", "desc b", "u"),
                                  ("c", "C", "s", "", "x" * 300, "u"), ("b", "B2", "s", "", "dup", "u")],
                                 "id string, title string, source string, date_iso string, description string, "
                                 "url string")


def vectors(spark):
    return spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.6, 0.8]), ("z", [1.0, 0.0]),
                                  ("n", [-1.0, 0.0]), ("o", [0.0, 0.0])], "id string, vector array<float>")


def test_semantic_search(spark):
    q = F.array(F.lit(1.0), F.lit(0.0))
    rows = V.semantic_search(vectors(spark), catalog(spark), q, k=2).collect()
    # orphan z (no item) is skipped before the limit; ties go to the lower id; dup id b appears once
    assert [(r["id"], r["score"]) for r in rows] == [("a", 1.0), ("b", 1.0)]
    rows = V.semantic_search(vectors(spark), catalog(spark), q, k=10).collect()
    assert [r["id"] for r in rows] == ["a", "b", "c"]
    assert len(rows[2]["description"]) == 150
    assert rows[2]["score"] == 0.6


def test_zero_query_vector_is_error(spark):
    q = F.array(F.lit(0.0), F.lit(0.0))
    with pytest.raises(Exception, match="zero query vector"):
        V.semantic_search(vectors(spark), catalog(spark), q).collect()


def test_zero_vector_scores_zero_and_passes(spark):
    q = F.array(F.lit(1.0), F.lit(0.0))
    s = {r["id"]: r["score"] for r in V.score_against(vectors(spark), q).collect()}
    assert s["o"] == 0.0 and s["n"] < 0


def test_topk_join_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    n, d = 300, 8
    vecs = rng.normal(size=(n, d)).astype(np.float32)
    groups = rng.integers(0, 3, size=n)
    groups[:150] = 0  # a hot group
    rows = [(int(i), int(g), v.tolist()) for i, (g, v) in enumerate(zip(groups, vecs))]
    df = spark.createDataFrame(rows, "vid bigint, g int, v array<float>")
    blocked = V.topk_join(df, df, 3, "vid", "v", "vid", "v", group="g", exclude_self=True, block_rows=40,
                          strategy="blocked")
    bcast = V.topk_join(df, df, 3, "vid", "v", "vid", "v", group="g", exclude_self=True, strategy="broadcast")
    got = {(int(r["q_id"]), r["rank"]): int(r["c_id"]) for r in blocked.collect()}
    assert got == {(int(r["q_id"]), r["rank"]): int(r["c_id"]) for r in bcast.collect()}
    v64 = vecs.astype(np.float64)
    norms = np.linalg.norm(v64, axis=1)
    for i in range(n):
        same = [j for j in range(n) if groups[j] == groups[i] and j != i]
        sims = [(-(v64[i] @ v64[j]) / (norms[i] * norms[j] + 1e-10), str(j)) for j in same]
        best = [int(j) for _, j in sorted(sims)[:3]]
        assert [got[(i, r)] for r in (1, 2, 3)] == best


def test_embed_batches_and_failures(spark):
    def flaky(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError("model down")
        return [[float(len(t)), 1.0] for t in texts]
    flaky.model_name = "len-model"
    df = spark.createDataFrame([(str(i), "t", "boom" if i == 3 else "hola" * i) for i in range(7)],
                               "id string, title string, text string")
    out = {r["id"]: r for r in V.embed(df, flaky, batch=3, retries=1, backoff=0).collect()}
    assert not out["3"]["ok"] and out["3"]["vector"] == [0.0, 0.0]
    assert out["4"]["ok"] and out["4"]["vector"] == [16.0, 1.0]
    assert {r["model"] for r in out.values()} == {"len-model"}


def test_hashing_embedder_deterministic():
    e = V.hashing_embedder(32)
    a, b = e(["La inflación sube", ""])
    assert a == e(["La inflación sube"])[0]
    assert abs(np.linalg.norm(a) - 1.0) < 1e-6 and not any(b)


def test_topk_auto_picks_by_size(spark):
    q = spark.createDataFrame([("q", [1.0, 0.0])], "id string, v array<float>")
    c = spark.createDataFrame([("a", [1.0, 0.1]), ("b", [0.0, 1.0])], "id string, v array<float>")
    small = V.topk_join(q, c, 1, "id", "v", "id", "v")
    big = V.topk_join(q, c, 1, "id", "v", "id", "v", broadcast_bytes=1)  # forces the blocked path
    assert [(r["q_id"], r["c_id"]) for r in small.collect()] == [("q", "a")] == \
        [(r["q_id"], r["c_id"]) for r in big.collect()]


def test_short_reply_gives_zero_vectors(spark):
    def short(texts):
        return [[1.0, 2.0]] * (len(texts) - 1)
    short.dim = 2
    df = spark.createDataFrame([(str(i), "t", f"x{i}") for i in range(3)], "id string, title string, text string").coalesce(1)
    got = {r["id"]: (r["vector"], r["ok"]) for r in V.embed(df, short).collect()}
    assert sorted(ok for _, ok in got.values()) == [False, True, True]
    assert [v for v, ok in got.values() if not ok] == [[0.0, 0.0]]


def test_null_group_is_a_group_in_both_strategies(spark):
    rows = [(0, None, [1.0, 0.0]), (1, None, [0.9, 0.1]), (2, 1, [1.0, 0.0]), (3, 1, [0.0, 1.0]), (4, 2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "i bigint, g int, v array<float>")
    both = [sorted((str(r["g"]), r["q_id"], r["c_id"], round(r["score"], 6), r["rank"]) for r in V.topk_join(
        df, df, 1, "i", "v", "i", "v", group="g", exclude_self=True, strategy=s).collect()) for s in ("broadcast", "blocked")]
    assert both[0] == both[1] and [x[:3] for x in both[0]] == [("1", "2", "3"), ("1", "3", "2"), ("None", "0", "1"), ("None", "1", "0")]
    with pytest.raises(ValueError, match="do not fit"):
        V.topk_join(df, df, 1, "i", "v", "i", "v", strategy="broadcast", broadcast_bytes=8)


def test_tiles_do_not_change_the_result():
    rng = np.random.default_rng(1)
    q, c = rng.normal(size=(17, 4)), rng.normal(size=(23, 4))
    ids = lambda n: np.array([str(i) for i in range(n)], dtype=object)
    whole = V._best(q, ids(17), c, ids(23), 3, True)
    for cells in (1, 30, 100):
        for a, b in zip(whole, V._best(q, ids(17), c, ids(23), 3, True, tile_cells=cells), strict=True):
            assert np.allclose(a, b)  # a product of other shape may round otherwise


def test_search_on_map_columns_checks_the_model(spark):
    vec = spark.createDataFrame([("a", [1.0, 0.0], "m", "VA"), ("b", [0.9, 0.1], "m", "VB")], "id string, vector array<float>, model string, title string")
    cat = spark.createDataFrame([("a", None, {"k": "v"}), ("b", "B", None), ("b", "B2", {})], "id string, title string, dims map<string,string>").selectExpr(
        "*", "'s' AS source", "'' AS date_iso", "'' AS description", "'' AS url")
    q = F.array(F.lit(1.0), F.lit(0.0))
    assert [(r["id"], r["title"]) for r in V.semantic_search(vec, cat, q, model="m").collect()] == [("a", "VA"), ("b", "B")]
    with pytest.raises(Exception, match="the query is of model other"):
        V.semantic_search(vec, cat, q, model="other").collect()
    hits = V.score_against(vec, q).select("id", "score")
    assert V.hits_to_items(hits, cat).count() == 2


def test_null_empty_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, None), (3, []), (4, [1.0, None]), (5, [1.0, 0.0, 0.0]), (6, [0.5, 0.5, 0.0]), (7, [0.0, 0.0]), (8, [None, None])]
    df = spark.createDataFrame(rows, "i bigint, v array<float>").repartition(3)
    both = [sorted((r["q_id"], r["rank"], r["c_id"], round(r["score"], 6)) for r in V.topk_join(
        df, df, 2, "i", "v", "i", "v", exclude_self=True, strategy=s, block_rows=2).collect()) for s in ("broadcast", "blocked")]
    assert both[0] == both[1]
    assert [x[:3] for x in both[0]] == [("0", 1, "1"), ("0", 2, "7"), ("1", 1, "0"), ("1", 2, "7"), ("5", 1, "6"), ("6", 1, "5"), ("7", 1, "0"), ("7", 2, "1")]
    none = df.filter("v IS NULL")
    for s in ("broadcast", "blocked"):
        assert V.topk_join(none, df, 2, "i", "v", "i", "v", strategy=s).count() == 0 == V.topk_join(df, none, 2, "i", "v", "i", "v", strategy=s).count()


def test_blocks_of_a_large_group_are_few(spark):
    sizes = [(1, 64), (256, 64), (257, 64), (2048, 64), (120_000, 64), (10_000_000, 64), (50, 10_000_000)]
    df = spark.createDataFrame(sizes, "n long, d int").select("n", V._blocks(F.col("n"), F.col("d"), 256).alias("b"))
    got = dict(tuple(r) for r in df.collect())
    assert got == {1: 1, 256: 1, 257: 2, 2048: 8, 120_000: 8, 10_000_000: -(-10_000_000 // (V.BLOCK_BYTES // 512)), 50: 1}


@pytest.mark.parametrize("k", [1, 2, 9])
def test_best_against_a_sort(k):
    rng = np.random.default_rng(3)
    c, q = rng.integers(-1, 2, (60, 3)).astype(float), rng.integers(-1, 2, (25, 3)).astype(float)  # many equal scores, some zero vectors
    c[7] = np.nan
    c_ids, q_ids = np.array([f"i{i % 50}" for i in range(60)], object), np.array([f"i{i}" for i in range(24)] + [None], object)
    c_ids[3] = None
    for candidates in (c, np.delete(c, 7, 0)):
        names = c_ids if candidates is c else np.delete(c_ids, 7)
        want = []
        for r, x in enumerate(q):
            with np.errstate(invalid="ignore"):
                s = (candidates @ x) / (np.linalg.norm(x) * np.linalg.norm(candidates, axis=1) + V.EPS)
            ranked = sorted((-s[i], str(names[i])) for i in range(len(s)) if names[i] != q_ids[r] and np.isfinite(s[i]))[:k]
            want += [(r, n, pytest.approx(-v)) for v, n in ranked]
        at, of, score = V._best(q, q_ids, candidates, names, k, True)
        assert len(at) == len(want) and [(r, str(names[i])) for r, i in zip(at, of, strict=True)] == [w[:2] for w in want] and list(score) == [w[2] for w in want]
