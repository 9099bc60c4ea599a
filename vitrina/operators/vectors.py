"""Vectors: embedding text, embedding, cosine scoring and top-k search.

Single-query search (V2) stays native: the query vector is a literal or a
scalar subquery, scores are ``aggregate(zip_with(...))`` expressions and the
top-k is ``TakeOrderedAndProject``.

Many-to-many matching (W3, J9) is exact and never materialises all pairs:
both sides are cut into blocks of at most ``block_rows`` rows per group; a
query block meets every candidate block of its group once (rows are
replicated by ``explode`` of block ids, a join on (group, query block,
candidate block)), a pandas function multiplies the two blocks and keeps the
k best candidates of each query; a final ``row_number() <= k`` per query
merges the block winners.  Memory per task is bounded by two blocks, a hot
group gets more blocks, and the output is at most k rows per query per block.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.functions.text import _c, strip_ws
from vitrina.operators.dedupe import row_order
from vitrina.session import checkpoint_dir

EPS = 1e-10  # fixed value: added to the norm product, as the reference does


# ---------------------------------------------------------------------------
# N8 embedding text, N7 result view
# ---------------------------------------------------------------------------
def embedding_text(title: Column | str = "title", description: Column | str = "description",
                   tags: Column | str = "tags", item_id: Column | str = "id") -> Column:
    """``title | description | tags`` without blank parts, stripped; the id when empty."""
    tag_text = F.array_join(F.coalesce(_c(tags), F.array().cast("array<string>")), " ")
    parts = F.array(F.coalesce(_c(title), F.lit("")), F.coalesce(_c(description), F.lit("")), tag_text)
    joined = strip_ws(F.array_join(F.filter(parts, lambda p: p != ""), " | "))
    return F.when(joined == "", _c(item_id).cast("string")).otherwise(joined)


def semantic_view(df: DataFrame, width: int = 150) -> DataFrame:
    """The 7 result fields, description cut to ``width``, score to 4 places."""
    return df.select("id", "title", "source", "date_iso",
                     F.substring(F.coalesce(F.col("description"), F.lit("")), 1, width).alias("description"),
                     "url", F.round(F.col("score"), 4).alias("score"))


# ---------------------------------------------------------------------------
# V1 cosine
# ---------------------------------------------------------------------------
def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two numeric arrays, accumulated in double."""
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str, a_norm: Column | None = None,
           b_norm: Column | None = None) -> Column:
    """``a·b / (|a|·|b| + 1e-10)`` (V1); pass precomputed norms to avoid recomputing."""
    na = a_norm if a_norm is not None else norm(a)
    nb = b_norm if b_norm is not None else norm(b)
    return dot(a, b) / (na * nb + F.lit(EPS))


def mean_vector(vectors: DataFrame, vec_col: str) -> Column:
    """Scalar subquery: the element-wise mean of ``vec_col`` (partial aggregate per position)."""
    e = vectors.select(F.posexplode(vec_col).alias("_i", "_x"))
    means = e.groupBy("_i").agg(F.avg("_x").alias("_m"))
    return means.agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))),
                                 lambda s: s["_m"]).alias("q")).scalar()


# ---------------------------------------------------------------------------
# V2 single-query search, J5
# ---------------------------------------------------------------------------
def hits_to_items(hits: DataFrame, catalog: DataFrame, key: str = "id",
                  order: Column | str | None = None) -> DataFrame:
    """Inner join of scored hits to catalogue items, first item per duplicate id.

    Catalogue rows of the hit ids are deduplicated with a ``min``-based
    aggregate (partial, skew-safe) before the join; hits without an item drop
    out before any limit, so they never use up k.
    """
    # only catalogue rows whose id was hit are deduplicated; the semi-join,
    # the aggregate and the final join all use the same id partitioning
    wanted = catalog.join(hits.select(key), key, "left_semi")
    return hits.join(_first_items(wanted, key, order), key, "inner")


def _first_items(catalog: DataFrame, key: str, order: Column | str | None = None) -> DataFrame:
    """One row per id: the least by ``order``, then by whole rows (any schema, maps included)."""
    cols = [c for c in catalog.columns if c != key]
    rest = row_order(catalog.select(*cols))
    rank = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(rest if order is None else [_c(order), *rest])])
    first = catalog.groupBy(key).agg(F.min_by(F.struct(*cols), rank).alias("_it"))
    return first.select(key, *[F.col("_it")[c].alias(c) for c in cols])


def score_against(vectors: DataFrame, q: Column, vec_col: str = "vector") -> DataFrame:
    """Add ``score`` = cosine of each vector with the query vector ``q``.

    A zero query vector is an error (V1), raised inside the plan.
    """
    # the query goes into its own column first: a scalar subquery may not sit
    # inside a higher-order function, a column reference may
    withq = vectors.withColumn("_q", q)
    qv = F.col("_q")
    qn = norm(qv)
    guard = F.when(qn == 0, F.raise_error(F.lit("zero query vector"))).otherwise(qn)
    return withq.withColumn("score", dot(vec_col, qv) / (norm(vec_col) * guard + F.lit(EPS))).drop("_q")


def semantic_search(vectors: DataFrame, catalog: DataFrame, q: Column, k: int = 10,
                    min_score: float = 0.0, vec_col: str = "vector", key: str = "id",
                    model: str | None = None) -> DataFrame:
    """Top-k catalogue items by cosine with ``q``.

    ``score >= min_score`` is applied before ranking (the default 0.0 drops
    negative cosines; zero vectors score 0 and pass); ties go to the lower id.
    With ``model``, the name of what made the query vector, a stored vector of
    another model fails the search (D9).  An item without a title takes the
    one stored with its vector, if there is one.
    """
    titled = "title" in vectors.columns
    if model is not None:
        wrong = F.raise_error(F.concat(F.lit(f"the query is of model {model}, a vector of "), F.coalesce("model", F.lit("none"))))
        vectors = vectors.withColumn(vec_col, F.when(F.col("model").eqNullSafe(F.lit(model)), F.col(vec_col)).otherwise(wrong))
    name = [F.col("title").alias("_title")] if titled else [F.lit(None).cast("string").alias("_title")]
    scored = score_against(vectors.select(key, vec_col, *name), q, vec_col).filter(F.col("score") >= min_score)
    # Only the id column of the catalogue takes part in ranking: hits without
    # an item drop out before the top-k, so they never use up k.  Item details
    # are then fetched for the k winners only, through a broadcast of at most
    # k ids.  The k winners are checkpointed: the ranking runs once for both readers.
    checkpoint_dir(vectors.sparkSession)
    top = (scored.select(key, "score", "_title").join(catalog.select(key), key, "left_semi")
           .orderBy(F.col("score").desc(), F.col(key).asc()).limit(k).checkpoint())
    first = _first_items(catalog.join(F.broadcast(top.select(key)), key, "left_semi"), key)
    items = top.join(F.broadcast(first), key, "inner").withColumn("title", F.coalesce("title", "_title"))
    return semantic_view(items.orderBy(F.col("score").desc(), F.col(key).asc()))


# ---------------------------------------------------------------------------
# W3 / J9 blocked exact top-k
# ---------------------------------------------------------------------------
TILE_CELLS = 1 << 20  # scores held at once: 8 MB for each temporary


def _kth_best(sims: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest number of each row; for few, by taking out the largest in turn."""
    if k > 8:
        return -np.partition(-sims, k - 1, axis=1)[:, k - 1]
    rows, out = np.arange(len(sims)), []
    for _ in range(k):
        at = sims.argmax(axis=1)
        out.append((at, sims[rows, at]))
        sims[rows, at] = -np.inf
    for at, value in reversed(out):  # a row short of numbers gives up one place twice
        sims[rows, at] = value
    return out[-1][1]


def _best(qm: np.ndarray, q_ids: np.ndarray, cm: np.ndarray, c_ids: np.ndarray, k: int, exclude_self: bool,
          tile_cells: int = TILE_CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of each query's k best candidates, ties by candidate id.

    Scores are made in tiles of at most ``tile_cells`` (one row of candidates at least).
    """
    qn, cn = np.linalg.norm(qm, axis=1), np.linalg.norm(cm, axis=1)
    kk, step = min(k, len(c_ids)), max(1, tile_cells // max(1, len(c_ids)))
    names = c_ids.astype(str)
    r_out, c_out, s_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    finite = bool(np.isfinite(qn).all() and np.isfinite(cn).all())
    if exclude_self:
        number = pd.factorize(np.r_[c_ids.astype(object), q_ids.astype(object)], use_na_sentinel=False)[0]  # one for each id, null too
        by_id, q_number = np.argsort(number[:len(c_ids)], kind="stable"), number[len(c_ids):]
        c_number = number[by_id]
    for at in range(0, len(q_ids) if kk else 0, step):
        sims = qm[at:at + step] @ cm.T
        bound = np.outer(qn[at:at + step], cn)
        bound += EPS
        sims /= bound
        if exclude_self:
            lo, hi = (np.searchsorted(c_number, q_number[at:at + step], side) for side in ("left", "right"))
            for r in np.flatnonzero(hi > lo):
                sims[r, by_id[lo[r]:hi[r]]] = -np.inf
        # the k-th best score of each row, everything at or above it, then a sort of that few
        least = _kth_best(sims, kk) if finite else -np.partition(-sims, kk - 1, axis=1)[:, kk - 1]
        r, c = np.nonzero(sims >= least[:, None])
        score = sims[r, c]
        ok = np.isfinite(score)
        r, c, score = r[ok], c[ok], score[ok]
        order = np.lexsort((names[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        first = np.searchsorted(r, np.arange(len(sims)))
        best = np.arange(len(r)) - first[r] < kk
        r_out.append(r[best] + at)
        c_out.append(c[best])
        s_out.append(score[best])
    return np.concatenate(r_out), np.concatenate(c_out), np.concatenate(s_out)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.vstack(vectors.to_numpy()).astype(np.float64)


#: A large group is cut into this many blocks a side, each no larger than ``BLOCK_BYTES`` of numbers.
GROUP_BLOCKS, BLOCK_BYTES = 8, 16 << 20
BROADCAST_QUERY_BYTES = 64 * 1024 * 1024  # query matrices up to this size are broadcast


def topk_join(queries: DataFrame, candidates: DataFrame, k: int, q_id: str, q_vec: str,
              c_id: str, c_vec: str, group: str | None = None, exclude_self: bool = False,
              block_rows: int = 4096, min_score: float | None = None, strategy: str = "auto",
              broadcast_bytes: int = BROADCAST_QUERY_BYTES) -> DataFrame:
    """Exact top-k candidates per query by cosine.

    Returns ``(group?, q_id, c_id, score, rank)`` with rank 1..k, ties broken by
    candidate id.  ``group`` restricts matches to equal group values; null is a
    group like any other.  Null and empty vectors and those with a null in them, on either side, match
    nothing, and vectors of different lengths do not match each other.

    ``strategy="auto"`` counts the queries (one small job) and, when the
    query matrix fits ``broadcast_bytes``, broadcasts it: candidates are
    scored where they are stored and only k rows per query per batch are
    shuffled.  Otherwise both sides are cut into blocks (``"blocked"``).  Both ways
    score group by group in tiles of ``TILE_CELLS``, and give the same rows.
    ``"broadcast"`` with more queries than fit is an error.
    """
    if strategy not in ("auto", "broadcast", "blocked"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy != "blocked":
        stats = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(q_vec)).alias("d")).first()
        fits = (stats["n"] or 0) * max(stats["d"] or 0, 1) * 8 <= broadcast_bytes
        if strategy == "broadcast" and not fits:
            raise ValueError(f"{stats['n']} queries of {stats['d']} numbers do not fit {broadcast_bytes} bytes")
        if fits:
            return _topk_broadcast(queries, candidates, k, q_id, q_vec, c_id, c_vec, group,
                                   exclude_self, min_score)
    return _topk_blocked(queries, candidates, k, q_id, q_vec, c_id, c_vec, group, exclude_self,
                         block_rows, min_score)


def _side(df: DataFrame, group: str | None, row_id: str, vec: str, side: str) -> DataFrame:
    """(group, its text form, id, vector) of one side; the text form holds the vector's length, and no ``g`` for a null group.

    Vectors that are null, empty or have a null in them have no score, as in V1, so they take no part.
    """
    g, v = F.col(group) if group else F.lit(0), F.col(vec)
    whole = df.filter(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull()))
    return whole.select(g.alias("g"), F.to_json(F.struct(F.size(v).alias("n"), g.alias("g"))).alias("gk"), F.col(row_id).cast("string").alias(f"{side}_id"), v.alias(f"{side}_vec"))


def _ranked(part: DataFrame, k: int, group: str | None, min_score: float | None) -> DataFrame:
    if min_score is not None:
        part = part.filter(F.col("score") >= min_score)
    w = Window.partitionBy("gk", "q_id").orderBy(F.col("score").desc(), F.col("c_id").asc())
    ranked = part.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("gk")
    return ranked.withColumnRenamed("g", group) if group else ranked.drop("g")


def _topk_broadcast(queries: DataFrame, candidates: DataFrame, k: int, q_id: str, q_vec: str,
                    c_id: str, c_vec: str, group: str | None, exclude_self: bool,
                    min_score: float | None) -> DataFrame:
    """Broadcast query matrix (size checked by the caller), scan candidates once."""
    spark = queries.sparkSession
    qd, cd = _side(queries, group, q_id, q_vec, "q"), _side(candidates, group, c_id, c_vec, "c")
    # bounded: checked against broadcast_bytes; Arrow holds the numbers as numbers
    got = qd.withColumn("q_vec", F.col("q_vec").cast("array<double>")).toArrow().sort_by("gk").combine_chunks()
    keys = got.column("gk").to_numpy()
    cuts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)] if len(keys) else np.zeros(0, np.int64)
    of_key = {}
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):  # vectors under one key have one length
        part = got.slice(lo, hi - lo)
        flat = part.column("q_vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        of_key[keys[lo]] = (part.column("q_id").to_numpy().astype(object), flat.reshape(hi - lo, -1))
    bc = spark.sparkContext.broadcast(of_key)
    from vitrina.session import ship_package
    ship_package(spark)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for key, part in pdf.groupby("gk", sort=True):
                if key not in bc.value:
                    continue
                ids, qm = bc.value[key]
                r, c, s = _best(qm, ids, _matrix(part["c_vec"]), part["c_id"].to_numpy(), k, exclude_self)
                yield pd.DataFrame({"gk": key, "q_id": ids[r], "c_id": part["c_id"].to_numpy()[c], "score": s})

    part = cd.select("gk", "c_id", "c_vec").mapInPandas(run, "gk string, q_id string, c_id string, score double")
    return _ranked(_with_group(part, cd), k, group, min_score)


def _with_group(part: DataFrame, side: DataFrame) -> DataFrame:
    """The group's own value back from its text form."""
    return part.withColumn("g", F.from_json("gk", T.StructType([side.schema["g"]]))["g"])


def _blocks(n: Column, dim: Column, block_rows: int) -> Column:
    """Number of blocks of a group's ``n`` vectors of ``dim`` numbers."""
    most = F.greatest(F.floor(F.lit(BLOCK_BYTES) / (8 * dim)), F.lit(1))
    rows = F.greatest(F.lit(block_rows), F.least(F.ceil(n / GROUP_BLOCKS), most))
    return F.ceil(n / rows).cast("int")


def _topk_blocked(queries: DataFrame, candidates: DataFrame, k: int, q_id: str, q_vec: str,
                  c_id: str, c_vec: str, group: str | None, exclude_self: bool, block_rows: int,
                  min_score: float | None) -> DataFrame:
    """Both sides in blocks; each query block meets each candidate block of its group once.

    A block has ``block_rows`` rows or, in a large group, more, since each side is copied once for every block of the other.
    """
    qd, cd = _side(queries, group, q_id, q_vec, "q"), _side(candidates, group, c_id, c_vec, "c")
    # blocks from the group sizes (one row per group, an equi-join)
    qn = qd.groupBy("gk").agg(F.count(F.lit(1)).alias("_nq"), F.max(F.size("q_vec")).alias("_d"))
    cn = cd.groupBy("gk").agg(F.count(F.lit(1)).alias("_nc"))
    nb = qn.join(cn, "gk").select("gk", _blocks(F.col("_nq"), F.col("_d"), block_rows).alias("_bq"),
                                  _blocks(F.col("_nc"), F.col("_d"), block_rows).alias("_bc"))
    qb, cb = qd.join(nb, "gk"), cd.join(nb, "gk")
    qb = (qb.withColumn("_iq", F.pmod(F.xxhash64("q_id"), F.col("_bq")).cast("int"))
          .withColumn("_ic", F.explode(F.sequence(F.lit(0), F.col("_bc") - 1))))
    cb = (cb.withColumn("_ic", F.pmod(F.xxhash64("c_id"), F.col("_bc")).cast("int"))
          .withColumn("_iq", F.explode(F.sequence(F.lit(0), F.col("_bq") - 1))))
    keys = ["gk", "_iq", "_ic"]

    def per_block(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"gk": [], "q_id": [], "c_id": [], "score": []})
        q_ids, c_ids = a["q_id"].to_numpy(), b["c_id"].to_numpy()
        r, c, s = _best(_matrix(a["q_vec"]), q_ids, _matrix(b["c_vec"]), c_ids, k, exclude_self)
        return pd.DataFrame({"gk": a["gk"].iloc[0], "q_id": q_ids[r], "c_id": c_ids[c], "score": s})

    from vitrina.session import ship_package
    ship_package(queries.sparkSession)
    blocks = (qb.select(*keys, "q_id", "q_vec").groupBy(*keys)
              .cogroup(cb.select(*keys, "c_id", "c_vec").groupBy(*keys))
              .applyInPandas(per_block, schema="gk string, q_id string, c_id string, score double"))
    return _ranked(_with_group(blocks, qd), k, group, min_score)


# ---------------------------------------------------------------------------
# V3 embedding
# ---------------------------------------------------------------------------
def hashing_embedder(dim: int = 256) -> Callable[[list[str]], list[list[float]]]:
    """Offline default embedder: signed feature hashing of lower-case word
    tokens into ``dim`` buckets, L2-normalised.  A token's hash is the first 15
    hex digits of its md5, so any engine can repeat it; the top bit is the sign.
    Hashes of tokens are kept from batch to batch, up to a fixed number of them.
    Self-contained (no module globals), so it pickles by value to workers."""
    spot: dict[str, int] = {}

    def embed(texts: list[str]) -> list[list[float]]:
        import hashlib as _hl
        import re as _re

        import numpy as _np

        token = _re.compile(r"\w+", _re.UNICODE)
        rows = [token.findall((t or "").lower()) for t in texts]
        if len(spot) > 1 << 19:
            spot.clear()
        for tok in {tok for row in rows for tok in row} - spot.keys():
            spot[tok] = int(_hl.md5(tok.encode("utf-8")).hexdigest()[:15], 16)
        out = _np.zeros((len(texts), dim))
        of = _np.repeat(_np.arange(len(rows)), [len(row) for row in rows])
        h = _np.fromiter((spot[tok] for row in rows for tok in row), _np.int64, len(of))
        _np.add.at(out, (of, h % dim), _np.where(h >> 59, 1.0, -1.0))
        norms = _np.linalg.norm(out, axis=1, keepdims=True)
        return (out / _np.where(norms > 0, norms, 1)).astype(_np.float32).tolist()
    embed.model_name = f"hashing-{dim}"  # type: ignore[attr-defined]
    embed.dim = dim  # type: ignore[attr-defined]
    return embed


def embed(df: DataFrame, embedder: Callable[[list[str]], list[list[float]]] | None = None,
          text_col: str = "text", id_col: str = "id", title_col: str | None = "title",
          batch: int = 50, retries: int = 3, backoff: float = 0.5) -> DataFrame:
    """Embed a text column in batches of ``batch`` on the executors (V3).

    ``mapInPandas`` hands Arrow batches to the embedder; a failing batch is
    retried with backoff, then item by item; an item that still fails gets a
    zero vector and ``ok = false`` (instead of a silent zero).  Output:
    ``(id, title, model, vector, ok)``.
    """
    emb = embedder or hashing_embedder()
    model = getattr(emb, "model_name", getattr(emb, "__name__", "embedder"))
    dim = getattr(emb, "dim", None)
    cols = [F.col(id_col).cast("string").alias("id"),
            (F.col(title_col) if title_col else F.lit("")).cast("string").alias("title"),
            F.col(text_col).cast("string").alias("text")]

    def call(texts: list[str]) -> list[list[float]]:
        last = None
        for attempt in range(retries):
            try:
                return emb(texts)
            except Exception as e:  # noqa: BLE001 - any embedder failure is retried
                last = e
                time.sleep(backoff * (2 ** attempt))
        raise last  # type: ignore[misc]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for start in range(0, len(pdf), batch):
                part = pdf.iloc[start:start + batch]
                texts = part["text"].fillna("").tolist()
                oks = [True] * len(texts)
                try:
                    vecs = call(texts)
                except Exception:  # noqa: BLE001 - fall back to one by one
                    vecs = []
                    for i, t in enumerate(texts):
                        try:
                            vecs.append(call([t])[0])
                        except Exception:  # noqa: BLE001
                            vecs.append(None)
                            oks[i] = False
                # a short reply leaves the last texts without a vector
                oks = [ok and i < len(vecs) and vecs[i] is not None for i, ok in enumerate(oks)]
                vecs = [*vecs, *[None] * (len(texts) - len(vecs))][: len(texts)]
                width = dim or next((len(v) for v in vecs if v is not None), 0)
                vecs = [v if v is not None else [0.0] * width for v in vecs]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "title": part["title"].to_numpy(),
                                    "model": model, "vector": vecs, "ok": oks})

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
                           T.StructField("model", T.StringType()),
                           T.StructField("vector", T.ArrayType(T.FloatType())),
                           T.StructField("ok", T.BooleanType())])
    from vitrina.session import ship_package
    ship_package(df.sparkSession)
    return df.select(*cols).mapInPandas(run, schema)
