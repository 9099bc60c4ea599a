"""Quality rules with robust multivariate outliers.

Two fixed rules reject short and repetitive texts.  Of the rest, each document
is a vector of transformed statistics, and each (language, source) group gets a
minimum-covariance-determinant estimate: from deterministic starts, concentration
steps keep the ``support`` share of the group with the smallest Mahalanobis
distance and take mean and covariance of those, until the steps are used up; the
start with the smallest determinant wins.  A document whose squared distance to
its group's estimate passes ``cut`` is rejected.

Everything is DataFrame code.  A step is two aggregations over slim rows (a
histogram of distances, then moments), both partial in each task, so a group
that holds most rows costs no more than any other.  Distances come from a
Cholesky factor written out as columns.  Statistics are kept as integers and
moments summed as decimals, so results do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.llm.common import SPACE_CHARS, checkpointed, null_safe_join, word_array, wrapped

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: The transformed statistics, and the least standard deviation that a group may claim for each (so that groups
#: in which nearly all documents agree do not reject on a trifle).
FEATURES = ("word_length", "symbols", "dup_lines", "repeats")
FLOORS = (0.10, 0.15, 0.16, 0.16)
UNIT = 10_000  # statistics are integers in ten-thousandths
#: Rejected rows (two numbers each) that are broadcast at most; beyond, the same join is a shuffle.
MAX_BROADCAST_ROWS = 1_000_000
#: A group needs this many documents for an estimate of its own; below, the language's is used, then that of all.
MIN_GROUP = 100
SUPPORT = 0.75
STEPS = 4
#: Upper 1e-6 point of the chi-square distribution with four degrees of freedom.
CUT = 33.38


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` (long); null text has zeros.

    Columns of ``docs`` by these names are replaced.  Arrays that a lambda looks
    into are columns of their own, so that they are built once a row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    words, windows, order = F.col("__words"), F.col("__windows"), F.col("__order")
    no_longs = F.array().cast("array<bigint>")
    # the 3-word windows of the text as hashes; then (hash, position) in order, for texts in which some window repeats
    made = F.when(F.size(words) >= 4, F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(no_longs)
    ordered = F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    # a window repeats if a neighbour in that order has its hash
    again = F.filter(order, lambda x, j: F.coalesce(F.get(order, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(order, j + 1)["h"] == x["h"], F.lit(False)))
    # by position, each repeated window adds its words up to those already counted
    covered = F.aggregate(F.array_sort(F.transform(again, lambda x: x["i"])), F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                          lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")), lambda acc: acc["n"])
    return (docs.withColumn("__words", word_array(F.col(text_col))).withColumn("__lines", lines)
            .withColumn("__windows", made).withColumn("__order", ordered)
            .withColumn("n_words", F.size(words).cast("long"))
            .withColumn("word_chars", F.length(F.translate(text, SPACE_CHARS, "")).cast("long"))
            .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
            .withColumn("n_lines", F.size("__lines").cast("long"))
            .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("__words", "__lines", "__windows", "__order"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def feature_columns() -> list[Column]:
    """The statistics of a row as integers."""
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    raw = (F.log(1 + per_word("word_chars")), F.log1p(10 * per_word("n_symbols")),
           F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))), F.sqrt(per_word("n_repeat_words")))
    return [F.round(x * UNIT).cast("long").alias(n) for x, n in zip(raw, FEATURES, strict=True)]


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and covariance of the statistics by key, from exact sums; variances get the floors added."""
    exact = lambda c: F.sum(c.cast("decimal(20,0)")).cast("double")
    k = len(FEATURES)
    sums = [exact(F.col(a)).alias(f"s{i}") for i, a in enumerate(FEATURES)]
    prods = [exact(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}{j}") for i in range(k) for j in range(i + 1)]
    got = rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums, *prods)
    mean = [(F.col(f"s{i}") / F.col("n") / UNIT).alias(f"m{i}") for i in range(k)]
    cov = [(F.col(f"p{i}{j}") / F.col("n") / UNIT**2 - F.col(f"s{i}") * F.col(f"s{j}") / F.col("n") / F.col("n") / UNIT**2
            + F.lit(FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i in range(k) for j in range(i + 1)]
    return _factor(got.select(*keys, "n", *mean, *cov))


def _factor(est: DataFrame) -> DataFrame:
    """Adds the Cholesky factor ``l..`` of the covariance ``c..`` and the log determinant."""
    k = len(FEATURES)
    for i in range(k):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for r in range(j):
                rest = rest - F.col(f"l{i}{r}") * F.col(f"l{j}{r}")
            est = est.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 4))) if i == j else rest / F.col(f"l{j}{j}"))
    det = F.lit(0.0)
    for i in range(k):
        det = det + 2 * F.log(F.col(f"l{i}{i}"))
    return est.withColumn("log_det", det)


def _distance(e: Column) -> Column:
    """Squared Mahalanobis distance of a row's statistics to the estimate in the struct ``e``."""
    total, y = F.lit(0.0), []
    for i, name in enumerate(FEATURES):
        v = F.col(name) / UNIT - e[f"m{i}"]
        for j in range(i):
            v = v - e[f"l{i}{j}"] * y[j]
        y.append(v / e[f"l{i}{i}"])
        total = total + y[-1] * y[-1]
    return total


def _params() -> list[str]:
    k = len(FEATURES)
    return [f"m{i}" for i in range(k)] + [f"l{i}{j}" for i in range(k) for j in range(i + 1)] + ["log_det"]


def mcd_estimates(stats: DataFrame, support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """One estimate for each group of ``stats`` (columns ``level, lang, source`` and the statistics).

    Starts: the coordinate-wise median with the floors as scale, and the plain
    mean and covariance.  Medians and the support come from exact counts.
    """
    group = ["level", "lang", "source"]
    n = stats.groupBy(*group).agg(F.count("*").alias("group_n"))
    # medians from histograms of statistics in hundredths
    one = stats.select(*group, F.posexplode(F.array(*[F.floor(F.col(f) / (UNIT // 100)) for f in FEATURES])).alias("f", "b"))
    hist = one.groupBy(*group, "f", "b").agg(F.count("*").alias("c"))
    w = Window.partitionBy(*group, "f")
    med = (hist.withColumn("upto", F.sum("c").over(w.orderBy("b"))).withColumn("all", F.sum("c").over(w))
           .where("2 * upto >= all").groupBy(*group, "f").agg((F.min("b") / 100 + 0.005).alias("m"))
           .groupBy(*group).pivot("f", list(range(len(FEATURES)))).agg(F.first("m")))
    k = len(FEATURES)
    robust = _factor(med.select(*group, *[F.col(str(i)).alias(f"m{i}") for i in range(k)],
                                *[F.lit(4 * FLOORS[i] ** 2 if i == j else 0.0).alias(f"c{i}{j}") for i in range(k) for j in range(i + 1)]))
    plain = _moments(stats, group)
    keys = ["start", *group]
    est = checkpointed(robust.select(F.lit(0).alias("start"), *group, *_params()).unionByName(plain.select(F.lit(1).alias("start"), *group, *_params())))
    twice = stats.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("start"), "*")
    for _ in range(steps):
        far = null_safe_join(twice, est.select(*keys, F.struct(*_params()).alias("e")), keys).select(*keys, *FEATURES, F.floor(F.log2(1e-9 + _distance(F.col("e"))) * 64).alias("bin"))
        bins = far.groupBy(*keys, "bin").agg(F.count("*").alias("c"))
        w = Window.partitionBy(*keys)
        last = (bins.withColumn("upto", F.sum("c").over(w.orderBy("bin"))).withColumn("all", F.sum("c").over(w))
                .where(F.col("upto") >= support * F.col("all")).groupBy(*keys).agg(F.min("bin").alias("last_bin")))
        core = null_safe_join(far, last, keys).where("bin <= last_bin").select(*keys, *FEATURES)
        est = checkpointed(_moments(core, keys).select(*keys, *_params()))
    best = est.groupBy(*group).agg(F.min_by(F.struct(*_params()), F.struct("log_det", "start")).alias("b"))
    return null_safe_join(best.select(*group, "b.*"), n, group)


def judged(docs: DataFrame, stats: DataFrame, support: float = SUPPORT, steps: int = STEPS, min_group: int = MIN_GROUP, cut: float = CUT) -> DataFrame:
    """``docs`` (with text statistics, ``lang`` and ``source``) plus ``base_failed, distance2, kept``.

    ``stats`` are the rows from which groups are estimated.  A document takes
    the estimate of its (language, source), or of its language if that group has
    fewer than ``min_group`` passing documents, or else of all documents; with
    fewer than ``min_group`` passing documents overall nothing is rejected.
    """
    # the levels that a group takes part in; null stands for "any" beyond a level's own columns
    any_ = F.lit(None).cast("string")
    levels = F.array(F.struct(F.lit(0).alias("level"), F.col("lang"), F.col("source")),
                     F.struct(F.lit(1).alias("level"), F.col("lang"), any_.alias("source")),
                     F.struct(F.lit(2).alias("level"), any_.alias("lang"), any_.alias("source")))
    named = [F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")]
    stats = checkpointed(stats.select(*named, *FEATURES))
    rows = stats.select(F.explode(levels).alias("g"), *FEATURES).select("g.*", *FEATURES)
    est = (mcd_estimates(rows, support, steps).where(F.col("group_n") >= min_group)
           .select(F.col("level").alias("e_level"), F.col("lang").alias("e_lang"), F.col("source").alias("e_source"), F.struct(*_params()).alias("e")))
    groups = docs.select(*named).distinct().select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), F.explode(levels).alias("g"))
    chosen = (groups.join(est, (F.col("g.level") == F.col("e_level")) & F.col("g.lang").eqNullSafe(F.col("e_lang")) & F.col("g.source").eqNullSafe(F.col("e_source")))
              .groupBy("g_lang", "g_source").agg(F.min_by("e", "e_level").alias("e")))
    return (docs.join(checkpointed(chosen), F.col("lang").cast("string").eqNullSafe(F.col("g_lang")) & F.col("source").cast("string").eqNullSafe(F.col("g_source")), "left")
            .withColumn("distance2", _distance(F.col("e")))
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= cut, F.lit(True)))
            .drop("e", "g_lang", "g_source"))


def _measured(docs: DataFrame, *more: str) -> DataFrame:
    return (text_statistics(docs).withColumn("base_failed", base_failed())
            .select(*more, "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *feature_columns()))


def quality_rules(docs: DataFrame, **params) -> DataFrame:
    """One verdict per document of ``docs`` (``doc_id, text, lang, source``).

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, distance2``.  Null text has no words and
    fails the base rules; null language or source is a group of its own;
    repeated rows are judged alike; no rows give no rows; other columns are
    ignored.
    """
    measured = checkpointed(_measured(docs.select("doc_id", "text", "lang", "source"), "doc_id"))
    return judged(measured, measured.where(~F.col("base_failed")), **params).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2")


def keep_good(docs: DataFrame, **params) -> DataFrame:
    """``docs`` without the documents that the rules reject; all columns stay as they are.

    Statistics are taken once and kept as slim rows; the rejected (id, text
    hash) pairs are then taken out of ``docs`` by an anti join, broadcast if
    their number is within ``MAX_BROADCAST_ROWS``.  Rows that share id and text share the verdict,
    and go if one of them is rejected.
    """
    text_key = F.xxhash64(F.coalesce("text", F.lit("")))
    measured = checkpointed(_measured(docs.select("doc_id", "text", "lang", "source", text_key.alias("text_key")), "doc_id", "text_key"))
    bad = (judged(measured, measured.where(~F.col("base_failed")), **params).where("NOT kept")
           .select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct())
    bad = checkpointed(bad)
    few = bad.count() <= MAX_BROADCAST_ROWS
    rows = wrapped(docs, "doc_id", text_key.alias("text_key"))
    return rows.join(F.broadcast(bad) if few else bad, F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("text_key") == F.col("bad_key")), "left_anti").select("row.*")
