"""URL filters: host and path rules, and logistic regression on hashed character n-grams.

A rule names a host suffix and a path prefix; the longest rule that fits a URL
decides it.  URLs without a rule go to a logistic regression over hashed
character n-grams of host and path, trained from a small labelled URL table of
at most ``max_train`` rows.  Features, training (Spark ML) and scoring run in the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import checkpointed, lower_ascii

#: Fixed rules of the contract: (verdict, host, path prefix).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MAX_TRAIN = 4096
NGRAMS = (2, 3, 4)
BUCKETS = 1 << 14


def with_host_path(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both empty for null or a URL without ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return (df.withColumn("host", lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)))
            .withColumn("path", F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    name = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _pieces(mark: str, c: Column, n: int) -> Column:
    """All n-grams of a string, each after the mark of its part."""
    at = F.sequence(F.lit(1), F.length(c) - (n - 1))
    return F.when(F.length(c) >= n, F.transform(at, lambda i: F.concat(F.lit(mark), F.substring(c, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def _grams(df: DataFrame) -> DataFrame:
    """Adds ``grams``: the character n-grams of the whole host and the whole path."""
    ends = [(mark, F.concat(F.lit("^"), F.col(part), F.lit("$"))) for mark, part in (("h", "host"), ("p", "path"))]
    return df.withColumn("grams", F.concat(*[_pieces(mark, c, n) for mark, c in ends for n in NGRAMS]))


def fit_url_model(labelled: DataFrame, max_train: int = MAX_TRAIN):
    """Logistic regression from ``(url, label)`` with label 1.0 for allow, or None if only one label (or none) occurs.

    At most ``max_train`` distinct (host, path, label) rows are used, by the
    order of their md5; they are fitted in one partition, so reruns agree.
    """
    rows = (with_host_path(labelled).select("host", "path", F.col("label").cast("double").alias("label")).where("label IS NOT NULL").distinct()
            .orderBy(F.md5(F.concat_ws("\n", "host", "path")), "host", "path", "label").limit(max_train).coalesce(1))
    train = HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True).transform(_grams(rows))
    if train.select("label").distinct().count() < 2:
        return None
    return LogisticRegression(maxIter=60, regParam=0.01, standardization=False).fit(train)


def filter_urls(pages: DataFrame, labelled: DataFrame, rules=RULES, max_train: int = MAX_TRAIN) -> DataFrame:
    """Verdict for every row of ``pages`` (``page_id, url``).

    Returns ``page_id, host, path, rule, verdict, score``: ``score`` is the
    model's probability of allow (null without a model; then URLs without a rule
    get the only label there is, or allow without any).  Null URLs have empty
    host and path and are judged on those.  Repeated rows and other columns do
    no harm; no rows give no rows.
    """
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = with_host_path(pages.select("page_id", "url")).withColumn("rule", name).withColumn("by_rule", verdict)
    model = fit_url_model(labelled, max_train)
    if model is None:
        only = labelled.where("label IS NOT NULL").agg(F.max("label")).first()[0]
        scored = rows.withColumn("score", F.lit(None).cast("double")).withColumn("by_model", F.lit("block" if only == 0 else "allow"))
    else:
        tf = HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True)
        model.setProbabilityCol("probability").setPredictionCol("prediction")
        scored = model.transform(tf.transform(_grams(rows))).withColumn("by_model", F.when(F.col("prediction") == 1.0, "allow").otherwise("block"))
        scored = scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_model").alias("verdict"), "score")


def labelled_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """A labelled URL table from the URLs that a rule decides."""
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return (with_host_path(pages.select("url")).withColumn("verdict", verdict).where("verdict IS NOT NULL")
            .select("url", (F.col("verdict") == "allow").cast("double").alias("label")))


def held_out_accuracy(labelled: DataFrame, share: int = 5, max_train: int = MAX_TRAIN) -> DataFrame:
    """One row on the model over labelled URLs that it has not seen: ``n, accuracy, majority`` (the share of the commoner label).

    One in ``share`` distinct (host, path) is held out, by the crc32 of both; the model learns from the others.
    Rows without a label are left out; without held-out rows or a model both shares are null.
    """
    rows = with_host_path(labelled.where("label IS NOT NULL")).withColumn("out", F.crc32(F.concat_ws("\n", "host", "path").cast("binary")) % share == 0)
    pages = rows.where("out").select(F.monotonically_increasing_id().alias("page_id"), "url", F.col("label").cast("double").alias("label"))
    pages = checkpointed(pages)
    seen = rows.where("NOT out").select("url", "label")
    judged = filter_urls(pages, seen, (), max_train).where("score IS NOT NULL").select("page_id", (F.col("verdict") == "allow").alias("allow"))
    right = judged.join(pages.select("page_id", "label"), "page_id").withColumn("ok", F.col("allow") == (F.col("label") == 1.0))
    ones = F.avg("label")
    return right.agg(F.count("*").alias("n"), F.avg(F.col("ok").cast("double")).alias("accuracy"), F.greatest(ones, 1 - ones).alias("majority"))
