"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm import decontam, frames, jaccard, lines, mixing, pii, quality, quotes, runs, site_tree, suffix_tree, urls, warc
from vitrina.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql.strip()
        return fn
    return add


@query()
def op1_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document with a suffix tree learned from those that are not held out."""
    return suffix_tree.score_documents(read(spark, sf_dir, "documents"))


@query(mixing.MIX_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: source weights 1, 2, 3, repeating, share the whole budget, three passes at most."""
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


@query(r"""
WITH c AS (
  SELECT page_id, url, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
t AS (
  SELECT payload_digest AS d, max(page_id) AS target FROM c WHERE payload_bytes >= 1000 GROUP BY payload_digest),
r AS (
  SELECT c.*, CASE WHEN t.target <> c.page_id THEN t.target END AS refers_to,
         regexp_replace(coalesce(url, ''), '^.*?://', '', 's') AS rest
  FROM c LEFT JOIN t ON c.payload_digest = t.d AND c.payload_bytes >= 1000)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
       array_to_string(list_reverse(string_split(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.')), ',')
         || ')' || regexp_replace(rest, '^[^/?#]*', '') AS url_key
FROM r
""")
def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, a minute apart, and read the merged index back."""
    pages = read(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", F.timestamp_seconds(F.lit(1_700_000_000) + 60 * F.col("page_id")).alias("captured"), F.col("html").alias("payload"))
    return warc.archive_round_trip(captures).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key")


@query()
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents that repeats an earlier one, exactly or within one word."""
    return lines.repeated_lines(read(spark, sf_dir, "documents"))


@query()
def op5_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rebuilt from mail whose replies quote what they answer."""
    return quotes.conversations_from_quotes(quotes.quoting_messages(read(spark, sf_dir, "conversations")))


@query()
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the strict spans, all spans, and how many the method adds."""
    found = pii.find_pii(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *[pii.count_kind(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS], F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"),
                        pii.count_kind(F.col("spans"), "secret").alias("n_secret"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


@query()
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality statistics and verdict of every document."""
    return quality.quality_rules(read(spark, sf_dir, "documents"))


@query()
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; the model learns from the URLs that rules decide."""
    pages = read(spark, sf_dir, "pages")
    return urls.filter_urls(pages, urls.labelled_by_rules(pages)).withColumn("score", F.round("score", 6))


@query()
def op9_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingle sets are 90 % alike."""
    return jaccard.jaccard_groups(read(spark, sf_dir, "documents"), k=3, num=90, den=100)


@query()
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) whose texts overlap."""
    return decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query(r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
c AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS c2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT doc_id, t, n, form,
         array_to_string(units[1:least(c1, c2)], '') AS pre, array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
         array_to_string(units[greatest(c1, c2) + 1:n], '') AS suf
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
""")
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as seekable frames, cut into prefix, middle and suffix, and restored from its output."""
    return frames.fill_in_middle(frames.stored_frames(read(spark, sf_dir, "documents")), keep_output=False)


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs of every document, a tenth of which are made to end periodically, and digests of the collapsed texts."""
    return runs.run_digests(runs.periodic_runs(runs.with_planted_runs(read(spark, sf_dir, "documents"))))


@query()
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by the style tree of its site."""
    return site_tree.extract_main_text(read(spark, sf_dir, "pages"))
