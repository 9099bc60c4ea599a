"""Lookups written as equi-joins (J4, J6, J11/J12 live in ``streaming.incremental``).

J4 (url equal OR slug equal, first listing entry wins) and J6 (exact id,
then prefix-stripped slug, then substring either way) are the two shapes a
planner would turn into a nested loop.  Here each is a union of equi-joins:

* J4: the listing is first reduced to its first entry per url and per slug
  (``min_by`` aggregates, partial and skew-safe), so each join is N:1 and a
  slug shared by many entries cannot multiply rows; the best of the two
  candidates per sitemap url is another ``min_by``.
* J6: the exact tiers are left joins; "a contains b" reads each a once through an
  automaton of all b, whose number is checked, and beyond that is an equi-join on one short
  substring of b, the one that fewest candidates have, verified on the whole keys: the
  containing side has at most three rows per character.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.session import checkpoint_dir

_FULL_SLUG = lambda c: F.element_at(F.split(F.regexp_replace(c, r"/+$", ""), "/"), -1)


def match_listing(sitemap: DataFrame, listing: DataFrame, url: str = "url", ordinal: str = "ordinal",
                  listing_url: str = "url", fields: list[str] | None = None) -> DataFrame:
    """Attach to each sitemap row the first listing entry whose url is equal or
    whose last path segment equals the sitemap url's (J4)."""
    fields = fields or [c for c in listing.columns if c not in (listing_url, ordinal)]
    entry = F.struct(F.col(ordinal).alias("_ord"), *[F.col(f) for f in fields],
                     F.col(listing_url).alias("listing_url"))
    by_url = listing.groupBy(F.col(listing_url).alias("_k")).agg(F.min(entry).alias("_e"))
    by_slug = listing.groupBy(_FULL_SLUG(F.col(listing_url)).alias("_k")).agg(F.min(entry).alias("_e"))
    s = sitemap.withColumn("_slug", _FULL_SLUG(F.col(url)))
    c1 = s.join(by_url, s[url] == by_url["_k"], "inner").select(url, "_e")
    c2 = s.join(by_slug, s["_slug"] == by_slug["_k"], "inner").select(url, "_e")
    best = c1.unionByName(c2).groupBy(url).agg(F.min("_e").alias("_e"))
    out = s.drop("_slug").join(best, url, "left")
    return out.select(*[c for c in sitemap.columns],
                      F.col("_e")["_ord"].alias(f"match_{ordinal}"),
                      *[F.col("_e")[f].alias(f"match_{f}") for f in fields],
                      F.col("_e")["listing_url"].alias("match_url"))


GRAM = 3  # characters of a substring key


def grams(df: DataFrame, col: str, out: str = "gram") -> DataFrame:
    """The distinct substrings of ``col`` of 1 to ``GRAM`` characters as rows: at most ``GRAM`` times its length."""
    text = F.col(col)
    of_len = lambda n: F.when(F.length(text) >= n, F.transform(
        F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return df.withColumn(out, F.explode(F.array_distinct(F.concat(*[of_len(n) for n in range(1, GRAM + 1)]))))


#: Needles that are broadcast as one automaton at most; beyond, they meet their hays by grams.
MAX_NEEDLES = 200_000


def containing(needles: DataFrame, hays: DataFrame, max_needles: int = MAX_NEEDLES) -> DataFrame:
    """Pairs ``(source, needle, hay)`` where a ``hay`` of the same source contains the ``needle``.

    Up to ``max_needles`` needles are one Aho-Corasick automaton in every task, and each hay is
    read through it once, where it lies.  More needles are looked up under one of their grams of
    ``GRAM`` characters (or the whole needle, if shorter), the one that fewest hays have, and verified.
    """
    known = needles.select("source", "needle").limit(max_needles + 1).collect()  # bounded
    if len(known) <= max_needles and _automaton() is not None:
        return _by_automaton([(r["source"], r["needle"]) for r in known], hays)
    return _by_grams(needles, hays)


def _automaton():
    try:
        import ahocorasick
    except ImportError:
        return None
    return ahocorasick.Automaton


def _by_automaton(needles: list[tuple[str, str]], hays: DataFrame) -> DataFrame:
    from vitrina.session import ship_package
    ship_package(hays.sparkSession)
    shared = hays.sparkSession.sparkContext.broadcast(needles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources: dict[str, set] = {}
        for source, needle in shared.value:
            if needle:
                sources.setdefault(needle, set()).add(source)
        machine = _automaton()()
        for needle in sources:
            machine.add_word(needle, needle)
        machine.make_automaton()
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for source, hay in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                for needle in {n for _, n in machine.iter(hay)} if sources and hay else ():
                    if source in sources[needle]:
                        out[0].append(source), out[1].append(needle), out[2].append(hay)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], ["source", "needle", "hay"])

    return hays.select("source", "hay").mapInArrow(run, "source string, needle string, hay string")


def _by_grams(needles: DataFrame, hays: DataFrame) -> DataFrame:
    posted = grams(hays, "hay").select("source", "hay", "gram")
    often = posted.groupBy("source", "gram").agg(F.count(F.lit(1)).alias("n"))
    own = grams(needles, "needle").filter(F.length("gram") == F.least(F.length("needle"), F.lit(GRAM)))
    rare = (own.join(often, ["source", "gram"], "left")
            .groupBy("source", "needle").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), F.col("gram"))).alias("gram")))
    return rare.join(posted, ["source", "gram"]).filter(F.contains("hay", "needle")).select("source", "needle", "hay")


def find_bundle(ids: DataFrame, bundles: DataFrame, id_col: str = "id", source: Column | None = None,
                stem_col: str = "stem", max_needles: int = MAX_NEEDLES) -> DataFrame:
    """Resolve item ids to bundle stems of their source.

    ``bundles`` has the stems and, in ``source``, the folder of each; an id
    looks only in the folder of its own source and finds nothing without one, so
    one id under two sources is resolved twice.
    Bundles without a ``source`` column are one folder for all ids.  Tier 1:
    stem equals the id; tier 2: stem equals the id without its ``source-``
    prefix; tier 3 (only for ids unresolved so far): the slug contains the
    stem or the stem contains the slug.  Within a tier the least stem wins.
    Output: the ids columns plus ``stem`` and ``how``.

    Stems are made distinct once and stored, so the tiers read them as they
    are; what tier 3 finds is reduced to the least stem of a slug before it is joined.
    """
    src = source if source is not None else F.lit(None).cast("string")
    foldered = "source" in bundles.columns
    checkpoint_dir(ids.sparkSession)
    rows = ids.select(F.struct(*[F.col(f"`{c}`") for c in ids.columns]).alias("_row"), F.col(id_col).alias("_id"), src.alias("_src"))
    look = rows.withColumn("_slug", F.when(F.col("_id").startswith(F.concat(F.col("_src"), F.lit("-"))), F.expr("substring(_id, length(_src) + 2)"))
                           .otherwise(F.col("_id"))).withColumn("_folder", F.col("_src") if foldered else F.lit(""))
    stems = bundles.select((F.col("source") if foldered else F.lit("")).alias("source"), F.col(stem_col).cast("string").alias("stem")).distinct().checkpoint()
    for tier, on in ((1, "_id"), (2, "_slug")):
        named = stems.select(F.col("source").alias(f"_f{tier}"), F.col("stem").alias(f"_s{tier}"))
        look = look.join(named, (F.col("_folder") == F.col(f"_f{tier}")) & (F.col(on) == F.col(f"_s{tier}")), "left").drop(f"_f{tier}")
    look = look.checkpoint()
    left = look.filter("_s1 IS NULL AND _s2 IS NULL AND _slug <> '' AND _folder IS NOT NULL").select(F.col("_folder").alias("source"), F.col("_slug").alias("slug")).distinct()
    stored = stems.filter("stem <> '' AND source IS NOT NULL")
    inside = containing(stored.withColumnRenamed("stem", "needle"), left.withColumnRenamed("slug", "hay"), max_needles)
    around = containing(left.withColumnRenamed("slug", "needle"), stored.withColumnRenamed("stem", "hay"), max_needles)
    found = inside.select("source", F.col("hay").alias("slug"), F.col("needle").alias("stem")).unionByName(around.select("source", F.col("needle").alias("slug"), F.col("hay").alias("stem")))
    part = found.groupBy(F.col("source").alias("_f3"), F.col("slug").alias("_g3")).agg(F.min("stem").alias("_s3"))
    out = look.join(part, (F.col("_folder") == F.col("_f3")) & (F.col("_slug") == F.col("_g3")), "left")
    how = F.when(F.col("_s1").isNotNull(), "exact").when(F.col("_s2").isNotNull(), "slug").when(F.col("_s3").isNotNull(), "partial")
    # an id that is resolved by itself takes no partial stem, though its slug may belong to others too
    return out.select("_row.*", F.coalesce("_s1", "_s2", "_s3").alias("stem"), how.alias("how"))
