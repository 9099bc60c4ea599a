"""J4 and J6 against brute force on small fixtures."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrina.operators import lookup as L


def slug(u):
    return u.rstrip("/").split("/")[-1]


def test_match_listing_first_wins(spark):
    sitemap = spark.createDataFrame([("https://p.example/docs/a/",), ("https://p.example/docs/b",),
                                     ("https://p.example/docs/none",)], "url string")
    listing_rows = [("https://mirror.example/a", 5, "A-mirror"), ("https://p.example/docs/a/", 7, "A-exact"),
                    ("https://x.example/b/", 2, "B-slug"), ("https://y.example/b", 1, "B-slug-first")]
    listing = spark.createDataFrame(listing_rows, "url string, ordinal int, title string")
    got = {r["url"]: (r["match_ordinal"], r["match_title"]) for r in
           L.match_listing(sitemap, listing, fields=["title"]).collect()}
    for s in [r[0] for r in sitemap.collect()]:
        cands = [(o, t) for u, o, t in listing_rows if u == s or slug(u) == slug(s)]
        exp = min(cands) if cands else (None, None)
        assert got[s] == exp


def test_find_bundle_tiers(spark):
    stems = ["ipc", "ipc-general", "empleo", "a-very-long-stem-name"]
    ids = [("funcas-ipc",), ("ipc",), ("ipc-general-2024",), ("long-stem",), ("nothing",), ("bbva-empleo",)]
    b = spark.createDataFrame([(s,) for s in stems], "stem string")
    i = spark.createDataFrame(ids, "id string")
    from vitrina.functions.text import source_of_id
    got = {r["id"]: (r["stem"], r["how"]) for r in
           L.find_bundle(i, b, "id", source=source_of_id("id", ["funcas", "bbva", "ine"])).collect()}

    def brute(item):
        src = next((s for s in ("funcas", "bbva", "ine") if item.startswith(s)), None)
        sl = item[len(src) + 1:] if src and item.startswith(src + "-") else item
        if item in stems:
            return item, "exact"
        if sl in stems:
            return sl, "slug"
        part = sorted(s for s in stems if sl in s or s in sl)
        return (part[0], "partial") if part else (None, None)

    for (item,) in ids:
        assert got[item] == brute(item), item


def test_bundle_of_the_ids_own_source(spark):
    ids = spark.createDataFrame([("funcas-ipc",), ("ine-ipc",), ("ine-ipc-2024",), ("bbva-ip",), ("ipc",), ("ine-",)], "id string")
    bundles = spark.createDataFrame([("ine", "ipc"), ("funcas", "epa"), ("bbva", "la-ipc"), (None, "ipc")], "source string, stem string")
    src = F.nullif(F.regexp_extract("id", "^(funcas|bbva|ine)-", 1), F.lit(""))
    got = {r["id"]: (r["stem"], r["how"]) for r in L.find_bundle(ids, bundles, "id", source=src).collect()}
    assert got == {"funcas-ipc": (None, None), "ine-ipc": ("ipc", "slug"), "ine-ipc-2024": ("ipc", "partial"),
                   "bbva-ip": ("la-ipc", "partial"), "ipc": (None, None), "ine-": (None, None)}


def test_one_id_in_two_sources(spark):
    ids = spark.createDataFrame([("ipc", "a"), ("ipc", "b"), ("ipc", None), ("x", "b"), (None, "a"), ("ipc", "a")], "id string, src string")
    bundles = spark.createDataFrame([("a", "ipc"), ("b", "ipc-b"), ("b", "zz")], "source string, stem string")
    for most in (L.MAX_NEEDLES, 0):
        got = [tuple(r) for r in L.find_bundle(ids, bundles, "id", source=F.col("src"), max_needles=most).collect()]
        assert sorted(got, key=str) == sorted([("ipc", "a", "ipc", "exact")] * 2 + [
            ("ipc", "b", "ipc-b", "partial"), ("ipc", None, None, None), ("x", "b", None, None), (None, "a", None, None)], key=str)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text("ab-", min_size=1, max_size=7), min_size=1, max_size=12), st.lists(st.text("ab-", min_size=1, max_size=7), min_size=1, max_size=12))
def test_containing_equals_all_pairs(spark, needles, hays):
    df = lambda xs, c: spark.createDataFrame([("s", x) for x in set(xs)], f"source string, {c} string")
    for most in (L.MAX_NEEDLES, 0):
        got = {(r["needle"], r["hay"]) for r in L.containing(df(needles, "needle"), df(hays, "hay"), most).collect()}
        assert got == {(n, h) for n in needles for h in hays if n in h}
