"""Mixing, quality rules, URL filter, decontamination and quotation linking against plain versions."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrina.llm import decontam, mixing, quality, quotes, urls
from vitrina.llm.common import null_safe_join

WORD = r"[^\x20\x09-\x0D]+"


def n_words(t):
    return len(re.findall(WORD, t or ""))


# --- mixing ---

def filled(sizes, weights, budget, cap):
    """Water-filling by rounds."""
    target, capped = {}, set()
    while True:
        left = budget - sum(cap * sizes[s] for s in capped)
        w = sum(weights[s] for s in sizes if s not in capped)
        target = {s: cap * sizes[s] if s in capped else left * weights[s] / w for s in sizes}
        over = {s for s in sizes if s not in capped and target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


def test_water_filling(spark):
    rng = random.Random(3)
    for _ in range(3):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 500, 20_000]) * rng.randint(1, 9) for i in range(12)} | {None: 77}
        order = sorted(s for s in sizes if s) + [None]
        weights = {s: i % 3 + 1 for i, s in enumerate(order)}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.water_fill(df, mixing.cycled_weights(df)).collect()}
        want = filled(sizes, weights, sum(sizes.values()), 3)
        assert got == {s: pytest.approx(t) for s, t in want.items()}


def test_mix_matches_sql_and_targets(spark, docs, corpus):
    got = sorted(tuple(r) for r in mixing.mix_sources(docs).collect())
    c = duckdb.connect()
    c.register("documents", docs.toPandas())
    want = sorted(c.execute(mixing.MIX_SQL).fetchall())
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
    assert got == sorted(tuple(r) for r in mixing.mix_sources(docs.repartition(2)).collect())
    source = {r[0]: r[3] for r in corpus}
    taken, target, longest = Counter(), {}, Counter()
    for i, size, _, t, k in got:
        assert k <= 3 * size
        taken[source[i]] += k
        target[source[i]] = t
        longest[source[i]] = max(longest[source[i]], size * sum(x[0] == i for x in got))
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in target)


def test_mixed_documents_replace_a_column_of_that_name(docs):
    had = docs.withColumn("Mix_Repeats", F.lit("x")).withColumn("a.b", F.lit(1))
    out = mixing.mixed_documents(had)
    assert out.columns == [*docs.columns, "a.b", "mix_repeats"]
    assert sorted((r["doc_id"], r["mix_repeats"]) for r in out.collect()) == sorted((r["doc_id"], r["mix_repeats"]) for r in mixing.mixed_documents(docs).collect())


def test_mix_odd_tables(clashing, no_docs, corpus):
    assert mixing.mix_sources(clashing).count() == len(corpus)
    assert mixing.mix_sources(no_docs).count() == 0
    out = mixing.mixed_documents(clashing)
    assert out.columns == [*clashing.columns, "mix_repeats"] and out.where("mix_repeats < 1 OR mix_repeats > 3").count() == 0


# --- quality ---

def statistics(t):
    w = re.findall(WORD, t or "")
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(WORD, x)]
    return (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), len(lines) - len(set(lines)), len(covered))


def test_statistics(spark, docs, corpus):
    rng = random.Random(6)
    more = [(1000 + i, " ".join(rng.choice("ab c#$") for _ in range(rng.randint(0, 40))) + "\n a a\na a\n a a", "en", "s", 0) for i in range(60)]
    df = docs.unionByName(spark.createDataFrame(more, docs.schema))
    text = {r[0]: r[1] for r in [*corpus, *more]}
    rows = quality.quality_rules(df).collect()
    assert len(rows) == len(corpus) + 60
    for r in rows:
        s = statistics(text[r["doc_id"]])
        assert tuple(r)[1:6] == s
        assert r["base_failed"] == (s[0] < 50 or 100 * s[4] > 50 * s[0])
        assert not (r["kept"] and r["base_failed"])


def test_outliers_go_and_the_rest_stays(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        w = [rng.choice("abcdefgh") * rng.randint(2, 7) + str(rng.randrange(99)) for _ in range(rng.randint(60, 200))]
        if i % 5 == 0:  # a fifth of the group: more than the mean and covariance bear
            w = [x + "#$" for x in w]
        rows.append((i, " ".join(w), "en", "a" if i % 2 else "b", 0))
    rows += [(1000 + i, " ".join("zz" + str(rng.randrange(10**6)) for _ in range(80)), "xx", "tiny", 0) for i in range(3)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert all(got[i] == (i % 5 != 0) for i in range(400))
    assert got == {r["doc_id"]: r["kept"] for r in quality.quality_rules(spark.createDataFrame(rows[::-1], "doc_id long, text string, lang string, source string, n_chars long")).collect()}


def plain_mcd(x):
    """Squared distances to the estimate of one group, with numpy: two starts, concentration steps on the nearest rows."""
    floors, k = np.array(quality.FLOORS), len(quality.FEATURES)
    data = x / quality.UNIT

    def factor(c):
        low = np.zeros((k, k))
        for i in range(k):
            for j in range(i + 1):
                rest = c[i, j] - low[i, :j] @ low[j, :j]
                low[i, j] = math.sqrt(max(rest, floors[i] ** 2 / 4)) if i == j else rest / low[j, j]
        return low

    def moments(rows):
        return rows.mean(axis=0), factor(np.cov(rows.T, bias=True) + np.diag(floors**2))

    def distance(mean, low):
        return (np.linalg.solve(low, (data - mean).T) ** 2).sum(axis=0)

    cells = np.sort(x // (quality.UNIT // 100), axis=0)
    median = cells[(len(x) + 1) // 2 - 1] / 100 + 0.005
    found = []
    for start, (mean, low) in enumerate([(median, factor(np.diag(4 * floors**2))), moments(data)]):
        for _ in range(quality.STEPS):
            bins = np.floor(np.log2(1e-9 + distance(mean, low)) * 64)
            last = min(b for b in np.unique(bins) if (bins <= b).sum() >= quality.SUPPORT * len(x))
            mean, low = moments(data[bins <= last])
        found.append((2 * np.log(np.diag(low)).sum(), start, mean, low))
    _, _, mean, low = min(found, key=lambda f: f[:2])
    return lambda rows: (np.linalg.solve(low, (rows / quality.UNIT - mean).T) ** 2).sum(axis=0)


def test_verdicts_by_a_plain_estimate(spark):
    rng = np.random.default_rng(5)
    groups, rows = {("en", "a"): 260, ("en", "b"): 150, ("en", "few"): 30, ("de", "a"): 130, (None, None): 12}, []
    for (lang, source), n in groups.items():
        mix = rng.normal(size=(4, 4))
        x = np.abs(rng.normal(size=(n, 4)) @ mix * 800 + rng.uniform(3000, 16000, 4))
        x[: n // 8] *= rng.uniform(0.1, 6, (n // 8, 1))  # outliers
        rows += [(i, lang, source, False, *map(int, v)) for i, v in enumerate(np.round(x))]
    ddl = "doc_id long, lang string, source string, base_failed boolean, " + ", ".join(f"{f} long" for f in quality.FEATURES)
    df = spark.createDataFrame(rows, ddl).repartition(3)
    got = {(r["lang"], r["source"], r["doc_id"]): (r["distance2"], r["kept"]) for r in quality.judged(df, df).collect()}
    values = lambda keep: np.array([r[4:] for r in rows if keep(r)])
    gone = 0
    for lang, source in groups:
        own = [r for r in rows if r[1:3] == (lang, source)]
        # a group of fewer than MIN_GROUP takes its language's estimate, a language of fewer that of all
        pool = values(lambda r: r[1:3] == (lang, source)) if len(own) >= quality.MIN_GROUP else values(lambda r: r[1] == lang)
        pool = pool if len(pool) >= quality.MIN_GROUP else values(lambda r: True)
        want = plain_mcd(pool)(np.array([r[4:] for r in own]))
        assert [got[lang, source, r[0]][0] for r in own] == pytest.approx(want.tolist(), rel=1e-6)
        assert [got[lang, source, r[0]][1] for r in own] == (want <= quality.CUT).tolist()
        gone += (want > quality.CUT).sum()
    assert gone > 10


def test_quality_odd_tables(clashing, no_docs):
    assert quality.quality_rules(no_docs).count() == 0 and quality.keep_good(no_docs).count() == 0
    out = quality.keep_good(clashing)
    assert out.columns == clashing.columns
    kept = sorted(r["doc_id"] for r in quality.quality_rules(clashing).where("kept").collect())
    assert sorted(r["doc_id"] for r in out.collect()) == kept


# --- URLs ---

def test_host_path_and_rules(spark):
    rows = ["http://A.b.ORG/es/x?y#z", "https://example.org/es/1", "https://www.EXAMPLE.org/en/12", "//no", None, "", "x://y?/a", "x://a.com/fr/b", "x://a.com/de/", "x://com/de/1",
            "x://telecom/de/", "x://org", "x://u:p@h.org:80/", "a://b://c/d", "h://É.org/É"]
    got = {r["url"]: (r["host"], r["path"], r["rule"], r["v"]) for r in (lambda d: d.select("url", "host", "path", urls.rule_for(F.col("host"), F.col("path"))[0].alias("rule"),
           urls.rule_for(F.col("host"), F.col("path"))[1].alias("v")))(urls.with_host_path(spark.createDataFrame([(u,) for u in rows], "url string"))).collect()}
    assert got == {
        "http://A.b.ORG/es/x?y#z": ("a.b.org", "/es/x", "org/", "allow"), "https://example.org/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
        "https://www.EXAMPLE.org/en/12": ("www.example.org", "/en/12", "example.org/en/1", "block"), "//no": ("", "", None, None), None: ("", "", None, None), "": ("", "", None, None),
        "x://y?/a": ("y", "", None, None), "x://a.com/fr/b": ("a.com", "/fr/b", "com/fr/", "allow"), "x://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
        "x://com/de/1": ("com", "/de/1", "com/de/", "block"), "x://telecom/de/": ("telecom", "/de/", None, None), "x://org": ("org", "", None, None),
        "x://u:p@h.org:80/": ("u:p@h.org:80", "/", None, None), "a://b://c/d": ("b:", "//c/d", None, None), "h://É.org/É": ("É.org", "/É", "org/", "allow")}


def test_model_learns_on_held_out_urls(spark):
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [(i, f"http://{name()}.net/{'casino' if i % 2 else 'docs'}/{name()}") for i in range(400)]
    train = spark.createDataFrame([(u, 0.0 if i % 2 else 1.0) for i, u in rows[:200]], "url string, label double")
    got = urls.filter_urls(spark.createDataFrame(rows[200:], "page_id long, url string"), train).collect()
    assert sum(r["verdict"] == ("block" if r["page_id"] % 2 else "allow") for r in got) >= 195
    again = urls.filter_urls(spark.createDataFrame(rows[200:], "page_id long, url string"), train.repartition(3)).collect()
    assert {r["page_id"]: r["score"] for r in got} == pytest.approx({r["page_id"]: r["score"] for r in again})


def test_url_odd_tables(spark):
    pages = spark.createDataFrame([(1, None, 0), (1, None, 0), (2, "x://y.net/" + "p" * 50_000, 0)], "page_id long, url string, score int")
    none = spark.createDataFrame([], "url string, label double")
    assert [r["verdict"] for r in urls.filter_urls(pages, none).collect()] == ["allow"] * 3
    assert [r["verdict"] for r in urls.filter_urls(pages, spark.createDataFrame([("x://a/", 0.0)], none.schema)).collect()] == ["block"] * 3
    both = spark.createDataFrame([("x://a/", 0.0), ("x://b.net/pp", 1.0), (None, 1.0), ("u", None)], none.schema)
    assert urls.filter_urls(pages, both).count() == 3 and urls.filter_urls(pages.limit(0), both).count() == 0


def test_url_model_on_urls_it_has_not_seen(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    r = urls.held_out_accuracy(urls.labelled_by_rules(pages)).first()
    assert r["n"] > 100 and r["accuracy"] > 0.95 and r["accuracy"] > r["majority"] + 0.1
    none = spark.createDataFrame([("x://a/b", 1.0)], "url string, label double")
    assert urls.held_out_accuracy(none).first()["accuracy"] is None


# --- decontamination ---

def toks(t):
    return [x for x in re.split(r"[^\w]|_", (t or "").lower()) if x]


def brute_leaks(rows, items):
    """The rule alone, over all alignments of items that a seed spans."""
    return every_leak([r[:2] for r in rows], [(k, b) for k, b in items if len(toks(b)) >= decontam.SPAN])


@pytest.fixture(scope="module")
def leaky(spark):
    rng = random.Random(12)
    w = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    items = [(i, " ".join(w(n))) for i, n in enumerate([15, 20, 33, 9, 8, 5, 0, 60])] + [(8, None), (9, "the of the of " * 4)]
    rows = [(i, " ".join(w(120))) for i in range(30)]
    for i in range(30, 70):
        part = items[rng.choice([0, 1, 2, 3, 4, 7])][1].split()
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            part[rng.randrange(len(part))] = "changed"
        rows.append((i, " ".join(w(rng.randint(0, 40))) + " " + ", ".join(part).upper() + ". " + " ".join(w(rng.randint(0, 40)))))
    return rows + [(70, None), (71, ""), (72, "the of " * 500), (30, rows[30][1]), (73, "w1 " * 9)], items


@pytest.mark.parametrize("limit", [decontam.MAX_BROADCAST_TOKENS, -1])
def test_leaks(spark, leaky, limit):
    rows, items = leaky
    df, it = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["matched"] for r in decontam.leaks(df, it, max_broadcast_tokens=limit).collect()}
    assert got == brute_leaks(rows, items)
    assert len({d for d, _ in got}) > 20 and not any(d < 30 for d, _ in got)


def every_leak(rows, items):
    """The rule alone: all alignments, no seeds."""
    out = defaultdict(int)
    for i, t in rows:
        d = toks(t)
        for k, b in items:
            w = toks(b)
            st = min(decontam.WINDOW, len(w))
            for shift in range(-len(w), len(d)):
                eq = [int(0 <= j + shift < len(d) and d[j + shift] == w[j]) for j in range(len(w))]
                for k0 in range(len(w) - st + 1):
                    if (m := sum(eq[k0 : k0 + st])) >= -(-st * decontam.SHARE // 1):
                        out[i, k] = max(out[i, k], m)
    return dict(out)


@pytest.mark.parametrize("limit", [decontam.MAX_BROADCAST_TOKENS, -1])
def test_every_pattern_of_changes(spark, limit):
    items = [(n, " ".join(f"i{n}w{j}" for j in range(n))) for n in range(8, 16)]
    texts = []
    for n, b in items:
        for gone in itertools.combinations(range(n), min(n, decontam.WINDOW) - -(-min(n, decontam.WINDOW) * 3 // 4)):
            texts.append("some words before it " + " ".join("changed" if j in gone else x for j, x in enumerate(b.split())) + " and after it")
        texts += [" ".join(b.split()[cut:]) for cut in (1, 2, 3, 4)] + [" ".join(b.split()[:-cut]) + " x y" for cut in (1, 2, 3, 4)]
    rows = list(enumerate(texts))
    df, it = spark.createDataFrame(rows, "doc_id long, text string").repartition(2), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["matched"] for r in decontam.leaks(df, it, max_broadcast_tokens=limit).collect()}
    assert got == every_leak(rows, items) and len(got) > 1000


@pytest.mark.parametrize("limit", [decontam.MAX_BROADCAST_TOKENS, -1])
def test_short_items_match_word_for_word(spark, limit):
    items = [(1, "Who wrote it?"), (2, "one two three four five six seven"), (3, "yes"), (4, ""), (5, None), (6, "one two three four five six seven eight")]
    rows = [(1, "He asked: who WROTE it, and who wrote it"), (2, "one two three four five six seven"), (3, "one two three four five six x"), (4, "Yes"), (5, None), (6, "who wrote"), (None, "yes")]
    df, it = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontam.leaks(df, it, max_broadcast_tokens=limit, min_item_tokens=1).collect()}
    assert got == {(1, 1, 3, 3, 2), (2, 2, 7, 7, 0), (2, 6, 7, 8, 0), (3, 6, 6, 8, 0), (4, 3, 1, 1, 0), (None, 3, 1, 1, 0)}


def plan_nodes(plan):
    """All nodes of a plan that ran."""
    name = plan.nodeName()
    inner = [plan.executedPlan()] if name.startswith("AdaptiveSparkPlan") else [plan.plan()] if name.endswith("QueryStage") else []
    kids = plan.children()
    for p in inner + [kids.apply(i) for i in range(kids.size())]:
        yield from plan_nodes(p)
    yield plan


@pytest.mark.parametrize("limit", [decontam.MAX_BROADCAST_TOKENS, -1])
def test_many_items_and_long_documents_in_little_memory(spark, limit):
    rng = random.Random(4)
    w = lambda n: [f"w{rng.randrange(30000)}" for _ in range(n)]
    items = [(i, " ".join(w(40))) for i in range(1500)] + [(2000, " ".join(w(700))), (2001, "a short one here")]
    items += [(3000 + i, items[7][1].upper()) for i in range(50)] + [(8, items[9][1]), (None, items[10][1]), (None, items[10][1])]
    part = lambda i, a, b: items[i][1].split()[a:b]
    rows = [(0, w(1000) + part(7, 3, 30) + w(50)), (1, part(9, 0, 20) + w(2000) + part(10, 20, 40)), (2, w(63) + part(1500, 180, 200) + w(44) + part(1500, 640, 660)), (3, w(3000)), (4, w(126) + ["a", "short", "one", "here"] + w(3))]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(2)
    got = decontam.leaks(df, spark.createDataFrame(items, "item_id long, text string"), max_broadcast_tokens=limit)
    found = {(r["doc_id"], r["item_id"]): (r["matched"], r["stretch"]) for r in got.collect()}
    assert found == {(0, i): (13, 13) for i in [7, *range(3000, 3050)]} | {(1, i): (13, 13) for i in (8, 9, 10, None)} | {(2, 2000): (13, 13), (4, 2001): (4, 4)}
    assert got.where("doc_id = 4").first()["doc_start"] == 126 and got.where("doc_id = 0").first()["doc_start"] == 997  # ten of 13 are equal from here
    nodes = list(plan_nodes(got._jdf.queryExecution().executedPlan()))
    sent = [p.metrics().apply("dataSize").value() for p in nodes if p.nodeName() == "BroadcastExchange"]
    assert sent and max(sent) < 8 << 20  # the keys alone would be 360,000 rows
    rows_out = [p.metrics().apply("shuffleRecordsWritten").value() for p in nodes if p.nodeName() == "Exchange" and "doc_id" in p.output().mkString()]
    assert rows_out and max(rows_out) < 20_000  # of 41,000 windows


def test_items_too_short_to_be_evidence(spark, docs, corpus):
    items = spark.createDataFrame([(1, "The"), (2, "who wrote it"), (3, "who wrote it then"), (4, ""), (5, None)], "item_id long, text string")
    rows = spark.createDataFrame([(1, "the end"), (2, "Who wrote it? The cat."), (3, "and who wrote it, then?")], "doc_id long, text string")
    assert [r["doc_id"] for r in decontam.leaks(rows, items).collect()] == [3]
    assert sorted(map(tuple, decontam.items_left_out(items).collect())) == [(1, 1), (2, 3), (4, 0), (5, 0)]
    assert sorted(r["doc_id"] for r in decontam.without_leaks(rows, items).collect()) == [1, 2]
    common = spark.createDataFrame([(1, corpus[0][1].split()[0])], "item_id long, text string")
    assert decontam.without_leaks(docs, common).count() == len(corpus)


def test_leaks_odd_tables(spark, clashing, no_docs, corpus):
    items = spark.createDataFrame([(1, corpus[0][1]), (None, corpus[1][1]), (2, None)], "item_id long, text string").withColumn("h", F.lit(1))
    out = decontam.without_leaks(clashing, items)
    assert out.columns == clashing.columns
    ids = {r["doc_id"] for r in out.collect()}
    assert not ids & {0, 1} and 20 in ids
    assert decontam.leaks(no_docs, items).count() == 0
    assert decontam.without_leaks(clashing, items.limit(0)).count() == len(corpus)


# --- quotations ---

def test_threads(spark):
    rows = [
        (1, "f", 1, "ann", "Shall we meet on Monday?\nThe room is free then."),
        (2, "f", 2, "bob", "> shall we  meet on MONDAY\nYes, that suits me well."),
        (3, "f", 3, "cy", "> > Shall we meet on Monday?\n> Yes, that suits me well.\n\nI cannot come on that day."),
        (4, "f", 4, "dan", ">> Shall we meet on Monday?\nOnly the deep quote is known here."),
        (5, "f", 5, "eve", "> nobody ever wrote this line\nA new thread starts with me."),
        (6, "g", 6, "fay", "> Shall we meet on Monday?\nThis is another folder, no link."),
        (7, "f", 0, "gus", "> Shall we meet on Monday?\nToo early to be a reply to it."),
        (8, None, 8, None, None), (9, None, 9, "x", "> > >\n>\n"), (None, "f", 10, "nil", "> Shall we meet on Monday?"),
    ]
    m = spark.createDataFrame(rows, "message_id long, folder string, sent long, author string, text string").withColumn("level", F.lit(1)).withColumn("first", F.lit(2))
    got = quotes.conversations_from_quotes(m).collect()
    assert [(r["conversation_id"], r["depth"], r["message_id"], r["parent_id"]) for r in got] == [
        (None, 0, None, None), (1, 0, 1, None), (1, 1, 2, 1), (1, 1, 4, 1), (1, 2, 3, 2), (5, 0, 5, None), (6, 0, 6, None), (7, 0, 7, None), (8, 0, 8, None), (9, 0, 9, None)]
    text = {r["message_id"]: (r["text"], r["n_quoted"]) for r in got}
    assert text[3] == ("I cannot come on that day.", 2) and text[8] == ("", 0) and text[9] == ("", 2)
    assert quotes.conversations_from_quotes(m.limit(0)).count() == 0


def test_long_thread_and_round_trip(spark):
    rng = random.Random(7)
    turns = [(c, t, "user", "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(8)) for _ in range(3))) for c in range(3) for t in range(40 if c == 0 else 3)]
    turns += [(50 + i, 0, "user", "the same first turn in all of these") for i in range(30)] + [(50 + i, 1, "bot", f"answer number {i} to the first turn") for i in range(30)]
    got = quotes.conversations_from_quotes(quotes.quoting_messages(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))).collect()
    assert len(got) == len(turns)
    text = {(c, t): x for c, t, _, x in turns}
    for r in got:
        c, t = r["folder"], r["sent"]
        assert (r["conversation_id"], r["depth"], r["text"]) == (c << 20, t, text[c, t])


def test_short_lines_link(spark):
    rows = [
        (1, "f", 1, "Shall we meet on Monday then?"), (2, "f", 2, "> Shall we meet on Monday then?\nYes, thanks"),
        (3, "f", 3, "> Yes, thanks\n> > Shall we meet on Monday then?\nGood"), (4, "f", 4, "> Good\nGood"), (5, "f", 5, "yes thanks"),
        (6, "f", 6, "> Yes - thanks!\nWelcome"), (7, "f", 7, "> Welcome\n> Shall we meet on Monday then?\nLast"), (8, "g", 8, "> Good\nOther folder"), (9, "f", 0, "> Good\nToo early"),
    ]
    m = spark.createDataFrame(rows, "message_id long, folder string, sent long, text string")
    assert {r["message_id"]: r["parent_id"] for r in quotes.link_quotes(m).collect()} == {2: 1, 3: 2, 4: 3, 6: 5, 7: 1}


def brute_links(rows):
    """The rule alone: for every quoted line the last earlier message of the folder that wrote it."""
    def parts(text):
        for x in re.split("\r?\n", text or "") if text else []:
            marks = re.match(r"[\x20\t]*>(?:[\x20\t]*>)*", x)
            words = " ".join(re.findall(r"[^\W_]+", x[marks.end():] if marks else x)).lower()
            if words:
                yield marks.group().count(">") if marks else 0, words
    out = {}
    for i, folder, sent, text in rows:
        votes = defaultdict(lambda: [0, 0])
        for level, words in parts(text):
            writers = [(s, j) for j, f, s, t in rows if f == folder and (s, j) < (sent, i) and (0, words) in set(parts(t))] if level else []
            if writers:
                v = votes[level, max(writers)]
                v[0] += len(words.split())
                v[1] += 1
        if votes:
            low = min(level for level, _ in votes)
            best = max((v[0], first, v[1]) for (level, first), v in votes.items() if level == low)
            out[i] = (best[1][1], low, best[2])
    return out


def links_of(spark, rows):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "false")  # passages then go over the ends of partitions
    try:
        got = quotes.link_quotes(spark.createDataFrame(rows, "message_id long, folder string, sent long, text string")).collect()
    finally:
        spark.conf.set(key, was)
    return {r["message_id"]: (r["parent_id"], r["level"], r["passages"]) for r in got}


def test_last_writer_of_a_line_written_twice(spark):
    line = "Shall we meet on Monday then?"
    rows = [(1, "f", 1, line), (2, "f", 2, "no"), (3, "f", 3, line), (4, "f", 4, f"> {line}\nYes"), (5, "f", 5, line), (6, "g", 6, f"> {line}")]
    assert links_of(spark, rows) == {4: (3, 1, 1)} == brute_links(rows)


@pytest.mark.parametrize("seed", range(3))
def test_links_by_the_rule(spark, seed):
    rng = random.Random(seed)
    said = ["yes", "no", "ok then", "shall we meet on monday", "that suits me very well", "x"] + [f"line number {i}" for i in range(20)]
    rows = []
    for i in range(300):
        lines = [f"{rng.choice(['> ', '>> ', '> > >'])}{rng.choice(said).upper()}!" for _ in range(rng.randint(0, 4))] + [rng.choice(said) for _ in range(rng.randint(0, 3))]
        rng.shuffle(lines)
        rows.append((i, rng.choice(["f", "g", None]), rng.randrange(60), "\n".join(lines) if rng.random() < 0.95 else None))
    want = brute_links(rows)
    assert links_of(spark, rows) == want and len(want) > 150


def test_whole_turns_are_quoted(spark):
    turns = [(1, 0, "a", "one\ntwo\nthree"), (1, 1, "b", "four\nfive"), (1, 2, "a", "six"), (2, 0, "a", None)]
    got = {r["message_id"] - (1 << 20): r["text"] for r in quotes.quoting_messages(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1] == "> one\n> two\n> three\nfour\nfive" and got[2] == "> > one\n> > two\n> > three\n> four\n> five\nsix"


def test_rows_that_share_an_id(spark):
    rows = [(1, "f", 1, "first words here"), (2, "f", 2, "> first words here\na"), (2, "f", 2, "> first words here\na"), (2, "f", 3, "other")]
    m = spark.createDataFrame(rows, "message_id long, folder string, sent long, text string").withColumn("author", F.lit("x"))
    got = sorted((r["message_id"], r["sent"], r["parent_id"], r["conversation_id"], r["text"]) for r in quotes.conversations_from_quotes(m).collect() if r["message_id"] == 2)
    assert got == [(2, 2, 1, 1, "a"), (2, 2, 1, 1, "a"), (2, 3, 1, 1, "other")]


def test_null_safe_join(spark):
    a, b = spark.createDataFrame([(1, None), (2, "x")], "n int, k string"), spark.createDataFrame([(None, 5), ("x", 6)], "k string, v int")
    assert sorted(map(tuple, null_safe_join(a, b, ["k"]).collect())) == [(1, None, 5), (2, "x", 6)]
