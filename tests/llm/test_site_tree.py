"""Main text by site style trees: parsing, importance against plain sums, planted sites."""

import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrina.llm import queries, site_tree
from vitrina.llm.dom import Page
from tests.llm.conftest import sentence

SCHEMA = "page_id long, url string, html string"


def text_of(html, low=frozenset()):
    return site_tree.main_text(Page(html, "h", {}), low)[0]


@pytest.mark.parametrize(("html", "want"), [
    ("", ""), ("plain &amp; bare", "plain & bare"), ("a < b and 1<2", "a < b and 1<2"), ("<p>one<p>two<br>three</p>four", "one\ntwo three\nfour"),
    ("<p><b>one<br><p>two", "one\ntwo"), ("<p>a <b>b</p><p>c</b> d</p>", "a b\nc d"), ("<ul><li>a<li>b <i>c</i></ul>d", "a\nb c\nd"),
    ("<script>var t=\"</p>\";x<y</script>z", "z"), ("<style>p{}</style><!-- no <p> no -->yes<!-- cut", "yes"), ("x<![CDATA[no]]>y<?no?>z", "xyz"),
    ('<div title="a > b">c</div>', "c"), ("<p title='it>s'>c", "c"), ('<p title="open>one</p><p>two</p>', "one\ntwo"),
    ("&lt;p&gt; &#233;&eacute;&nbsp;&#x1F600;", "<p> éé \U0001f600"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("<textarea><p>no</textarea>yes<noscript>no</noscript>", "yes"), ("<h1>t</h1><p>  a \n\t b\r\n</p>", "t\na b"), ("<body><p>a", "a"), ("a<p", "a"), ("</p>a</b>", "a"),
    ("<title>no</title><p>yes", "yes"), ("<svg><text>no</text></svg>yes", "yes"), ("<p>so<img alt=no>me</p>", "some"), ("<select><option>a<option>b</select>c", "c"), ("<noscript><p>no</noscript>yes", "yes"), ("<p>a<button>no</button> b</p>", "a b"),
])
def test_blocks(html, want):
    assert text_of(html) == want


@pytest.mark.parametrize("part", [
    "<nav>n</nav>", "<div class='ad'>n</div>", "<div id=cookie-notice>n</div>", "<aside>n</aside>", "<form>n<input></form>", "<footer><p>n</footer>", "<header><h1>n</h1></header>",
    "<div class='siteHeader'>n</div>", "<div role=banner>n</div>", "<ul class='main-menu'><li>n</ul>", "<section id=comments><article class=comment><p>n</article></section>",
    "<div hidden>n</div>", "<p style='display: none'>n</p>", "<div class=sidebar><div class=content>n</div></div>", "<div class=\"share-buttons\">n</div>"])
@pytest.mark.parametrize("frame", ["<body>{}<article><h1>t</h1><p>a</p></article>{}", "<body><main>{}<h1>t</h1><p>a</p>{}</main>", "<body><div class=c1>{}<h1>t</h1><p>a</p>{}</div>"])
def test_furniture_goes(part, frame):
    assert text_of(frame.format(part, part)) == "t\na"


@pytest.mark.parametrize("part", ["<nav>n</nav>", "<div class='ad'>n</div>", "<form>n</form>", "<section class=comments><p>n</section>", "<article>a reader</article>", "<aside>n</aside>"])
def test_furniture_in_the_article_goes(part):
    assert text_of(f"<body><article><h1>t</h1>{part}<p>a</p>{part}</article>") == "t\na"


@pytest.mark.parametrize("wrapper", ["<form id=f>", "<div class='page has-sidebar'>", "<body class='no-ads'>", "<div id=header-fixed>"])
def test_wrappers_stay(wrapper):
    assert text_of(f"{wrapper}<article class='post has-comments'><header><h1>t</h1></header><p>a</p></article>") == "t\na"
    assert text_of(f"{wrapper}<div class=k><h1>t</h1><p>a</p></div>") == "t\na"


def test_text_outside_the_article_goes():
    assert text_of("<p>x</p><article><p>a</p></article><div class=k>y</div>") == "a"
    assert text_of("<p>x</p><main><p>a</p><p>b</p></main>y") == "a\nb"
    assert text_of("<p>x</p><div class=entry-content><p>long enough</p></div>") == "long enough"
    assert text_of("<p>much longer than the other</p><div class=content><p>a</p></div>") == "much longer than the other\na"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("<>/ab!-\"'= &;?p")), max_size=60))
def test_any_text_is_read(html):
    text_of(html)


def test_long_broken_pages_stay_linear():
    for html in ("<p a=\"" * 30_000, "<" * 200_000, "<b>" * 20_000 + "x", "<div>" * 3_000 + "x", "</p" * 50_000, "<!--" * 50_000):
        text_of(html)


def site(rng, host, n, start, article):
    """Pages of a site whose furniture has no telling name, and the text of each."""
    menu = "".join(f"<li><a href=/{i}>{sentence(rng, 2)}</a></li>" for i in range(5))
    legal, share = sentence(rng, 20), sentence(rng, 6)
    open_, close = article
    rows = []
    for i in range(n):
        paras = [sentence(rng, rng.randint(8, 30)) for _ in range(rng.randint(1, 5))]
        head = sentence(rng, 5)
        html = (f"<html><body><div class=x1><ul>{menu}</ul></div>{open_}<h1>{head}</h1><p>{paras[0]}</p><div class='x2 x{i}'>{share} {i}</div>"
                + "".join(f"<p>{p}</p>" for p in paras[1:]) + f"{close}<div class=x3><p>{legal}</p></div></body></html>")
        rows.append((start + i, f"https://{host}/a/{i}", html, "\n".join([head, *paras])))
    return rows


@pytest.fixture(scope="module")
def sites():
    rng = random.Random(7)
    kinds = [("<article>", "</article>"), ("<div class=k1>", "</div>"), ("<main>", "</main>"), ("<div class='x9 y'><div>", "</div></div>")]
    return [row for k, a in enumerate(kinds) for row in site(rng, f"h{k}.example.org", 30 + k, 100 * k, a)]


def as_pages(spark, rows):
    return spark.createDataFrame([r[:3] for r in rows], SCHEMA).repartition(3)


def plain_importance(rows):
    """The definition, page by page: node -> (pages, sequences, presentation, content)."""
    on, sequences, texts, memo = Counter(), defaultdict(Counter), defaultdict(lambda: defaultdict(list)), {}
    for _, url, html, *_ in rows:
        for (node, kind, feature), c in site_tree.page_pairs(Page(html or "", site_tree.host_of(url), memo), memo).items():
            if kind == site_tree.PAGE:
                on[node] += 1
            elif kind == site_tree.SEQUENCE:
                sequences[node][feature] += 1
            else:
                texts[node][feature].append(c)
    out = {}
    for node, m in on.items():
        entropy = lambda c, m=m: -sum(x / sum(c) * math.log(x / sum(c), m) for x in c)
        p = min(entropy(sequences[node].values()), 1.0) if m > 1 else 1.0
        hs = [entropy(c) for c in texts[node].values()] if m > 1 else []
        out[node] = (m, len(sequences[node]), round(p, 6) + 0.0, round(1 - sum(hs) / len(hs), 6) + 0.0 if hs else 1.0)
    return out


def test_importance(spark, sites):
    got = {r["node"]: r for r in site_tree.node_importance(as_pages(spark, sites)).collect()}
    want = plain_importance(sites)
    assert got.keys() == want.keys() and len(want) > 20
    for node, (m, n, p, c) in want.items():
        r = got[node]
        assert (r["pages"], r["sequences"]) == (m, n)
        assert r["presentation"] == pytest.approx(p, abs=1e-5) and r["content"] == pytest.approx(c, abs=1e-5)
        assert r["importance"] == pytest.approx((1 - 0.9**n) * p + 0.9**n * c, abs=1e-5)


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_unnamed_furniture_goes(spark, sites, most):
    got = {r["page_id"]: r for r in site_tree.extract_main_text(as_pages(spark, sites), max_broadcast=most).collect()}
    assert {i: r["text"] for i, r in got.items()} == {i: t for i, _, _, t in sites}
    assert all(r["removed_by_importance"] >= 3 and r["n_chars"] == len(r["text"]) for r in got.values())


def test_few_pages_and_copies_are_left_alone(spark):
    rng = random.Random(2)
    few = site(rng, "few.example.org", 4, 0, ("<div class=k>", "</div>"))
    one = site(rng, "copies.example.org", 1, 50, ("<div class=k>", "</div>"))[0]
    copies = [(50 + i, *one[1:]) for i in range(20)]
    inside = [(100 + i, f"http://a.example.org/{i}", f"<article><h1>same</h1><p>same text</p></article><p>{i}</p>", "same\nsame text") for i in range(20)]
    got = {r["page_id"]: r["text"] for r in site_tree.extract_main_text(as_pages(spark, few + copies + inside)).collect()}
    assert all(set(t.split("\n")) <= set(got[i].split("\n")) for i, _, _, t in few + copies)
    assert all(got[i] == t for i, _, _, t in inside)


def test_odd_rows(spark, sites):
    rows = sites[:40] + [sites[0], (None, None, None), (7000, "no host", "<p>x</p>"), (7001, "http://h0.example.org/z", ""), (7002, None, "<p>" + "long " * 100_000)]
    pages = as_pages(spark, rows)
    run = lambda d, **k: sorted((tuple(r) for r in site_tree.extract_main_text(d, **k).collect()), key=repr)
    got = run(pages)
    assert len(got) == len(rows) and run(pages, max_broadcast=0) == got
    by_id = {r[0]: r for r in got}
    assert by_id[None][1:4] == (None, "", 0) and by_id[7000][2] == "x" and by_id[7001][2] == "" and by_id[7002][3] == 499_999
    more = pages
    for name in ("node", "kind", "feature", "c", "s", "low", "page", "text", "n_chars"):
        more = more.withColumn(name, pages["page_id"])
    assert run(more) == got and run(more, max_broadcast=0) == got
    assert run(pages.where("false")) == []


def test_query_on_given_rows(spark):
    folder = "/root/testdata/sf0.001"
    import html
    import re
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = queries.op11_main_text(spark, folder).collect()
    assert len(rows) == len(pages) and rows[0].__fields__[:4] == ["page_id", "url", "text", "n_chars"]
    for r in rows:
        inner = re.search("(?s)<article>(.*)</article>", pages[r["page_id"]]["html"]).group(1)
        parts = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", p))).split()) for p in re.split("</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])
