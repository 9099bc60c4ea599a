"""Main text of pages by a site style tree.

The pages of one host are merged into one tree: nodes with the same presentations
from the root down are one node of the site.  For each node two entropies are
taken over the pages that have it (in logarithms to the number of pages, so from
0 to 1): of the sequences of children that it has on them (runs of one presentation
counted once), and, for each text found in its branch, of the pages that text stands on.
Its importance is

    (1 - DECAY ** l) * presentation + DECAY ** l * (1 - mean entropy of its texts)

with l the number of its different sequences.  A menu that all pages share has
importance 0, a branch that has something else to say on each page nearly 1.
Branches of less than ``LEAST`` go.

Statistics alone cannot know an advert that is new on every page, so tags, roles and class words
that name page furniture take a branch's importance to 0 as well, and those that name
the article protect it: what has such a part keeps only that, and within it plain flow (paragraphs,
headings, lists without a presentation of their own) is not judged.
Sites of fewer than ``MIN_PAGES`` pages, and pages that would lose all they say, go by names alone.

Two passes: each task counts the (node, text) and (node, sequence) pairs of its
pages and one shuffle adds them up, so a host with a third of all pages is many
partial counts.  The nodes to be removed (a few per host) are then broadcast if there are at most
``MAX_BROADCAST_NODES``; beyond, each page's nodes meet them in a join and come
back to the page as a list.  Pages themselves are only shuffled in that case.

Defined cases: null or empty pages have no text; pages without a host are
one site; text outside of any tag counts; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import checkpointed
from vitrina.llm.dom import _DIGITS, Page, _key
from vitrina.session import ship_package

DECAY = 0.9
LEAST = 0.3
MIN_PAGES = 5
MAX_BROADCAST_NODES = 1_000_000
#: Pairs that a task counts before it hands them on.
MAX_PAIRS = 500_000

#: Names of page furniture: elements that never hold the article, roles, and words of classes and ids.
NEVER = frozenset("head script style noscript template iframe svg canvas object audio video select button textarea input nav aside footer dialog menu search math".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist tooltip status".split())
WORDS = frozenset((
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot adsense adunit banner banners sponsor sponsors sponsored promo promos promoted promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs crumbs sidebar sidebars aside footer foot footnav masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts disclaimer privacy paywall popup modal overlay "
    "newsletter newsletters subscribe subscription signup signin login register social share sharing sharebar follow related recommended recommendations "
    "comment comments commentlist commenter respond replies reply disqus pagination pager copyright widget widgets outbrain taboola skip "
    "searchbox searchform feedback poll survey hidden").split())
#: Words that name furniture outside of an article only.
OUTER_WORDS = frozenset(["header", "head", "top", "bottom", "search", "form"])
#: Words that make an article or main element furniture.
ASIDE_WORDS = frozenset("comment ad ads advert sponsored promo promoted related recommended".split())
REGION_WORDS = frozenset("article articlebody content maincontent main post entry story".split())
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
PART, PAGE_PART, NAMED_PART = 3, 2, 1
_TEXT_DDL = "page_id long, url string, text string, n_chars long, removed_by_role long, removed_by_importance long"
_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("removed_by_role", pa.int64()), ("removed_by_importance", pa.int64())])


def host_of(url: str | None) -> str:
    """Host of a URL, A-Z lower-cased; empty without one."""
    _, sep, rest = (url or "").partition("://")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].translate({c: c + 32 for c in range(65, 91)}) if sep else ""


def _words(found: dict) -> frozenset[str]:
    return frozenset(w.lower() for w in _SPLIT.split(f"{found.get('class', '')} {found.get('id', '')}") if w)


def _part(tag: str, found: dict, names: frozenset) -> int:
    """What kind of part that holds the article an element is, 0 if none."""
    if tag == "article" or "articleBody" in found.get("itemprop", ""):
        return PART
    if tag == "main" or found.get("role", "").lower() == "main":
        return PAGE_PART
    return NAMED_PART if tag in ("div", "section", "td") and not REGION_WORDS.isdisjoint(names) else 0


def _furniture(tag: str, found: dict, names: frozenset, part: int, within: int) -> bool:
    """Whether an element's names call it page furniture."""
    if tag in ("html", "body"):
        return False
    if part >= PAGE_PART:
        return not ASIDE_WORDS.isdisjoint(names)
    return (tag == "form" or tag == "header" and within < PART or found.get("role", "").lower() in ROLES
            or not (WORDS if within == PART else WORDS | OUTER_WORDS).isdisjoint(names))


class Judged:
    """What the names on a page say: furniture, parts that hold the article, and which nodes statistics may remove."""

    def __init__(self, page: Page):
        n = len(page.tag)
        self.page, self.part, self.gone = page, [0] * n, [False] * n
        called, inside, holds, article = [False] * n, [0] * n, [False] * n, [False] * n
        for i in range(1, n):
            tag, found, up = page.tag[i], page.attributes[i], page.parent[i]
            names = _words(found) if found else frozenset()
            self.part[i] = _part(tag, found, names)
            hidden = "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower()
            # an article in an article is a reader's
            self.gone[i] = self.gone[up] or tag in NEVER or hidden or tag == "article" and article[up]
            called[i] = _furniture(tag, found, names, self.part[i], inside[up])
            article[i] = article[up] or tag == "article"
            inside[i] = max(inside[up], 0 if self.gone[i] else self.part[i])
        for i in range(n - 1, 0, -1):
            heading = page.tag[i] == "h1" and page.tag[page.parent[i]] != "header"
            if not self.gone[i] and (holds[i] or heading or self.part[i] >= PAGE_PART and not called[i]):
                holds[page.parent[i]] = True
        for i in range(1, n):
            # an element that holds the article is its wrapper, whatever it is called
            self.gone[i] = self.gone[i] or self.gone[page.parent[i]] or called[i] and not holds[i]
        self.holds, self.inside = holds, inside
        self.open = self._judged()

    def _judged(self) -> list[bool]:
        """Whether statistics may remove a node: not what holds an article, nor an article's plain flow."""
        p, out = self.page, [False] * len(self.page.tag)
        for i in range(1, len(out)):
            up = p.parent[i]
            if p.tag[i] in ("html", "body") or self.holds[i] or self.part[i] >= PAGE_PART:
                continue
            out[i] = self.inside[up] < PAGE_PART or out[up] or bool(p.attributes[i].keys() & {"class", "id", "role"})
        return out


def _sequence(page: Page, node: int) -> str:
    """Presentations of a node's children in order, runs of one as one."""
    out, last = [], None
    for c in page.children[node]:
        sign = page.sign[c].split(":")[0]
        if sign != last:
            out.append(sign)
            last = sign
    return " ".join(out)


#: What a counted pair is about: a node's sequence of children, a text of its branch, or the page itself.
SEQUENCE, TEXT, PAGE = 0, 1, 2


def page_pairs(page: Page, memo: dict) -> dict[tuple[int, int, int], int]:
    """Counts of (node, kind, feature) of one page."""
    judged, out = Judged(page), {}
    for i, may in enumerate(judged.open):
        if may:
            out[(page.key[i], PAGE, 0)] = 1
            pair = (page.key[i], SEQUENCE, _key(SEQUENCE, _sequence(page, i), memo))
            out[pair] = 1
    for block in page.blocks:
        for node, text in block:
            if judged.open[node] and not text.isspace():
                feature, seen = _key(TEXT, _DIGITS.sub("0", " ".join(text.split())), memo), set()
                while node > 0:
                    if judged.open[node] and page.key[node] not in seen:
                        seen.add(page.key[node])
                        pair = (page.key[node], TEXT, feature)
                        out[pair] = out.get(pair, 0) + 1
                    node = page.parent[node]
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, kind, feature, c, s): occurrences c_j on the pages of a piece as sums of c_j and of c_j ln c_j."""
    memo: dict = {}

    def rows(held: dict) -> pa.RecordBatch:
        nodes, kinds, features = zip(*held, strict=True) if held else ((), (), ())
        c, s = zip(*held.values(), strict=True) if held else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(kinds, pa.int32()), pa.array(features, pa.int64()),
                                           pa.array(c, pa.int64()), pa.array(s, pa.float64())], ["node", "kind", "feature", "c", "s"])

    held: dict = {}
    for batch in batches:
        for url, html in zip(batch.column(0), batch.column(1), strict=True):
            for pair, c in page_pairs(Page(html.as_py() or "", host_of(url.as_py()), memo), memo).items():
                old = held.get(pair)
                add = c * math.log(c) if c > 1 else 0.0
                if old is None:
                    held[pair] = [c, add]
                else:
                    old[0] += c
                    old[1] += add
            if len(held) >= MAX_PAIRS:
                yield rows(held)
                held = {}
    yield rows(held)


def node_importance(pages: DataFrame, decay: float = DECAY) -> DataFrame:
    """``(node, pages, sequences, presentation, content, importance)`` of every node that statistics may judge."""
    ship_package(pages.sparkSession)
    pairs = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(
        _count, "node long, kind int, feature long, c long, s double")
    added = pairs.groupBy("node", "kind", "feature").agg(F.sum("c").alias("c"), F.sum("s").alias("s"))
    of = lambda kind, x: F.when(F.col("kind") == kind, x)
    c = F.col("c").cast("double")
    sums = added.groupBy("node").agg(
        F.max(of(PAGE, F.col("c"))).alias("pages"), F.count(of(SEQUENCE, c)).alias("sequences"), F.sum(of(SEQUENCE, c)).alias("ns"), F.sum(of(SEQUENCE, c * F.log(c))).alias("ss"),
        F.count(of(TEXT, c)).alias("texts"), F.sum(of(TEXT, F.log(c) - F.col("s") / c)).alias("hs"))
    m = F.log(F.col("pages").cast("double"))
    presentation = F.when(F.col("pages") > 1, F.least(F.lit(1.0), (F.log("ns") - F.col("ss") / F.col("ns")) / m)).otherwise(1.0)
    content = F.when((F.col("pages") > 1) & (F.col("texts") > 0), 1 - F.col("hs") / F.col("texts") / m).otherwise(1.0)
    share = F.pow(F.lit(decay), F.col("sequences"))
    return (sums.withColumn("presentation", F.round(presentation, 9)).withColumn("content", F.round(content, 9))
            .select("node", "pages", "sequences", "presentation", "content", F.round((1 - share) * F.col("presentation") + share * F.col("content"), 9).alias("importance")))


def _gather(page: Page, gone: list[bool]) -> tuple[list[str], list[list[int]]]:
    """The blocks that are left as trimmed texts, each with the nodes of its segments."""
    texts, nodes = [], []
    for block in page.blocks:
        left = [(i, t) for i, t in block if not gone[i]]
        text = " ".join("".join(t for _, t in left).split())
        if text:
            texts.append(text)
            nodes.append([i for i, t in left if not t.isspace()])
    return texts, nodes


def main_text(page: Page, low) -> tuple[str, int, int]:
    """(text, branches removed by names, branches removed by importance); ``low`` has the keys of nodes to be removed."""
    judged = Judged(page)
    by_name = sum(g and not judged.gone[page.parent[i]] for i, g in enumerate(judged.gone) if i)
    poor, roots = [False] * len(page.tag), 0
    for i in range(1, len(poor)):
        up = poor[page.parent[i]]
        poor[i] = up or judged.open[i] and page.key[i] in low
        roots += poor[i] and not up
    both = [g or p for g, p in zip(judged.gone, poor, strict=True)]
    texts, nodes = _gather(page, both)
    if not texts:
        roots = 0
        texts, nodes = _gather(page, judged.gone)
    for level in (PART, PAGE_PART, NAMED_PART):
        within = [False] * len(page.tag)
        for i in range(1, len(within)):
            within[i] = within[page.parent[i]] or judged.part[i] == level
        kept = [t for t, at in zip(texts, nodes, strict=True) if any(within[i] for i in at)]
        size = sum(map(len, kept))
        if size and (level > NAMED_PART or 2 * size >= sum(map(len, texts))):
            texts = kept
            break
    return "\n".join(texts), by_name, roots


def _extract(low: np.ndarray | None):
    """Rows of texts; without ``low`` each row brings its own list of nodes to be removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, memo = frozenset(low.tolist()) if low is not None else None, {}
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for j in range(batch.num_rows):
                url = batch.column(1)[j].as_py()
                page = Page(batch.column(2)[j].as_py() or "", host_of(url), memo)
                text, by_name, by_importance = main_text(page, shared if shared is not None else frozenset(batch.column(3)[j].as_py() or ()))
                for column, value in zip(out, (text, len(text), by_name, by_importance), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string())]
                                             + [pa.array(x, f.type) for x, f in zip(out, list(_TEXT)[2:], strict=True)], schema=_TEXT)
    return run


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (page, node) of the nodes that statistics may remove."""
    memo: dict = {}
    for batch in batches:
        pages, nodes = [], []
        for j in range(batch.num_rows):
            page = Page(batch.column(2)[j].as_py() or "", host_of(batch.column(1)[j].as_py()), memo)
            found = {page.key[i] for i, may in enumerate(Judged(page).open) if may}
            pages += [batch.column(0)[j].as_py()] * len(found)
            nodes += found
        yield pa.RecordBatch.from_arrays([pa.array(pages, pa.string()), pa.array(nodes, pa.int64())], ["page", "node"])


def extract_main_text(pages: DataFrame, least: float = LEAST, min_pages: int = MIN_PAGES, max_broadcast: int = MAX_BROADCAST_NODES) -> DataFrame:
    """``(page_id, url, text, n_chars, removed_by_role, removed_by_importance)`` of every page."""
    ship_package(pages.sparkSession)
    low = checkpointed(node_importance(pages).where((F.col("pages") >= min_pages) & (F.col("importance") < least)).select("node"))
    needed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    if low.count() <= max_broadcast:
        keys = np.array([r["node"] for r in low.collect()], np.int64)
        return needed.mapInArrow(_extract(keys), _TEXT_DDL)
    # equal pages have equal nodes, so they may share one list
    named = needed.withColumn("page", F.sha2(F.concat_ws("\x01", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))).cast("binary"), 256))
    own = named.select("page", "url", "html").mapInArrow(_nodes, "page string, node long").join(low, "node")
    lists = own.groupBy("page").agg(F.collect_set("node").alias("low"))
    return named.join(lists, "page", "left").select("page_id", "url", "html", "low").mapInArrow(_extract(None), _TEXT_DDL)
