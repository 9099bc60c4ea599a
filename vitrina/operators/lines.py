"""Line-oriented parsing of listing and detail pages.

A page is one row.  Its lines are an array; heading lines cut it into blocks,
and "the last matching line wins" is the last element of the block's matches.
All of it is done in the row, so nothing is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions import text as X

# Markers of working-paper lines in a listing.
WORKING_PAPER_MARKERS = ["Working Paper", "Documento de Trabajo", "WP_"]
# Paper listing heading: "## [title](url)" (D1: the intended linked heading).
PAPER_HEADING = r"^## \[(.+?)\]\((.+?)\)"


def page_lines(pages: DataFrame, key: str, text_col: str) -> DataFrame:
    """One row per line: (key, line_no, line), line_no 0-based."""
    return pages.select(key, F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"))
                        .alias("line_no", "line"))


def marked_lines(pages: DataFrame, key: str, text_col: str, markers: list[str],
                 width: int = 120) -> DataFrame:
    """Lines containing any marker, stripped and cut to ``width``."""
    ln = page_lines(pages, key, text_col)
    hit = reduce(lambda a, b: a | b, [F.col("line").contains(m) for m in markers])
    return ln.filter(hit).select(key, "line_no",
                                 F.substring(X.strip_ws("line"), 1, width).alias("line"))


def _starts_with_any(c: Column, prefixes: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in prefixes])


def _blocks(pages: DataFrame, key: str, text_col: str, is_head) -> DataFrame:
    """One row per block: ``key, block`` (from 1), ``head`` (its heading line) and ``body`` (the lines up to the next).

    Lines before the first heading belong to none.  A page is cut up in its row: no shuffle.
    """
    lines = F.col("_lines")
    rows = pages.select(key, F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("_lines"))
    rows = rows.withColumn("_heads", F.filter(F.transform(lines, lambda x, i: F.when(is_head(x), i)), lambda i: i.isNotNull()))
    cut = F.transform("_heads", lambda at, i: F.struct(
        (i + 1).alias("block"), F.get(lines, at).alias("head"),
        F.slice(lines, at + 2, F.coalesce(F.get(F.col("_heads"), i + 1), F.size(lines)) - at - 1).alias("body")))
    return rows.select(key, "_lines", "_heads", F.explode(cut).alias("_b")).select(key, "_b.block", "_b.head", "_b.body")


def _last(body: Column | str, value) -> Column:
    """The last value that ``value`` finds in a line, or null."""
    return F.try_element_at(F.filter(F.transform(body, value), lambda v: v.isNotNull()), F.lit(-1))


def paper_listing(pages: DataFrame, key: str, text_col: str) -> DataFrame:
    """Parse a paper listing into one row per block.

    Block = lines from one ``## [title](url)`` heading to the next.  Within a
    block: ``Fecha:`` lines give ``Month YYYY`` (last match wins); other
    short lines that are not headings, links, images, bullets, urls or stop
    words are author candidates (last one wins).
    """
    def date(line: Column) -> Column:
        return F.when(line.contains("Fecha:"), X.blank_to_null(F.regexp_extract(F.lower(line), r"([a-z]+ \d{4})", 1)))

    def author(line: Column) -> Column:
        stripped, low = X.strip_ws(line), F.lower(line)
        stop = reduce(lambda a, b: a | b, [low.contains(w_) for w_ in X.AUTHOR_STOP_WORDS])
        ok = (~line.contains("Fecha:") & (stripped != "") & ~_starts_with_any(line, ["#", "[", "!", "*"])
              & (F.length(stripped) < 100) & ~line.startswith("http") & ~stop)
        return F.when(ok, stripped)

    b = _blocks(pages, key, text_col, lambda line: line.rlike(PAPER_HEADING))
    part = lambda i: X.strip_ws(F.regexp_extract("head", PAPER_HEADING, i))
    return b.select(key, F.col("block").cast("int").alias("block"), part(1).alias("title"), part(2).alias("url"),
                    X.capitalize(_last("body", date)).alias("date"), _last("body", author).alias("author_raw"))


def report_listing(pages: DataFrame, key: str, text_col: str, link_host: str) -> DataFrame:
    """Parse a report listing: ``##``/``###`` headings open blocks.

    A heading that is a Markdown link gives its text as title and its target
    as url, unless the block links an article itself (D12).  Per block: long
    date (``13 noviembre 2020``), first article link of the last line that has
    one, geography from the title, technique flag.
    """
    months = "|".join(X.LISTING_MONTHS)
    host = link_host.replace(".", r"\.")
    date = lambda line: X.blank_to_null(F.regexp_extract(F.lower(line), rf"(\d{{1,2}}\s+(?:{months})\s+\d{{4}})", 1))
    link = lambda line: X.blank_to_null(F.regexp_extract(line, rf'(?:href=")?(https?://{host}/[^"\s)]+)', 1))
    b = _blocks(pages, key, text_col, lambda line: line.startswith("### ") | line.startswith("## "))
    b = b.withColumn("_text", X.strip_ws(F.regexp_replace("head", r"^[# ]+", "")))
    linked = r"^\[(.+?)\]\((.+?)\)$"
    b = b.withColumn("title", F.when(F.col("_text").rlike(linked), X.strip_ws(F.regexp_extract("_text", linked, 1))).otherwise(F.col("_text")))
    marked = lambda line: line.contains(X.TECHNIQUE_MARKER)
    has_body = F.size("body") > 0
    return b.filter(F.col("title") != "").select(
        key, F.col("block").cast("int").alias("block"), "title", _last("body", date).alias("date_raw"),
        F.coalesce(_last("body", link), X.blank_to_null(F.regexp_extract("_text", linked, 2))).alias("url"),
        F.when(has_body, X.geography_from_title("title")).alias("geography"),
        F.when(has_body & (F.exists("body", marked) | marked(F.col("title"))), F.lit("big-data")).alias("technique"))
