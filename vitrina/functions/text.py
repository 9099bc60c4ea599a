"""Scalar text functions (X1-X25) as native Column expressions.

Every function takes and returns ``Column`` objects; none of them runs Python
per row.  They stay in whole-stage codegen, except those over lists, which use lambdas.  Regular expressions
use Java syntax; ``(?d)`` (UNIX_LINES) makes ``^``, ``$`` and ``.`` treat only
``\\n`` as a line end, as Python's ``re`` does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
# Geography names recognised at the start of a report title ("España | ...").
GEOGRAPHY_NAMES = ["España", "Global", "México", "Turquía", "Colombia", "Argentina",
                   "Perú", "EEUU", "Europa", "China"]
# Keywords that become tags when found in a dataset (operation) name.
DATASET_KEYWORDS = ["precio", "pib", "empleo", "población", "industria", "comercio",
                    "turismo", "vivienda", "salario", "consumo", "contabilidad"]
# Words that disqualify a listing line from being the author line.
AUTHOR_STOP_WORDS = ["fecha", "versión", "download", "pdf", "política", "funcas", "publicaciones"]
# Month names recognised in a report listing date ("13 noviembre 2020").
LISTING_MONTHS = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
                  "septiembre", "octubre", "noviembre", "diciembre", "january", "february",
                  "march", "april", "may", "june", "july", "august", "september", "october",
                  "november", "december"]
# Dimensions whose codes become series tags, and codes that give no tag.
TAG_DIMENSIONS = ["REF_AREA", "ADJUSTMENT", "ICP_SUFFIX"]
UNTAGGED_AREAS = ["ES", "U2"]
# Marker of the technique flag in report listings.
TECHNIQUE_MARKER = "Con técnicas Big Data"
# Base urls used for fallbacks.
REPORT_URL_BASE = "https://www.bbvaresearch.com/publicaciones/"
SERIES_API_BASE = "https://data-api.ecb.europa.eu/service/data/"
PDF_URL_PATTERN = r"https://www\.funcas\.es/wp-content/uploads/[^\"')\s]+\.pdf"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python's whitespace (``str.isspace``: ASCII blanks, U+001C-U+001F, U+0085,
# U+00A0, U+1680, U+2000-U+200A, U+2028/9, U+202F, U+205F, U+3000), derived
# by that rule so ``strip_ws`` equals ``str.strip()``.
WHITESPACE = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())


def strip_ws(c: Column | str) -> Column:
    """``str.strip()``: drop leading and trailing whitespace (a character trim, no regex)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    """``''`` becomes null so ``coalesce`` can express ``a or b``."""
    return F.nullif(_c(c), F.lit(""))


def or_else(*cols: Column | str) -> Column:
    """Python ``a or b or c`` over strings: first non-null, non-empty value."""
    return F.coalesce(*[blank_to_null(x) for x in cols[:-1]], _c(cols[-1]))


# ---------------------------------------------------------------------------
# X1 / X2 dates
# ---------------------------------------------------------------------------
# English month names, the only ones ``%B`` accepts in the C locale.
C_LOCALE_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august",
                   "september", "october", "november", "december"]
SPANISH_MONTHS = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
                  "septiembre", "octubre", "noviembre", "diciembre"]
_ISO = r"^(\d{4}-\d{1,2}-\d{1,2})(?:T(?:[01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)?)?$"


def _ymd(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def parse_date_iso(c: Column | str, spanish_months: bool = False) -> Column:
    """Free-form date text to ISO text.

    Tried in order, on the stripped text: ISO date, alone or as part of a stamp
    with or without offset (the local date is kept: no zone conversion),
    ``D Month YYYY``, ``D de Month de YYYY``, ``Month YYYY`` (day 1) and
    ``YYYY`` (Jan 1).  Month names are English, as in the C locale; with
    ``spanish_months`` also Spanish (D4).  Then the first four-digit run
    anywhere, then the first 10 characters.  Null and ``''`` give ``''``.

    Each form is one regular expression of its exact shape; the parts are put
    together as ``Y-M-D`` text and cast to a date, which rejects days that do
    not exist.  No lambda and no timestamp parse: it stays in whole-stage codegen.
    """
    raw = _c(c)
    s = strip_ws(raw)
    number = {name: i % 12 + 1 for i, name in enumerate(C_LOCALE_MONTHS + (SPANISH_MONTHS if spanish_months else []))}
    name = "(?i:" + "|".join(number) + ")"
    table = F.create_map(*[F.lit(x) for pair in number.items() for x in (pair[0], str(pair[1]))])
    month = F.element_at(table, F.lower(F.regexp_extract(s, name, 0)))
    year = F.right(s, F.lit(4))
    day = F.regexp_extract(s, r"^\d+", 0)

    def date(text: Column) -> Column:
        return F.when(~F.startswith(text, F.lit("0000")), text.try_cast("date").cast("string"))

    attempts = [
        F.when(s.rlike(_ISO), date(F.regexp_extract(s, _ISO, 1))),
        F.when(s.rlike(rf"^\d{{1,2}}\s+(?:{name}\s+|de\s+{name}\s+de\s+)\d{{4}}$"), date(F.concat_ws("-", year, month, day))),
        F.when(s.rlike(rf"^{name}\s+\d{{4}}$"), date(F.concat_ws("-", year, month, F.lit("1")))),
        F.when(s.rlike(r"^\d{4}$") & (s != "0000"), F.concat(s, F.lit("-01-01"))),
        blank_to_null(F.regexp_extract(raw, r"(\d{4})", 1)),
    ]
    return F.when(raw.isNull() | (raw == ""), F.lit("")).otherwise(F.coalesce(*attempts, F.substring(raw, 1, 10)))


def epoch_ms_date(c: Column | str, tz: str = "UTC") -> Column:
    """Epoch milliseconds to ``YYYY-MM-DD`` in zone ``tz`` (X2, D8: one rule).

    Text that is not an integer keeps its first 10 characters.
    """
    raw = _c(c)
    ms = raw.try_cast("bigint")
    utc = F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    local = utc if tz.upper() == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    return F.when(ms.isNotNull(), _ymd(local)).otherwise(F.substring(raw.cast("string"), 1, 10))


def year_of(c: Column | str) -> Column:
    """Four-digit year inside a date text, or null (D11: never ``date[:4]``)."""
    return blank_to_null(F.regexp_extract(_c(c), r"(\d{4})", 1))


def compact_date(c: Column | str) -> Column:
    """``2024-05-17`` -> ``20240517``."""
    return F.replace(_c(c), F.lit("-"), F.lit(""))


# ---------------------------------------------------------------------------
# X4 / X5 slugs, X23 / X24 ids
# ---------------------------------------------------------------------------
def slug40(c: Column | str) -> Column:
    """First 40 characters, lower case, non ``[a-z0-9]`` runs to ``-``, ``-`` trimmed."""
    s = F.regexp_replace(F.lower(F.substring(_c(c), 1, 40)), r"[^a-z0-9]+", "-")
    return F.regexp_replace(s, r"^-+|-+$", "")


def url_slug(c: Column | str, width: int = 50) -> Column:
    """Last path segment of a url (trailing ``/`` ignored), cut to ``width``."""
    trimmed = F.regexp_replace(_c(c), r"/+$", "")
    return F.substring(F.element_at(F.split(trimmed, "/"), -1), 1, width)


def item_id(prefix: str, key: Column | str, fallback: Column | None = None) -> Column:
    """``prefix-key``; when the key is blank and a fallback is given, ``prefix-fallback``."""
    k = _c(key).cast("string")
    if fallback is None:
        return F.concat(F.lit(prefix + "-"), k)
    return F.concat(F.lit(prefix + "-"), F.coalesce(blank_to_null(k), fallback.cast("string")))


def source_of_id(c: Column | str, sources: list[str]) -> Column:
    """First source name the id starts with, else null."""
    col = _c(c)
    out = F.lit(None).cast("string")
    for src in reversed(sources):
        out = F.when(col.startswith(src), F.lit(src)).otherwise(out)
    return out


def strip_source_prefix(c: Column | str, source: Column) -> Column:
    """Id without its ``source-`` prefix (the bundle slug)."""
    col = _c(c)
    prefix = F.concat(source, F.lit("-"))
    return F.when(col.startswith(prefix), F.substring(col, F.length(prefix) + 1, 1 << 30)) \
        .otherwise(col)


# ---------------------------------------------------------------------------
# X6-X8, X20 Markdown
# ---------------------------------------------------------------------------
def front_matter(c: Column | str, key: str) -> Column:
    """Header field ``key: "value"`` of a bundle, or null."""
    return blank_to_null(F.regexp_extract(_c(c), rf'(?md)^{key}:\s*"(.+)"$', 1))


def section(c: Column | str, name: str, width: int = 500) -> Column:
    """Body of ``## name`` up to the next ``##`` heading, stripped, cut.

    An empty section gives ``''`` (D3); a missing one gives null.
    """
    col = _c(c)
    pat = rf"(?sd)## {name}[ \t]*\n(.*?)(?=\n##|\z)"
    body = F.substring(strip_ws(F.regexp_extract(col, pat, 1)), 1, width)
    return F.when(col.rlike(rf"(?sd)## {name}[ \t]*(\n|\z)"), body)


def md_link_text(c: Column | str) -> Column:
    """Text of the first Markdown link ``[text](url)``."""
    return blank_to_null(F.regexp_extract(_c(c), r"\[(.+?)\]\((.+?)\)", 1))


def md_link_url(c: Column | str) -> Column:
    """Url of the first Markdown link ``[text](url)``."""
    return blank_to_null(F.regexp_extract(_c(c), r"\[(.+?)\]\((.+?)\)", 2))


def body_url(c: Column | str) -> Column:
    """Url in a bundle body line ``**URL:** [text](url)``."""
    return blank_to_null(F.regexp_extract(_c(c), r"\*\*URL:\*\*\s*\[.+?\]\((.+?)\)", 1))


def first_heading(c: Column | str) -> Column:
    """Text after the first ``# `` in a page."""
    return blank_to_null(strip_ws(F.regexp_extract(_c(c), r"(?d)# (.+)", 1)))


def pdf_urls(c: Column | str, pattern: str = PDF_URL_PATTERN) -> Column:
    """All pdf links of a page, in page order."""
    return F.regexp_extract_all(_c(c), F.lit(f"({pattern})"), 1)


def page_pdf(c: Column | str, pattern: str = PDF_URL_PATTERN) -> Column:
    """First pdf link, or null."""
    return F.try_element_at(pdf_urls(c, pattern), F.lit(1))


def page_pdf_english(c: Column | str, pattern: str = PDF_URL_PATTERN) -> Column:
    """Second pdf link when the page mentions English, else null."""
    col = _c(c)
    low = F.lower(col)
    english = low.contains("english") | low.contains("inglés")
    return F.when(english, F.try_element_at(pdf_urls(col, pattern), F.lit(2)))


def page_abstract(c: Column | str) -> Column:
    """Text after ``Resumen:`` up to ``##`` or the end, stripped; null if absent."""
    col = _c(c)
    return F.when(col.rlike(r"(?s)Resumen:(.+?)(##|$)"),
                  strip_ws(F.regexp_extract(col, r"(?s)Resumen:(.+?)(?:##|$)", 1)))


def page_date(c: Column | str) -> Column:
    """Bold text of the last ``Fecha:`` line that has one, stripped."""
    lines = F.split(_c(c), "\n")
    hits = F.filter(lines, lambda ln: ln.contains("Fecha:") & ln.rlike(r"\*\*(.+?)\*\*"))
    last = F.try_element_at(hits, F.lit(-1))
    return F.when(F.size(hits) > 0, strip_ws(F.regexp_extract(last, r"\*\*(.+?)\*\*", 1)))


# ---------------------------------------------------------------------------
# X9-X15 lists and flags
# ---------------------------------------------------------------------------
def split_authors(c: Column | str, sep: str = ",") -> Column:
    """Split an author list on ``sep``, strip each part, drop blanks."""
    parts = F.split(F.coalesce(_c(c), F.lit("")), r"\Q" + sep + r"\E")
    return F.filter(F.transform(parts, strip_ws), lambda x: x != "")


def authors_short(c: Column | str) -> Column:
    """First two names joined by ``, `` plus `` et al.`` when there are more."""
    arr = _c(c)
    head = F.array_join(F.slice(arr, 1, 2), ", ")
    return F.when(F.size(arr) > 2, F.concat(head, F.lit(" et al."))).otherwise(head)


def geography_from_title(c: Column | str) -> Column:
    """Leading geography name followed by ``|`` in a title, else null (X11)."""
    names = "|".join(GEOGRAPHY_NAMES)
    return blank_to_null(F.regexp_extract(_c(c), rf"^({names})\s*[|]", 1))


def geography_from_slug(c: Column | str) -> Column:
    """``España`` / ``Global`` / ``''`` from an id slug (X11)."""
    low = F.lower(_c(c))
    spain = low.contains("espana") | low.contains("españa") | low.contains("espa-a")
    return F.when(spain, F.lit("España")).when(low.contains("global"), F.lit("Global")) \
        .otherwise(F.lit(""))


def technique(line: Column | str, title: Column | str) -> Column:
    """``big-data`` when the marker is in the line or the title."""
    hit = _c(line).contains(TECHNIQUE_MARKER) | _c(title).contains(TECHNIQUE_MARKER)
    return F.when(hit, F.lit("big-data"))


def doc_type(title: Column | str, description: Column | str) -> Column:
    """``nota_tecnica`` if ``técnica`` appears in title or description, else ``documento_trabajo``."""
    hit = F.lower(_c(title)).contains("técnica") | F.lower(_c(description)).contains("técnica")
    return F.when(hit, F.lit("nota_tecnica")).otherwise(F.lit("documento_trabajo"))


def doc_type_tag(title: Column | str, description: Column | str) -> Column:
    return F.when(doc_type(title, description) == "nota_tecnica", F.lit("nota técnica")) \
        .otherwise(F.lit("documento de trabajo"))


def keyword_tags(c: Column | str, keywords: list[str] | None = None) -> Column:
    """Keywords contained in the lower-cased name, in list order."""
    low = F.lower(_c(c))
    kws = F.array(*[F.lit(k) for k in (keywords or DATASET_KEYWORDS)])
    return F.filter(kws, lambda k: F.instr(low, k) > 0)


def dim_tags(dims: Column | str) -> Column:
    """Lower-cased codes of the tag dimensions, except untagged areas."""
    m = _c(dims)
    vals = F.transform(F.array(*[F.lit(d) for d in TAG_DIMENSIONS]),
                       lambda d: F.try_element_at(m, d))
    kept = F.filter(vals, lambda v: v.isNotNull() & (v != "")
                    & ~v.isin(*UNTAGGED_AREAS))
    return F.transform(kept, F.lower)


def clean_quotes(c: Column | str, width: int | None = None) -> Column:
    """Double quotes to single quotes, optionally cut to ``width``."""
    out = F.replace(_c(c), F.lit('"'), F.lit("'"))
    return F.substring(out, 1, width) if width else out


def report_fallback_url(url: Column | str, slug: Column | str, base: str = REPORT_URL_BASE) -> Column:
    """Url, else ``base + slug + '/'``."""
    return F.coalesce(blank_to_null(url), F.concat(F.lit(base), _c(slug), F.lit("/")))


def series_api_url(flow: Column | str, dim_codes: Column | str, base: str = SERIES_API_BASE) -> Column:
    """``base/flow/A.B.C``; the flow itself when there are no codes."""
    codes = _c(dim_codes)
    path = F.when(F.coalesce(F.size(codes), F.lit(0)) > 0, F.array_join(codes, ".")) \
        .otherwise(_c(flow))
    return F.concat(F.lit(base), _c(flow), F.lit("/"), path)


_SCI = r"^(-?)(\d)\.(\d+)E(-?\d+)$"


def py_number(c: Column | str) -> Column:
    """Render a number the way the reference's texts show a JSON number.

    Integer-valued numbers print without ``.0`` (JSON integers stay integers);
    other values follow Python's ``repr``: plain notation from 1e-4 up to
    1e16, exponent form (``1e-05``, ``1.5e+16``) outside.  Java's
    ``Double.toString`` already gives the shortest round-trip digits; only the
    notation is rewritten.  Null prints ``None``.
    """
    v = _c(c).cast("double")
    s = v.cast("string")
    sign, d0, frac = (F.regexp_extract(s, _SCI, i) for i in (1, 2, 3))
    exp = F.regexp_extract(s, _SCI, 4).try_cast("int")
    frac_t = F.when(frac == "0", F.lit("")).otherwise(frac)
    digits = F.concat(d0, frac_t)
    big = F.when(F.length(digits) <= exp + 1,
                 F.concat(sign, F.rpad(digits, exp + 1, "0"), F.lit(".0"))) \
        .otherwise(F.concat(sign, F.substring(digits, F.lit(1), exp + 1), F.lit("."),
                            F.substring(digits, exp + 2, F.lit(400))))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    sci = F.concat(sign, d0, F.when(frac_t == "", F.lit("")).otherwise(F.concat(F.lit("."), frac_t)),
                   F.lit("e"), F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.lpad(F.abs(exp).cast("string"), 2, "0"))
    a = F.abs(v)
    return (F.when(v.isNull(), F.lit("None"))
            .when(F.isnan(v), F.lit("nan"))
            .when(v == float("inf"), F.lit("inf"))
            .when(v == float("-inf"), F.lit("-inf"))
            .when((v == F.floor(v)) & (a < 1e16), v.cast("bigint").cast("string"))
            .when(~s.contains("E"), s)
            .when((a >= 1e16) | (a < 1e-4), sci)
            .when(a >= 1e7, big)
            .otherwise(small))


def series_description(label: Column, name: Column, last_value: Column, count: Column,
                       date_iso: Column) -> Column:
    """``ECB {label} | {name} | Valor: {v} | Obs: {n} ({date})``."""
    return F.concat(F.lit("ECB "), label, F.lit(" | "), name, F.lit(" | Valor: "),
                    py_number(last_value), F.lit(" | Obs: "), count.cast("string"),
                    F.lit(" ("), date_iso, F.lit(")"))


def capitalize(c: Column | str) -> Column:
    """Python ``str.capitalize()``: first character upper, the rest lower."""
    col = _c(c)
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 1 << 30)))


def md_links(c: Column | str) -> Column:
    """All Markdown links ``[text](url)`` of a text as an array of (text, url) structs."""
    pat = r"\[(.*?)\]\((.+?)\)"
    return F.arrays_zip(F.regexp_extract_all(_c(c), F.lit(pat), 1).alias("text"),
                        F.regexp_extract_all(_c(c), F.lit(pat), 2).alias("url"))
