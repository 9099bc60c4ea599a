"""Personal data by weak supervision.

Candidates come from strict and loose patterns for four kinds of personal data and for secrets (access
tokens and keys), which have no strict format of their own.  Labelers
vote on each candidate, for (1), against (-1) or not at all (0): does it hold
to the strict format, is its prefix or suffix in a gazetteer, does a word
nearby speak of the kind, does it stand free of letters and digits.
Expectation-maximisation on the counts of vote patterns estimates how reliable
each labeler is for each kind; the posteriors then train a logistic regression
on votes and shape, which decides the candidates.  Spans of the strict format always stay.

Texts are matched in the row, with SQL functions; candidates, a few per text,
are the only rows that are shuffled.  The two models are fitted on tables of
distinct (kind, votes, shape) with their counts, which have at most
5 * 3**4 * 9 rows however many candidates there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import checkpointed

KINDS = ("email", "ip", "card", "phone", "secret")
#: Those with a strict format.
BASE_KINDS = KINDS[:4]

#: Strict patterns: the fixed ones of the contract, written without backtracking so that long runs cost linear time.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Loose patterns, whose matches only count if the classifier takes them.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9.])[0-9]{4}(?:\.[0-9]{4}){3}(?![0-9.])",
    "secret": r"(?<![0-9A-Za-z_-])(?:[0-9A-Fa-f]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|(?:sk|pk|rk)[_-][0-9A-Za-z_-]{20,}|xox[abprs]-[0-9A-Za-z-]{10,})(?![0-9A-Za-z_-])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z.-])",
}
#: A part of an address, 0 to 255.
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: Gazetteers: endings of mail domains, first digits of cards, country codes.
DOMAINS = ("com", "net", "org", "edu", "gov", "io", "info", "biz", "example", "invalid", "uk", "de", "fr", "es", "it", "nl", "eu", "us", "ca", "au", "jp", "cn", "in", "br")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|62|64|65|35)"
#: Beginnings of keys by who issues them, and lengths that tokens in hexadecimal have, as digests of files do.
KEY_ISSUERS = r"^(?:AKIA|gh[pousr]_|[spr]k[_-]|xox)"
KEY_LENGTHS = r"^(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{64})$"
COUNTRY_CODES = r"^(?:\+|00)?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
#: Words that speak of a kind when they stand shortly before it.
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|correo|courriel|reply|address)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|login|from|client|ping)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment|tarjeta|karte|carte)\b",
    "secret": r"(?i)\b(?:token|secret|key|apikey|passw(?:or)?d|pwd|auth(?:orization)?|bearer|credentials?|contraseña|kennwort|passwort|clave|clé)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|mobile|cell|call|fax|whatsapp|sms|handy|telefon|tel[eé]fono)\b",
}
ASSIGNED = r"[\"']?\x20?[:=]\x20?[\"']?$"
AGAINST = r"(?i)\b(?:version|isbn|order|invoice|section|chapter|serial|no|nr|id|ref|commit|sha-?[0-9]{0,3}|md5|checksum|digest|etag|uuid)\b[.:#=]?\x20?[\"']?$"

LABELERS = ("format", "gazetteer", "context", "border")
#: Share of candidates and reliabilities before the first step: labelers are taken to be right more often than not.
START_SHARE, START_RIGHT = 0.5, {"format": 0.9, "gazetteer": 0.7, "context": 0.8, "border": 0.7}
EM_STEPS, FIT_STEPS = 40, 200
ACCEPT = 0.9
#: Words of left context that a labeler reads, in characters.
NEAR = 40
_BLOCK = 256


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n + 1 - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _strict_ok(kind: Column, span: Column) -> Column:
    """Whether a match of a kind's strict pattern holds to the format."""
    digits = _digits(span)
    n = F.length(digits)
    return (F.when(kind == "email", True)
            .when(kind == "ip", span.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
            .when(kind == "card", F.when(n.between(12, 19), _luhn(digits)).otherwise(False))
            .otherwise(n.between(9, 15)))


def _matches(text: Column) -> Column:
    """Array of (kind, strict, found, between) for the patterns that match; ``between`` are the pieces around the matches."""
    made = []
    for kind in KINDS:
        needs = text.contains("@") if kind == "email" else text.rlike("[0-9]")
        for strict, pattern in ((True, STRICT.get(kind)), (False, LOOSE[kind])):
            if pattern is None:
                continue
            if kind == "secret":
                needs = F.octet_length(text) >= 20
            if kind == "email" and not strict:
                needs = text.contains("at)") | text.contains("at]")
            found = F.when(needs, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
            made.append(F.struct(F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), F.lit(pattern).alias("pattern"), found.alias("found")))
    return F.filter(F.array(*made), lambda x: F.size(x["found"]) > 0)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Candidate spans with votes, and one row without a span for each text that has none.

    Columns: ``row`` (one for each row of ``docs``), ``doc_id, kind, strict,
    start, end`` (code points, end exclusive), ``ok`` (strict format holds),
    the labelers' votes and ``shape``.
    """
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hit = (base.withColumn("m", _matches(F.col("text"))).select("row", "doc_id", "text", F.explode_outer("m").alias("m"))
           .select("row", "doc_id", "m.kind", "m.strict", "m.found",
                   F.when(F.col("m.kind").isNotNull(), F.expr("split(text, m.pattern, -1)")).alias("between")))
    # start of each match: running lengths, by blocks so that very many matches in a text stay cheap
    hit = hit.withColumn("step", F.zip_with("between", "found", lambda a, b: F.length(a) + F.coalesce(F.length(b), F.lit(0))))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda acc, x: acc + x)
    last = F.floor((F.size("found") - 1) / _BLOCK).cast("int")
    hit = hit.withColumn("block", F.when(F.col("kind").isNotNull(), F.transform(F.sequence(F.lit(0), last), lambda j: total(F.slice(F.col("step"), j * _BLOCK + 1, F.lit(_BLOCK))))))
    hit = hit.withColumn("upto", F.transform(F.col("block"), lambda x, j: total(F.slice(F.col("block"), F.lit(1), j))))

    def spot(span: Column, i: Column) -> Column:
        j = F.floor(i / _BLOCK).cast("int")
        left = F.get(F.col("between"), i)
        start = F.get(F.col("upto"), j) + total(F.slice(F.col("step"), j * _BLOCK + 1, i - j * _BLOCK)) + F.length(left)
        return F.struct(span.alias("span"), start.alias("start"), F.right(left, F.lit(NEAR)).alias("left"), F.left(F.get(F.col("between"), i + 1), F.lit(2)).alias("right"))

    one = (hit.select("row", "doc_id", "kind", "strict", F.explode_outer(F.transform(F.col("found"), spot)).alias("s"))
           .select("row", "doc_id", "kind", "strict", F.col("s.span").alias("span"), F.col("s.start").alias("start"), (F.col("s.start") + F.length("s.span")).alias("end"),
                   F.col("s.left").alias("left"), F.col("s.right").alias("right")))
    kind, span = F.col("kind"), F.col("span")
    digits = F.length(_digits(span))
    by_kind = F.coalesce(*[F.when(kind == k, F.col("left").rlike(CONTEXT[k])) for k in KINDS], F.lit(False))
    known = (F.when(kind == "email", F.regexp_extract(F.lower(span), r"([a-z0-9-]+)$", 1).isin(*DOMAINS))
             .when(kind == "ip", ~span.rlike(r"^0*(?:0|255)\.")).when(kind == "card", _digits(span).rlike(ISSUERS))
             .when(kind == "secret", F.when(span.rlike(KEY_ISSUERS), True).when(~span.rlike(KEY_LENGTHS), False)).otherwise(span.rlike(COUNTRY_CODES)))
    touching = F.col("left").rlike(r"[\p{L}\p{N}]$") | F.col("right").rlike(r"^[\p{L}\p{N}]")
    # a secret's format is that it is assigned to a word for it; that it is drawn from letters and digits alike holds for digests too
    drawn = span.rlike("[0-9]") & span.rlike("[A-Za-z]")
    votes = {"format": F.when(kind == "secret", F.when(F.col("left").rlike(CONTEXT["secret"] + ASSIGNED), 1).when(drawn, 0).otherwise(-1)).when(F.col("strict"), F.when(F.col("ok"), 1).otherwise(-1)).otherwise(0), "gazetteer": _vote(known, ~known),
             "context": _vote(by_kind & ~F.col("left").rlike(AGAINST), F.col("left").rlike(AGAINST)), "border": _vote(~touching, touching)}
    shape = F.when(digits <= 8, 0).when(digits <= 12, 1).otherwise(2) * 3 + F.when(F.length(span) <= digits, 0).when(F.length(span) <= digits + 4, 1).otherwise(2)
    out = one.withColumn("ok", F.col("strict") & _strict_ok(kind, span)).withColumns({k: v.cast("int") for k, v in votes.items()}).withColumn("shape", shape.cast("int"))
    # a lone number is no candidate for a card
    out = out.withColumn("kind", F.when((kind == "card") & ~digits.between(12, 19), None).otherwise(kind))
    return out.select("row", "doc_id", "kind", "strict", "start", "end", "ok", *LABELERS, "shape")


def reliabilities(patterns: list[tuple[dict, int]]) -> tuple[float, dict, list[float]]:
    """Expectation-maximisation for one kind: from (votes, count) to (share of true candidates, vote odds, posteriors)."""
    share = START_SHARE
    prob = {y: {k: {v: (START_RIGHT[k] if (v == 1) == bool(y) else 1 - START_RIGHT[k]) if v else 0.5 for v in (-1, 0, 1)} for k in LABELERS} for y in (0, 1)}
    post = []
    for _ in range(EM_STEPS):
        post = []
        for votes, _n in patterns:
            yes, no = math.log(share), math.log(1 - share)
            for k in LABELERS:
                yes, no = yes + math.log(prob[1][k][votes[k]]), no + math.log(prob[0][k][votes[k]])
            post.append(1 / (1 + math.exp(min(50.0, max(-50.0, no - yes)))))
        n = sum(c for _, c in patterns)
        share = (sum(p * c for p, (_, c) in zip(post, patterns, strict=True)) + 1) / (n + 2)
        for y in (0, 1):
            held = [(p if y else 1 - p) * c for p, (_, c) in zip(post, patterns, strict=True)]
            for k in LABELERS:
                # prior counts keep a labeler's odds on the side they started from until the data say otherwise
                start = {v: (START_RIGHT[k] if (v == 1) == bool(y) else 1 - START_RIGHT[k]) if v else 0.5 for v in (-1, 0, 1)}
                seen = {v: 2 * start[v] + sum(h for h, (votes, _) in zip(held, patterns, strict=True) if votes[k] == v) for v in (-1, 0, 1)}
                whole = sum(seen.values())
                prob[y][k] = {v: x / whole for v, x in seen.items()}
    return share, prob, post


def _features(votes: dict, shape: int) -> list[str]:
    return ["bias", f"shape={shape}", *[f"{k}={votes[k]}" for k in LABELERS]]


def fit_classifier(rows: list[tuple[dict, int, int]]) -> dict[str, float]:
    """Logistic regression for one kind from (votes, shape, count); labels are the posteriors of the votes."""
    merged: dict[tuple, int] = {}
    for votes, _, c in rows:
        key = tuple(votes[k] for k in LABELERS)
        merged[key] = merged.get(key, 0) + c
    keys = sorted(merged)
    _, _, post = reliabilities([(dict(zip(LABELERS, k, strict=True)), merged[k]) for k in keys])
    label = dict(zip(keys, post, strict=True))
    data = [(_features(v, s), label[tuple(v[k] for k in LABELERS)], c) for v, s, c in sorted(rows, key=lambda r: (tuple(r[0][k] for k in LABELERS), r[1]))]
    total = sum(c for _, _, c in data)
    weights: dict[str, float] = {}
    for _ in range(FIT_STEPS):
        slope: dict[str, float] = {}
        for names, y, c in data:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights.get(n, 0.0) for n in names)))))
            for n in names:
                slope[n] = slope.get(n, 0.0) + c * (y - p)
        for n, g in slope.items():
            weights[n] = weights.get(n, 0.0) + 1.5 * (g / total - 1e-4 * weights.get(n, 0.0))
    return weights


def find_pii(docs: DataFrame, accept: float = ACCEPT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in every text.

    Returns ``doc_id, spans`` and ``base``, two arrays of (start, kind_no, end)
    in that order: all spans, and those of the strict formats.  A loose
    candidate counts if the classifier gives it ``accept`` or more and it
    overlaps no strict span and no accepted span that starts before it.  Null text is empty;
    repeated rows are returned as often as they occur; other columns are ignored; no rows give no rows.
    """
    found = checkpointed(candidates(docs, id_col, text_col))
    table = found.where("kind IS NOT NULL").groupBy("kind", *LABELERS, "shape").agg(F.count("*").alias("c")).collect()  # at most 5 * 3**4 * 9 rows
    score = F.lit(None).cast("double")
    for kind in KINDS:
        rows = [({k: r[k] for k in LABELERS}, r["shape"], r["c"]) for r in table if r["kind"] == kind]
        if rows:
            w = fit_classifier(rows)
            z = F.lit(w.get("bias", 0.0))
            for name in (*LABELERS, "shape"):
                part = F.lit(0.0)
                for n, x in w.items():
                    if n.startswith(name + "="):
                        part = F.when(F.col(name) == int(n.split("=")[1]), F.lit(x)).otherwise(part)
                z = z + part
            score = F.when(F.col("kind") == kind, 1 / (1 + F.exp(-z))).otherwise(score)
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    span = F.struct(F.col("start"), number.alias("kind_no"), F.col("end"))
    sure = F.col("kind").isNotNull() & F.col("ok")
    maybe = F.col("kind").isNotNull() & ~F.col("ok") & (score >= accept)
    by_text = found.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.when(sure, span))).alias("base"), F.array_sort(F.collect_list(F.when(maybe, span))).alias("maybe"))
    over = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    free = by_text.withColumn("maybe", F.filter("maybe", lambda x: ~F.exists(F.col("base"), lambda b: over(x, b))))
    added = free.withColumn("added", F.filter("maybe", lambda x, i: ~F.exists(F.slice(F.col("maybe"), F.lit(1), i), lambda b: over(x, b))))
    return added.select("doc_id", F.array_sort(F.concat("base", "added")).alias("spans"), "base")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    name = lambda x: F.get(F.array(*map(F.lit, KINDS)), x["kind_no"])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda x: x["kind_no"] == KINDS.index(kind))).cast("long")
