"""Accent folding (X3): NFKD, then drop combining marks, on all planes.

The mapping is derived once, on the driver, from the Unicode database that
ships with Python; nothing is listed by hand.  It works character by character, so
the fold of a text is the folds of its characters in a row, and a text that contains
another still does after folding.  Characters whose folded form is one character
(``á`` -> ``a``) or nothing (combining marks) go into one JVM-side ``translate``.
Texts that hold a character with a longer form (found by a second ``translate``) are
first taken apart: Hangul syllables are decomposed by arithmetic on their code points, all
others (ligatures, fractions, circled and squared letters) are looked up by their
place in a string of all such characters.  Pure ASCII texts are left as they are.
"""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the Hangul decomposition: first syllable, and the first leading, middle and trailing letters with their numbers.
HANGUL, HANGUL_COUNT = 0xAC00, 11172
LEADING, MIDDLE, TRAILING = (0x1100, 19), (0x1161, 21), (0x11A8, 27)


def fold_py(s: str) -> str:
    """Reference rule in plain Python (used by tests and the exact path)."""
    return "".join(ch for ch in unicodedata.normalize("NFKD", s) if not unicodedata.combining(ch))


@functools.lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Return (matching, replace, expansions) built from ``unicodedata``.

    ``translate(c, matching, replace)`` maps ``matching[i]`` to ``replace[i]``
    and deletes characters of ``matching`` past the end of ``replace``;
    ``expansions`` are (character, longer form) pairs without the Hangul syllables.
    """
    pairs_from, pairs_to, deleted, expansions = [], [], [], []
    for cp in range(0x110000):
        if 0xD800 <= cp <= 0xDFFF or HANGUL <= cp < HANGUL + HANGUL_COUNT:
            continue
        ch = chr(cp)
        if unicodedata.combining(ch):
            deleted.append(ch)
            continue
        if not unicodedata.decomposition(ch):
            continue
        folded = fold_py(ch)
        if folded == ch:
            continue
        if len(folded) == 1:
            pairs_from.append(ch)
            pairs_to.append(folded)
        elif not folded:
            deleted.append(ch)
        else:
            expansions.append((ch, folded))
    return "".join(pairs_from) + "".join(deleted), "".join(pairs_to), tuple(expansions)


def _letters(first: int, count: int) -> Column:
    return F.lit("".join(chr(first + i) for i in range(count)))


def _taken_apart(text: Column) -> Column:
    """Every character that has a longer folded form replaced by that form."""
    _, _, expansions = fold_tables()
    keys, forms = F.lit("".join(c for c, _ in expansions)), F.array(*[F.lit(f) for _, f in expansions])

    def one(ch: Column) -> Column:
        n = F.ascii(ch) - HANGUL  # the code point of the character
        per = MIDDLE[1] * (TRAILING[1] + 1)
        at = lambda letters, i: F.substring(_letters(*letters), i.cast("int"), F.lit(1))
        trail = n % (TRAILING[1] + 1)
        hangul = F.concat(at(LEADING, F.floor(n / per) + 1), at(MIDDLE, F.floor(n % per / (TRAILING[1] + 1)) + 1),
                          F.when(trail > 0, at(TRAILING, trail)).otherwise(""))
        place = F.position(ch, keys)
        return (F.when(F.octet_length(ch) == 1, ch).when((n >= 0) & (n < HANGUL_COUNT), hangul)
                .when(place > 0, F.element_at(forms, place)).otherwise(ch))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def fold(c: Column | str) -> Column:
    """Accent-fold a string column with native expressions only."""
    col = F.col(c) if isinstance(c, str) else c
    matching, replace, expansions = fold_tables()
    longer = "".join(ch for ch, _ in expansions) + "".join(chr(HANGUL + i) for i in range(HANGUL_COUNT))
    # translate finds a character by hash; a regex class of so many ranges would try them one by one
    has_longer = F.char_length(F.translate(col, longer, "")) != F.char_length(col)
    whole = F.when(has_longer, _taken_apart(col)).otherwise(col)
    return F.when(F.octet_length(col) == F.char_length(col), col).otherwise(F.translate(whole, matching, replace))


@F.pandas_udf(T.StringType())
def _fold_exact_udf(s: pd.Series) -> pd.Series:
    import unicodedata as ud  # self-contained: no module globals on the worker

    def one(v):
        return None if v is None else "".join(ch for ch in ud.normalize("NFKD", v) if not ud.combining(ch))
    return s.map(one)


def fold_exact(c: Column | str) -> Column:
    """Exact NFKD folding for any script, as an Arrow-batched pandas UDF."""
    from pyspark.sql import SparkSession

    from vitrina.session import ship_package
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)  # the UDF lives in this module: workers must import it
    col = F.col(c) if isinstance(c, str) else c
    return _fold_exact_udf(col)
