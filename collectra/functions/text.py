"""Text column expressions (all JVM-side, no per-row Python)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from collectra.schemas import NAME_STOP_WORDS

# (?U) makes \s match Unicode whitespace, like Python's str.split().
_WS = "(?U)\\s"
# every character Python's str.strip() removes, built by rule (all BMP)
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip_ws(c: Column) -> Column:
    """Strip all leading/trailing whitespace, as Python's ``str.strip()``.

    Spark ``trim`` strips blanks only; ``btrim`` with the whitespace set is
    a plain character scan (no regex), so it stays cheap per row.
    """
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def upper_strip(c: Column) -> Column:
    return F.upper(strip_ws(c))


def compact_upper(c: Column) -> Column:
    """Remove blanks, strip, upper-case (zone / support-centre codes)."""
    return F.upper(strip_ws(F.replace(c.cast("string"), F.lit(" "), F.lit(""))))


def normalize_phone(c: Column) -> Column:
    """Text, drop a trailing ``.0`` left by spreadsheet number formatting, strip."""
    s = c.cast("string")
    return strip_ws(F.when(s.endswith(".0"), F.left(s, F.length(s) - 2)).otherwise(s))


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters -> base letters, built from Unicode NFD by rule.

    Combining marks of their own stand at the end, without a counterpart:
    ``translate`` deletes them.
    """
    src, dst = [], []
    for cp in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        ch = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFD", ch) if unicodedata.category(x) != "Mn")
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    marks = [chr(cp) for cp in range(0x0300, 0x0370) if unicodedata.category(chr(cp)) == "Mn"]
    return "".join(src + marks), "".join(dst)


_ACCENTED, _PLAIN = _accent_table()


def fold_accents(c: Column) -> Column:
    return F.translate(c, _ACCENTED, _PLAIN)


def name_tokens(c: Column, stop_words=NAME_STOP_WORDS) -> Column:
    """Distinct tokens of a person name: lower, accents folded, split on
    whitespace, tokens longer than one char that are not stop words."""
    stops = F.array(*[F.lit(w) for w in stop_words])
    toks = F.split(fold_accents(F.lower(c.cast("string"))), f"{_WS}+")
    kept = F.filter(toks, lambda t: (F.length(t) > 1) & ~F.array_contains(stops, t))
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(kept))
