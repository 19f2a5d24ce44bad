"""Money text parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prepaid_flag(c: Column | None) -> Column:
    """``ANTICIPADO`` when the instalment text mentions it, else ``NORMAL``."""
    if c is None:
        return F.lit("NORMAL")
    return F.when(F.upper(c.cast("string")).contains("ANTICIPADO"), F.lit("ANTICIPADO")).otherwise(F.lit("NORMAL"))


def parse_amount(c: Column, parity: bool = False) -> Column:
    """Instalment text -> double: ``ANTICIPADO`` (any case) -> 0, thousands
    commas removed, unparsable / NULL -> 0.

    ``parity=True`` removes only the first comma, as the source system does,
    so ``1,234,567`` fails to parse and becomes 0.
    """
    raw = c.cast("string")
    # the case-insensitive regex only runs on the rows that mention the word
    s = F.when(F.upper(raw).contains("ANTICIPADO"), F.regexp_replace(raw, "(?i)ANTICIPADO", "0")).otherwise(raw)
    if parity:
        s = F.when(s.contains(","), F.regexp_replace(s, "^([^,]*),", "$1")).otherwise(s)
    else:
        s = F.replace(s, F.lit(","), F.lit(""))
    return F.coalesce(s.try_cast("double"), F.lit(0.0))
