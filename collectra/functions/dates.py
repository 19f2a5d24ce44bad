"""Date parsing rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mixed_date(c: Column) -> Column:
    """Text -> date: first of ``yyyy-MM-dd`` on the first 10 chars, a full
    ``yyyy-MM-dd HH:mm:ss`` timestamp, or the first 10 chars with ``/`` read
    as ``-``.  Other layouts (e.g. ``dd/MM/yyyy``) give NULL."""
    s = c.cast("string")
    head = F.substring(s, 1, 10)
    return F.coalesce(
        F.try_to_date(head, "yyyy-MM-dd"),
        F.to_date(F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss"))),
        F.try_to_date(F.translate(head, "/", "-"), "yyyy-MM-dd"),
    )


def parse_mixed_dates(df: DataFrame, cols) -> DataFrame:
    """Existing columns become DateType: native date/timestamp truncated,
    text parsed with :func:`mixed_date`."""
    types = dict(df.dtypes)
    out = {}
    for c in cols:
        if c not in types:
            continue
        col = F.col(f"`{c}`")
        if types[c] == "date":
            continue
        if types[c].startswith("timestamp"):
            out[c] = F.to_date(col)
        else:
            out[c] = mixed_date(col)
    return df.withColumns(out) if out else df


def dates_to_text(df: DataFrame) -> DataFrame:
    """Every DateType column rendered as ``yyyy-MM-dd`` text."""
    out = {f.name: F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd")
           for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
    return df.withColumns(out) if out else df


def dmy_date(c: Column) -> Column:
    """Text ``d-m-y`` (``/`` allowed, 2-digit year -> 20yy) -> date, else NULL."""
    from collectra.functions.text import strip_ws
    s = F.translate(F.lower(strip_ws(c)), "/", "-")
    parts = F.split(s, "-")
    y = parts.getItem(2)
    y = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    ymd = F.concat_ws("-", y, parts.getItem(1), parts.getItem(0))
    return F.when(F.size(parts) == 3, F.try_to_date(ymd, "y-M-d"))
