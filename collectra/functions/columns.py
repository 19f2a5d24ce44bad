"""Schema-tolerant helpers: the landing tables may lack columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def q(name: str) -> Column:
    """Column by exact name (names like ``Meta_T.R_$`` need backticks)."""
    return F.col(f"`{name}`")


def has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def existing(df: DataFrame, cols) -> list[str]:
    """Listed columns that exist, de-duplicated, list order kept."""
    seen, out = set(), []
    for c in cols:
        if c in df.columns and c not in seen:
            seen.add(c)
            out.append(c)
    return out


def project_existing(df: DataFrame, cols) -> DataFrame:
    """Select the listed columns that exist; an empty list keeps all."""
    keep = existing(df, cols or [])
    return df.select(*[q(c) for c in keep]) if keep else df


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Add missing columns: ``{name: Column-or-literal}``; existing ones untouched."""
    add = {k: (v if isinstance(v, Column) else F.lit(v)) for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(add) if add else df


def guard_numeric(df: DataFrame, cols, default: float = 0.0) -> DataFrame:
    """Listed numeric columns: safe cast to double, NULL -> default; missing -> default."""
    out = {}
    for c in cols:
        if c in df.columns:
            out[c] = F.coalesce(q(c).try_cast("double"), F.lit(default))
        else:
            out[c] = F.lit(default).cast("double")
    return df.withColumns(out)


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])
