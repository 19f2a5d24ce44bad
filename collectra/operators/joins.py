"""Join helpers: skew-tolerant outer join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_skew_safe(left: DataFrame, right: DataFrame, on, right_cols=None) -> DataFrame:
    """``left LEFT JOIN right USING (on)`` that survives a hot key on the right.

    AQE can split a skewed partition of the *preserved* side of a left outer
    join but not of the right side.  An inner join can be split on either
    side, so the fan-out part is computed as an inner join and the rows
    without a partner are added back with an anti join (NULL-padded).
    Null keys never match, exactly as in a left join: those rows skip both
    joins, so the inner and the anti join read the same non-null-key input
    and its shuffle is one stage that AQE reuses for both.
    """
    on = [on] if isinstance(on, str) else list(on)
    rcols = [c for c in (right_cols or right.columns) if c not in on]
    col = lambda c: F.col(f"`{c}`")  # noqa: E731  (names may contain dots)
    r = right.select(*[col(c) for c in on + rcols])
    keyed = reduce(lambda a, b: a & b, [col(c).isNotNull() for c in on])
    lk = left.where(keyed)
    lcols = [col(c) for c in left.columns]
    pad = [F.lit(None).cast(r.schema[c].dataType).alias(c) for c in rcols]
    matched = lk.join(r.where(keyed), on, "inner").select(*lcols, *[col(c) for c in rcols])
    unmatched = lk.join(r.select(*[col(c) for c in on]).where(keyed).distinct(), on, "left_anti")
    no_key = left.where(~keyed)
    return (matched.unionByName(unmatched.select(*lcols, *pad))
            .unionByName(no_key.select(*lcols, *pad)))
