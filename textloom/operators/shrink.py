"""Narrow integer columns to the smallest type that holds their values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDTHS = ((T.ByteType(), 7), (T.ShortType(), 15), (T.IntegerType(), 31), (T.LongType(), 63))
_INTEGERS = tuple(type(t) for t, _ in _WIDTHS)


def shrink_schema(df: DataFrame) -> DataFrame:
    """Cast every integer column to the narrowest signed type that fits.

    One aggregate finds all extremes. It reads ``df`` once more, so shrink a
    stored or checkpointed frame, not the plan that computes it.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, _INTEGERS)]
    if not names:
        return df
    ends = df.agg(
        *[F.min(F.col(f"`{n}`")).alias(f"lo{i}") for i, n in enumerate(names)],
        *[F.max(F.col(f"`{n}`")).alias(f"hi{i}") for i, n in enumerate(names)],
    ).first()
    casts = {}
    for i, name in enumerate(names):
        low, high = ends[f"lo{i}"] or 0, ends[f"hi{i}"] or 0
        casts[name] = next(t for t, bits in _WIDTHS if -(2**bits) <= low and high < 2**bits)
    return df.select(
        *[
            F.col(f"`{c}`").cast(casts[c]).alias(c) if c in casts else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
