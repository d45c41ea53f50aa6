"""Joins on values that a third of all rows may share.

The heavy values are split off by their share of the rows: at most ``1 / share`` values
can each hold that share, so the heavy part of a mapping has a proven size and is
broadcast; what is left has no heavy value, so its hash exchange is even.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_values(counts: DataFrame, value: str, n: str, share: float = 1e-3) -> DataFrame:
    """The values of ``counts`` (value, n) that hold at least ``share`` of all rows."""
    total = counts.agg(F.sum(n).alias("_total"))
    return counts.join(F.broadcast(total), F.col(n) >= F.col("_total") * share).select(value)


def join_by_value(rows: DataFrame, mapping: DataFrame, value: str, heavy: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``mapping`` (one row per ``value``) without a hot task."""
    top = F.broadcast(heavy.select(value).distinct())
    hot = rows.join(top, value, "left_semi").join(F.broadcast(mapping.join(top, value, "left_semi")), value, how)
    cold = rows.join(top, value, "left_anti").join(mapping, value, how)
    return hot.unionByName(cold)


def sized(frame: DataFrame, rows: int = 100_000) -> DataFrame:
    """``frame``, to be broadcast if it is counted to be small; else joined by exchange.

    Counted, not assumed: the plan depends on the size, the result does not. ``frame``
    should be materialised, since it is counted and then read.
    """
    return F.broadcast(frame) if frame.limit(rows + 1).count() <= rows else frame


def join_nullable(rows: DataFrame, other: DataFrame, key: str, heavy_share: float = 1e-3) -> DataFrame:
    """Left join on ``key`` where a value or null may hold a third of the rows.

    Null keys match nothing and never meet the exchange; heavy keys meet by broadcast.
    ``other`` has one row per key.
    """
    named = rows.where(F.col(key).isNotNull())
    counts = named.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    met = join_by_value(named, other, key, heavy_values(counts, key, "_n", heavy_share), "left")
    rest = rows.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields if f.name != key])
    return met.unionByName(rest)
