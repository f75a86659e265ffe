"""Keep-one-row-per-key operators.

Both are aggregates over a struct. With strings in the struct Spark sorts on both sides of the
shuffle; a hot key still leaves one row per task, where a window ``row_number`` would sort its
whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, key: list[str], order: list[str], agg) -> DataFrame:
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_pick")
    out = df.groupBy(*key).agg(agg(packed).alias("_pick"))
    return out.select(*key, *[F.col(f"_pick.{c}").alias(c) for c in df.columns if c not in key]).select(*df.columns)


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per ``key``: the one with the smallest ``order`` values
    (NULL sorts first). Pass an explicit file-order column for keep-first."""
    return _pick(df, key, order, F.min)


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per ``key``: the one with the largest ``order`` values
    (NULL sorts lowest); remaining columns break exact ties."""
    return _pick(df, key, order, F.max)
