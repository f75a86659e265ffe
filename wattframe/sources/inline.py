"""Small constant tables built inside the JVM (no Python worker round trip)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _sql_literal(v, dtype: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(dtype, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({v!r} AS {dtype.simpleString()})"


def inline_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A DataFrame of literal rows: one ``VALUES`` statement, parsed in the JVM."""
    values = ", ".join(
        "(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(r, schema.fields)) + ")" for r in rows
    )
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
