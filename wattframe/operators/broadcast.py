"""Size-checked broadcast.

A derived side (several joins deep) is written to the shared folder first. Its size in bytes is
then known, nothing is cached, a lost executor does not lose it, and neither the size check nor
the broadcast computes it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.session import scratch_dir

# Bytes of Parquet. Dimension rows are narrow, so this is some 100 MB in memory at most.
DEFAULT_MAX_BROADCAST_BYTES = 16 << 20


def materialised(df: DataFrame, name: str = "side") -> tuple[DataFrame, int]:
    """``df`` as a table in the shared folder, and its bytes (from the file listing alone)."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    size = listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return spark.read.schema(df.schema).parquet(path), int(size)


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, name: str = "side") -> tuple[DataFrame, bool]:
    """``df`` as a written table, marked for broadcast if its bytes are proven small; whether it is.

    Otherwise the join is left to the planner: sort-merge, where adaptive execution splits the
    partition of a hot key.
    """
    table, size = materialised(df, name)
    return (F.broadcast(table), True) if size <= max_bytes else (table, False)
