"""Ledger of a day-partitioned table: which days are stored, with how many rows, since when.

Every merge appends one row per touched day, after the days have been replaced: a day that the
ledger names is stored. High-water mark, catch-up and gap report read this small table (one file
per load) and neither list nor open a file of the table itself. A run that stops between the two
writes leaves a day out of the ledger; it is asked for again, and the merge stores it unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.schemas import PARTITION_COLUMN
from wattframe.sources.files import stored_days, table_exists

SCHEMA = "day date, n_rows long, loaded_at timestamp"


def ledger_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}__ledger"


def record(table_path: str, counts: DataFrame) -> None:
    """Append (day, n_rows) of one load, as one file."""
    counts.select("day", F.col("n_rows").cast("long"), F.current_timestamp().alias("loaded_at")).coalesce(1).write.mode("append").parquet(
        ledger_path(table_path))


def loads(spark: SparkSession, table_path: str) -> DataFrame:
    """(day, n_rows, loaded_at) of every load of every day."""
    return spark.read.schema(SCHEMA).parquet(ledger_path(table_path))


def loaded_days(spark: SparkSession, table_path: str, partition_col: str = PARTITION_COLUMN) -> DataFrame:
    """(partition_col, n_rows, loaded_at): the last load of every stored day.

    A table that was stored without a ledger gets one from the names of its day folders, with
    unknown numbers of rows.
    """
    if not table_exists(spark, ledger_path(table_path)):
        names = [(d,) for d in sorted(stored_days(spark, table_path, partition_col))]
        found = spark.createDataFrame(names, "day string").select(F.try_to_date("day").alias("day"), F.lit(None).cast("long").alias("n_rows"))
        if not names:
            return found.select(F.col("day").alias(partition_col), "n_rows", F.lit(None).cast("timestamp").alias("loaded_at"))
        record(table_path, found.where("day is not null"))
    last = F.max_by("n_rows", "loaded_at").alias("n_rows")
    return loads(spark, table_path).where("day is not null").groupBy(F.col("day").alias(partition_col)).agg(
        last, F.max("loaded_at").alias("loaded_at"))
