"""Tables clustered by unit, which joins on the unit read without an exchange.

:func:`write_clustered` makes a catalog table of facts by month, with every month cut into buckets of
units; :func:`write_bucketed` gives a dimension the same buckets. A join of both reads bucket by bucket
(:func:`join_clustered`). A unit with more rows than an average bucket would make its bucket the one
long task: such units, at most as many as there are buckets, are noted with the table and joined apart,
from a plain scan that is split by size.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.schemas import PARTITION_COLUMN
from wattframe.sources.sinks import lookup_options

MONTH = "settlement_month"
BUCKET_BYTES = 1 << 30
HOT_UNITS = "wattframe.hot_units"


def buckets_for(n_bytes: int, least: int = 8, most: int = 1 << 14) -> int:
    """Buckets of about a gigabyte, a power of two: Spark joins tables whose numbers divide each other."""
    n = least
    while n * BUCKET_BYTES < n_bytes and n < most:
        n *= 2
    return n


def month_of(day) -> F.Column:
    return F.date_format(day, "yyyy-MM")


def write_clustered(facts: DataFrame, name: str, path: str, buckets: int, key: str = "bm_unit", day: str = PARTITION_COLUMN) -> None:
    """Replace the catalog table ``name`` at ``path`` by ``facts``, by month (column ``MONTH``) and bucket of ``key``.

    A bucket of a month is one sorted file; one that is much larger than the others is split by adaptive
    execution. Rows without a day or a key are kept (month NULL, first bucket). ``facts`` is evaluated twice.
    """
    spark = facts.sparkSession
    per_key = facts.groupBy(key).agg(F.count("*").alias("n"))
    share = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)) / buckets).scalar()
    # Fewer keys than buckets can have more rows than an average bucket.
    hot = sorted(r[0] for r in per_key.where((F.col("n") > share) & F.col(key).isNotNull()).select(key).collect())
    rows = facts.withColumn(MONTH, month_of(F.col(day)))
    dealt = rows.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets))).hint("rebalance", MONTH, "_bucket").drop("_bucket")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt.sortWithinPartitions(MONTH, key, day).write.mode("overwrite").options(path=path, **lookup_options(key)) \
        .partitionBy(MONTH).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{HOT_UNITS}' = '{_quoted(json.dumps(hot))}')")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "bm_unit") -> None:
    """Replace the catalog table ``name`` at ``path`` by ``df``, one sorted file a bucket of ``key``."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    df.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").option("path", path) \
        .bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def hot_units(spark: SparkSession, name: str) -> list[str]:
    """Units of a clustered table that have more rows than an average bucket."""
    row = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == HOT_UNITS).first()
    return json.loads(row["value"]) if row else []


def clustered(spark: SparkSession, name: str, days: tuple | None = None, day: str = PARTITION_COLUMN) -> DataFrame:
    """The facts of a clustered table; ``days`` (first, last; None leaves a side open) prunes months and filters days."""
    df = spark.table(name)
    for bound, cmp in zip(days or (None, None), ("__ge__", "__le__")):
        if bound is not None:
            value = F.lit(str(bound)).cast("date")
            df = df.where(getattr(F.col(MONTH), cmp)(F.lit(str(bound)[:7])) & getattr(F.col(day), cmp)(value))
    return df.drop(MONTH)


def join_clustered(facts: DataFrame, side: DataFrame, hot: list[str], key: str = "bm_unit") -> DataFrame:
    """``facts`` left-joined with ``side``, both over tables with the same buckets of ``key``.

    Units of ``hot`` are joined with their few rows of ``side`` by broadcast: their facts are read as
    splits of any size, not as one bucket.
    """
    if not hot:
        return facts.join(side.hint("merge"), key, "left")
    is_hot = F.col(key).isin(hot)
    many = facts.where(~is_hot | F.col(key).isNull()).join(side.where(~is_hot).hint("merge"), key, "left")
    few = facts.where(is_hot).join(F.broadcast(side.where(is_hot)), key, "left")
    return many.unionByName(few)
