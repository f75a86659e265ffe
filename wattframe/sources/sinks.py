"""Sinks.

Day-partitioned tables are written with dynamic partition overwrite. :func:`merge_days` keeps the
stored rows of a touched day that the batch does not replace; :func:`write_days` replaces days.
"""

from __future__ import annotations

from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.operators.dedup import keep_last
from wattframe.schemas import PARTITION_COLUMN
from wattframe.session import scratch_dir
from wattframe.sources import ledger
from wattframe.sources.files import NULL_PARTITION, read_days, stored_days, table_exists

#: A stored day of more rows is merged and written in slices.
SLICE_ROWS = 1_000_000
#: Rows a key in a day of more than ``SLICE_ROWS`` rows, from which on tasks reduce their keys before the shuffle.
ROWS_A_KEY = 4


def write_days(
    df: DataFrame,
    path: str,
    partition_col: str = PARTITION_COLUMN,
    cluster_by: tuple[str, ...] = ("bm_unit",),
    rebalance: bool = True,
    lookup: tuple[str, ...] = ("bm_unit",),
) -> None:
    """Write ``df`` into ``path`` partitioned by day, replacing the days present as a whole.

    ``rebalance`` hashes days over the shuffle partitions, so a day is normally written by one
    task into one file, and adaptive execution splits a hot day over several tasks. Small
    partitions are not put together again: creating a day's file costs more than a task. Pass
    ``rebalance=False`` when ``df`` is already day-aligned (a row-wise transform of a scan of a
    day-partitioned table): each task then writes the day it read, with no shuffle. Within a
    file rows are sorted by unit so that the statistics of its row groups and pages prune unit filters;
    columns of ``lookup`` get a Bloom filter where their dictionary does not fit (see :func:`lookup_options`).
    """
    keys = [c for c in cluster_by if c in df.columns and c != partition_col]
    if rebalance:
        df = df.hint("rebalance", partition_col)
    out = df.sortWithinPartitions(partition_col, *keys)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col)
    writer = writer.options(**lookup_options(*[c for c in lookup if c in df.columns]))
    with _no_coalescing(df.sparkSession):
        writer.parquet(path)


@contextmanager
def _no_coalescing(spark: SparkSession):
    """Small shuffle partitions stay apart."""
    conf, setting = spark.conf, "spark.sql.adaptive.coalescePartitions.enabled"
    before = conf.get(setting)
    conf.set(setting, "false")
    try:
        yield
    finally:
        conf.set(setting, before)


def _repeats_keys(batch: DataFrame, key: list[str], sizes: dict, partition_col: str) -> bool:
    """Whether a day of more than ``SLICE_ROWS`` rows holds more than ``ROWS_A_KEY`` rows a key."""
    large = [d for d, n in sizes.items() if n > SLICE_ROWS]
    if not large:
        return False
    day = F.col(partition_col)
    of = day.isin([d for d in large if d is not None])
    n_keys = F.approx_count_distinct(F.xxhash64(*key)).alias("k")
    held = batch.where(of | day.isNull() if None in large else of).groupBy(day).agg(F.count("*").alias("n"), n_keys)
    return bool(held.where(F.col("n") > ROWS_A_KEY * F.col("k")).head(1))


def _slice(day: Column, spread: Column, sizes: dict) -> Column:
    """Number of a row's slice of its day: days of more than ``SLICE_ROWS`` rows have 2, 4, 8, ... slices."""
    by_count: dict[int, list] = {}
    for d, n in sizes.items():
        if n > SLICE_ROWS and d is not None:
            by_count.setdefault(1 << ((n - 1) // SLICE_ROWS).bit_length(), []).append(d)
    count = F.lit(1)
    for k, of in by_count.items():
        count = F.when(day.isin(of), k).otherwise(count)
    return F.pmod(spread, count.cast("long"))


def lookup_options(*columns: str) -> dict[str, str]:
    """Parquet options for columns that are looked up by value.

    A row group whose dictionary or Bloom filter does not hold the value is not read. The filter is
    written only for column chunks that outgrew their dictionary, and its size follows their values.
    """
    bloom = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return bloom | {"parquet.bloom.filter.adaptive.enabled": "true"} if columns else {}


def merge_days(batch: DataFrame, path: str, key: list[str], order: tuple[str, ...] = (), drop: tuple[str, ...] = (),
               partition_col: str = PARTITION_COLUMN, version: str | None = None, day_key: str | None = None) -> list:
    """Merge ``batch`` into the day-partitioned table at ``path`` by ``key``; returns the touched days.

    Rows of a touched day that the batch does not hold stay. Of the rows with one key the largest
    ``version`` wins, stored or new (a column that is stored, such as the time of landing; NULL is
    oldest); without it, or with equal ones, the batch's row replaces the stored one. Within the batch the largest
    ``order`` columns come next, then the other columns break ties. ``drop`` names bookkeeping columns
    that are not stored. A row with NULL in a key column has no key: it is kept beside the others, and
    only a row equal to it in every column but ``version`` is the same row.

    Only the folders of the touched days are read. The merged days are written to the shared
    folder before they replace the stored ones, so a failed run can be repeated, and their
    numbers of rows are appended to the table's ledger. Running a batch twice changes nothing.
    ``batch`` is evaluated twice: write it first if that is dear.

    ``day_key`` names the key column that the day follows from. Rows are then dealt out by it once, a large
    day in slices of its keys: the versions of a key meet where their day is written from, and nothing is
    shuffled by day again. Where a day holds far more rows than keys, each task reduces its keys first.
    """
    spark = batch.sparkSession
    sizes = dict(batch.groupBy(partition_col).count().collect())  # one row per calendar day
    days = list(sizes)
    if not days:
        return []
    stored = T.StructType([f for f in batch.schema.fields if f.name not in drop])
    rows = batch.withColumn("_load", F.lit(1))
    folders = sorted({NULL_PARTITION if d is None else str(d) for d in days} & stored_days(spark, path, partition_col))
    if folders:
        old = read_days(spark, path, folders, stored, partition_col).withColumn("_load", F.lit(0))
        rows = rows.unionByName(old, allowMissingColumns=True)
    columns = [c for c in rows.columns if c not in drop and c != "_load"]
    newest = [version] if version else []
    whole = [c for c in columns if c != version]
    same = list(key)
    if set(whole) != set(key):  # else the whole row is the key, NULLs included
        lacks = F.lit(False)
        for c in key:
            lacks = lacks | F.col(c).isNull()
        rows = rows.withColumn("_row", F.when(lacks, F.struct(*whole)))  # NULL beside a full key
        same.append("_row")
    dealt = day_key is not None and not _repeats_keys(batch, key, sizes, partition_col)
    if dealt:
        if folders and table_exists(spark, ledger.ledger_path(path)):
            for r in ledger.loaded_days(spark, path).collect():
                if r[0] in sizes:
                    sizes[r[0]] += r["n_rows"] or 0
        rows = rows.withColumn("_slice", _slice(F.to_date(day_key), F.xxhash64(*same), sizes)).repartition(day_key, "_slice")
        same = [day_key, "_slice", *[c for c in same if c != day_key]]
    merged = keep_last(rows, same, [*newest, "_load", *order]).select(*columns)
    stage = scratch_dir(spark, "merged-days")
    with _no_coalescing(spark) if dealt else nullcontext():
        merged.write.parquet(stage)
    merged = spark.read.schema(merged.schema).parquet(stage)
    write_days(merged, path, partition_col=partition_col, rebalance=not dealt)
    ledger.record(path, merged.groupBy(F.col(partition_col).alias("day")).agg(F.count("*").alias("n_rows")))
    return days


def write_table(df: DataFrame, path: str) -> None:
    """Unpartitioned overwrite (create-or-replace)."""
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """One file per task, each a single line that holds one JSON array: an empty object, then the records.

    Nothing is shuffled, and no task writes the rows of others.
    """
    def in_brackets(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_pydict({"value": ["[{}"]})
        yield from batches
        yield pa.RecordBatch.from_pydict({"value": ["]"]})

    texts = df.select(F.concat(F.lit(","), F.to_json(F.struct("*"))).alias("value"))
    texts.mapInArrow(in_brackets, "value string").write.mode("overwrite").option("lineSep", " ").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
