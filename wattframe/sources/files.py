"""File sources with explicit schemas (no schema inference at scale)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_feed_json(spark: SparkSession, path: str | list[str], schema: T.StructType,
                   multiline: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """Read feed records with a fixed schema.

    Landing files should be JSON lines (splittable, many tasks per file); responses saved as one JSON
    array are read by many tasks with :func:`wattframe.sources.json_arrays.read_json_array`
    (``multiline=True`` reads each file in a single task). Extra fields are ignored; values of the wrong
    type become NULL (PERMISSIVE mode). ``keep_corrupt`` adds the text of records
    that cannot be read as ``_corrupt_record`` (NULL for the others).
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
             blank_as_null: bool = True, with_file_order: str | None = None) -> DataFrame:
    """Read a headed CSV with a fixed schema; columns are taken by name.

    ``blank_as_null=True`` (default) reads blank string cells as NULL;
    ``False`` keeps them as '' so that blank keys join each other, as a
    loader that keeps empty strings does.
    ``with_file_order`` adds a column increasing in file order (for
    keep-first de-duplication); splits of one file keep their order.
    """
    df = read_csv_columns(spark, path, {f.name: f.dataType for f in schema.fields}, blank_as_null)
    if with_file_order:
        df = df.withColumn(with_file_order, F.monotonically_increasing_id())
    return df


def read_csv_columns(spark: SparkSession, path: str | list[str], columns: dict[str, T.DataType] | None = None,
                     blank_as_null: bool = True, others: bool = False) -> DataFrame:
    """Read a headed CSV that may carry extra columns in any order: every
    cell is read as text, then the named columns are selected and cast
    (ANSI-safe: values that do not parse become NULL). ``others`` keeps the
    file's other columns after them, as text."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    columns = dict(columns or {})
    if others:
        columns |= {c: T.StringType() for c in raw.columns if c not in columns}
    out = []
    for name, dtype in columns.items():
        c = F.col(f"`{name}`")
        if blank_as_null:
            c = F.when(c != "", c)
        elif isinstance(dtype, T.StringType):
            c = F.coalesce(c, F.lit(""))
        out.append((c if isinstance(dtype, T.StringType) else c.try_cast(dtype)).alias(name))
    return raw.select(*out)


def read_parquet_table(spark: SparkSession, path: str, days: tuple[str, str] | None = None,
                       partition_col: str = "settlement_date_partition") -> DataFrame:
    """Read a (Hive-partitioned) Parquet table; ``days`` prunes partitions."""
    df = spark.read.parquet(path)
    if days is not None:
        part = F.col(partition_col)
        df = df.where((part >= F.lit(days[0]).cast("date")) & (part <= F.lit(days[1]).cast("date")))
    return df


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of a dataset's Parquet files, one row per file; no file is opened."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
            .load(path).select("path", "length"))


def _children(spark: SparkSession, path: str) -> list[str] | None:
    """Names directly below ``path`` (one listing of that folder), None if it does not exist."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else None


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a dataset has been written at ``path``; only that folder itself is listed."""
    return any(not n.startswith(("_", ".")) for n in _children(spark, path) or [])


def stored_days(spark: SparkSession, path: str, partition_col: str) -> set[str]:
    """Values of ``partition_col`` that have a folder, from one listing of the table's own folder."""
    head = f"{partition_col}="
    return {n[len(head):] for n in _children(spark, path) or [] if n.startswith(head)}


#: Folder name of a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def read_days(spark: SparkSession, path: str, days: list[str], schema: T.StructType | None = None,
              partition_col: str = "settlement_date_partition") -> DataFrame:
    """The rows of some stored days, from their folders alone: no other day is listed.

    ``schema`` adds the columns that older files may lack (they read as NULL).
    """
    folders = [f"{path.rstrip('/')}/{partition_col}={d}" for d in days]
    reader = spark.read.option("basePath", path)
    if schema is not None:
        first = reader.parquet(folders[-1]).schema
        known = set(schema.names)
        schema = T.StructType([*schema.fields, *[f for f in first.fields if f.name not in known]])
        reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*folders)
