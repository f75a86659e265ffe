"""Landed JSON arrays of flat records, read by many tasks even if the file is one line.

The text is split at ``}``: a piece is then the text of one record, with a bracket or comma before
it, and the file can be cut anywhere between pieces. Pieces that are no whole record (a text value
that holds ``}``, a nested value) are put together again with their neighbours: pieces are numbered
within their split of the file, splits are added up, and a run of consecutive fragments is parsed as
an array of its own. A file in which some run still cannot be read that way is read whole, by one task.
The text is split and parsed once: what was read of each piece is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.operators.broadcast import materialised
from wattframe.sources.files import CORRUPT

_FILE = ("file", "modified")
#: What may stand between two records, and in front of the first one.
_BEFORE = " \t\n\x0b\f\r,["


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, modified, split, at, text): ``at`` ascends within a split."""
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"),
                        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"),
                        F.col("value").alias("raw"), F.ltrim("value", F.lit(_BEFORE)).alias("text"))


def _quotes(text):
    """Number of quotes that are not escaped."""
    plain = F.when(text.contains("\\"), F.regexp_replace(text, r"\\.", "")).otherwise(text)
    return F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """Records of JSON files that hold one array of objects each (on one line or many).

    Same records as a whole-file reader gives, plus ``landed_at`` (the file's modification time); extra fields are
    ignored, values of the wrong type are NULL, and a ``null`` body or a list end is no record. ``keep_corrupt``
    adds the text of what cannot be read as ``_corrupt_record``. Files of JSON lines read the same way.
    """
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    pieces = _pieces(spark, path)
    parsed = F.from_json(F.concat("text", F.lit("}")), fields, options)
    whole = F.col("text").startswith("{") & F.col(f"record.{CORRUPT}").isNull() & (_quotes(F.col("text")) % 2 == 0)
    end = F.regexp_replace("text", r"[\s\]]+", "").isin("", "null")
    read = pieces.withColumn("record", parsed).withColumn("whole", whole)
    read = read.select(*_FILE, "split", "at", "whole", F.when(F.col("whole"), F.col("record")).alias("record"),
                       F.when(~F.col("whole"), F.col("raw")).alias("raw"), F.when(~F.col("whole"), end).alias("end"))
    read, _ = materialised(read, "pieces")
    columns = [*schema.names, *([CORRUPT] if keep_corrupt else []), "landed_at"]

    fragments = read.where(~F.col("whole")).select(*_FILE, "split", "at", "raw", "end")
    if not fragments.where("not end").head(1):
        return read.where("whole").select("record.*", F.col("modified").alias("landed_at")).select(*columns)
    # Numbers of pieces within their file: their place in the split plus what the splits before it hold.
    held = read.groupBy("file", "split").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(F.col("file").alias("of"), F.col("split").alias("of_split"), "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                       F.sum("n").over(Window.partitionBy("file")).alias("n_pieces"))
    held, _ = materialised(held, "splits")
    placed = fragments.join(held, (F.col("file") == F.col("of")) & (F.col("split") == F.col("of_split"))).withColumn(
        "place", F.col("before") + F.col("at") - F.col("first"))
    run = F.col("place") - F.row_number().over(Window.partitionBy("file").orderBy("place"))
    last = F.col("place") == F.col("n_pieces") - 1
    runs = placed.withColumn("run", run).groupBy(*_FILE, "run").agg(
        F.array_sort(F.collect_list(F.struct("place", "raw", last.alias("is_last"), "end"))).alias("parts"))
    # Every piece but the file's last had a } after it; blank pieces that end the list say nothing.
    text = F.concat_ws("", F.transform("parts", lambda p: F.concat(
        F.when(p["is_last"] & p["end"], F.lit("")).otherwise(p["raw"]), F.when(p["is_last"], F.lit("")).otherwise(F.lit("}")))))
    opens = F.when(F.col("parts")[0]["place"] == 0, F.regexp_replace(text, r"^\s*\[", "")).otherwise(text)
    joined = runs.select(*_FILE, F.regexp_replace(opens, r"^[\s,]+|[\s,]+$", "").alias("text")).where("text != ''")
    listed = F.concat(F.lit("["), F.regexp_replace("text", r"\}\s*\n\s*\{", "},{"), F.lit("]"))  # JSON lines have no commas
    joined, _ = materialised(joined.select(*_FILE, listed.alias("text"), F.try_parse_json(listed).isNotNull().alias("readable")), "runs")
    bad = [r[0] for r in joined.where("not readable").select("file").distinct().collect()]  # files that are no lists of flat records

    def records(texts: DataFrame) -> DataFrame:
        """Records of (file, modified, text), each text an array; a text that is none is one unreadable record."""
        found = F.from_json("text", T.ArrayType(schema), options)
        some = texts.select(F.explode_outer(found).alias("record"), found.isNull().alias("none"), "text", F.col("modified").alias("landed_at"), "file")
        return some.select("record.*", F.when(F.col("none"), F.col("text")).alias(CORRUPT), "landed_at", "file")

    out = read.where("whole").select("record.*", F.col("modified").alias("landed_at"), "file").select(
        *schema.names, F.lit(None).cast("string").alias(CORRUPT), "landed_at", "file")
    out = out.unionByName(records(joined.where("readable")))
    if bad:
        entire = spark.read.option("wholetext", True).text(bad).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("text"))
        out = out.where(~F.col("file").isin(bad)).unionByName(records(entire))
    return out.select(*columns)
