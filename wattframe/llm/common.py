"""Helpers shared by the text operators: tables, written intermediates, a bounded Bloom filter."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.session import scratch_dir

WORD_BREAK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table; also lets Python workers that are started from now on import this package.

    Clusters get the package by ``--py-files`` or an image; the path serves local sessions.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder.

    Cuts the lineage: what later stages read survives the loss of any executor.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, df: DataFrame) -> str:
    """``name``, or with underscores added, such that no column of ``df`` has it (columns are told apart without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_row(docs: DataFrame, stage) -> DataFrame:
    """``stage`` (documents that stay, decided by doc_id) applied to rows instead of ids.

    Where ids repeat or are missing, every row gets a key of its own in the order of doc_id (null
    last) for the time of the stage; other tables go through it as they are.
    """
    if not docs.groupBy("doc_id").count().where("doc_id is null or count > 1").head(1):
        return stage(docs)
    own = unused("own_id", docs)
    ordered = docs.orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text")).withColumn(own, F.col("doc_id"))
    keyed = written(ordered.withColumn("doc_id", F.monotonically_increasing_id()), "keyed-rows")
    return stage(keyed).withColumn("doc_id", F.col(own)).select(*docs.columns)


def word_count(text):
    """Column: number of white-space separated words; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    squeezed = F.regexp_replace(t, WORD, "w")
    return F.length(F.regexp_replace(squeezed, WORD_BREAK, "")).cast("long")


def crc_mod(column, n: int):
    """Column: crc32 of the value as text, modulo ``n``."""
    return F.crc32(column.cast("string")) % n


#: Slices of a filter: a value's slice is its remainder, so that slices are filled by tasks of their own.
_SLICES = 61


def bloom(df: DataFrame, column: str, max_bits: int = 29, probes: int = 3):
    """Bloom filter of a long column as a broadcast: about 12 bits for each distinct value.

    At most 2**max_bits bits (a bound on the broadcast, met beyond 40 million values): with more
    values the filter lets more rows pass, never fewer, and whoever uses it checks exactly
    afterwards. The values are dealt out by slice, each task fills the slices that it gets from its
    stream of rows, and only the slices reach the driver.
    """
    values = written(df.select(F.col(column).cast("long").alias("v")).where("v is not null").distinct(), "filter-values")
    log2_bits = min(max((12 * values.count() // _SLICES).bit_length(), 10), max_bits - 6)

    def fill(batches):
        slices: dict[int, np.ndarray] = {}
        for b in batches:
            v = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for s in np.unique(v % _SLICES).tolist():
                bits = slices.setdefault(s, np.zeros(1 << (log2_bits - 3), dtype=np.uint8))
                for i in _probes(v[v % _SLICES == s].view(np.uint64), log2_bits, probes):
                    np.bitwise_or.at(bits, i >> np.uint64(3), (1 << (i & np.uint64(7))).astype(np.uint8))
        for s, bits in slices.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([bits.tobytes()], pa.binary())], ["s", "bits"])

    dealt = values.repartition(_SLICES, F.pmod("v", F.lit(_SLICES)))
    found = {r["s"]: bytes(r["bits"]) for r in dealt.mapInArrow(fill, "s int, bits binary").collect()}
    empty = bytes(1 << (log2_bits - 3))
    return df.sparkSession.sparkContext.broadcast(b"".join(found.get(s, empty) for s in range(_SLICES)))


def _probes(values: np.ndarray, log2_bits: int, probes: int) -> list[np.ndarray]:
    from wattframe.llm.textops import mix

    h = mix(values)
    step = mix(h) | np.uint64(1)
    return [(h + np.uint64(k) * step) >> np.uint64(64 - log2_bits) for k in range(probes)]


def bloom_has(bits: np.ndarray, values: np.ndarray, probes: int = 3) -> np.ndarray:
    """Whether the filter may hold each of the values (unsigned, of the column's 64 bits)."""
    of_slice = len(bits) // _SLICES
    at = (values.view(np.int64) % _SLICES).astype(np.uint64) * np.uint64(of_slice)
    out = np.ones(len(values), dtype=bool)
    for i in _probes(values, (of_slice * 8).bit_length() - 1, probes):
        out &= (bits[at + (i >> np.uint64(3))] >> (i & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out
