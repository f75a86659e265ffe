"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by the digest of the normalised text. A batch is first
reduced to one row per digest (partial sums before the shuffle, so that a text with very many
copies is a few rows), the new digests are those of a sort-merge anti-join with the index, and
they are appended to it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm.common import WORD_BREAK, by_row, written
from wattframe.session import scratch_dir

INDEX_COLUMNS = "digest string, keep_id long, n_chars long"


def digest(text):
    """Column: SHA-256 (hex) of the text without white space; null counts as empty."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), WORD_BREAK + "+", "")
    return F.sha2(F.encode(bare, "UTF-8"), 256)


class DigestIndex:
    """Digests of all texts kept so far, in a catalog table bucketed and sorted by digest.

    ``table`` names the table; it is created when the first batch is added, below ``path`` (by
    default in the cluster's shared folder). ``buckets`` is fixed at creation: about one bucket
    for each 128 MB of index.
    """

    def __init__(self, spark: SparkSession, table: str | None = None, buckets: int = 16, path: str | None = None):
        self.spark, self.buckets, self.path = spark, buckets, path
        self.table = table or f"digest_index_{uuid.uuid4().hex[:12]}"

    def read(self) -> DataFrame:
        if self.spark.catalog.tableExists(self.table):
            return self.spark.table(self.table)
        return self.spark.createDataFrame([], INDEX_COLUMNS)

    def add(self, docs: DataFrame) -> DataFrame:
        """Deduplicate ``docs`` (doc_id, text) against the index and within itself, append what is new.

        Returns one row per row of ``docs``: doc_id, keep_id (the row whose text stays),
        group_size (equal texts in this batch), kept, text_sha256.

        Of equal texts in a batch the row with most code points in the original text stays,
        then the smallest doc_id (a null doc_id comes last). A text that is already in the index
        keeps the row of the earlier batch. Null texts count as empty; texts without any
        character left are equal to each other. Rows that repeat both doc_id and text count in
        group_size and are all marked kept when theirs is the row that stays.
        """
        rows = written(docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
            digest(F.col("text")).alias("digest")), "digests")
        # One row per digest and length, then per digest: only sums and minima of longs, which hash.
        lengths = rows.groupBy("digest", "n_chars").agg(F.count("*").alias("n"), F.min("doc_id").alias("keep_id"))
        batch = written(lengths.groupBy("digest").agg(
            F.max_by("keep_id", "n_chars").alias("keep_id"), F.max("n_chars").alias("n_chars"),
            F.sum("n").alias("group_size")), "batch-digests")
        new = batch.hint("merge").join(self.read().select("digest"), "digest", "left_anti")
        self._append(new.select("digest", "keep_id", "n_chars"))
        stays = written(
            batch.select("digest", "group_size", F.col("n_chars").alias("most")).hint("merge").join(
                self.read().select("digest", "keep_id", F.col("n_chars").alias("keep_chars")), "digest"), "stays")
        # A plain sort-merge join: adaptive execution splits the partition of a text with many copies.
        return rows.join(stays, "digest").select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))).alias("kept"),
            F.col("digest").alias("text_sha256"))

    def _append(self, new: DataFrame) -> None:
        writer = (new.repartition(self.buckets, "digest").write.format("parquet").mode("append")
                  .bucketBy(self.buckets, "digest").sortBy("digest"))
        if not self.spark.catalog.tableExists(self.table):
            writer = writer.option("path", self.path or scratch_dir(self.spark, "digest-index"))
        writer.saveAsTable(self.table)


def exact_dedup(docs: DataFrame, table: str | None = None) -> DataFrame:
    """One batch through the digest index ``table`` (a new index if none is named)."""
    return DigestIndex(docs.sparkSession, table).add(docs)


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each digest, all columns; ids may repeat or be null."""
    return by_row(docs, _kept)


def _kept(docs: DataFrame) -> DataFrame:
    gone = exact_dedup(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
