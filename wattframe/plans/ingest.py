"""Landed feed records -> stored tables: clean, set aside what cannot be used, merge by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe import schemas
from wattframe.operators import clean
from wattframe.operators.broadcast import materialised
from wattframe.schemas import GENERATION_KEY, PARTITION_COLUMN
from wattframe.sources.files import CORRUPT, table_exists
from wattframe.sources.sinks import append_table, merge_days

CAPACITY_PARTITION = "publish_date"
#: When a record's file landed; stored with the facts, not part of the domain table.
LANDED_AT = "landed_at"


def _set_aside(raw: DataFrame, reason: Column, feed_cols: list[str], path: str | None) -> None:
    """Add the records that have a ``reason`` to the quarantine table, each once: a batch that is
    run again adds nothing."""
    if not path:
        return
    text = F.to_json(F.struct(*feed_cols))
    corrupt = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")
    found = raw.where(reason.isNotNull()).select(reason.alias("reason"), F.coalesce(corrupt, text).alias("record")).distinct()
    if table_exists(raw.sparkSession, path):
        known = raw.sparkSession.read.schema(found.schema).parquet(path).select(F.col("reason").alias("r"), F.col("record").alias("t"))
        found = found.join(known, F.col("reason").eqNullSafe(F.col("r")) & F.col("record").eqNullSafe(F.col("t")), "left_anti")
        found, _ = materialised(found, "set-aside")  # the table is not read while it is added to
    append_table(found, path)


def _unreadable(raw: DataFrame) -> Column:
    """Whether a record's text cannot be read; a ``null`` body is no such record."""
    if CORRUPT not in raw.columns:
        return F.lit(False)
    return F.coalesce(F.btrim(F.col(CORRUPT)) != "null", F.lit(False))


def merge_generation(raw: DataFrame, table_path: str, quarantine_path: str | None = None) -> list:
    """Merge raw generation records into the day-partitioned table; returns the touched days.

    The last landed record of a (unit, day, period) wins. ``landed_at``, if the records carry it, is
    stored with them, so that an older file that arrives later replaces nothing; records without a unit or period
    are kept beside the others. Unreadable records and records without a readable settlement date go to the quarantine
    table; a ``null`` response body (every field NULL) is nothing and is dropped.
    """
    cols = schemas.GENERATION_FEED.names
    unreadable = _unreadable(raw)
    empty = F.coalesce(*[F.col(c).cast("string") for c in cols]).isNull()
    day = clean.parse_timestamp(F.col("settlementDate"))
    reason = F.when(unreadable, F.lit("unreadable record")).when(~empty & day.isNull(), F.lit("no settlement date"))
    if quarantine_path:  # read for it and for the facts, but parsed once
        raw, _ = materialised(raw, "landed")
        _set_aside(raw, reason, cols, quarantine_path)
    if LANDED_AT not in raw.columns:
        raw = raw.withColumn(LANDED_AT, F.lit(None).cast("timestamp"))
    facts = clean.clean_generation(raw.where(~unreadable), keep=(LANDED_AT,)).where(F.col(PARTITION_COLUMN).isNotNull())
    facts, _ = materialised(facts, "landed-facts")  # the merge reads its batch several times
    return merge_days(facts, table_path, list(GENERATION_KEY), version=LANDED_AT, day_key="settlement_date")


def merge_capacity(raw: DataFrame, table_path: str, quarantine_path: str | None = None) -> list:
    """Merge raw capacity publications into the table partitioned by publish day.

    A publication has no key of its own: the whole row is, so a repeated one is stored once and
    nothing of a stored day is lost. Records without a unit or a publish time are set aside.
    """
    cols = schemas.CAPACITY_FEED.names
    unreadable = _unreadable(raw)
    empty = F.coalesce(*[F.col(c).cast("string") for c in cols]).isNull()
    at = clean.parse_timestamp(F.col("publishTime"))
    reason = F.when(unreadable, F.lit("unreadable record")).when(~empty & F.col("bmUnit").isNull(), F.lit("no unit")) \
        .when(~empty & at.isNull(), F.lit("no publish time"))
    raw, _ = materialised(raw, "landed")
    _set_aside(raw, reason, cols, quarantine_path)
    cap = clean.clean_capacity(raw.where(~unreadable)).withColumn(CAPACITY_PARTITION, F.to_date("publish_time"))
    cap = cap.where(F.col(CAPACITY_PARTITION).isNotNull())
    return merge_days(cap, table_path, cap.columns, partition_col=CAPACITY_PARTITION)
