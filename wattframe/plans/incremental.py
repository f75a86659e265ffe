"""Incremental, idempotent ingest of day-partitioned generation data.

* windows: which settlement days a run loads (initial load, daily batch);
* high-water mark / catch-up: resume after missed runs;
* gap report: every day missing between the first and last loaded day;
* de-duplication of re-published rows;
* merge: by key into the touched days, so a re-run or a partial day loses and duplicates nothing;
* refresh: recompute derived daily totals for the touched days only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.constants import CAPACITY_HISTORY_START, INITIAL_LOAD_DAYS, PUBLISH_DELAY_DAYS
from wattframe.functions.numeric import total
from wattframe.operators.broadcast import materialised
from wattframe.operators.dedup import keep_last
from wattframe.plans.views import daily_generation_by_unit
from wattframe.schemas import GENERATION_KEY, PARTITION_COLUMN
from wattframe.sources import sinks
from wattframe.sources.files import read_days, table_files
from wattframe.sources.ledger import loaded_days

DateLike = dt.date | str | Column


def _date(d: DateLike) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


def ingest_windows(today: DateLike, initial_days: int = INITIAL_LOAD_DAYS,
                   delay_days: int = PUBLISH_DELAY_DAYS) -> dict[str, Column]:
    """Settlement days loaded by a run on ``today`` (data is published late).

    initial load: [today - initial_days, today - delay_days - 1];
    daily batch:  the single day today - delay_days (half-open [d, d + 1)).
    """
    t = _date(today)
    return {
        "initial_from": F.date_sub(t, initial_days),
        "initial_to": F.date_sub(t, delay_days + 1),
        "batch_day": F.date_sub(t, delay_days),
    }


def capacity_windows(today: DateLike, history_start: DateLike = CAPACITY_HISTORY_START) -> dict[str, Column]:
    """Publication-time windows of the capacity feed for a run on ``today``.

    initial load: [history_start, yesterday) ; daily batch: [yesterday, today),
    both half-open on ``publish_time`` midnights.
    """
    t = _date(today)
    return {
        "initial_from": _date(history_start),
        "initial_to": F.date_sub(t, 1),
        "batch_from": F.date_sub(t, 1),
        "batch_to": t,
    }


def in_publish_window(capacity: DataFrame, start: Column, end: Column) -> DataFrame:
    """Capacity rows published in [start, end) (dates, at midnight)."""
    ts = F.col("publish_time")
    return capacity.where((ts >= start.cast("timestamp_ntz")) & (ts < end.cast("timestamp_ntz")))


def ingest_window_report(generation: DataFrame, today: DateLike | None = None,
                         initial_days: int = INITIAL_LOAD_DAYS, delay_days: int = PUBLISH_DELAY_DAYS) -> DataFrame:
    """Rows and MWh per day in the initial and batch windows of ``today``.

    Without ``today`` the run date is the one whose batch day is the last
    day in the data. With a literal date the filter prunes partitions.
    """
    part = F.col(PARTITION_COLUMN)
    if today is None:
        today = F.date_add(generation.agg(F.max(PARTITION_COLUMN)).scalar(), delay_days)
    w = ingest_windows(today, initial_days, delay_days)
    picked = generation.where(part.between(w["initial_from"], w["batch_day"]))
    label = F.when(part == w["batch_day"], F.lit("batch")).otherwise(F.lit("initial"))
    return picked.groupBy(part.alias(PARTITION_COLUMN), label.alias("ingest_window")).agg(
        F.count(F.lit(1)).alias("n_rows"), total(F.col("quantity")).alias("total_quantity_mwh")
    )


def high_water_mark(table: DataFrame, partition_col: str = PARTITION_COLUMN) -> Column:
    """Last day present, as a scalar subquery. For a stored table pass its
    :func:`wattframe.sources.ledger.loaded_days`, which reads no data."""
    return table.agg(F.max(partition_col)).scalar()


def generation_window(spark, table_path: str, today: DateLike) -> tuple[str, str]:
    """First and last settlement day that a run on ``today`` asks for: the initial window if
    nothing is stored, else the batch day, or from the day after the last one stored if runs were
    missed. Days come from the table's ledger."""
    present = loaded_days(spark, table_path)
    w = ingest_windows(today)
    one = spark.range(1)
    if not present.head(1):
        row = one.select(w["initial_from"].alias("a"), w["initial_to"].alias("b")).first()
    else:
        row = catch_up(present, w["batch_day"]).select(F.col("request_from").alias("a"), F.col("scheduled_from").alias("b")).first()
    return str(row["a"]), str(row["b"])


def catch_up(table: DataFrame, scheduled_from: DateLike, partition_col: str = PARTITION_COLUMN) -> DataFrame:
    """One row: high-water mark, scheduled start and the start to request.

    If days were missed (mark < scheduled - 1) the run resumes the day after
    the mark; otherwise it keeps its schedule.
    """
    hwm = table.agg(F.max(partition_col).alias("high_water_mark"))
    sched = _date(scheduled_from)
    return hwm.select(
        "high_water_mark",
        sched.alias("scheduled_from"),
        F.when(F.col("high_water_mark") < F.date_sub(sched, 1), F.date_add("high_water_mark", 1))
        .otherwise(sched)
        .alias("request_from"),
    )


def settlement_dates_present(table: DataFrame, partition_col: str = PARTITION_COLUMN) -> DataFrame:
    return table.select(partition_col).distinct()


def settlement_dates_in_files(spark, path: str, partition_col: str = PARTITION_COLUMN) -> DataFrame:
    """Days present in a stored or landed Parquet dataset, from the listing of its files
    (``.../<partition_col>=YYYY-MM-DD/...``): one row per file, and no data file is opened."""
    day = F.regexp_extract("path", rf"{partition_col}=(\d{{4}}-\d{{2}}-\d{{2}})", 1)
    return table_files(spark, path).select(F.try_to_date(day).alias(partition_col)).where(F.col(partition_col).isNotNull()).distinct()


def missing_settlement_dates(table: DataFrame, partition_col: str = PARTITION_COLUMN) -> DataFrame:
    """Every day between the first and last day present that has no rows.

    The calendar has one row per day of the span (bounded by the date range,
    not by the data volume); the anti join is against distinct days.
    """
    present, _ = materialised(settlement_dates_present(table, partition_col), "days")  # used twice below
    span = present.agg(F.min(partition_col).alias("lo"), F.max(partition_col).alias("hi"))
    calendar = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias(partition_col))
    return calendar.join(present, partition_col, "left_anti")


def dedup_generation(loads: DataFrame, order: tuple[str, ...] = ("load_id", "quantity"),
                     drop: tuple[str, ...] = ("load_id",)) -> DataFrame:
    """One row per (bm_unit, settlement_date, settlement_period): the latest load
    wins (``order`` columns descending; the rest break exact ties).
    Bookkeeping columns in ``drop`` are removed from the result. Rows without a full key are
    no versions of each other: of them only whole copies are removed."""
    key = list(GENERATION_KEY)
    keyed = F.col(key[0]).isNotNull() & F.col(key[1]).isNotNull() & F.col(key[2]).isNotNull()
    return keep_last(loads.where(keyed), key, list(order)).drop(*drop).unionByName(loads.where(~keyed).drop(*drop).distinct())


def merge_days(batch: DataFrame, table_path: str, order: tuple[str, ...] = (), drop: tuple[str, ...] = ()) -> list:
    """Merge generation rows into the day-partitioned table by (unit, date, period): rows of a
    touched day that the batch does not hold stay, re-published ones are replaced, rows without a
    full key are kept as they are (:func:`wattframe.sources.sinks.merge_days`). Returns the touched days."""
    return sinks.merge_days(batch, table_path, list(GENERATION_KEY), order, drop, day_key="settlement_date")


def refresh_daily(daily_path: str, table_path: str, spark, days: list) -> None:
    """Recompute the daily totals of the touched ``days`` from the stored facts and overwrite only them."""
    if not days:
        return
    facts = read_days(spark, table_path, sorted(str(d) for d in days if d is not None))
    daily = daily_generation_by_unit(facts).withColumn(PARTITION_COLUMN, F.to_date("settlement_date"))
    sinks.write_days(daily, daily_path)
